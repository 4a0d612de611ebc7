"""Quality classifier: gated-attention multiple-instance learning over the passages of a document."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.common import held_out, in_small_batches

PASSAGE_WORDS, HIDDEN, GATE = 64, 24, 12
#: Labelled rows of each label that the model is fitted on at most, with all their passages.
TRAIN_ROWS = 1500
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 32, 0.01, 1e-3, 7
ACCEPT = 0.7

#: Kinds of byte: other, space, line end, a-z, A-Z, digit, full stop and comma, other sentence marks, quotes and
#: brackets, symbols, bytes of other letters.
KINDS = 11
_KIND = np.zeros(256, np.uint8)
for _k, _chars in enumerate((" \t", "\n\r\x0b\x0c", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,", "!?;:", "'\"()[]-", "#$%&*+/<=>@\\^_`{|}~"), 1):
    _KIND[[ord(c) for c in _chars]] = _k
_KIND[128:] = 10
FEATURES = KINDS * KINDS + 5


def passages(text: str | None) -> np.ndarray:
    """Features of every passage of ``PASSAGE_WORDS`` words: shares of pairs of byte kinds, repeated words, lengths.

    A null or empty text, or one of white space alone, is one passage of zeros.
    """
    words = text.split() if text else []
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    n = -(-len(words) // PASSAGE_WORDS)
    raw = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), np.uint8) if not ("\n" in text or "\r" in text) else np.frombuffer(text.strip().encode("utf-8", "surrogatepass"), np.uint8)
    kind = _KIND[raw]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # A passage's bytes: all up to the start of the word after it.
    blank = (kind == 1) | (kind == 2)
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if len(starts) != len(words):  # white space beyond ASCII: places by share of the bytes
        starts = (np.arange(len(words)) * len(raw)) // len(words)
    first = starts[::PASSAGE_WORDS]
    size = np.diff(np.append(first, len(raw)))
    pair = kind.astype(np.int64) * KINDS + np.append(kind[1:], 0)
    cells = np.bincount(pair + np.repeat(np.arange(n) * KINDS * KINDS, size) if first[0] == 0 else pair + np.clip(np.searchsorted(first, np.arange(len(raw)), "right") - 1, 0, None) * KINDS * KINDS, minlength=n * KINDS * KINDS)
    shares = cells.reshape(n, -1) / np.maximum(size, 1)[:, None]
    in_passage = np.arange(len(words)) // PASSAGE_WORDS
    count = np.bincount(in_passage, minlength=n)
    marks = np.fromiter(map(hash, words), np.int64, len(words))
    same = np.bincount(in_passage[1:], (marks[1:] == marks[:-1]) & (in_passage[1:] == in_passage[:-1]), n)
    order = np.lexsort((marks, in_passage))
    m, p = marks[order], in_passage[order]
    distinct = np.bincount(p, np.concatenate([[True], (m[1:] != m[:-1]) | (p[1:] != p[:-1])]), n)
    mean = np.bincount(in_passage, lengths, n) / count
    spread = np.sqrt(np.maximum(0, np.bincount(in_passage, lengths**2, n) / count - mean**2))
    more = np.stack([same / count, distinct / count, np.minimum(mean, 50) / 10, np.minimum(spread, 50) / 10, np.log1p(count) / 5], 1)
    return np.concatenate([shares, more], 1).astype(np.float32)


class AttentionModel:
    """Encoder h = tanh(Ex + e), gate a = softmax(w·(tanh(Vh) * sigmoid(Uh))) over a bag, score = sigmoid(c·Σah + b)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.mean, self.scale = mean, scale
        self.p = {"E": init(FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "b": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of all bags in order; first: where each bag begins."""
        p, size = self.p, np.diff(np.append(first, len(x)))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, first), size))
        a = s / np.repeat(np.add.reduceat(s, first), size)
        z = np.add.reduceat(a[:, None] * h, first)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": y, "size": size}

    def gradient(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, first)
        dy = (f["y"] - label) / len(label)
        dz = np.repeat(dy[:, None] * p["c"], f["size"], 0)
        da = (dz * f["h"]).sum(1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), f["size"]))
        dt, dg = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ dh, "e": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ ds, "c": f["z"].T @ dy, "b": dy.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), BATCH):
                some = order[at : at + BATCH]
                x = np.concatenate([bags[i] for i in some]).astype(np.float64)
                first = np.cumsum([0, *(len(bags[i]) for i in some[:-1])])
                step += 1
                for k, grad in self.gradient(x, first, labels[some]).items():
                    grad = grad + DECAY * self.p[k]
                    m, v = moments[k]
                    m[:] = 0.9 * m + 0.1 * grad
                    v[:] = 0.999 * v + 0.001 * grad**2
                    self.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        return self.forward(np.concatenate(bags), np.cumsum([0, *(len(b) for b in bags[:-1])]))["y"] if bags else np.empty(0)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> AttentionModel | None:
    """Fit on up to ``rows`` documents of each label whose id isn't held out, chosen by a hash of the id.

    Labels that are null, or whose document is missing, teach nothing; of several labels of an id the mean is rounded.
    None if there is no labelled document; with one label only, the model learns that label.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y")).where("doc_id is not null and y is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    picked = [known.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for v in (0, 1)]
    picked = picked[0].unionAll(picked[1])  # at most 2 * rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [passages(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.astype(np.float16).tobytes() for x in found], pa.binary())], ["doc_id", "y", "bag"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, bag binary").collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in sample]
    every = np.concatenate(bags)
    model = AttentionModel(every.mean(0), every.std(0) + 0.02)
    model.fit(bags, np.array([r["y"] for r in sample], float))
    return model


def score_quality(docs: DataFrame, model: AttentionModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(all columns of ``docs``' id and text, score): the score of every whole text; 0.5 everywhere without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # some kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            texts, scores, at = batch.column(1).to_pylist(), [], 0
            while at < len(texts):
                bags, size = [], 0
                while at < len(texts) and size < 1 << 20:
                    bags.append(passages(texts[at]))
                    size += len(texts[at] or "")
                    at += 1
                scores.append(model.score(bags) if model else np.full(len(bags), 0.5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row: fitted on labels that aren't held out, scored on the whole text.

    Null and empty texts get the score of an empty passage; without any label all score 0.5. Repeated rows are kept
    and score alike; an empty table gives an empty result; language, source and id are never inputs.
    """
    scored = score_quality(docs, fit_quality(docs, labels, id_col, text_col, label_col), id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def with_quality(docs: DataFrame, model: AttentionModel | None, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of every whole text as a column behind its own (one of that name is replaced)."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    place = docs.columns.index(text_col)
    names = [*docs.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            scores = [0.5 if model is None else float(model.score([passages(t)])[0]) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    return in_small_batches(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
