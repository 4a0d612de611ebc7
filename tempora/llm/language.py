"""Language identification with blended-spectrum string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import held_out

GRAMS, SLOTS = 3, 1 << 16
#: Documents of a language and of all languages that the model is fitted on at most, and landmarks among them.
TRAIN_ROWS, TRAIN_TOTAL, LANDMARKS, RIDGE = 300, 6000, 256, 1e-3
#: Documents whose presence rows are multiplied at once.
BLOCK = 64
#: A letter is of Unicode category L.
_letter = regex.compile(r"\p{L}").search
UNKNOWN = "und"


def presence(text: str) -> np.ndarray:
    """Sorted slots of the distinct character 1-, 2- and 3-grams of a lower-cased text, digits as one sign."""
    points = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    points[(points >= 48) & (points <= 57)] = 48
    seen = np.zeros(SLOTS, bool)
    gram = np.zeros(len(points), np.uint64)
    for n in range(1, GRAMS + 1):
        if len(points) < n:
            break
        gram = gram[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        seen[((gram ^ gram >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


def _rows(sets: list[np.ndarray]) -> np.ndarray:
    """Presence rows of unit length: their products are the normalised kernel."""
    out = np.zeros((len(sets), SLOTS), np.float32)
    for row, slots in zip(out, sets):
        row[slots] = 1 / np.sqrt(max(1, len(slots)))
    return out


class KernelModel:
    """One-versus-rest ridge regression on Nyström features of the presence kernel."""

    def __init__(self, sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> None:
        self.langs = sorted(set(langs))
        target = np.where(np.array(langs)[:, None] == np.array(self.langs), 1.0, -1.0)
        chosen = np.unique(np.linspace(0, len(sets) - 1, min(landmarks, len(sets))).astype(int))
        marks = _rows([sets[i] for i in chosen])
        values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        near = np.vstack([_rows(sets[at : at + BLOCK]) @ marks.T for at in range(0, len(sets), BLOCK)])
        features = np.hstack([near @ root, np.ones((len(sets), 1))])
        weight = 1 / np.array([langs.count(v) for v in langs])  # every language counts alike
        gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, features.T @ (target * weight[:, None]))
        # (rows · landmarksᵀ) · duals = rows · (landmarksᵀ · duals): the right product is made once.
        self.matrix, self.bias = (marks.T @ (root @ solved[:-1])).astype(np.float32), solved[-1]

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        return _rows(sets) @ self.matrix + self.bias


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> KernelModel | None:
    """Fit on up to ``rows`` documents of each language, chosen by a hash of the id among those that aren't held out.

    Rows without a language or a letter teach nothing; None if none are left.
    """
    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang is not null")
    known = known.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    n = max(1, known.select("lang").distinct().count())
    picked = known.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max(2, min(rows, TRAIN_TOTAL // n))).select("doc_id", "lang").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [presence(t).tobytes() if t and _letter(t) else None for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "lang", "slots"])

    sample = _texts(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").select("doc_id", "lang", "text").mapInArrow(run, "doc_id long, lang string, slots binary")
    sample = sorted((r["lang"], r["doc_id"], bytes(r["slots"])) for r in sample.where("slots is not null").collect())
    return KernelModel([np.frombuffer(s, np.int32) for _, _, s in sample], [v for v, _, _ in sample]) if sample else None


def identify(docs: DataFrame, model: KernelModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): score is the regression's value for the language, from -1..1 to 0..1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.matrix, model.bias) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        if shared.value:
            model = KernelModel.__new__(KernelModel)
            model.langs, model.matrix, model.bias = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if model and t and _letter(t)]
            for at in range(0, len(known), BLOCK):
                some = known[at : at + BLOCK]
                found = model.scores([presence(texts[i]) for i in some])
                for i, best, value in zip(some, found.argmax(1), found.max(1)):
                    langs[i], scores[i] = model.langs[best], float(min(1.0, max(0.0, (1 + value) / 2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row, read from its whole text.

    ``und`` with score 0 for a null text, one without a letter, and all texts if nothing could be learned. Repeated
    rows are kept; an empty table gives an empty result; language, source and id are never inputs of a prediction.
    """
    found = identify(docs, fit_language(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
