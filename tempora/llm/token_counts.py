"""Token counts by a two-tier lookup on the map side: no pre-token is ever shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm import pretokens

#: Frequent pre-tokens in the broadcast table and their most characters: at most 4 MB.
TABLE_ROWS, TABLE_CHARS = 1 << 15, 32
#: Texts that the table is made from on average, and tasks that count their pre-tokens: the driver gets as many lists.
SAMPLE_ROWS, SAMPLE_TASKS, SAMPLE_SEED = 10_000, 16, 5
#: Candidates that a task reports, and distinct pre-tokens that it counts before it drops rare ones.
TASK_ROWS, TASK_COUNTS = 1 << 15, 1 << 18
#: Lengths that a worker keeps besides the table, and the most characters of a kept pre-token.
CACHE_ROWS, CACHE_CHARS = 1 << 18, 64


class Lengths(dict):
    """Tokens of a pre-token: the broadcast table first, then what this worker has encoded."""

    def __init__(self, table: dict[str, int], encode) -> None:
        super().__init__(table)
        self.table, self.encode = table, encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ROWS + len(self.table):
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n


def frequent_pretokens(texts: DataFrame, text_col: str = "text", rows: int = TABLE_ROWS) -> list[str]:
    """Frequent pre-tokens of a seeded sample of some ``SAMPLE_ROWS`` whole texts, the most frequent first.

    A few tasks count those of the sample, drop rare ones when they have too many, and report one bounded list each,
    which the driver adds up: no pre-token is shuffled. The choice affects speed alone: results don't depend on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = pretokens.Splitter(pretokens.BYTE_PATTERN), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(split(text))
                if len(counts) > TASK_COUNTS:
                    counts = Counter(dict(counts.most_common(TASK_COUNTS // 4)))
        top = [(p, n) for p, n in counts.most_common(TASK_ROWS) if len(p) <= TABLE_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    some = texts.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    share = min(1.0, SAMPLE_ROWS / max(1, texts.count()))
    if share < 1:
        some = some.sample(share, SAMPLE_SEED)
    total: Counter = Counter()
    for r in some.repartition(SAMPLE_TASKS).mapInArrow(run, "piece string, n long").collect():
        total[r["piece"]] += r["n"]
    return [p for p, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:rows]]


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, as the byte-level vocabulary's own library counts them.

    No begin, end or added tokens; special strings inside a text count as one token, the library's default. A null
    text counts as empty. Texts are never cut. Repeated rows are kept, an empty table gives an empty result, other
    columns are ignored.
    """
    encoding, _, special, _ = pretokens.load(tokenizer_path)
    table = frequent_pretokens(docs, text_col)
    lengths = np.array([len(encoding._core_bpe.encode_single_piece(p.encode())) for p in table], np.uint8)
    ends = np.cumsum([len(p) for p in table], dtype=np.int32) if table else np.empty(0, np.int32)
    compact = docs.sparkSession.sparkContext.broadcast(("".join(table), ends, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, ends, lengths = compact.value
        known = {joined[a:b]: n for a, b, n in zip([0, *ends[:-1].tolist()], ends.tolist(), lengths.tolist())}
        split, at_special = pretokens.Splitter(pretokens.BYTE_PATTERN), pretokens.special_splitter(special)
        length = Lengths(known, pretokens.load(tokenizer_path)[0]._core_bpe.encode_single_piece).__getitem__
        names = set(special)

        def count(text: str | None) -> int:
            if not text:
                return 0
            if not any(s in text for s in names):
                return sum(map(length, split(text)))
            return sum(1 if part in names else sum(map(length, split(part))) for part in at_special.split(text))

        for batch in batches:
            n = pa.array([count(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
