"""Token files: ids by frequency rank in a byte-aligned variable-length code with separate control bytes."""

from __future__ import annotations

import functools
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm import pretokens
from tempora.llm.common import materialize, scratch_dir
from tempora.llm.wordcache import WordCache

#: Documents of a file, the most files, and characters of texts that are encoded at once.
DOCS_PER_FILE, MAX_FILES, BLOCK_CHARS = 4096, 50_000, 1 << 21
#: Ids that are packed or decoded at once.
UNPACK_IDS = 1 << 18


def normalise(text: str) -> str:
    """NFC, then lower case letter by letter (a final sigma stays a plain one). White space is left: it is dropped anyway."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


@functools.lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """The worker's own, kept from task to task."""
    encoding, ids, _, special_ids = pretokens.load(path)
    piece = encoding._core_bpe.encode_single_piece

    def encode(words: list[str]) -> Iterator[list[int]]:
        for word in words:
            yield [special_ids[word]] if word in special_ids else [ids[r] for r in piece(word.encode("utf-8", "surrogatepass") + pretokens.WORD_END)]

    return WordCache(encode)


def encode_words(docs: DataFrame, tokenizer_path: str, end_id: int, bounds: list[int], id_col: str, text_col: str) -> DataFrame:
    """(file_no, doc_id, n, ids): compressed little-endian ids of every whole text, the end id last."""
    _, of_rank, special, special_ids = pretokens.load(tokenizer_path)
    cuts, vocabulary = np.array(bounds, np.int64), max([*of_rank, *special_ids.values(), end_id]) + 1
    width = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer_path)
        split, at_special = pretokens.Splitter(pretokens.WORD_PATTERN), pretokens.special_splitter(special)
        pack = zstandard.ZstdCompressor(level=1).compress

        def words(text: str | None) -> list[str]:
            if not text:
                return []
            if not any(s in text for s in special):
                return split(normalise(text))
            return list(itertools.chain.from_iterable([part] if part in special_ids else split(normalise(part)) for part in at_special.split(text)))

        for batch in batches:
            # Null ids come first; as whole numbers, since a float can't tell large ids apart.
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            keys = batch.column(0).fill_null(0).to_numpy()
            files = np.where(known, np.searchsorted(cuts, keys, side="left"), 0).astype(np.int32)
            texts, at = batch.column(1), 0
            while at < batch.num_rows:
                first, some, size = at, [], 0
                while at < batch.num_rows and size < BLOCK_CHARS:
                    text = texts[at].as_py()
                    some.append(words(text))
                    size += len(text or "")
                    at += 1
                flat, ends = cache.encode_lists(some)
                flat = flat.astype(width)
                spans = list(itertools.pairwise(ends.tolist()))
                packed = [pack(np.append(flat[a:b], width.type(end_id)).tobytes()) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files[first:at]), batch.column(0)[first:at], pa.array([b - a + 1 for a, b in spans], pa.int64()), pa.array(packed, pa.binary())], ["file_no", "doc_id", "n", "ids"]
                )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "file_no int, doc_id long, n long, ids binary")


def unpack_ids(blob: bytes, wide: bool = False) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4" if wide else "<u2")


def id_counts(encoded: DataFrame, wide: bool) -> list[int]:
    """All ids that occur, the most frequent first: a task reports one row per id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for blobs in itertools.batched(batch.column(0).to_pylist(), 500):
                n = np.bincount(np.concatenate([unpack_ids(b, wide) for b in blobs]))
                if len(n) > len(total):
                    n, total = total, n
                total[: len(n)] += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    found = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return [r["id"] for r in found.orderBy(F.desc("n"), "id").collect()]


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data): two control bits a rank, four ranks a control byte, hold its bytes less one; data has its low bytes in order."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    first = np.cumsum(size, dtype=np.int64) - size
    data = np.empty(int(size.sum(dtype=np.int64)), np.uint8)
    data[first] = ranks & 0xFF
    for more in range(1, int(size.max(initial=1))):
        has = size > more
        data[first[has] + more] = ranks[has] >> np.uint32(8 * more) & 0xFF
    return control.tobytes(), data.tobytes()


#: Bytes of each of the four ranks of a control byte.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks that pack_ranks wrote, by table lookup."""
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    first = np.cumsum(size) - size
    got = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = got[first].astype(np.uint32)
    for more in range(1, int(size.max(initial=1))):
        has = size > more
        ranks[has] |= got[first[has] + more].astype(np.uint32) << np.uint32(8 * more)
    return ranks


def together(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of up to ``UNPACK_IDS`` ids together, or of one that is longer."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + UNPACK_IDS, side="right")))
        yield at, last
        at = last


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets), [None, pa.py_buffer(np.concatenate([[0], offsets]).astype(np.int32)), pa.py_buffer(values)])


def pack_rows(ids: list[np.ndarray], rank: np.ndarray) -> tuple[pa.BinaryArray, pa.BinaryArray]:
    """(control, data) of several documents, each as pack_ranks has it, from the rank of every id."""
    counts = np.array([len(i) for i in ids], np.int64)
    ranks = rank[np.concatenate(ids)]
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    places, ends = -(-counts // 4) * 4, np.cumsum(counts)
    codes = np.zeros(int(places.sum()), np.uint8)
    codes[np.arange(ends[-1]) + np.repeat(np.cumsum(places) - places - (ends - counts), counts)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    total = np.cumsum(size, dtype=np.int64)
    first = total - size
    data = np.empty(int(total[-1]), np.uint8)
    data[first] = ranks & 0xFF
    for more in range(1, int(size.max(initial=1))):
        has = np.flatnonzero(size > more)
        data[first[has] + more] = ranks[has] >> np.uint32(8 * more) & 0xFF
    return _binary(np.cumsum(places) // 4, control), _binary(total[ends - 1], data)


def unpack_rows(control: pa.BinaryArray, data: pa.BinaryArray, counts: np.ndarray, of_rank: np.ndarray) -> pa.BinaryArray:
    """The ids of several documents as little-endian unsigned 32-bit, ``counts`` each, by table lookup over all of them at once."""
    places = -(-counts // 4) * 4  # a document's control bytes stand for four ranks each, the last ones for nothing
    size = SIZES[np.frombuffer(b"".join(control.to_pylist()), np.uint8)].ravel()
    begin = np.cumsum(places) - places
    ends = np.cumsum(counts)
    if len(size) != ends[-1]:
        size = size[np.arange(ends[-1]) + np.repeat(begin - (ends - counts), counts)]
    first = np.cumsum(size) - size
    got = np.frombuffer(b"".join(data.to_pylist()) + b"\0\0\0", np.uint8)
    ranks = got[first].astype(np.uint32)
    for more in range(1, int(size.max(initial=1))):
        has = np.flatnonzero(size > more)
        ranks[has] |= got[first[has] + more].astype(np.uint32) << np.uint32(8 * more)
    return _binary(ends * 4, of_rank[ranks])


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", docs_per_file: int = DOCS_PER_FILE) -> str:
    """Encode every whole text, add ``end_id``, and write the ids in ascending order of doc_id; returns the folder.

    ``ranks`` in it has one row: the ids by rank. ``blocks`` has files of consecutive documents, file_no=0, 1, ..., in
    Parquet containers that Spark commits and any Hadoop store takes; a row has doc_id, n, control and data bytes.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark)
    key = F.col(f"`{id_col}`").cast("long")
    n = docs.count()
    files = max(1, min(MAX_FILES, -(-n // docs_per_file)))
    share = [i / files for i in range(1, files)]
    bounds = sorted(set((docs.agg(F.percentile_approx(key, share, max(10_000, 10 * files))).first()[0] or []) if share else []))
    wide = max([*pretokens.load(tokenizer_path)[1], end_id]) >= 1 << 16
    encoded = encode_words(docs, tokenizer_path, end_id, bounds, id_col, text_col)
    encoded = materialize(encoded.repartitionById(len(bounds) + 1, "file_no").sortWithinPartitions("doc_id", "n"), "uncompressed")
    by_rank = id_counts(encoded, wide)
    spark.createDataFrame([(by_rank,)], "ids array<long>").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    shared = spark.sparkContext.broadcast(rank)  # four bytes for each id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, last in together(batch.column(2).to_numpy()):
                rows = batch.slice(at, last - at)
                control, data = pack_rows([unpack_ids(blob, wide) for blob in rows.column(3).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], control, data], ["file_no", "doc_id", "n", "control", "data"])

    encoded.mapInArrow(run, "file_no int, doc_id long, n long, control binary, data binary").write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, doc_id, n, ids): the documents' ids, decoded; ids is little-endian unsigned 32-bit."""
    by_rank = spark.sparkContext.broadcast(np.array(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(2).to_numpy()
            for at, last in together(counts):
                rows = batch.slice(at, last - at)
                ids = unpack_rows(rows.column(3), rows.column(4), counts[at:last], by_rank.value)
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], ids], ["file_no", "doc_id", "n", "ids"])

    blocks = spark.read.schema("file_no int, doc_id long, n long, control binary, data binary").parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "file_no int, doc_id long, n long, ids binary")


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: start counts the ids of all documents before.

    Only a file's documents are sorted as one group; the files before it are summed up, one row each.
    """
    rows = materialize(read_token_files(spark, path).select("file_no", "doc_id", "n", F.crc32("ids").alias("ids_crc32")))
    before = Window.partitionBy(F.lit(0)).orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("file_no").agg(F.sum("n").alias("in_file")).select("file_no", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("file_no").orderBy(F.col("doc_id").asc_nulls_first(), "n", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(F.broadcast(offsets), "file_no")  # at most MAX_FILES rows
    return joined.select("doc_id", (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32")
