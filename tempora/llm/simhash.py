"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import materialize, release, small
from tempora.llm.graph import connected_components

BITS, RADIUS, WORDS, SEED = 64, 4, 4, 42
#: Shingles whose hashes are summed at once, variants that a group should hold, and that a task sorts at once.
SHINGLE_BLOCK, GROUP_VARIANTS, SORT_VARIANTS = 1 << 16, 1 << 20, 1 << 23
#: Low bits of a variant that can name its group, at most.
MAX_GROUP_BITS = 24


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of a text's word shingles: a bit is 1 if set in over half the hashes."""
    if not text:
        return 0
    # bytes.lower() changes A-Z only, and bytes.split() splits at 0x20 and 0x09 to 0x0D only.
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = memoryview(b" ".join(parts))
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[:-1]]
    n = max(1, len(parts) - words + 1)
    last = ends[min(words, len(parts)) - 1 :]
    votes, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLE_BLOCK):
        hashes = np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts[at : min(n, at + SHINGLE_BLOCK)], last[at : at + SHINGLE_BLOCK])], np.uint64)
        votes += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long. Null or wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


@functools.lru_cache(maxsize=256)
def _ball(first: int, end: int, radius: int = RADIUS // 2) -> np.ndarray:
    """Masks of up to ``radius`` of the bits from ``first`` to before ``end``."""
    return np.array([sum(1 << b for b in some) for n in range(radius + 1) for some in itertools.combinations(range(first, end), n)], np.uint64)


def _local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a[i]-b[i] as links of every value to the smallest of its component."""
    values, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = both[: len(a)], both[len(a) :]
    root = np.arange(len(values))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            keep = root != np.arange(len(values))
            return values[keep], values[root[keep]]
        root = new


def _variants(owners: np.ndarray, group: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The variants of the ``owners``, within half the radius, whose low ``bits`` bits are ``group``; and whose each is."""
    low = np.uint64((1 << bits) - 1)
    flipped = np.bitwise_count((owners ^ np.uint64(group)) & low)
    based = (owners & ~low) | np.uint64(group)
    found, whose = [], []
    for n in range(RADIUS // 2 + 1):  # bits that are flipped to get into the group; the others may be flipped above them
        some = np.flatnonzero(flipped == n)
        if len(some):
            ball = _ball(bits, BITS, RADIUS // 2 - n)
            found.append((based[some, None] ^ ball).ravel())
            whose.append(np.repeat(some, len(ball)))
    return np.concatenate(found), np.concatenate(whose)


def _meet(owners: np.ndarray, group: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints that have a variant of the group in common, as stars.

    Those that share a variant are each tied to the smallest of them, and the two are compared; no pairs are listed.
    """
    owners = np.unique(owners)
    links = []
    ball = len(_ball(bits, BITS))
    # A crowded group is gone through slice by slice, by the next bits of its variants: memory stays bounded.
    slices = 1
    while len(owners) * ball > SORT_VARIANTS * slices and slices < 1 << 12:
        slices *= 2
    step = max(1, SORT_VARIANTS // ball)
    for part in range(slices):
        found, whose = [], []
        for at in range(0, len(owners), step):
            v, w = _variants(owners[at : at + step], group, bits)
            if slices > 1:
                keep = (v >> np.uint64(bits)) & np.uint64(slices - 1) == part
                v, w = v[keep], w[keep]
            found.append(v)
            whose.append(w + at)
        v, w = np.concatenate(found), np.concatenate(whose)
        order = np.argsort(v, kind="stable")  # owners are in order within equal variants
        v, w = v[order], w[order]
        first = np.concatenate([[True], v[1:] != v[:-1]])
        least = w[first][np.cumsum(first) - 1]
        met = np.flatnonzero(least != w)
        a, b = owners[w[met]], owners[least[met]]
        close = np.bitwise_count(a ^ b) <= RADIUS
        links.append(_local_roots(a[close], b[close]))
    return np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links])


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``RADIUS`` bits of each other.

    Not every link is listed, but fingerprints are connected by the result exactly if they are by all links.
    Every fingerprint emits all 2,081 variants within half the radius, and two within the radius meet at one. Variants are
    shuffled by their low bits: as those of a fingerprint fall into few such groups, what travels is the
    fingerprint with the group's bits, and its variants of that group are written out where they arrive.
    """
    n, bits = fps.count(), 0
    while bits < MAX_GROUP_BITS and n * len(_ball(0, BITS)) > GROUP_VARIANTS << bits:
        bits += 2
    masks = F.array(*(F.lit(int(m)).cast("long") for m in _ball(0, bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            groups, owners = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cut = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for a, b in itertools.pairwise(cut):
                if a == b:
                    continue
                if held and groups[a] != group:
                    yield out(held, group)
                    held = []
                group = int(groups[a])
                held.append(owners[a:b])
        if held:
            yield out(held, group)

    def out(held: list[np.ndarray], group: int) -> pa.RecordBatch:
        u, v = _meet(np.concatenate(held), group, bits)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    low = F.col("fp").bitwiseAND((1 << bits) - 1)
    spread = fps.select("fp", F.explode(masks).alias("mask")).select(low.bitwiseXOR(F.col("mask")).alias("grp"), "fp")
    return materialize(spread.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "u long, v long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: documents whose fingerprints are linked, directly or through others.

    component_id is the smallest id reachable by links, itself included (null only if all ids of the component are
    null). Equal fingerprints are one class before any search, so copies cost one row each. Null, empty and wordless
    texts have fingerprint 0 and are linked like any other. Repeated rows are kept; an empty table gives an empty
    result; other columns are ignored.
    """
    found = materialize(fingerprints(docs, id_col, text_col, words))
    classes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    part = connected_components(link_fingerprints(classes.select("fp")))
    named = classes.join(part, classes.fp == part.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return found.join(named, found.fp == named._fp).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` whose id names its group: one document of each group, with all its columns as they are.

    Of rows that share that id one stays. A group whose ids are all null keeps one row of each text in it.
    """
    groups = materialize(simhash_groups(docs, id_col, text_col, words))
    kept = F.count_if(F.expr("doc_id = component_id or component_id is null"))
    # Ids that stay once, nearly all, aren't looked up: with few others no text moves.
    counts = materialize(groups.groupBy(F.col("doc_id").alias("_id")).agg(kept.alias("n")).where("n <> 1"))
    release(groups)
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_id"))
    left = docs.join(small(counts.select("_id")), same, "left_anti")
    if counts.where("n > 1").limit(1).count():
        repeated = docs.join(small(counts.where("n > 1").select("_id")), same, "left_semi")
        once = repeated.where(F.col(f"`{id_col}`").isNotNull()).dropDuplicates([id_col]).unionAll(repeated.where(F.col(f"`{id_col}`").isNull()).dropDuplicates([text_col]))
        left = left.unionAll(once)
    return left
