"""Near-duplicate embeddings by lattice hashing: projections decoded to E8 points, verified by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.buckets import bucket_components
from tempora.llm.common import materialize

#: At these, 99.98 % of pairs with a cosine of just 0.95 share a cell, and one in 8,000 of unrelated pairs; a third point
#: for each cell makes that rarer where there are billions of vectors.
#: Tables, E8 points that form a cell of a table, and the projections' scale in units of the lattice.
TABLES, POINTS, SCALE, SEED = 16, 2, 0.66, 11
COSINE = 0.95
#: Vectors of a component that one task compares with as many others.
BLOCK = 2048


def _nearest_two(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the points with integers of even sum (D8): the nearest to each row and one next to it, with their squared distances."""
    near = np.rint(y)
    off = y - near
    order = np.argsort(-np.abs(off), axis=1)
    rows = np.arange(len(y))
    step = np.where(off >= 0, 1.0, -1.0)

    def moved(p: np.ndarray, which: np.ndarray) -> np.ndarray:
        p = p.copy()
        p[rows, which] += step[rows, which]
        return p

    odd = near.sum(1) % 2 != 0
    first = np.where(odd[:, None], moved(near, order[:, 0]), near)
    # An odd row's other choice moves the second coordinate instead; an even row's moves both.
    second = np.where(odd[:, None], moved(near, order[:, 1]), moved(moved(near, order[:, 0]), order[:, 1]))
    return first, ((y - first) ** 2).sum(1), second, ((y - second) ** 2).sum(1)


def e8_cells(y: np.ndarray) -> np.ndarray:
    """The two E8 points nearest to each row of y (n, 8), doubled to integers: its cell and the neighbouring one to probe.

    E8 is D8 and D8 shifted by a half; the runner-up is the best of the other coset's point and the own coset's next.
    """
    a, da, a2, da2 = _nearest_two(y)
    b, db, b2, db2 = (x + 0.5 if x.ndim == 2 else x for x in _nearest_two(y - 0.5))
    points, far = np.stack([a, b, a2, b2], 1), np.stack([da, db, da2, db2], 1)
    best = np.argsort(far, axis=1, kind="stable")[:, :2]
    return np.rint(2 * np.take_along_axis(points, best[:, :, None], 1)).astype(np.int64)


def _mix(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = (keys ^ more.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def cell_keys(x: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """(n, tables * 2^POINTS) hashed cells of unit vectors: in each table its own cell and the neighbours that are probed."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    y = SCALE * (x @ rng.normal(size=(x.shape[1], tables * POINTS * 8)))
    cells = e8_cells(y.reshape(-1, 8)).reshape(len(x), tables, POINTS, 2, 8)
    keys = np.zeros((len(x), tables, 1), np.uint64) + np.arange(tables, dtype=np.uint64)[None, :, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(x.shape[1])
    for p in range(POINTS):
        both = []
        for probe in range(2):
            k = keys
            for c in range(8):
                k = _mix(k, cells[:, :, p, probe, c][:, :, None] + (c + 1) * 1000)
            both.append(k)
        keys = np.concatenate(both, 2)
    return keys.reshape(len(x), -1).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """List column of one width as unit rows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    # Scaled by the largest value first: squares of very large or small numbers don't overflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _close(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Whether each row of x has the cosine or more with each row of y.

    A product of matrices adds up in another order than a row does; where that could matter, the row's sum decides.
    """
    product = x @ y.T
    close = product >= cosine
    a, b = np.nonzero(np.abs(product - cosine) < 1e-9)
    close[a, b] = _cosines(x[a], y[b]) >= cosine
    return close


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(1)


def _by_width(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    """Places of a batch's rows, by the length of their vector."""
    widths = np.array([len(v) for v in batch.column(column)])
    for w in np.unique(widths):
        yield np.flatnonzero(widths == w)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in _by_width(batch, 1):
            for i in range(0, len(at), 1000):
                some = batch.take(pa.array(at[i : i + 1000]))
                keys = cell_keys(_matrix(some.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(some.column(0).to_numpy(), keys.shape[1]))], ["key", "h"])


def _linked(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose vectors have the cosine or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in _by_width(batch, 2):
                some = batch.take(pa.array(at))
                good = _cosines(_matrix(some.column(2)), _matrix(some.column(3))) >= cosine
                yield pa.RecordBatch.from_arrays([some.column(0).filter(pa.array(good)), some.column(1).filter(pa.array(good))], ["a", "b"])

    left = classes.select(F.col("h").alias("a"), F.col("v").alias("va"))
    right = classes.select(F.col("h").alias("b"), F.col("v").alias("vb"))
    both = pairs.join(left, "a").join(right, "b").where(F.size("va") == F.size("vb"))
    return both.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _count_links(members: DataFrame, cosine: float) -> DataFrame:
    """(h, links): rows of other classes of the component with the cosine or more. members: (c, h, v, copies).

    All links lie within components. A component is cut into blocks, and every two blocks of it are compared as one
    product of matrices; a task never holds more than two blocks, and no pairs are listed.
    """
    n = members.groupBy("c").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = members.join(n, "c").withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")))
    paired = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.select("c", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "h", "v", "copies")
    group = ["c", "lo", "hi"]

    def compare(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        one = pa.Table.from_batches(rows).combine_chunks()
        block, h, copies = (one.column(k).to_numpy() for k in ("block", "h", "copies"))
        x = _matrix(one.column("v").combine_chunks())
        lo = block == one.column("lo")[0].as_py()
        if lo.all():
            close = _close(x, x, cosine)
            np.fill_diagonal(close, False)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(close @ copies)], ["h", "links"])
        close = _close(x[lo], x[~lo], cosine)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[lo], h[~lo]])), pa.array(np.concatenate([close @ copies[~lo], copies[lo] @ close]))], ["h", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if held and tuple(keys[a]) != key:
                    yield compare(held)
                    held = []
                key = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield compare(held)

    found = paired.repartition(*group).sortWithinPartitions(*group, "block", "h").mapInArrow(run, "h long, links long")
    return found.groupBy("h").agg(F.sum("links").alias("links"))


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; links are pairs with the cosine or more, in double precision.

    n_links counts the other rows linked directly, component_id is the smallest id reachable by links. Vectors that are
    null, empty, zero, or hold null or non-finite values link with nothing and are kept; vectors of different lengths
    never link. Rows with the same vector are one class until the end, so copies cost nothing; an empty table gives an
    empty result; other columns are ignored.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    every = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"), good.alias("good"))
    usable = every.where("good").select("vec_id", "v", F.xxhash64("v").alias("h"))
    classes = materialize(usable.groupBy("h", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")))
    keys = classes.select("h", "v").mapInArrow(_keys, "key long, h long")
    part = bucket_components(keys.distinct(), lambda pairs: _linked(pairs, classes, cosine))
    members = materialize(classes.join(part, classes.h == part.node, "left").select(F.coalesce("component", "h").alias("c"), "h", "v", "least", "copies", F.col("component").isNotNull().alias("linked")))
    links = _count_links(members.where("linked").select("c", "h", "v", "copies"), cosine)
    least = members.groupBy("c").agg(F.min("least").alias("component_id"))
    named = members.select("c", "h", "copies").join(least, "c").join(links, "h", "left")
    named = named.select(F.col("h").alias("_h"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = usable.select("vec_id", "h").join(named, F.col("h") == F.col("_h")).select("vec_id", "n_links", "component_id")
    lone = every.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionAll(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
