"""Clocks of long streams: decoding and fitting in buckets of device time, with the same results as one walk over all.

Both are sequential rules. A bucket of pulses is walked by itself, from the state in which the bucket before it ends:

- Decoding: states are small and discrete, so a round walks every bucket from a guess, and the next one from what the
  bucket before it really ended in, until no bucket was entered in another state than that. The guess counts whole seconds
  of the device's clock from the first lock on; a wrong one costs rounds and never changes the result. A bucket that holds
  coded pulses ends in the same state from any guess, so buckets longer than the code's period settle in three rounds.
- Fitting: with the rejected pulses given, a bucket turns any state it may be entered in by one linear rule (its element),
  so one row a bucket carries the filter and the smoother across all of them. The gate rejects by the state, so rounds
  repeat with the pulses that the last one rejected, until none changes: the first bucket is right from the first round
  on, the second from the next one, and mostly all of them at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.scratch import written

#: Seconds of device time in a bucket: some thousand pulses.
BUCKET_S = 3600.0
#: Pulses that a task holds states of at a time: some tens of MB.
PULSES = 1 << 18

STATE = "struct<dev:double,now:double,anchored:double,skip:int>"


def _bucket(df: DataFrame, t: str, bucket_s: float) -> DataFrame:
    return df.withColumn("_b", F.floor(F.col(t) / bucket_s))


def _schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def _numbers(batch: pa.RecordBatch | pa.StructArray, name: str) -> np.ndarray:
    """A column as doubles, nulls as NaN."""
    column = batch.column(name) if isinstance(batch, pa.RecordBatch) else batch.field(name)
    return np.array(column.to_numpy(zero_copy_only=False), float)


def _sizes(column: pa.ListArray) -> np.ndarray:
    return np.array(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def _pieces(batches: Iterator[pa.RecordBatch], lists: str) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose column ``lists`` has ``PULSES`` values at most, or one row."""
    for batch in batches:
        total, at = np.cumsum(_sizes(batch.column(lists))), 0
        while at < len(total):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PULSES, "right")))
            yield batch.slice(at, end - at)
            at = end


class _Steps:
    """Lists side by side, longest first: the values of one step, of all lists that get so far, lie together."""

    def __init__(self, sizes: np.ndarray):
        self.sizes, self.order = sizes, np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[self.order] = np.arange(len(sizes))
        longest = int(sizes.max()) if len(sizes) else 0
        active = len(sizes) - np.cumsum(np.bincount(sizes, minlength=longest + 1))[:longest]
        ends = np.cumsum(active)
        self.cuts = list(zip((ends - active).tolist(), ends.tolist(), active.tolist()))
        self.begins = np.cumsum(sizes) - sizes
        self.place = np.arange(int(sizes.sum())) - np.repeat(self.begins, sizes)
        self.to = (ends - active)[self.place] + np.repeat(rank, sizes)

    def laid(self, flat: np.ndarray) -> np.ndarray:
        out = np.empty_like(flat)
        out[self.to] = flat
        return out

    def of_list(self, sorted_values: np.ndarray) -> np.ndarray:
        """Values of the lists, longest first, in the order that the lists came in."""
        out = np.empty_like(sorted_values)
        out[self.order] = sorted_values
        return out


def decode_in_buckets(edges: DataFrame, keys: list[str], columns: list[str], t: str, walk: Callable, before: bool, bucket_s: float = BUCKET_S, block_s: float = 256.0, max_rounds: int = 100_000) -> DataFrame:
    """(keys, dev, main): what ``walk`` finds in ``edges``, per key in order of the first of ``columns``.

    ``walk(arrays of columns, own, state)`` gets a bucket's edges and up to two that follow, the number of its own, and the
    state (dev, now, anchored, skip) it is entered in, or None; it returns device times, main times and the state at its
    end. ``before`` says whether a state's time is that of the last edge before the bucket, or of its first. ``t`` is the
    device time in seconds that deals edges into buckets; ``block_s`` the seconds after which codes repeat, for guesses.
    """
    by = [*keys, "_b"]
    rows = _bucket(edges.select(*keys, *dict.fromkeys([*columns, t])), t, bucket_s)
    packed = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_e"), F.min(t).alias("first"), F.max(t).alias("last"))
    # A bucket is a row, so rounds sort and group nothing.
    rows = written(packed.select(*by, "first", "last", F.slice("_e", 1, 2).alias("head"), *(F.col(f"_e.{c}").cast("array<double>").alias(f"_v{i}") for i, c in enumerate(columns))))
    order = Window.partitionBy(*keys).orderBy("_b")
    after = F.slice(F.concat(F.coalesce(F.lead("head", 1).over(order), F.array()), F.coalesce(F.lead("head", 2).over(order), F.array())), 1, 2)
    at = F.lag("last").over(order) if before else F.col("first")
    ends = rows.select(*by, "head", "first", "last").withColumn("after", after).withColumn("at", at)
    ends = written(ends.select(*by, "at", *(F.col(f"after.{c}").cast("array<double>").alias(f"_a{i}") for i, c in enumerate(columns))))
    rows = rows.drop("head", "first", "last")
    none = F.lit(None).cast(STATE)
    states = ends.withColumn("state", none)
    out = f"{_schema(rows, keys)}, _b long, devs array<double>, mains array<double>, left {STATE}"
    names = ("dev", "now", "anchored", "skip")
    left_type = pa.struct([("dev", pa.float64()), ("now", pa.float64()), ("anchored", pa.float64()), ("skip", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "_v0"):
            parts = []
            for prefix in "va":
                sizes = _sizes(batch.column(f"_{prefix}0"))
                values = [np.array(batch.column(f"_{prefix}{i}").flatten().to_numpy(zero_copy_only=False), float) for i in range(len(columns))]
                parts.append((np.append(0, np.cumsum(sizes)).tolist(), values))
            (own_at, own), (ahead_at, ahead) = parts
            devs, mains, sizes, lefts = [], [], [], []
            for i, state in enumerate(batch.column("state").to_pylist()):
                arrays = [np.append(v[own_at[i] : own_at[i + 1]], a[ahead_at[i] : ahead_at[i + 1]]) for v, a in zip(own, ahead)]
                found = walk(arrays, own_at[i + 1] - own_at[i], None if state is None else tuple(state[n] for n in names))
                devs += found[0]
                mains += found[1]
                sizes.append(len(found[0]))
                lefts.append(None if found[2] is None else dict(zip(names, found[2])))
            columns_out = [*(batch.column(k) for k in by), _list(np.array(devs, float), np.array(sizes)), _list(np.array(mains, float), np.array(sizes)), pa.array(lefts, left_type)]
            yield pa.RecordBatch.from_arrays(columns_out, names=[*by, "devs", "mains", "left"])

    for k in range(max_rounds):
        found = written(rows.join(states, by).mapInArrow(run, out))
        entered = F.lag("left").over(order)
        if k == 0:
            # Before the first lock no state is carried, so the first one to be locked is right.
            lock = F.first(F.when(F.col("left.now") >= 0, F.col("left")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
            now = lock["now"] + F.rint(F.col("at") - lock["dev"])
            guess = F.when(lock.isNotNull(), F.struct(F.col("at").alias("dev"), now.alias("now"), F.floor((now - 1) / block_s).cast("double").alias("anchored"), F.lit(0).alias("skip"))).otherwise(entered)
        else:
            guess = entered
        last, states = states, written(found.select(*by, "left").join(ends, by).withColumn("state", guess.cast(STATE)).drop("left"))
        if not states.join(last.select(*by, F.col("state").alias("_was")), by).where(~F.col("state").eqNullSafe(F.col("_was"))).limit(1).count():
            return found.select(*keys, F.explode(F.arrays_zip(F.col("devs").alias("dev"), F.col("mains").alias("main"))).alias("x")).select(*keys, "x.dev", "x.main")
    raise RuntimeError("decoding did not settle")


class _Pulses:
    """The pulses of many buckets, each with offsets at the time of its first one, ``r`` after the clock's first.

    States are kept as columns over the buckets, so a step is numpy work on all of them at once.
    """

    def __init__(self, batch: pa.RecordBatch, noise):
        self.steps, self.noise = _Steps(_sizes(batch.column("devs"))), noise
        steps, begins, sizes = self.steps, self.steps.begins, self.steps.sizes
        self.dev, self.main = (np.array(batch.column(c).flatten().to_numpy(zero_copy_only=False), float) for c in ("devs", "mains"))
        first = _numbers(batch, "first")
        self.r = first - _numbers(batch, "dev0")
        dt = self.main - np.append(np.nan, self.main[:-1])
        dt[begins] = self.main[begins] - _numbers(batch, "main_before")
        after = np.append(dt[1:], np.nan)
        dt[begins[np.isnan(dt[begins])]] = 1.0
        after[begins + sizes - 1] = _numbers(batch, "main_after") - self.main[begins + sizes - 1]  # NaN behind the last
        self.pulse = np.repeat(_numbers(batch, "start").astype(np.int64), sizes) + steps.place
        self.q = (noise.offset + self.r * self.r * noise.skew, self.r * noise.skew, np.full(len(self.r), float(noise.skew)))
        self.x, self.y, self.dt, self.after = (steps.laid(v) for v in (self.dev - np.repeat(first, sizes), self.main, dt, after))
        self.late = steps.laid(self.pulse) > noise.gate_after
        self.sorted_q = [v[steps.order] for v in self.q]

    def element(self, rejected: np.ndarray) -> list[np.ndarray]:
        """How each bucket turns the state x it is entered in: to a x + b with covariance c, and what its pulses say of x (e, j)."""
        n = len(self.r)
        state = [np.full(n, v) for v in (1.0, 0.0, 0.0, 1.0, *[0.0] * 10)]
        for begin, end, n in self.steps.cuts:
            x, dt = self.x[begin:end], self.dt[begin:end]
            a00, a01, a10, a11, b0, b1, c00, c01, c11, e0, e1, j00, j01, j11 = (v[:n] for v in state)
            for c, q in zip((c00, c01, c11), self.sorted_q):
                c += q[:n] * dt
            h0, h1 = c00 + x * c01, c01 + x * c11
            used = ~rejected[begin:end] / (h0 + x * h1 + self.noise.pulse)
            miss, s0, s1 = self.y[begin:end] - b0 - x * b1, a00 + x * a10, a01 + x * a11
            g0, g1 = h0 * used, h1 * used
            e0 += s0 * miss * used
            e1 += s1 * miss * used
            j00 += s0 * s0 * used
            j01 += s0 * s1 * used
            j11 += s1 * s1 * used
            a00 -= g0 * s0
            a01 -= g0 * s1
            a10 -= g1 * s0
            a11 -= g1 * s1
            b0 += g0 * miss
            b1 += g1 * miss
            c00 -= g0 * h0
            c01 -= g0 * h1
            c11 -= g1 * h1
        return [self.steps.of_list(v) for v in state]

    def filtered(self, entered: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """States and covariances (m0, m1, p00, p01, p11) after each pulse from those that the buckets are entered in, and the
        pulses that the gate rejects; all by step."""
        state, noise = [v[self.steps.order] for v in entered], self.noise
        after, rejected = [np.empty(len(self.x)) for _ in state], np.zeros(len(self.x), bool)
        for begin, end, n in self.steps.cuts:
            x, dt = self.x[begin:end], self.dt[begin:end]
            m0, m1, p00, p01, p11 = (v[:n] for v in state)
            for p, q in zip((p00, p01, p11), self.sorted_q):
                p += q[:n] * dt
            h0, h1 = p00 + x * p01, p01 + x * p11
            miss, var = self.y[begin:end] - m0 - x * m1, h0 + x * h1 + noise.pulse
            used = 1.0 / var
            if noise.gate is not None:
                rejected[begin:end] = self.late[begin:end] & (np.abs(miss) > noise.gate * np.sqrt(var))
                used *= ~rejected[begin:end]
            g0, g1 = h0 * used, h1 * used
            m0 += g0 * miss
            m1 += g1 * miss
            p00 -= g0 * h0
            p01 -= g0 * h1
            p11 -= g1 * h1
            for v, now in zip(after, state):
                v[begin:end] = now[:n]
        return after, rejected

    def pulls(self, after: list[np.ndarray]) -> list[np.ndarray]:
        """What pulls each filtered state to the smoothed one behind it, a 2x2 matrix by step; nothing behind the last pulse."""
        p00, p01, p11 = after[2:]
        q00, q01, q11 = (self.steps.laid(np.repeat(q, self.steps.sizes)) * self.after for q in self.q)
        m00, m01, m11 = p00 + q00, p01 + q01, p11 + q11
        det = m00 * m11 - m01 * m01
        with np.errstate(all="ignore"):
            i00, i01, i11 = m11 / det, -m01 / det, m00 / det
        flat = np.flatnonzero(np.abs(det) <= 1e-14 * np.abs(m00 * m11))
        if len(flat):
            inverse = np.linalg.pinv(np.stack([m00, m01, m01, m11], 1)[flat].reshape(-1, 2, 2))
            i00[flat], i01[flat], i11[flat] = inverse[:, 0, 0], inverse[:, 0, 1], inverse[:, 1, 1]
        found = [p00 * i00 + p01 * i01, p00 * i01 + p01 * i11, p01 * i00 + p11 * i01, p01 * i01 + p11 * i11]
        last = np.isnan(self.after)
        for v in found:
            v[last] = 0.0
        return found

    def rule(self, after: list[np.ndarray]) -> list[np.ndarray]:
        """The smoother of each bucket: the state behind it s gives g s + g0 at its first pulse."""
        n, pull = len(self.r), self.pulls(after)
        state = [np.full(n, v) for v in (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)]
        for begin, end, n in reversed(self.steps.cuts):
            u00, u01, u10, u11 = (v[begin:end] for v in pull)
            m0, m1 = after[0][begin:end], after[1][begin:end]
            g00, g01, g10, g11, s0, s1 = (v[:n].copy() for v in state)
            new = (u00 * g00 + u01 * g10, u00 * g01 + u01 * g11, u10 * g00 + u11 * g10, u10 * g01 + u11 * g11, m0 + u00 * (s0 - m0) + u01 * (s1 - m1), m1 + u10 * (s0 - m0) + u11 * (s1 - m1))
            for v, now in zip(state, new):
                v[:n] = now
        return [self.steps.of_list(v) for v in state]

    def smoothed(self, after: list[np.ndarray], behind: list[np.ndarray]) -> list[np.ndarray]:
        """Smoothed states of each pulse from those behind the buckets, in the order of the pulses."""
        pull, state, found = self.pulls(after), [v[self.steps.order] for v in behind], [np.empty(len(self.x)) for _ in range(2)]
        for begin, end, n in reversed(self.steps.cuts):
            u00, u01, u10, u11 = (v[begin:end] for v in pull)
            m0, m1 = after[0][begin:end], after[1][begin:end]
            d0, d1 = state[0][:n] - m0, state[1][:n] - m1
            found[0][begin:end] = state[0][:n] = m0 + u00 * d0 + u01 * d1
            found[1][begin:end] = state[1][:n] = m1 + u10 * d0 + u11 * d1
        return [v[self.steps.to] for v in found]


ELEMENT = ["a00", "a01", "a10", "a11", "b0", "b1", "c00", "c01", "c11", "e0", "e1", "j00", "j01", "j11"]
RULE = ["g00", "g01", "g10", "g11", "s0", "s1"]
ENTERED = ["m0", "m1", "p00", "p01", "p11"]
BEHIND = ["z0", "z1"]


def _entered(steps: _Steps, rows: pa.StructArray) -> list[np.ndarray]:
    """State and covariance (``ENTERED``) that each bucket of many clocks is entered in; rows: the clocks' elements, in order."""
    main0 = _numbers(rows, "main0")[steps.begins][steps.order]
    m0, m1, p00, p01, p11, r = main0.copy(), *(np.full(len(main0), v) for v in (1.0, 1.0, 0.0, 1e-6, 0.0))
    known, found = {c: steps.laid(_numbers(rows, c)) for c in ["r", *ELEMENT]}, [np.empty(len(rows)) for _ in ENTERED]
    for begin, end, n in steps.cuts:
        at, a00, a01, a10, a11, b0, b1, c00, c01, c11, e0, e1, j00, j01, j11 = (v[begin:end] for v in known.values())
        d = at - r[:n]
        m0, m1, p00, p01, p11, r = m0[:n] + d * m1[:n], m1[:n], p00[:n] + 2 * d * p01[:n] + d * d * p11[:n], p01[:n] + d * p11[:n], p11[:n], at
        for v, now in zip(found, (m0, m1, p00, p01, p11)):
            v[begin:end] = now
        # What the pulses say of the state: p (1 + j p)^-1, of which both halves are the same.
        t00, t01, t10, t11 = 1 + j00 * p00 + j01 * p01, j00 * p01 + j01 * p11, j01 * p00 + j11 * p01, 1 + j01 * p01 + j11 * p11
        det = t00 * t11 - t01 * t10
        k00, k01, k10, k11 = (p00 * t11 - p01 * t10) / det, (p01 * t00 - p00 * t01) / det, (p01 * t11 - p11 * t10) / det, (p11 * t00 - p01 * t01) / det
        u0, u1 = e0 - j00 * m0 - j01 * m1, e1 - j01 * m0 - j11 * m1
        k01 = (k01 + k10) / 2
        n0, n1 = m0 + k00 * u0 + k01 * u1, m1 + k01 * u0 + k11 * u1
        m0, m1 = a00 * n0 + a01 * n1 + b0, a10 * n0 + a11 * n1 + b1
        f00, f01, f10, f11 = a00 * k00 + a01 * k01, a00 * k01 + a01 * k11, a10 * k00 + a11 * k01, a10 * k01 + a11 * k11
        p00, p01, p11 = f00 * a00 + f01 * a01 + c00, f00 * a10 + f01 * a11 + c01, f10 * a10 + f11 * a11 + c11
    return [v[steps.to] for v in found]


def _behind(steps: _Steps, rows: pa.StructArray) -> list[np.ndarray]:
    """The smoothed state (``BEHIND``) just behind each bucket of many clocks, from the last one back; at the bucket's own time."""
    state, r = [np.zeros(len(steps.sizes)) for _ in BEHIND], np.zeros(len(steps.sizes))
    known, found = {c: steps.laid(_numbers(rows, c)) for c in ["r", *RULE]}, [np.empty(len(rows)) for _ in BEHIND]
    for begin, end, n in reversed(steps.cuts):
        at, g00, g01, g10, g11, s0, s1 = (v[begin:end] for v in known.values())
        z1 = state[1][:n].copy()
        z0 = state[0][:n] + (at - r[:n]) * z1
        found[0][begin:end], found[1][begin:end] = z0, z1
        state[0][:n], state[1][:n], r[:n] = g00 * z0 + g01 * z1 + s0, g10 * z0 + g11 * z1 + s1, at
    return [v[steps.to] for v in found]


def _along(elements: DataFrame, keys: list[str], columns: list[str], compute: Callable[[_Steps, pa.StructArray], list[np.ndarray]], names: list[str], kept: bool) -> DataFrame:
    """(keys, _b, names): what ``compute`` finds along the buckets of each clock; ``kept``: and was, the pulses rejected so far."""
    extra = ["rejected"] if kept else []
    packed = elements.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_b", *columns, *extra))).alias("_l"))
    schema = f"{_schema(elements, keys)}, _b long, {', '.join(f'{c} double' for c in names)}{', was array<int>' if kept else ''}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "_l"):
            steps, rows = _Steps(_sizes(batch.column("_l"))), batch.column("_l").flatten()
            of = pa.array(np.repeat(np.arange(len(batch)), steps.sizes))
            found = [*(batch.column(k).take(of) for k in keys), rows.field("_b"), *map(pa.array, compute(steps, rows)), *(rows.field(c) for c in extra)]
            yield pa.RecordBatch.from_arrays(found, names=[*keys, "_b", *names, *(["was"] if kept else [])])

    return packed.mapInArrow(run, schema)


def fit_in_buckets(pairs: DataFrame, keys: list[str], noise, bucket_s: float = BUCKET_S, max_rounds: int = 100_000) -> DataFrame:
    """(keys, pulse, dev, main, b, a, dev0, rejected): the model that ``clock.fit_clock`` gives for the pairs of each key.

    Pulses stay in their buckets, a row each, and a task takes many buckets side by side; per clock only a row a bucket comes together.
    """
    by = [*keys, "_b"]
    rows = _bucket(pairs.select(*keys, F.col("dev").cast("double").alias("dev"), F.col("main").cast("double").alias("main")), "dev", bucket_s)
    packed = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("dev", "main"))).alias("_p"))
    rows = written(packed.select(*by, F.col("_p")[0].alias("f"), F.element_at("_p", -1).alias("l"), F.size("_p").alias("n"), F.col("_p.dev").alias("devs"), F.col("_p.main").alias("mains")))
    order = Window.partitionBy(*keys).orderBy("_b")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.select(
        *by, F.col("f.dev").alias("first"), F.lag("l.main").over(order).alias("main_before"), F.lead("f.main").over(order).alias("main_after"),
        F.coalesce(F.sum("n").over(past), F.lit(0)).alias("start"), F.first("f.dev").over(order).alias("dev0"), F.first("f.main").over(order).alias("main0"),
    )
    ends = written(ends)
    rows = rows.drop("f", "l", "n")
    columns = ["main0", "r", *ELEMENT, *RULE]
    of_bucket = f"{_schema(rows, keys)}, _b long, {', '.join(f'{c} double' for c in columns)}, rejected array<int>, changed boolean"

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The buckets' elements, and the linear rules of their smoothers, from the states they are entered in (none yet: nothing is rejected)."""
        for batch in _pieces(batches, "devs"):
            pulses = _Pulses(batch, noise)
            steps, n = pulses.steps, len(batch)
            rule, rejected, changed = [np.full(n, v) for v in (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)], np.zeros(len(pulses.x), bool), np.zeros(n, bool)
            if "m0" in batch.schema.names:
                after, rejected = pulses.filtered([_numbers(batch, c) for c in ENTERED])
                rule = pulses.rule(after)
                was, before = batch.column("was"), np.zeros(len(pulses.x), bool)
                before[np.repeat(steps.begins, _sizes(was)) + was.flatten().to_numpy(zero_copy_only=False)] = True
                changed[np.repeat(np.arange(n), steps.sizes)[rejected[steps.to] != before]] = True
            out = rejected[steps.to]
            places = _list(steps.place[out].astype(np.int32), np.bincount(np.repeat(np.arange(n), steps.sizes)[out], minlength=n))
            found = [*(batch.column(k) for k in by), batch.column("main0"), *map(pa.array, (pulses.r, *pulses.element(rejected), *rule)), places, pa.array(changed)]
            yield pa.RecordBatch.from_arrays(found, names=[*by, *columns, "rejected", "changed"])

    elements = written(rows.join(ends, by).mapInArrow(one, of_bucket))
    for _ in range(max_rounds):
        entered = written(_along(elements, keys, ["main0", "r", *ELEMENT], _entered, ENTERED, True))
        elements = written(rows.join(ends.join(entered, by), by).mapInArrow(one, of_bucket))
        if not elements.where("changed").limit(1).count():
            break
    else:
        raise RuntimeError("the fit did not settle")
    behind = _along(elements, keys, ["r", *RULE], _behind, BEHIND, False)
    model = f"{_schema(rows, keys)}, pulse long, dev double, main double, b double, a double, dev0 double, rejected boolean"

    def smooth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "devs"):
            pulses = _Pulses(batch, noise)
            after, rejected = pulses.filtered([_numbers(batch, c) for c in ENTERED])
            offset, skew = pulses.smoothed(after, [_numbers(batch, c) for c in BEHIND])
            of = np.repeat(np.arange(len(batch)), pulses.steps.sizes)
            found = [pulses.pulse, pulses.dev, pulses.main, offset - pulses.r[of] * skew, skew, _numbers(batch, "dev0")[of], rejected[pulses.steps.to]]
            names = ["pulse", "dev", "main", "b", "a", "dev0", "rejected"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(of)) for k in keys), *map(pa.array, found)], names=[*keys, *names])

    known = written(ends.join(entered.drop("was"), by).join(behind, by))
    return rows.join(known, by).mapInArrow(smooth, model)
