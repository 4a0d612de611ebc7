"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import tempora.plans as plans

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        out.append(tuple("null" if row[i] is None or isinstance(row[i], float) and math.isnan(row[i]) else f"{row[i]:.6g}" if isinstance(row[i], float) else str(row[i]) for i in order))
    return sorted(columns), sorted(out)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, FOLDER)
    found = duck.execute(plans.ORACLE_SQL[name])
    assert canonical(df.collect(), df.columns) == canonical(found.fetchall(), [d[0] for d in found.description])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_sql(spark):
    found = plans.QUERIES["fused_tracks"](spark, FOLDER).collect()
    assert len(found) == 5 and all(r.n == r.rows and r.off_m < 0.5 for r in found)


def test_preference_covers_all_days(spark, duck):
    found = {(r.user_id, r.day) for r in plans.QUERIES["source_preference_days"](spark, FOLDER).collect()}
    want = duck.execute("SELECT DISTINCT user_id, epoch_us(ts) // 86400000000 FROM events").fetchall()
    assert found == set(want) and len({d for _, d in found}) > 2


def test_fits_return_values(spark):
    circles = plans.QUERIES["circle_values"](spark, FOLDER).collect()
    assert len(circles) > 5 and all(c.r > 0 and c.cx is not None and c.cy is not None for c in circles)
    motions = plans.QUERIES["rigid_motion"](spark, FOLDER).collect()
    assert len(motions) > 5 and all(m.tx == -3.5 and m.r1 < 0 for m in motions)
