"""Embedding groups, connected components and the pipeline's stages."""

from __future__ import annotations

import random

import numpy as np

from tempora.llm import embeddings, graph


def test_components(spark):
    rng = random.Random(0)
    n = 300
    links = [(i, i + 1) for i in range(0, 120)] + [(rng.randrange(120, n), rng.randrange(120, n)) for _ in range(150)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3), (4, None), (1, 0), (0, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {x: find(x) for x in root}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute(rows):
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float) / np.abs(rows[k][1]).max()) / np.abs(rows[k][1]).max() for k in good}
    near = {k: [j for j in good if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.95] for k in range(len(rows)) if k in unit}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen)
        out.append((i, len(near.get(k, [])), least, i == least))
    return sorted(out)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 16)))]
    for i in range(100, 160):
        base = np.array(rows[i % 6][1])
        rows.append((i, (base + rng.normal(size=16) * np.linalg.norm(base) * 0.02 * (i % 4)).tolist()))
    rows += [(200, None), (201, []), (202, [0.0] * 16), (203, [1.0, None] + [0.0] * 14), (204, [float("nan")] * 16), (205, [float("inf")] + [0.0] * 15), (206, rows[3][1]), (206, rows[3][1]), (207, rows[4][1][:8]), (208, [x * 1e200 for x in rows[5][1]]), (209, [x * 1e-200 for x in rows[5][1]])]
    df = spark.createDataFrame([(i, v, 1, "clash", 3) for i, v in rows], "vec_id long, embedding array<double>, label int, h string, copies int")
    found = sorted(tuple(r) for r in embeddings.embedding_groups(df).select("vec_id", "n_links", "component_id", "kept").collect())
    assert found == brute(rows)
    assert embeddings.embedding_groups(df.limit(0)).count() == 0


def test_embedding_blocks(spark, monkeypatch):
    """A component that is cut into many blocks gives the same counts."""
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    rng = np.random.default_rng(2)
    base = rng.normal(size=32)
    rows = [(i, (base + rng.normal(size=32) * 0.2).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in embeddings.embedding_groups(df).select("vec_id", "n_links", "component_id", "kept").collect()) == brute(rows)


def test_lattice():
    """A decoded point is the nearest of all E8 points around."""
    rng = np.random.default_rng(3)
    y = rng.normal(size=(200, 8)) * 2
    found = embeddings.e8_cells(y)
    assert (found[:, 0] % 2 == found[:, 0, :1] % 2).all() and (found.sum(2) % 4 == 0).all()
    far = ((2 * y[:, None, :] - found) ** 2).sum(2)
    assert (far[:, 0] <= far[:, 1] + 1e-9).all() and (far[:, 0] <= 4 + 1e-9).all()  # the covering radius is 1


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    n = docs.count()
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder))
        seen.append((name, docs.count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    counts = [n, *(c for _, c in seen)]
    assert all(a >= b for a, b in zip(counts, counts[1:])) and counts[-1] > n / 2
    assert docs.where("not round_trip").count() == 0
