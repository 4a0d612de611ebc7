"""Personal data, the Merkle manifest and the filter audit against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tempora.llm import filter_audit, merkle, pii, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h int, g string, row string, spans int, part string"
WORDS = "ka mo ri tel vun sha nor lip dez gum".split()


def frame(spark, rows):
    """Rows (id, text, lang, source) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 7, "g", "row", 1, "part") for i, t, lang, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            bad = kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 10 <= len(digits) <= 15
            if not bad:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


PRIVATE = [
    "a.b@c.de", "x@y.com_foo@bar.com", "a@b", "foo@bar@x.com", "a@b..com", "a@b.c.", "🙂a@b.io🙂", "1.2.3.4.5.6.7.8", "1.2.3.999", "0001.2.3.255", "300.1.2.3.4", "v1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "4111111111111111 4111111111111111", "5 5 0 0 0 0 0 0 0 0 0 0 0 0 0 4", "+1 (743) 555-3824", "+49.30.1234567 890", "++123456789012", "+1 2", "1--2", "中文4111111111111111中文", "+12345678901+12345678901", "@@", "1.1.1.1@1.1.1.1",
]


@pytest.fixture(scope="module")
def private():
    rng = random.Random(3)
    texts = [None, "", " ", *PRIVATE, " ".join(PRIVATE), "".join(PRIVATE)]
    texts += ["".join(rng.choice("ab1234 .@+-(") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    texts += ["1" * 2000, "a" * 2000, "1 " * 1000 + "@", ("x@y.zz 10.1.1.1 " * 500)]
    out = [(i, t, "en", "s") for i, t in enumerate(texts)]
    return [*out, (None, "mail a@b.de", None, None), (3, texts[3], "en", "s"), (3, texts[3], "en", "s"), (4, "other a@b.fr", "en", "s")]


def test_base_spans(spark, private):
    found = pii.pii_spans(frame(spark, private).repartition(3)).collect()
    want = Counter((i, ",".join(f"{k}:{a}:{e}" for a, _, e, k in plain_spans(t))) for i, t, *_ in private)
    assert Counter((r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base)) for r in found) == want
    for r in found:
        base = [s for s in r.spans if s.base]
        assert [(s.start, s.rank) for s in r.spans] == sorted((s.start, s.rank) for s in r.spans)
        if len(r.spans) < 500:
            assert not any(a.start < b.end and b.start < a.end for a in r.spans if not a.base for b in base)
    assert pii.pii_spans(frame(spark, private).limit(0)).count() == 0


def test_long_texts(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(["1" * 300_000, "a" * 300_000, "1 " * 150_000 + "@", "ab1" * 100_000, "1." * 100_000, "x@y.zz 10.1.1.1 " * 10_000])]
    found = {r.doc_id: r.spans for r in pii.pii_spans(frame(spark, rows)).collect()}
    assert found[0] == found[1] == [] and not any(s.base for i in (2, 3) for s in found[i]) and [s.start for s in found[4]] == [8 * i for i in range(25_000)]
    assert Counter(s.kind for s in found[5] if s.base) == {"email": 10_000, "ip": 10_000}


def test_added_spans(spark):
    rng = random.Random(8)
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f"{sentence(rng, 30)} token = \"{''.join(rng.choice('0123456789abcdef') for _ in range(40))}\" {sentence(rng, 30)}", "en", "s") for i in range(40)]
    rows += [(i, f"{sentence(rng, 9)} mail{i}@host{i}.org {sentence(rng, 9)} tel +1 (743) 555-{i:04}", "en", "s") for i in range(40, 80)]
    rows += [(100, f"ka secret = '{key}' mo", "en", "s"), (101, "ka 4111111111111112 mo 999.1.1.1 ri 12:30:45 am 2024-01-15 version 1.2.3", "en", "s"), (102, "call (743) 555-3824 now", "en", "s")]
    rows += [(103, sentence(rng, 200), "en", "s"), (104, "write to jo (at) example.org", "en", "s"), (105, "Donaudampfschifffahrtsgesellschaftskapitän und Donaudampfschiff", "de", "s")]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.pii_spans(frame(spark, rows)).collect()}
    texts = {i: t for i, t, *_ in rows}
    assert all([k for k, *_ in found[i]] == ["secret"] and re.fullmatch("[0-9a-f]{40}", texts[i][found[i][0][1] : found[i][0][2]]) for i in [*range(40), 100])
    assert all([k for k, *_ in found[i]] == ["email", "phone"] for i in range(40, 80))
    assert found[101] == found[103] == found[105] == []
    assert [k for k, *_ in found[102]] == ["phone"] and [k for k, *_ in found[104]] == ["email"]


def test_reliabilities(spark):
    """EM against the same rules in plain loops."""
    import math

    rng = random.Random(4)
    seen = Counter(tuple(rng.choice([-1, 0, 1]) if rng.random() < 0.4 else y for _ in pii.LABELERS) for y in rng.choices([1, -1], [3, 2], k=300))
    got = {tuple(r.votes): r.belief for r in pii.reliabilities(spark.createDataFrame([(1, list(v), n) for v, n in seen.items()], "kind int, votes array<int>, n long")).collect()}
    r = {v: 1 / (1 + math.exp(-sum(v))) for v in seen}
    w, total = pii.WEIGHT, sum(seen.values())
    for _ in range(pii.ROUNDS):
        t = {}
        for side, own in ((0, -1), (1, 1)):
            for j in range(len(pii.LABELERS)):
                c = {x: w * (0.5 if x == 0 else 0.4 if x == own else 0.1) + sum(n * (r[v] if side else 1 - r[v]) for v, n in seen.items() if v[j] == x) for x in (-1, 0, 1)}
                t |= {(side, j, x): k / sum(c.values()) for x, k in c.items()}
        share = (sum(n * r[v] for v, n in seen.items()) + w / 2) / (total + w)
        odds = {v: math.log(share / (1 - share)) + sum(math.log(t[1, j, x] / t[0, j, x]) for j, x in enumerate(v)) for v in seen}
        r = {v: 1 / (1 + math.exp(-o)) for v, o in odds.items()}
    assert got.keys() == r.keys() and all(abs(got[v] - r[v]) < 1e-9 for v in r)


def hexed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return hexed(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root and each node's siblings, level by level: (sibling, whether it is on the left)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            paths[k].append((nodes[other] if other < len(nodes) else None, bool(i & 1)))
        nodes = [hexed(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


@pytest.mark.parametrize("storey", [2, 10])
def test_merkle(spark, monkeypatch, storey):
    monkeypatch.setattr(merkle, "STOREY", storey)
    rng = random.Random(2)
    rows = [(i, sentence(rng, 5), rng.choice(["en", "en", "en", "de", None, "ä", ""]), "s") for i in range(150)]
    rows += [(None, "x", "en", None), (5, None, "en", None), (5, None, "en", None), (5, "", "en", ""), (7, "lone", "xx", "s"), (8, "z" * 100_000, "de", "s")]
    df = frame(spark, rows)
    found = merkle.merkle_manifest(df.repartition(5)).collect()
    groups = {}
    for i, t, lang, s in rows:
        n = None if t is None else len(t)
        own = plain_leaf((i, s, lang, n, t))
        told = plain_leaf((i, s, lang, n + 1, t)) if n is not None and i is not None and zlib.crc32(str(i).encode()) % 7 == 0 else own
        groups.setdefault(lang, []).append((i is not None, i or 0, own, i, told))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    want = Counter()
    for g, up in zip(names, above):
        for (_, _, own, i, told), path in zip(sorted(groups[g]), trees[g][1]):
            want[(i, own, told, trees[g][0], root, tuple(path + up))] += 1
    assert Counter((r.doc_id, r.leaf, r.retold, r.subroot, r.root, tuple((s.sibling, s.left) for s in r.path)) for r in found) == want
    assert all((r.leaf == r.retold) == (f == r.root) for r, f in ((r, r.f) for r in merkle.merkle_manifest(df).select("*", merkle.fold(F.col("retold"), F.col("path")).alias("f")).collect()))
    assert merkle.merkle_manifest(df.limit(0)).count() == 0


def test_filter_audit(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([sentence(rng, 210), sentence(rng, 20), f"Ä {sentence(rng, 199)} AAA", " ".join(f"w{j}" for j in range(250)) + rng.choice(["", "#", "X" * 60]), "\t same \n"]), rng.choice(["en", "de", None, ""]), "s") for i in range(120)]
    rows += [(None, "\t same \n", "en", None), (500, None, "en", None), (501, "", "en", None), (502, "q " * 5000, "en", None), (3, rows[3][1], "en", None), (3, rows[3][1], "en", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1)]
    found = filter_audit.filter_audit(frame(spark, rows).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))

    def failed(i, text):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [j for j, u, *_ in rows if (u or "") == t and j is not None]
        return {f for f, bad in zip("ABCDE", [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and min(same) < i]) if bad}

    marks = [(lang or "", failed(i, t), i in good, i in toxic) for i, t, lang, _ in rows]
    assert len(found) == 3 * 600
    want, shapley = {}, Counter()
    for part in ("", "en", "de"):
        own = [m[1:] for m in marks if m[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                here, before = [m for m in left if f in m[0]], [m for m in own if f in m[0] and m[0] & set(order[:k])]
                left = [m for m in left if f not in m[0]]
                want[part, order, k + 1] = (len(left), len(here), len(before), sum(m[0] == {f} for m in own), sum(m[1] for m in here), sum(m[2] for m in here))
                shapley[part, f] += len(here)
    for r in found:
        assert (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) == want[r.part, r.filter_order, r.step]
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]
    assert filter_audit.filter_audit(frame(spark, rows).limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


@pytest.mark.parametrize("name", ["op12_merkle", "op13_filter_audit", "op3_embedding_dedup", "op7_decontaminate"])
def test_queries_with_sql(spark, name):
    """The registered queries against their SQL."""
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    found = duck.execute(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert Counter(tuple(str(r[c]) for c in columns) for r in df.collect()) == Counter(tuple(str(x[names.index(c)]) for c in columns) for x in found.fetchall())


def test_query_of_personal_data(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op11_pii(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, _, e, k in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[1] == k for w in want) for k in range(4))
