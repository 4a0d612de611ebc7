"""The document operators against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempora.llm import decontaminate, language, linededup, pieces, quality, sharding, simhash, token_counts, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, h int, key string"
WORDS = [a + b for a in ("ka", "mo", "ri", "tel", "vun", "sha") for b in ("na", "lor", "pit", "sed", "gum")]


def frame(spark, rows):
    """Rows (id, text, lang, source) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "clash", 7, "clash") for i, t, lang, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = sentence(rng, 60)
    out = [(1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", "s"), (4, "…!?", "de", None), (5, "zwölf Boxkämpfer <|endoftext|> jagen 中文字符 🙂", "de", "s"), (6, base, "en", "hot"), (7, base, "en", "hot"), (7, base, "en", "hot")]
    for i in range(10, 70):
        out.append((i, "\n".join(sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 5))), rng.choice(["en", "de"]), "hot" if i % 3 else f"s{i}"))
    near = base.split()
    for i in range(70, 76):
        near = list(near)
        near[rng.randrange(len(near))] = rng.choice(WORDS)
        out.append((i, " ".join(near), "en", "near"))
    out.append((80, sentence(rng, 30_000), "en", "long"))
    out.append((None, "no id here", "en", "s"))
    return out


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shards(spark, rows):
    df = frame(spark, rows)
    out = sharding.stratified_shards(df, 5).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and sorted(by) == list(range(5))
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    texts = Counter((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert texts == Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    hot = Counter(r.shard for r in out if r.source == "hot")
    n = sum(hot.values())
    assert all(abs(hot[s] - n * len(by[s]) / len(out)) <= 2 for s in by)
    assert collected(sharding.stratified_shards(df, 5)) == collected(sharding.stratified_shards(df.repartition(7), 5))
    assert sharding.stratified_shards(df.limit(0), 5).count() == 0
    assert sharding.stratified_shards(df, 500).count() == len(rows)


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_simhash(spark, rows, monkeypatch):
    for variants, at_once in ((1 << 20, 1 << 23), (1 << 15, 1 << 13)):  # one group; many groups, some in slices
        monkeypatch.setattr(simhash, "GROUP_VARIANTS", variants)
        monkeypatch.setattr(simhash, "SORT_VARIANTS", at_once)
        out = simhash.simhash_groups(frame(spark, rows)).collect()
        fps = [brute_fingerprint(t) for _, t, *_ in rows]
        assert Counter((r[0], np.uint64(f).astype(np.int64).item()) for r, f in zip(rows, fps)) == Counter((r.doc_id, r.fp) for r in out)
        root = components(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if bin(fps[a] ^ fps[b]).count("1") <= 4])
        least = {k: min((r[0] for r, x in zip(rows, root) if x == k and r[0] is not None), default=None) for k in root}
        assert Counter((r[0], least[x]) for r, x in zip(rows, root)) == Counter((r.doc_id, r.component_id) for r in out)
    assert simhash.simhash_groups(frame(spark, [])).count() == 0


def test_simhash_chain(spark):
    """A crowd of fingerprints around one value, all linked through steps of a few bits."""
    rng = random.Random(1)
    values = [rng.getrandbits(64)]
    for _ in range(400):
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            v ^= 1 << b
        values.append(v)
    values += [rng.getrandbits(64) for _ in range(50)]
    values = sorted(set(values))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = simhash.link_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    at = {v: i for i, v in enumerate(signed)}
    found = components(len(values), [(at[r.u], at[r.v]) for r in links])
    want = components(len(values), [(a, b) for a, b in itertools.combinations(range(len(values)), 2) if bin(values[a] ^ values[b]).count("1") <= 4])
    assert len(set(zip(found, want))) == len(set(found)) == len(set(want))


def test_variants_by_group():
    """All groups together have the whole ball of every fingerprint, each variant once."""
    rng = np.random.default_rng(3)
    owners = np.unique(rng.integers(0, 1 << 63, 5, dtype=np.uint64))
    for bits in (0, 2, 6):
        found = Counter()
        for group in range(1 << bits):
            low = np.uint64((1 << bits) - 1)
            reached = np.array([o for o in owners if int(o & low) ^ group in simhash._ball(0, bits).tolist()], np.uint64)
            if len(reached):
                v, w = simhash._variants(reached, group, bits)
                assert all(int(x & low) == group for x in v)
                found.update((int(reached[i]), int(x)) for x, i in zip(v, w))
        assert found == Counter((int(o), int(o) ^ m) for o in owners for m in simhash._ball(0, 64).tolist())


def test_keep_one(spark, rows):
    out = simhash.keep_one_of_each(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    groups = simhash.simhash_groups(frame(spark, rows)).collect()
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted({r.component_id for r in groups}, key=repr)


def brute_contamination(rows, items):
    fixed = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(fixed))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])].add(i)
    out = Counter()
    for i, t, *_ in rows:
        w = words(t)
        hit, ids = set(), set()
        for g, who in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    ids |= {str(x) for x in who if x is not None}
        out[(i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


def test_kept_documents_move_no_texts(spark):
    """Few documents go, so the ids that go are sent to the texts, however many stay and whatever Spark broadcasts by itself."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(40)) for _ in range(60)]
    docs = frame(spark, [(i, t, "en", "x") for i, t in enumerate([*texts, texts[0], texts[1]])])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.keep_one_of_each(docs)
        kept = {r.doc_id for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kept == set(range(60)) and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_contamination(spark, rows):
    rng = random.Random(8)
    docs = {r[0]: r[1] for r in rows}
    items = [(1, docs[6]), (2, None), (3, ""), (4, "Karinlo Mopit"), (5, docs[20].split("\n")[0][:400]), (6, docs[6].upper()), (7, sentence(rng, 40)), (10, sentence(rng, 13)), (11, "zwölf"), (None, docs[10])]
    planted = [*rows, (90, sentence(rng, 500) + ". " + items[7][1] + " ! " + sentence(rng, 9), "en", "p"), (91, items[6][1] + " " + items[6][1], "en", "p")]
    found = decontaminate.contamination(frame(spark, planted), spark.createDataFrame(items, "item_id long, text string"))
    digest = found.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    want = brute_contamination(planted, items)
    assert Counter(tuple(r) for r in digest.collect()) == want
    kept = decontaminate.drop_contaminated(frame(spark, planted), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(r.doc_id for r in kept.collect()) == sum((Counter({k[0]: n}) for k, n in want.items() if not k[5]), Counter())
    with pytest.MonkeyPatch.context() as patch:  # too many windows to broadcast
        patch.setattr(decontaminate, "BROADCAST_ROWS", 0)
        df = frame(spark, planted).withColumns({"_d": F.lit(1), "_t": F.lit("x"), "n": F.lit(2), "w": F.lit(3)})
        found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"))
        digest = found.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), "contaminated")
        assert Counter(tuple(r) for r in digest.collect()) == want
        again = decontaminate.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
        assert again.columns == df.columns and again.count() == kept.count()
    none = decontaminate.contamination(frame(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(rows)


def test_token_counts(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    odd = [(100 + k, t, None, None) for k, t in enumerate(["<|endoftext|><|endoftext|>", "a<|endoftext|> b", "x" * 3000, "   \x85\x1c \r\n ", "Ǆ ½²³ ١٢٣ don't I'LL", "\x00\x01"])]
    want += Counter((i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t, *_ in odd)
    out = token_counts.token_counts(frame(spark, [*rows, *odd]), path)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out.collect()) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out.collect())
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


def test_token_files(spark, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    known = [r for r in rows if r[0] is not None] + [(2**62 + k, f"large id {k}", None, None) for k in range(9)] + [(101, "ΑΣ Σ <|endoftext|>İ é it's", None, None), (102, "日本 " * 500, None, None)]
    out = token_files.token_file_digest(spark, token_files.write_token_files(frame(spark, known), path, 1, docs_per_file=9)).collect()
    want, start = Counter(), 0
    for i, t, *_ in sorted(known, key=lambda r: r[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want[(i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in out) == want
    assert token_files.token_file_digest(spark, token_files.write_token_files(frame(spark, []), path, 1)).count() == 0
    mixed = token_files.token_file_digest(spark, token_files.write_token_files(frame(spark, [*known, (None, "first of all", None, None)]).coalesce(1), path, 1, docs_per_file=9)).collect()
    lone = next(r for r in mixed if r.doc_id is None)
    assert lone.start == 0 and Counter((r.doc_id, r.start - lone.n_tokens, *r[2:]) for r in mixed if r.doc_id is not None) == want


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1, 0], list(range(0, 70000, 7))])
def test_rank_code(ranks):
    control, data = token_files.pack_ranks(np.array(ranks, np.uint32))
    assert token_files.unpack_ranks(control, data, len(ranks)).tolist() == ranks


def test_pieces(spark, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = [(100 + k, t, None, None) for k, t in enumerate(["  a b  c \n d\té <s> 日本 ", "<0x0A> ﬁ ① ½", "a" * 300, "▁x ▁", " ", "\r\n\x00"])]
    coded = pieces.encode_pieces(frame(spark, [*rows, *odd]), path)
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == Counter((i, tuple(library.encode(t or ""))) for i, t, *_ in [*rows, *odd])
    decoded = pieces.decode_pieces(coded, path).collect()
    assert all(r.decoded == library.decode(list(r.ids)) for r in decoded)
    assert pieces.piece_digest(coded, path).where("not round_trip").count() == 1  # a mark in the text itself comes back as a space
    assert pieces.encode_pieces(frame(spark, []), path).count() == 0
    model = pieces.load(path)
    for key, value in list(model.pairs.items())[:500]:
        a, b = model.piece[key >> 32], model.piece[key & 0xFFFFFFFF]
        assert (model.merge(a + b) == [a, b]) == value


def brute_lines(rows):
    occurrences = []
    for i, t, *_ in rows:
        for k, line in enumerate(t.split("\n") if t is not None else ()):
            line = re.sub(r"[ \t\r\f\v]+", " ", line.lower()).strip(" ")
            if line:
                occurrences.append((i is None, i or 0, xxhash.xxh64_intdigest((t or "").encode(), 42), k, line, i))
    distinct = sorted({o[4] for o in occurrences})
    all_sets = [frozenset(x[i : i + 5] for i in range(max(1, len(x) - 4))) for x in distinct]
    alike = lambda p, q: len(p & q) >= 0.8 * len(p | q)
    root = components(len(distinct), [(a, b) for a, b in itertools.combinations(range(len(distinct)), 2) if alike(all_sets[a], all_sets[b])])
    part = dict(zip(distinct, root))
    first = {}
    for o in sorted(occurrences, key=lambda o: (o[0], o[1], o[3])):
        first.setdefault(part[o[4]], (o[5], o[3]))
    gone = defaultdict(set)
    for o in occurrences:
        if first[part[o[4]]] != (o[5], o[3]):
            gone[o[5]].add(o[3])
    return gone


def test_lines(spark, rows):
    rng = random.Random(3)
    line = sentence(rng, 40)
    changed = line.replace(line.split()[7], "xx", 1)
    more = [(200, f"{line}\nkept one", "en", "s"), (201, f"first\n{changed}\n{line.upper()}", "en", "s"), (202, "first\nkept one\nfirst", "en", "s"), (203, "a\n\nb\na", "en", "s"), (204, "😀😀é😀\n B\n\nfirst!", "en", "s")]
    some = rows + more
    df = frame(spark, some).withColumns({"_d": F.lit(1), "_T": F.lit("x"), "_th": F.lit(2), "_removed": F.lit(None).cast("int")})
    out = linededup.dedup_lines(df)
    assert out.where("_d = 1 and _T = 'x' and _th = 2 and _removed is null").count() == len(some)
    assert out.columns == [*df.columns, "n_lines", "removed"]
    gone = brute_lines(some)
    for r in out.collect():
        assert set(r.removed) == gone.get(r.doc_id, set())
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[201] == "first" and texts[202] == "" and texts[203] == "a\n\nb" and texts[204] == "😀😀é😀\n\nfirst!" and texts[1] is None and texts[2] == ""
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


def test_quality(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        text = sentence(rng, 120) if good else " ".join(w.upper() + "!!" for w in sentence(rng, 60).split()) + " " + sentence(rng, 60)
        docs.append((i, text, "en", "s"))
        labels.append((i, int(good), 0))
    docs += [(1000, None, None, None), (1001, "", None, None), (1002, " \n", None, None), (6, sentence(rng, 20_000), "en", "s"), (5, docs[5][1], "en", "s"), (None, "no id", None, None)]
    labels += [(5, 1, 0), (7, None, 0), (None, 0, 0), (9999, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.quality_scores(frame(spark, docs), table).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    known = dict((i, q) for i, q, _ in labels)
    held = [(r.predicted, known[r.doc_id]) for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(p == q for p, q in held) >= 0.97 * len(held) > 0
    none = quality.quality_scores(frame(spark, docs), table.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(frame(spark, []), table).count() == 0


def test_quality_gradient():
    rng = np.random.default_rng(0)
    model = quality.AttentionModel(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    x, first, y = rng.normal(size=(7, quality.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, first)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = model.gradient(x, first, y)
    for name in model.p:
        at = tuple(rng.integers(0, s) for s in model.p[name].shape)
        old, step = model.p[name][at], 1e-5
        model.p[name][at] = old + step
        up = loss()
        model.p[name][at] = old - step
        down = loss()
        model.p[name][at] = old
        assert abs((up - down) / (2 * step) - found[name][at]) < 1e-6


def test_language(spark):
    rng = random.Random(4)
    kinds = {"aa": ["kaminot", "lurebas", "ominda"], "bb": ["zwißch", "übrückt", "schnöq"], "cc": ["ñandúes", "ción", "llevará"]}
    docs = [(i, " ".join(rng.choice(kinds[k]) + rng.choice("xyz") for _ in range(30)), k, "s") for i, k in enumerate(rng.choice(list(kinds)) for _ in range(300))]
    docs += [(1000, None, "aa", None), (1001, "", "aa", None), (1002, "123 …! ½ ² Ⅷ ⓐ", "bb", None), (1004, " ".join(["ñandúes", "ción"] * 20_000), "cc", "s"), (1003, "kaminotx", None, None), (3, docs[3][1], docs[3][2], "s"), (None, "lurebasy", "aa", None)]
    out = language.language_ids(frame(spark, docs)).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    found = {r.doc_id: r.lang_pred for r in out}
    assert found[1000] == found[1001] == found[1002] == "und"
    held = [r for r in out if r.held_out and r.doc_id < 300]
    truth = {i: lang for i, _, lang, _ in docs}
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert {r.lang_pred for r in language.language_ids(frame(spark, [(1, "abc", None, None)])).collect()} == {"und"}
    assert language.language_ids(frame(spark, [])).count() == 0


def test_token_rows_pack_as_one_by_one():
    import numpy as np

    from tempora.llm import token_files as tf

    rng = np.random.default_rng(1)
    for vocabulary in (60_000, 1 << 25):
        rank = rng.permutation(vocabulary).astype(np.uint32)
        by_rank, ids = np.argsort(rank).astype("<u4"), [rng.integers(0, vocabulary, n) for n in (1, 4, 3, 17, 8, 1, 1000, 5)]
        control, data = tf.pack_rows(ids, rank)
        assert [(c.as_py(), d.as_py()) for c, d in zip(control, data)] == [tf.pack_ranks(rank[x]) for x in ids]
        back = tf.unpack_rows(control.slice(1, 5), data.slice(1, 5), np.array([len(x) for x in ids[1:6]]), by_rank)
        assert [b.as_py() for b in back] == [x.astype("<u4").tobytes() for x in ids[1:6]]
    assert list(tf.together(np.array([tf.UNPACK_IDS + 1, 3, 4]))) == [(0, 1), (1, 3)]
    assert list(tf.together(np.array([], np.int64))) == []
