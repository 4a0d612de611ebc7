"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import decontaminate, embeddings, filter_audit, language, linededup, merkle, pieces, pii, quality, sharding, simhash, token_counts, token_files
from tempora.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dealt = sharding.stratified_shards(docs, 24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "removed", F.size("removed").cast("long").alias("n_removed"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_groups(table(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.piece_digest(pieces.encode_pieces(table(spark, sf_dir, "documents"), model), model)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.token_file_digest(spark, path)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_ids(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.BASE), F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.merkle_manifest(table(spark, sf_dir, "documents"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s.sibling), ""), 256)
    told = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), merkle.fold(F.col("retold"), F.col("path")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_pieces": op6_pieces,
    "op7_decontaminate": op7_decontaminate,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_language": op10_language,
    "op11_pii": op11_pii,
    "op12_merkle": op12_merkle,
    "op13_filter_audit": op13_filter_audit,
}

#: SQL for those operators that SQL can express; the others are tested against brute force.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"

#: crc32 of the digits of doc_id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1))), 4294967295)"""

ORACLE_SQL: dict[str, str] = {
    "op3_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.a AS vec_id, coalesce(n, 0) AS n_links, component_id, c.a = component_id AS kept FROM c LEFT JOIN n USING (a)""",
    "op7_decontaminate": f"""WITH d AS (SELECT doc_id, {_WORDS} FROM documents), b AS (SELECT item_id, {_WORDS} FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, k WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM p JOIN g USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * 20 >= len(w) AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op12_merkle": f"""WITH RECURSIVE f(doc_id, lang, leaf, told) AS (SELECT doc_id, lang, sha256(a || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') || z),
sha256(a || coalesce(octet_length(encode(CAST(n_chars + t AS VARCHAR))) || ':' || (n_chars + t), '-') || z) FROM (SELECT *, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a,
coalesce(octet_length(encode(text)) || ':' || text, '-') AS z, CASE WHEN {_CRC} % 7 = 0 THEN 1 ELSE 0 END AS t FROM documents)),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM f),
r(lang, lev, n, i, h) AS (SELECT lang, 0, n, i, leaf FROM l UNION ALL SELECT lang, lev + 1, (n + 1) // 2, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM r WHERE n > 1 GROUP BY lang, lev, n, i // 2),
s AS (SELECT lang, h, lev, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM r WHERE n = 1),
u(lev, n, i, h) AS (SELECT 0, n, i, h FROM s UNION ALL SELECT lev + 1, (n + 1) // 2, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lev, n, i // 2),
p AS (SELECT l.doc_id, l.leaf, l.lang, l.i AS pos, a.lev, (l.i >> a.lev) & 1 AS odd, b.h AS sib FROM l JOIN (SELECT DISTINCT lang, lev, n FROM r WHERE n > 1) a ON l.lang IS NOT DISTINCT FROM a.lang LEFT JOIN r b ON b.lang IS NOT DISTINCT FROM l.lang AND b.lev = a.lev AND b.i = xor(l.i >> a.lev, 1)
UNION ALL SELECT l.doc_id, l.leaf, l.lang, l.i, 1000 + a.lev, (s.i >> a.lev) & 1, b.h FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN (SELECT DISTINCT lev, n FROM u WHERE n > 1) a ON true LEFT JOIN u b ON b.lev = a.lev AND b.i = xor(s.i >> a.lev, 1)),
q AS (SELECT lang, pos, list(struct_pack(odd := odd, sib := sib) ORDER BY lev) AS path, sha256(string_agg(coalesce(sib, ''), '' ORDER BY lev)) AS proof FROM p GROUP BY lang, pos),
k(lang, i, d, h) AS (SELECT lang, i, 0, told FROM l UNION ALL SELECT k.lang, k.i, d + 1, sha256(CASE WHEN path[d + 1].sib IS NULL THEN k.h WHEN path[d + 1].odd = 1 THEN path[d + 1].sib || k.h ELSE k.h || path[d + 1].sib END) FROM k JOIN q ON k.lang IS NOT DISTINCT FROM q.lang AND k.i = q.pos WHERE d < len(path)),
e AS (SELECT lang, i, max_by(h, d) AS folded FROM k GROUP BY lang, i), t AS (SELECT h AS root FROM u WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN e ON e.lang IS NOT DISTINCT FROM l.lang AND e.i = l.i LEFT JOIN q ON q.lang IS NOT DISTINCT FROM l.lang AND q.pos = l.i, t""",
    "op13_filter_audit": r"""WITH w AS (SELECT *, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT x, min(doc_id) AS least FROM w GROUP BY x), g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT coalesce(lang, '') AS part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT) + 4 * CAST(100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) AS INT)
+ 8 * CAST(regexp_matches(x, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > least, false) AS INT) AS f FROM w JOIN m USING (x) LEFT JOIN g USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, f),
b AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS o FROM b a, b b, b c, b d, b e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT o AS filter_order, k AS step, x.bit AS own, coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(o[j]) - 65))), 0)::INT AS before FROM o, range(1, 6) t(k), b x WHERE o[k] = x.l),
t AS (SELECT part, filter_order, CAST(step AS INT) AS step, own, CAST(sum(CASE WHEN f & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN f & own > 0 AND f & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
CAST(sum(CASE WHEN f & own > 0 AND f & before > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN f = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN f & own > 0 AND f & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
CAST(sum(CASE WHEN f & own > 0 AND f & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM s, c GROUP BY ALL)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM t""",
}
