"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier of spans decides. DataFrame only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import materialize, small

#: The kinds of spans; the first four have a fixed pattern too, whose valid matches are always kept.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
#: The fixed patterns. They match what the plain forms do; marks for no way back and for where a run begins keep them
#: linear in texts without an end of word.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold at least before a pattern is tried: far cheaper to see.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
#: Candidates for all kinds, in the order in which they are tried: more than the fixed patterns find, and more than is personal.
_NAME = r"\s@<>()\[\]{}\"',;:="
CANDIDATE = "|".join(
    [
        rf"(?<![^{_NAME}])[^{_NAME}]++(?:@| ?[(\[]at[)\]] ?)[^{_NAME}]++",
        r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?:[0-9A-Fa-f]{1,4}|:[0-9A-Fa-f]{0,4})(?![0-9A-Za-z:])",
        r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
        r"(?<![A-Za-z0-9_])(?=[A-Za-z_]{0,64}[0-9])(?=[0-9]{0,64}[A-Za-z_])[A-Za-z0-9_]{20,}+",
        r"\+[0-9][ ().0-9-]{6,24}[0-9](?![0-9])",
        r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,18}+(?![0-9])",
        r"(?<![0-9])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,4}+(?![0-9])",
    ]
)
NEEDED = r"@|[(\[]at[)\]]|[0-9]"
#: Characters before and after a candidate that labelers look at.
BEFORE, AFTER = 24, 8
#: Lists: top-level domains, calling codes, names that a secret is given, and words that stand before a kind or against all.
DOMAINS = "com org net edu gov info biz io de fr es uk it eu us ca ch at nl be pt pl se".split()
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 81 82 86 90 91 351 353 358".split()
CUES = {
    "email": "mail email contact kontakt correo courriel",
    "ip": "ip host server address adresse dirección",
    "card": "card visa mastercard karte carte tarjeta credit",
    "phone": "tel telefon phone call fax mobil mobile handy teléfono téléphone",
    "secret": "token secret key apikey password passwd pwd bearer credential",
}
AGAINST = "version v isbn issn order sha sha1 sha256 md5 commit revision build figure page doi".split()
LABELERS = ("form", "plain", "listed", "cue", "against", "assigned")
FEATURES = 10
#: Steps of EM and of the classifier's descent; weights of the beliefs that EM starts from; the probability a span needs.
ROUNDS, STEPS, RATE, RIDGE, WEIGHT, ACCEPT = 20, 200, 2.0, 0.01, 10.0, 0.5


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _quad(hit: Column) -> Column:
    """Whether all four numbers are at most 255."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _luhn(hit: Column, least: int, most: int) -> Column:
    digits = _digits(hit)
    return F.when(F.length(digits).between(least, most), F.call_function("luhn_check", digits)).otherwise(F.lit(False))


def _valid(kind: Column, hit: Column) -> Column:
    """Whether a match of a fixed pattern counts."""
    return F.when(kind == 1, _quad(hit)).when(kind == 2, _luhn(hit, 14, 19)).when(kind == 3, F.length(_digits(hit)).between(10, 15)).otherwise(F.lit(True))


def _matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, th, kind, start, end, hit, before, after): all matches of the fixed patterns, and candidates (kind -1).

    A text is cut at a pattern's matches; the pieces between them, one after the other, say where each match starts. Only
    lengths and a few characters around a match are shuffled, by row of the input, which keeps repeated rows apart.
    """
    text = F.col("text")
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), _text(docs, text_col).alias("text")).withColumn("th", _text_key(text))

    def cut(pattern: str, needs: str) -> Column:
        pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
        return F.when(text.rlike(needs), pieces)

    every = F.array(*(cut(PATTERNS[k], NEEDS[k]) for k in BASE), cut(CANDIDATE, NEEDED))
    cuts = keyed.select("row", "doc_id", "th", F.posexplode_outer(every).alias("kind", "pieces")).select("row", "doc_id", "th", "kind", F.posexplode_outer("pieces").alias("at", "p"))
    gap, hit = F.col("p.gap"), F.col("p.hit")
    lean = cuts.where("p is not null").select("row", "doc_id", "th", "kind", "at", F.length(gap).alias("skip"), F.length(hit).alias("size"), hit.alias("hit"), F.right(gap, F.lit(BEFORE)).alias("before"), F.left(gap, F.lit(AFTER)).alias("head"))
    order = Window.partitionBy("row", "kind").orderBy("at")
    start = F.coalesce(F.sum(F.col("skip") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("skip")
    placed = lean.withColumn("start", start).withColumn("after", F.lead("head").over(order)).where("hit is not null")
    kind = F.when(F.col("kind") < len(BASE), F.col("kind")).otherwise(-1)
    return placed.select("row", "doc_id", "th", kind.alias("kind"), "start", (F.col("start") + F.col("size")).alias("end"), "hit", "before", "after")


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def _kind_of(hit: Column) -> Column:
    """The place in ``KINDS`` of what a candidate may be, by its characters."""
    quad = hit.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return (
        F.when(hit.rlike(r"@|[(\[]at[)\]]"), 0).when(hit.contains(":") | quad, 1).when(hit.rlike("[A-Za-z_]"), 4).when(hit.rlike(r"^\+") | (F.length(_digits(hit)) < 12), 3).otherwise(2)
    )


def _possible(kind: Column, hit: Column) -> Column:
    """False for a candidate that can't be of its kind: a number over 255 in an address, a card whose last digit is wrong."""
    return F.when(kind == 1, _quad(hit) | hit.contains(":")).when(kind == 2, _luhn(hit, 13, 19)).when(kind == 3, F.length(_digits(hit)).between(7, 15)).otherwise(F.lit(True))


def _by_kind(kind: Column, *each: Column) -> Column:
    chosen = F.when(kind == 0, each[0])
    for k, c in enumerate(each[1:], 1):
        chosen = chosen.when(kind == k, c)
    return chosen


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for ``yes``, -1 for ``no`` (without it: nothing), else 0."""
    return F.when(yes, 1).when(no if no is not None else F.lit(False), -1).otherwise(0)


def votes(kind: Column, hit: Column, before: Column) -> dict[str, Column]:
    """The labelers' votes on a candidate of a kind: 1 for, -1 against, 0 for no opinion.

    Patterns: the strict form of the kind; digits or letters that only repeat or count up. Lists: domains, issuers' first
    digits and lengths, calling codes, prefixes of keys. Context: a word for the kind just before, a word against it, a
    value that is assigned.
    """
    digits, near = _digits(hit), F.lower(before)
    never, always = F.lit(False), F.lit(True)
    email = hit.rlike(rf"^[{_LOCAL}]+(@| ?[(\[]at[)\]] ?)[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}\.?$")
    six = hit.rlike(r"^([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$|[A-Fa-f].*::|::.*[A-Fa-f]")
    card = _luhn(hit, 13, 19)
    phone = F.length(digits).between(10, 15) & hit.rlike(r"^[+(]")
    no_phone = ~F.length(digits).between(9, 15) | hit.rlike(r"^[0-9]{4}[.-][0-9]{2}[.-][0-9]{2}$|^[0-9]{2}[.-][0-9]{2}[.-][0-9]{4}$")
    secret = hit.rlike("^([0-9a-f]{32,}|[0-9A-F]{32,})$") | (hit.rlike("[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]"))
    issuer = digits.rlike("^(4([0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|6[0-9]{15,18})$")
    domain = F.lower(hit).rlike(rf"\.({'|'.join(DOMAINS)})\.?$")
    code = hit.rlike(rf"^\+({'|'.join(CODES)})[^0-9]|^\([0-9]{{3}}\) ")
    inner = hit.rlike(r"^(0|10|127|255|192\.168|169\.254)\.")
    key = hit.rlike("^(AKIA|ASIA|ghp_|gho_|sk_live_|sk_test_|xox[abp]_)")
    dull = hit.rlike(r"^(.)\1+$") | digits.rlike(r"^([0-9])\1+$|^0?123456789")
    cue = {k: near.rlike(rf"(^|[^\p{{L}}])({'|'.join(CUES[k].split())})[^\p{{L}}0-9]*$") for k in KINDS}
    return {
        "form": _by_kind(kind, _vote(email, always), _vote(_quad(hit) | six, always), _vote(card, always), _vote(phone, no_phone), _vote(secret, always)),
        "plain": _vote(never, dull),
        "listed": _by_kind(kind, _vote(domain, always), _vote(never, inner), _vote(issuer, always), _vote(code), _vote(key)),
        "cue": _by_kind(kind, *(_vote(cue[k]) for k in KINDS)),
        "against": _vote(never, near.rlike(rf"(^|[^\p{{L}}])({'|'.join(AGAINST)})[^\p{{L}}0-9]*$|#$")),
        "assigned": _by_kind(kind, F.lit(0), F.lit(0), F.lit(0), F.lit(0), _vote(before.rlike("[=:] ?[\"']?$"), near.rlike(r"[\p{L}]\s*$"))),
    }


def _features(kind: Column, hit: Column, before: Column, after: Column) -> list[Column]:
    """What the classifier of spans sees of one: its form and its surroundings, as 0 or 1."""
    v = votes(kind, hit, before)
    distinct = F.size(F.array_distinct(F.split(F.lower(hit), "")))
    found = [v["form"] == 1, v["listed"] == 1, v["listed"] == -1, v["cue"] == 1, v["against"] == -1, v["assigned"] == 1, F.length(hit) >= 32, distinct >= 10]
    found += [hit.rlike("[0-9]") & hit.rlike("[A-Za-z]"), F.coalesce(after, F.lit("")).rlike(r"^($|[\s\"'.,;:!?)#$%&*<])")]
    assert len(found) == FEATURES
    return [f.cast("double") for f in found]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def reliabilities(patterns: DataFrame) -> DataFrame:
    """(kind, votes, belief): what EM makes of ``patterns`` (kind, votes, n), the distinct votes and how often they are cast.

    The two-class model of independent labelers, for each kind: how probable a vote is if a span is personal and if it
    isn't, and the share of personal ones. It starts from the majority, and from the belief, worth ``WEIGHT`` spans a
    labeler, that votes are rather right than wrong; so a kind with few spans is judged by that, and the classes can't
    change places. There are at most 3^6 patterns a kind, so a kind's patterns are one row.
    """
    count = len(LABELERS)
    kinds = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("ps"))
    start = F.transform("ps", lambda p: F.lit(1.0) / (F.lit(1.0) + F.exp(-F.aggregate(p.votes, F.lit(0.0), lambda a, v: a + v))))
    places = F.sequence(F.lit(0), F.lit(6 * count - 1))  # class * 3 * labelers + labeler * 3 + (vote + 1)

    def prior(k: Column) -> Column:
        vote, own = k % 3 - 1, F.when(k < 3 * count, -1).otherwise(1)  # the first half: not personal
        return F.when(vote == 0, 0.5).when(vote == own, 0.4).otherwise(0.1) * WEIGHT

    def theta(r: Column) -> Column:
        """The probability of each vote of each labeler in each class."""
        weighed = F.transform(F.arrays_zip(F.col("ps").alias("p"), r.alias("r")), lambda x: F.struct(x.p.votes.alias("votes"), (x.p.n * (1 - x.r)).alias("no"), (x.p.n * x.r).alias("yes")))

        def counted(ws: Column) -> Column:
            def one(k: Column) -> Column:
                j = F.floor((k % (3 * count)) / 3).cast("int")
                return prior(k) + _total(F.transform(ws, lambda w: F.when(F.get(w.votes, j) == k % 3 - 1, F.when(k < 3 * count, w.no).otherwise(w.yes)).otherwise(0.0)))

            return F.transform(places, one)

        def shares(cs: Column) -> Column:
            def one(c: Column, k: Column) -> Column:
                first = (k - k % 3).cast("int")
                return c / (F.get(cs, first) + F.get(cs, first + 1) + F.get(cs, first + 2))

            return F.transform(cs, one)

        return _once(weighed, lambda ws: _once(counted(ws), shares))

    def update(r: Column, _: Column) -> Column:
        n = _total(F.transform("ps", lambda p: p.n.cast("double")))
        yes = _total(F.zip_with("ps", r, lambda p, x: p.n * x))
        share = (yes + WEIGHT / 2) / (n + WEIGHT)

        def beliefs(t: Column) -> Column:
            def of(p: Column) -> Column:
                def log_of(side: int) -> Column:
                    return _total(F.transform(p.votes, lambda v, j: F.ln(F.get(t, (v + 1 + 3 * j + side * 3 * count).cast("int")))))

                return F.lit(1.0) / (F.lit(1.0) + F.exp(log_of(0) - log_of(1) + F.ln((1 - share) / share)))

            return F.transform("ps", of)

        return _once(theta(r), beliefs)

    settled = kinds.withColumn("r", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, update))
    each = settled.select("kind", F.explode(F.arrays_zip(F.col("ps").alias("p"), F.col("r").alias("r"))).alias("x"))
    return each.select("kind", F.col("x.p.votes").alias("votes"), F.col("x.r").alias("belief"))


def _odds(w: Column, x: Column) -> Column:
    """The weights' (the last one stands alone) probability for features x."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.get(w, F.lit(FEATURES)) + _total(F.zip_with(F.slice(w, 1, FEATURES), x, lambda a, b: a * b)))))


def span_classifier(seen: DataFrame) -> DataFrame:
    """(kind, w): logistic regression of the beliefs on the features of ``seen`` (kind, x, n, yes), the distinct features,
    how many spans have them and their beliefs' sum: at most 2^10 rows a kind, so a kind is one row again.

    Spans for which nothing speaks (the first six features are 0) count as not personal, a quarter of all with the other
    features and one without: where nearly all spans are personal, these alone tell what the evidence is worth.
    """
    n = F.col("n").cast("double")
    kinds = seen.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("x", n.alias("n"), "yes"))).alias("ps"), F.sum(n).alias("all"))
    none = (F.struct(F.array(*(F.lit(0.0 if j < 6 else v) for j in range(FEATURES))).alias("x"), (F.col("all") / 4).alias("n"), F.lit(0.0).alias("yes")) for v in (0.0, 1.0))
    kinds = kinds.withColumn("ps", F.concat("ps", F.array(*none))).withColumn("all", F.col("all") * 1.5)

    def step(w: Column, _: Column) -> Column:
        def descend(off: Column) -> Column:
            def one(value: Column, j: Column) -> Column:
                slope = _total(F.zip_with("ps", off, lambda p, o: o * F.coalesce(F.get(p.x, j.cast("int")), F.lit(1.0))))
                return value - RATE * (slope / F.col("all") + RIDGE * F.when(j < FEATURES, value).otherwise(0.0))

            return F.transform(w, one)

        return _once(F.transform("ps", lambda p: p.n * _odds(w, p.x) - p.yes), descend)

    return kinds.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.array_repeat(F.lit(0.0), FEATURES + 1), step).alias("w"))


def _accepted(found: DataFrame) -> DataFrame:
    """The candidates of ``found`` that the classifier takes, with their kind."""
    kind, hit = F.col("kind"), F.col("hit")
    named = found.where("kind < 0").withColumn("kind", _kind_of(hit)).where(_possible(kind, hit))
    cast = votes(kind, hit, F.col("before"))
    x = F.array(*_features(kind, hit, F.col("before"), F.col("after")))
    voted = materialize(named.select("row", "doc_id", "th", "kind", "start", "end", F.array(*(cast[k] for k in LABELERS)).alias("votes"), x.alias("x")))
    beliefs = materialize(reliabilities(voted.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n"))))
    counted = voted.groupBy("kind", "votes", "x").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(beliefs), ["kind", "votes"])  # 5 * 3^6 rows at most
    seen = counted.groupBy("kind", "x").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("belief")).alias("yes"))
    weights = materialize(span_classifier(seen))
    return voted.join(F.broadcast(weights), "kind").where(_odds(F.col("w"), F.col("x")) >= ACCEPT).select("row", "doc_id", "th", "kind", "start", "end")  # a row a kind


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every row: spans are (start, rank, end, kind, base), by start and then by the kind's place in ``KINDS``.

    start and end count code points from 0, end exclusive. base spans are the valid matches of the fixed patterns; the
    others are candidates that the classifier takes and that touch no base span. A null text is empty; empty texts have no
    spans; a null id is an id like any other; repeated rows have the same spans each; an empty table gives an empty result;
    other columns are ignored. Long texts are searched whole, in time linear in their length.
    """
    found = materialize(_matches(docs, id_col, text_col))
    kept = found.where(F.when(F.col("kind") >= 0, _valid(F.col("kind"), F.col("hit"))).otherwise(False)).select("row", "doc_id", "th", "kind", "start", "end", F.lit(True).alias("base"))
    every = kept.unionAll(_accepted(found).withColumn("base", F.lit(False)))
    base = F.col("base")
    # Both look back, one in the other's order: to look ahead takes time with the square of the spans.
    there = Window.partitionBy("row").orderBy("start", F.col("base").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), "base", F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    reached, next_base = F.max(F.when(base, F.col("end"))).over(there), F.min(F.when(base, F.col("start"))).over(back)
    every = every.withColumn("free", F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(next_base >= F.col("end"), F.lit(True)))
    name = F.get(F.array(*map(F.lit, KINDS)), "kind")
    span = F.struct("start", F.col("kind").alias("rank"), "end", name.alias("kind"), "base")
    of_row = every.where(base | F.col("free")).groupBy("row", "doc_id", "th").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    once = materialize(of_row.groupBy("doc_id", "th").agg(F.first("spans").alias("spans")).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "spans"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _text_key(_text(docs, text_col)).alias("th"))
    joined = rows.join(small(once), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    return joined.select("doc_id", F.coalesce("spans", F.array().cast(once.schema["spans"].dataType)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
