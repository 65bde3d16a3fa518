"""Personal data by weak-supervision aggregation, in DataFrame functions only.

Candidate spans come from regular expressions: the four base kinds (email,
ip, card, phone) and further kinds (secrets, access keys, national numbers,
bank accounts, local phone numbers). Labelers vote +1, -1 or abstain (0) on
every candidate: strict format, gazetteers of prefixes and names, cue words
before the span, the shape of its characters, other candidates nearby.
Expectation-maximisation on the counted vote patterns estimates how reliable
each labeler is and how common personal data is per kind; the posterior
labels train a logistic span classifier on the spans' own features. Base
spans that pass their checks always stay; further candidates are added where
the classifier finds personal data and they overlap no base span.

Everything runs as built-in expressions: candidates are arrays beside their
row (no join, no shuffle of texts); one small table with them is written and
read by the counting passes and the final one. What reaches the driver are
counted patterns: at most kinds x 3**labelers rows, and feature combinations
(kinds x 5 x 4 x 4 x 4). Patterns use possessive quantifiers and look-behinds,
so they stay linear on very long texts without changing what matches.

Null and empty texts have no spans; repeated rows each get theirs; without
candidates the classifier adds nothing; extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.names import free_name
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

BASE_KINDS = ("email", "ip", "card", "phone")
# Patterns of the base kinds, leftmost and non-overlapping.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates: deliberately wide and of any length, the labelers decide.
# Longer than 40 or 128 characters, key and hex need a digit: a random string
# of that length has one (chance of none 2e-6 and below).
# An account number in groups of four has at most 34 characters by its standard.
MORE = {
    "secret": r"(?i)\b(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}\"?[A-Za-z0-9+/_.-]{6,}+\"?",
    "key": r"\b(?=[0-9]*+[A-Z])(?:(?=[A-Z]*+[0-9])[A-Z0-9]{16,}+|[A-Z]{16,40}+)\b",
    "hex": r"\b(?=[0-9]*+[a-f])(?:(?=[a-f]*+[0-9])[0-9a-f]{16,}+|[a-f]{16,128}+)\b",
    "national": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,}+|(?:\x20[A-Z0-9]{4}\b){2,7}+(?:\x20[A-Z0-9]{1,3}\b)?+)\b",
    "local_phone": r"\(?\b[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}\b",
}
KINDS = (*BASE_KINDS, *MORE)
# A cheap test that must hold before a pattern is tried.
GUARD = {"email": "@", "phone": "+"}
# Gazetteers and cue words.
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "xox", "AIza")
PRIVATE_NETS = r"^(?:0|10|127|255|192\.168|169\.254)\."
IBAN_COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us")
CUES = r"(?i)(?:mail|contact|call|phone|tel\b|mobile|fax|card|visa|account|iban|ssn|ip\b|host|server|login|user|password|passwd|pwd|token|secret|key|credential)\W{0,6}\w{0,8}\W{0,6}$"
COUNTER_CUES = r"(?i)(?:version|isbn|page|figure|table|section|chapter|order no|serial|sha\d*|md5|commit|digest)\W{0,6}$"
CONTEXT = 24
NEAR = 200                # code points to another candidate that supports this one
LABELERS = ("format", "gazetteer", "context", "shape", "nearby")
EM_STEPS = 50
ADD_SCORE = 0.5
BLOCK = 256


def matches(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches of a pattern as array<struct<start, end, value>>, in code
    points. Lengths of the parts between the matches give the positions; the
    running sum is taken in blocks, so its cost is linear in the matches."""
    tried = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]") if pattern in _DIGITS else F.lit(True)
    found = F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    parts = F.split(text, pattern, -1)
    lens = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, m: F.length(p) + F.length(m))

    def located(found: Column, lens: Column) -> Column:
        n_blocks = F.ceil(F.size(found) / F.lit(BLOCK)).cast("int")
        total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
        sums = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: total(F.slice(lens, b * BLOCK + 1, F.lit(BLOCK))))
        offsets = F.aggregate(sums, F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)))
        return F.transform(F.arrays_zip(found.alias("m"), F.sequence(F.lit(0), F.size(found) - 1).alias("i")), lambda x: _span(
            x["m"], F.element_at(offsets, (x["i"] / BLOCK).cast("int") + 1)
            + total(F.slice(lens, (x["i"] - x["i"] % BLOCK) + 1, x["i"] % BLOCK + 1))))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(found) > 0, located(found, lens)).otherwise(empty)


_DIGITS = {p for k, p in {**PATTERNS, **MORE}.items() if k in ("ip", "card", "hex", "national", "iban", "local_phone", "key")}


def _span(value: Column, end: Column) -> Column:
    return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits (short: at most 19)."""
    from_right = F.split(F.reverse(number), "")
    total = F.aggregate(F.transform(from_right, lambda d, i: _luhn_digit(d.cast("int"), i)), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)


def base_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    n = F.length(digits(value))
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), luhn(digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1) if no is not None else out).otherwise(0)


def _format_vote(kind: str, v: Column) -> Column:
    if kind in BASE_KINDS:
        return _vote(base_valid(kind, v), ~base_valid(kind, v))
    if kind == "secret":
        return _vote(v.rlike("[0-9]") & v.rlike(r"[=:]\s*\"?[A-Za-z0-9+/_.-]{12,}"), ~v.rlike("[0-9]"))
    if kind in ("key", "hex"):
        return _vote(v.rlike("[0-9]") & v.rlike("[A-Za-z]"), ~(v.rlike("[0-9]") & v.rlike("[A-Za-z]")))
    if kind == "national":
        return _vote(~v.rlike("^(?:000|666|9)|-00-|-0000$"), v.rlike("^(?:000|666|9)|-00-|-0000$"))
    if kind == "local_phone":
        return _vote(v.rlike(r"^\(?[2-9]"), ~v.rlike(r"^\(?[2-9]"))
    bare = F.length(F.regexp_replace(v, " ", ""))
    return _vote(bare.between(15, 34), ~bare.between(15, 34))


def _gazetteer_vote(kind: str, v: Column) -> Column:
    if kind == "email":
        return _vote(F.lower(F.regexp_extract(v, r"([A-Za-z]+)$", 1)).isin(*TOP_DOMAINS))
    if kind == "ip":
        return _vote(~v.rlike(PRIVATE_NETS), v.rlike(PRIVATE_NETS))
    if kind == "card":
        return _vote(digits(v).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits(v).rlike("^0"))
    if kind == "phone":
        return _vote(digits(v).rlike("^(?:1|3|4|7|8|9)"))
    if kind == "key":
        return _vote(v.rlike("^(?:" + "|".join(KEY_PREFIXES) + ")"))
    if kind == "iban":
        return _vote(F.substring(v, 1, 2).isin(*IBAN_COUNTRIES), ~F.substring(v, 1, 2).isin(*IBAN_COUNTRIES))
    if kind == "secret":
        return _vote(v.rlike("(?i)^(?:password|passwd|pwd|token|secret|api)"))
    return F.lit(0)


def _shape_vote(v: Column) -> Column:
    distinct = F.size(F.array_distinct(F.split(F.substring(F.regexp_replace(v, "[^A-Za-z0-9]", ""), 1, 64), "")))
    return _vote(distinct >= 6, distinct <= 2)


def _char_class(c: Column) -> Column:
    return (F.when(c == "", "none").when(c.rlike(r"^\s"), "space").when(c.rlike("^[A-Za-z0-9]"), "alnum").otherwise("other"))


def _candidate(kind: str, text: Column, x: Column) -> Column:
    v, start, end = x["value"], x["start"], x["end"]
    before = F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
    share = F.length(digits(v)) / F.length(v)
    return F.struct(
        F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
        _format_vote(kind, v).alias("format"), _gazetteer_vote(kind, v).alias("gazetteer"),
        _vote(before.rlike(CUES), before.rlike(COUNTER_CUES)).alias("context"), _shape_vote(v).alias("shape"),
        F.when(F.length(v) < 10, "s").when(F.length(v) < 16, "m").when(F.length(v) < 24, "l")
        .when(F.length(v) < 48, "x").otherwise("h").alias("size"),
        F.when(share == 0, "0").when(share < 0.5, "1").when(share < 0.95, "2").otherwise("3").alias("digits"),
        _char_class(F.substring(text, start, F.when(start > 0, 1).otherwise(0))).alias("left"),
        _char_class(F.substring(text, end + 1, F.lit(1))).alias("right"))


def candidates(docs: DataFrame, text: str, column: str) -> DataFrame:
    """``docs`` with all candidates of every row, ordered by start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    with_text = docs.withColumn("__t", t)
    groups = []
    described = lambda kind: lambda x: _candidate(kind, F.col("__t"), x)
    for kind, pattern in {**PATTERNS, **MORE}.items():
        groups.append(F.transform(matches(F.col("__t"), pattern, GUARD.get(kind)), described(kind)))
    ordered = F.array_sort(F.concat(*groups), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                           .otherwise(_rank(a["kind"]) - _rank(b["kind"])))
    near = lambda xs: F.transform(xs, lambda x, i: x.withField("nearby", F.when(
        ((i > 0) & (x["start"] - F.get(xs, i - 1)["end"] < NEAR) & (F.get(xs, i - 1)["end"] <= x["start"]))
        | ((F.get(xs, i + 1)["start"] - x["end"] < NEAR) & (F.get(xs, i + 1)["start"] >= x["end"])), 1).otherwise(0)))
    return with_text.withColumn("__c", ordered).withColumn(column, near(F.col("__c"))).drop("__t", "__c")


def _rank(kind: Column) -> Column:
    out = None
    for i, k in enumerate(KINDS):
        out = F.when(kind == k, i) if out is None else out.when(kind == k, i)
    return out


def estimate_labelers(patterns: list[tuple[str, tuple[int, ...], int]], steps: int = EM_STEPS) -> tuple[dict, dict]:
    """EM for a two-class naive Bayes model of the votes: log odds of personal
    data per kind, and per (labeler, vote). ``patterns``: kind, votes, count."""
    kinds = sorted({k for k, _, _ in patterns})
    prior = dict.fromkeys(kinds, 0.5)
    like = {(j, v, y): {1: 0.7, 0: 0.2, -1: 0.1}[v if y else -v] for j in range(len(LABELERS)) for v in (1, 0, -1) for y in (0, 1)}
    for _ in range(steps):
        mass = {key: 0.5 for key in like}
        per_kind = {k: [1.0, 1.0] for k in kinds}
        for kind, votes, n in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(
                math.log(like[j, v, 1] / like[j, v, 0]) for j, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            for j, v in enumerate(votes):
                mass[j, v, 1] += n * p
                mass[j, v, 0] += n * (1 - p)
            per_kind[kind][1] += n * p
            per_kind[kind][0] += n * (1 - p)
        like = {(j, v, y): m / sum(mass[j, u, y] for u in (1, 0, -1)) for (j, v, y), m in mass.items()}
        prior = {k: b / (a + b) for k, (a, b) in per_kind.items()}
    return ({k: math.log(p / (1 - p)) for k, p in prior.items()},
            {(j, v): math.log(like[j, v, 1] / like[j, v, 0]) for j in range(len(LABELERS)) for v in (1, 0, -1)})


FEATURES = ("kind", "size", "digits", "left", "right")


def train_classifier(rows: list[tuple[tuple[str, ...], float, float]], steps: int = 300) -> dict[tuple[str, str], float]:
    """Logistic regression on indicator features with soft labels, by
    full-batch gradient steps. ``rows``: feature values, count, sum of posteriors."""
    weights: dict[tuple[str, str], float] = {("", ""): 0.0}
    for values, _, _ in rows:
        weights.update({(f, v): 0.0 for f, v in zip(FEATURES, values)})
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(steps):
        slope = dict.fromkeys(weights, 0.0)
        for values, n, positive in rows:
            keys = [("", ""), *zip(FEATURES, values)]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in keys)))))
            for k in keys:
                slope[k] += (n * p - positive) / total
        for k in weights:
            weights[k] -= 2.0 * (slope[k] + 1e-4 * weights[k])
    return weights


def _choose(column: Column, values: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for k, w in values.items():
        out = F.when(column == k, F.lit(w)).otherwise(out)
    return out


def fit(found: DataFrame, column: str) -> dict[tuple[str, str], float]:
    """Span classifier weights from the candidates of all rows."""
    spans = found.select(F.explode(column).alias("c")).select("c.*")
    counted = spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()
    if not counted:
        return {("", ""): -30.0}
    prior, odds = estimate_labelers([(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in counted])
    logit = _choose(F.col("kind"), prior)
    for j, name in enumerate(LABELERS):
        logit = logit + F.when(F.col(name) == 1, odds[j, 1]).when(F.col(name) == -1, odds[j, -1]).otherwise(odds[j, 0])
    posterior = 1 / (1 + F.exp(-logit))
    rows = spans.groupBy(*FEATURES).agg(F.count("*").alias("n"), F.sum(posterior).alias("p")).collect()
    return train_classifier([(tuple(r[f] for f in FEATURES), float(r["n"]), float(r["p"])) for r in rows])


def find_spans(docs: DataFrame, text: str = "text", column: str = "pii", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) with struct<base, spans>, each an
    array<struct<kind, start, end>> ordered by start; spans holds the base
    spans and the added ones."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != column.lower()]
    # The carried columns travel in one struct: none of their names can meet a name of ours.
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("text"))
    found = cut_lineage(candidates(rows, "text", "__found").select("row", "__found"))
    weights = fit(found, "__found")
    by_feature = {f: {v: w for (g, v), w in weights.items() if g == f} for f in FEATURES}

    def score(x: Column) -> Column:
        total = F.lit(weights["", ""])
        for f in FEATURES:
            total = total + _choose(x[f], by_feature[f])
        return 1 / (1 + F.exp(-total))

    plain = lambda xs: F.transform(xs, lambda x: F.struct(x["kind"], x["start"], x["end"]))
    is_base = lambda x: x["kind"].isin(*BASE_KINDS)
    base = F.filter(F.col("__found"), lambda x: is_base(x) & (x["format"] == 1))
    more = F.filter(F.col("__found"), lambda x: ~is_base(x) & (score(x) >= ADD_SCORE) & ~F.exists(
        F.col("__base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    # Of overlapping additions the first stays.
    first = F.aggregate(F.col("__more"), F.array().cast("array<struct<kind:string,start:int,end:int>>"),
                        lambda acc, x: F.when((F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= x["start"]),
                                              F.concat(acc, F.array(x))).otherwise(acc))
    ordered = F.array_sort(F.concat(F.col("__base"), first), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(_rank(a["kind"]) - _rank(b["kind"])))
    return (found.withColumn("__base", plain(base)).withColumn("__more", plain(more))
            .select("row.*", F.struct(F.col("__base").alias("base"), ordered.alias("spans")).alias(column)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping
    spans give one placeholder. Same columns."""
    pii = free_name(docs, "__pii")
    found = find_spans(docs, text, pii)
    t = F.col(text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    built = F.aggregate(F.col(f"{pii}.spans"), start, lambda acc, x: F.when(
        x["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring(t, acc["at"] + 1, x["start"] - acc["at"]),
                     F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("out"), x["end"].alias("at")))
        .otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    return found.withColumn(text, F.when(F.size(f"{pii}.spans") > 0, built).otherwise(t)).select(*docs.columns)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    count = lambda k: F.size(F.filter("pii.base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in BASE_KINDS],
                      F.sha2(_written(F.col("pii.base")).cast("binary"), 256).alias("base_sha256"),
                      _written(F.col("pii.spans")).alias("spans"))
