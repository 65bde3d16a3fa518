"""Quality rules with robust multivariate outliers.

Per text a vector of transformed statistics (log length, log mean word
length, square roots of symbol, repeated-line, repeated-word and upper-case
shares). Per language and source the minimum-covariance-determinant (MCD)
centre and scatter are estimated over all texts that pass the base rules;
texts far from their group's centre in Mahalanobis distance are rejected.

Estimation runs as concentration steps in Spark from three starts (medians
with quartile spreads, medians with equal spreads, mean with covariance), then
repeatedly one aggregate per step that sums counts and first and second
moments per (group, start, distance bin); the bins up to the ``SUPPORT`` share
of a group give the next centre and scatter. The start that ends with the
smallest determinant is a group's estimate. A group's rows are never
gathered: where Spark does not broadcast the models, rows meet them by (group,
salt), and what reaches one task per group is at most ``BINS`` rows of sums a
start. A group with fewer than ``MIN_GROUP`` rows uses its language's
estimate, a smaller language the estimate of all texts.

``RIDGE`` is added to the variances: statistics that are constant in clean
texts (no symbols at all) keep a small tolerance. Null and empty texts have
no words and fail the base rule; null languages and sources are groups of
their own; repeated rows each get the same verdict; an empty table gives no
rows; extra columns pass through whatever their names (one of the result's
name is replaced). The estimate is a function of the table alone (no random
start).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.batches import bound_batches, release
from tallystar.llm.hashing import utf8
from tallystar.session import cut_lineage, few_files
from tallystar.sources.testdata import read_table

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SUPPORT = 0.75            # share of a group's rows in the MCD subset
MIN_GROUP = 200           # fewer rows: the language's estimate
MAX_STEPS = 12
TOLERANCE = 1e-4          # stop when no group's log determinant falls by more
BINS = 4096               # distance bins per group and start
SALTS = 64                # tasks that share the rows of one group
CUTOFF_Z = 5.0            # standard normal quantile of the rejection limit
# Added to the variance of each statistic, in the order of FEATURES.
FEATURES = ("length", "word_length", "symbols", "dup_lines", "repeats", "upper")
RIDGE = (0.25, 0.01, 0.002, 0.02, 0.02, 0.01)
P = len(FEATURES)

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, "
         "n_repeat_words long, n_upper long")
BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))


def _statistics(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t, raw in zip(text, utf8(text)):
        words = raw.split()          # of bytes: exactly space and 0x09-0x0D
        blanks = len(raw) - len(raw.translate(None, BLANKS))
        lines = [x for x in raw.split(b"\n") if x.strip(BLANKS)]
        triples = list(zip(words, words[1:], words[2:]))
        repeated = 0
        if len(set(triples)) < len(triples):
            seen = Counter(triples)
            reach = 0
            for i, triple in enumerate(triples):
                if seen[triple] > 1:
                    repeated += i + 3 - max(i, reach)
                    reach = i + 3
        rows.append((len(words), len(t or "") - blanks, len(raw) - len(raw.translate(None, SYMBOLS)),
                     len(lines) - len(set(lines)), len(lines), repeated,
                     len(raw) - len(raw.translate(None, UPPER))))
    release()
    return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                                       "n_repeat_words", "n_upper"])


def base_failed(s: str) -> F.Column:
    return ((F.col(f"{s}.n_words") < MIN_WORDS)
            | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PCT * F.col(f"{s}.n_words")))


def features(s: str) -> list[F.Column]:
    n = F.greatest(F.col(f"{s}.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(f"{s}.n_lines"), F.lit(1)).cast("double")
    return [F.log(n), F.log(chars / n), F.sqrt(F.col(f"{s}.n_symbols") / chars),
            F.sqrt(F.col(f"{s}.n_dup_lines") / lines), F.sqrt(F.col(f"{s}.n_repeat_words") / n),
            F.sqrt(F.col(f"{s}.n_upper") / chars)]


def wilson_hilferty(p: int, z: float) -> float:
    """Chi-square quantile with p degrees of freedom at normal quantile z."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
MODEL = ("grp string, start int, n double, logdet double, " + ", ".join(f"m{i} double" for i in range(P))
         + ", " + ", ".join(f"w{i}_{j} double" for i in range(P) for j in range(i + 1)))


def _distance(model: str = "", x: str = "x") -> F.Column:
    """Squared Mahalanobis distance: sum of squares of W (x - m), W lower triangular."""
    total = F.lit(0.0)
    for i in range(P):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"{model}w{i}_{j}") * (F.col(f"{x}{j}") - F.col(f"{model}m{j}"))
        total = total + part * part
    return total


def _model_row(group, start: int, n: float, mean: np.ndarray, cov: np.ndarray) -> dict:
    """One row of MODEL: W is the inverse Cholesky factor of the scatter."""
    low = np.linalg.cholesky(cov + np.diag(RIDGE))
    inv = np.linalg.inv(low)
    row = {"grp": group, "start": int(start), "n": float(n), "logdet": float(2 * np.log(np.diag(low)).sum())}
    row |= {f"m{i}": float(mean[i]) for i in range(P)}
    return row | {f"w{i}_{j}": float(inv[i, j]) for i in range(P) for j in range(i + 1)}


def _concentrate(pdf: pd.DataFrame) -> pd.DataFrame:
    """One group and start: bins of sums -> next centre and scatter from the nearest
    SUPPORT share of its rows (whole bins), with the determinant it had."""
    pdf = pdf.sort_values("bin")
    n = pdf["n"].to_numpy(dtype=float)
    upto = int(np.searchsorted(np.cumsum(n), SUPPORT * n.sum())) + 1
    used = pdf.iloc[:upto]
    h = used["n"].sum()
    mean = np.array([used[f"s{i}"].sum() for i in range(P)]) / h
    cov = np.zeros((P, P))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = used[f"s{i}_{j}"].sum() / h - mean[i] * mean[j]
    row = _model_row(pdf["grp"].iloc[0], pdf["start"].iloc[0], n.sum(), mean, cov)
    return pd.DataFrame([row | {"before": pdf["before"].iloc[0]}])


def _groups(lang: str, source: str) -> tuple[F.Column, F.Column]:
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    return F.concat(name(lang), F.lit("\u0001"), name(source)), name(lang)


def _salt() -> F.Column:
    return F.pmod(F.xxhash64(*X), F.lit(SALTS)).cast("int")


def _met(fit: DataFrame, model: DataFrame) -> DataFrame:
    """Rows with the models of their group. The salt spreads a large group."""
    spread = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return fit.join(spread, ["grp", "salt"])


def _starts(fit: DataFrame) -> DataFrame:
    """MODEL rows of the three starts of every group."""
    moments = [F.avg(x).alias(f"a{i}") for i, x in enumerate(X)]
    moments += [F.covar_pop(X[i], X[j]).alias(f"c{i}_{j}") for i, j in PAIRS]
    sums = fit.groupBy("grp").agg(F.count("*").cast("double").alias("n"), *moments,
                                  *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in X])

    def rows(batches):
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                quartiles = np.array([np.asarray(r[x], dtype=float) for x in X])
                spread = ((quartiles[:, 2] - quartiles[:, 0]) / 1.349) ** 2
                cov = np.zeros((P, P))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
                starts = ((quartiles[:, 1], np.diag(spread)), (quartiles[:, 1], np.eye(P)),
                          (np.array([r[f"a{i}"] for i in range(P)]), cov))
                out += [{**_model_row(r["grp"], k, r["n"], mean, scatter), "logdet": float("inf")}
                        for k, (mean, scatter) in enumerate(starts)]
            yield pd.DataFrame(out)

    return sums.mapInPandas(rows, MODEL)


def estimate(rows: DataFrame) -> DataFrame:
    """MODEL rows of every group at every level of ``rows`` (g2: language and
    source, g1: language, x0..): groups of MIN_GROUP rows or more, and all texts."""
    levels = F.array(F.concat(F.lit("2"), F.col("g2")), F.concat(F.lit("1"), F.col("g1")), F.lit("0"))
    counts = (rows.groupBy("g2", "g1").agg(F.count("*").alias("n"))
              .select(F.explode(levels).alias("grp"), "n").groupBy("grp").agg(F.sum("n").alias("n"))
              .where((F.col("n") >= MIN_GROUP) | (F.col("grp") == "0")).select("grp"))
    fit = rows.select(F.explode(levels).alias("grp"), _salt().alias("salt"), *X)
    fit = cut_lineage(_met(fit, counts))
    model = cut_lineage(few_files(_starts(fit)))
    for _ in range(MAX_STEPS):
        # 128 bins per factor of two in squared distance, clipped to BINS.
        d = F.log2(F.greatest(_distance(), F.lit(1e-6)))
        near = F.least(F.greatest(F.floor(d * 128) + BINS // 2, F.lit(0)), F.lit(BINS - 1)).cast("int")
        sums = (_met(fit, model).withColumn("bin", near).groupBy("grp", "start", "bin")
                .agg(F.count("*").alias("n"), F.first("logdet").alias("before"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
                     *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in PAIRS]))
        nxt = cut_lineage(few_files(sums.groupBy("grp", "start").applyInPandas(lambda pdf: _concentrate(pdf), MODEL + ", before double")))
        moved = nxt.agg(F.max(F.abs(F.col("before") - F.col("logdet"))).alias("d")).first()["d"]
        model = nxt.drop("before")
        if moved is None or moved < TOLERANCE:
            break
    # The least determinant (to the stopping tolerance; then the first start) is the estimate.
    rounded = F.round(F.col("logdet") / (10 * TOLERANCE))
    best = model.groupBy("grp").agg(F.min(F.struct(rounded.alias("least"), "start")).alias("best"))
    model = cut_lineage(few_files(model.join(best.select("grp", "best.start"), ["grp", "start"])))
    # Consistency: the subset's scatter is scaled up until the median distance of
    # all rows is the chi-square median (never down: the ridge is a floor).
    median = (_met(fit, model).groupBy("grp").agg(F.percentile_approx(_distance(), 0.5, 1000).alias("median")))
    scale = F.greatest(F.col("median") / F.lit(wilson_hilferty(P, 0.0)), F.lit(1.0))
    return cut_lineage(few_files(model.join(median, "grp").withColumn("scale", scale)))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          column: str = "quality", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) with a struct column: statistics,
    base_failed, distance (squared, scaled; null if the base rule fails), kept."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != column.lower()]
    bound_batches(docs.sparkSession)
    g2, g1 = _groups(lang, source)
    # The carried columns travel in one struct: none of their names can meet a name of ours.
    stats = cut_lineage(docs.select(
        F.struct(*carry).alias("row"), F.pandas_udf(_statistics, STATS)(F.col(text)).alias("s"), g2.alias("g2"), g1.alias("g1")))
    shaped = stats.select("row", "s", "g2", "g1", *[f.alias(x) for f, x in zip(features("s"), X)])
    model = estimate(shaped.where(~base_failed("s")).select("g2", "g1", *X))
    parameters = F.struct("scale", *[c for c in model.columns if c[0] in "mw" and c != "median"]).alias("p")
    found = model.select("grp", parameters)
    # Each group's finest level that has an estimate, then one join of the documents.
    groups = stats.select("g2", "g1").distinct()
    for k, name in enumerate((F.concat(F.lit("2"), "g2"), F.concat(F.lit("1"), "g1"), F.lit("0"))):
        groups = groups.withColumn("grp", name).join(found.withColumnRenamed("p", f"p{k}"), "grp", "left").drop("grp")
    groups = groups.select("g2", F.coalesce("p0", "p1", "p2").alias("m"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = shaped.withColumn("salt", _salt()).join(groups, ["g2", "salt"], "left")
    distance = _distance("m.") / F.col("m.scale")
    failed = base_failed("s")
    return named.select("row.*", F.struct(
        "s.*", failed.alias("base_failed"), F.when(~failed, distance).alias("distance"),
        (~failed & F.coalesce(distance <= wilson_hilferty(P, CUTOFF_Z), F.lit(True))).alias("kept")).alias(column))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = judge(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return q.select("doc_id", *[F.col(f"quality.{c}") for c in
                                ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "kept", "distance")])
