"""Rank-based significance tests: Kruskal-Wallis H with tie
correction, its chi-square p-value and a verdict.

All tests run in one pass, keyed by test. Observations are counted by (test,
value, group) first; mid-ranks are running sums over the distinct values of a
test, taken over ranges of values (``functions.ranks``), so neither many
observations nor many distinct values meet in one task. The p-value is the
regularised incomplete gamma function in column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.ranks import running_total

# Lanczos coefficients of the log gamma function for g = 7.
LANCZOS_G = 7.0
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
TINY = 1e-300


def ln_gamma(a: Column) -> Column:
    """Log of the gamma function for a >= 0.5."""
    z = a - 1.0
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        total = total + F.lit(c) / (z + float(i))
    t = z + (LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(total)


def _steps(a: Column) -> Column:
    """Term numbers: enough of both expansions for full precision at any x."""
    return F.sequence(F.lit(1), F.ceil(F.lit(80.0) + 14.0 * F.sqrt(a)).cast("int"))


def _series(a: Column, x: Column) -> Column:
    """sum of x^n / (a (a+1) ... (a+n)): times x^a e^-x / Gamma(a) it is P(a, x)."""
    first = F.lit(1.0) / a
    return F.aggregate(_steps(a), F.struct(first.alias("sum"), first.alias("term")), lambda m, i: F.struct(
        (m["sum"] + m["term"] * x / (a + i)).alias("sum"), (m["term"] * x / (a + i)).alias("term")), lambda m: m["sum"])


def _fraction(a: Column, x: Column) -> Column:
    """The continued fraction of Q(a, x) by the modified Lentz rule."""
    def far(v: Column) -> Column:
        return F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    d0 = F.lit(1.0) / far(x + 1.0 - a)

    def step(m: Column, i: Column) -> Column:
        k = i.cast("double")
        top, bottom = k * (a - k), x + 1.0 - a + 2.0 * k
        d, c = F.lit(1.0) / far(top * m["d"] + bottom), far(bottom + top / m["c"])
        return F.struct(d.alias("d"), c.alias("c"), (m["h"] * d * c).alias("h"))

    start = F.struct(d0.alias("d"), F.lit(1.0 / TINY).alias("c"), d0.alias("h"))
    return F.aggregate(_steps(a), start, step, lambda m: m["h"])


def gamma_q(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma function Q(a, x), a >= 0.5: the
    series below a + 1, the continued fraction above."""
    scale = F.exp(a * F.ln(x) - x - ln_gamma(a))
    return (F.when(x <= 0, F.lit(1.0)).when(x < a + 1.0, F.lit(1.0) - scale * _series(a, x))
            .otherwise(scale * _fraction(a, x)))


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper-tail probability of a chi-square(df) variate; NULL without
    statistic or degrees of freedom."""
    return F.when(x.isNull() | df.isNull() | (df < 1), F.lit(None).cast("double")).otherwise(
        gamma_q(df.cast("double") / 2.0, x.cast("double") / 2.0))


def sig_digits(c: Column, digits: int = 5) -> Column:
    """Keep ``digits`` significant digits (p-values span many magnitudes)."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


def kruskal_tests(observations: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis test of every ``test`` in (test, group, value) rows
    (ties corrected). Rows with a null group or value are left out."""
    seen = (observations.select("test", F.col("group").alias("g"), F.col("value").cast("double").alias("v")).dropna()
            .groupBy("test", "v", "g").agg(F.count(F.lit(1)).cast("double").alias("c")))
    values = seen.groupBy("test", "v").agg(F.sum("c").alias("t"), F.collect_list(F.struct("g", "c")).alias("own"))
    ranks = (running_total(values, ["test"], "v", "t", "_upto")
             .withColumn("rank", F.col("_upto") - (F.col("t") - 1.0) / 2.0))
    t = F.col("t")
    # Ties and group sums come from the same rows: the tie term rides on each value's first group.
    each = ranks.select("test", "rank", F.posexplode("own").alias("at", "e"),
                        F.when(F.col("at") == 0, t * t * t - t).otherwise(0.0).alias("tie"))
    per_group = each.groupBy("test", "e.g").agg(F.sum("e.c").alias("n"), F.sum(F.col("e.c") * F.col("rank")).alias("rs"),
                                                F.sum("tie").alias("tie"))
    st = per_group.groupBy("test").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
                                       F.sum(F.col("rs") * F.col("rs") / F.col("n")).alias("s"), F.sum("tie").alias("ties"))
    N = F.col("N")
    # Degenerate inputs (fewer than two rows, or every value tied) have no
    # statistic; R reports NaN, here it is NULL instead of a division by zero.
    n3 = N * N * N - N
    corr = F.when(n3 > 0, F.lit(1.0) - F.col("ties") / F.when(n3 > 0, n3))
    h = F.when(corr > 0, (F.lit(12.0) / (N * (N + 1.0)) * F.col("s") - F.lit(3.0) * (N + 1.0))
               / F.when(corr > 0, corr))
    out = st.select("test", F.round(h, 6).alias("statistic"), (F.col("k") - 1).cast("int").alias("df"),
                    N.cast("long").alias("n"), F.col("k").cast("long").alias("groups"))
    out = out.withColumn("p_value", sig_digits(chi2_sf(F.col("statistic"), F.col("df"))))
    return verdict(out, alpha)


def kruskal(df: DataFrame, value: str, group: str, test: str = "kruskal_wallis",
            alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis rank-sum test of ``value`` across ``group``."""
    return kruskal_tests(df.select(F.lit(test).alias("test"), F.col(group).alias("group"), F.col(value).alias("value")), alpha)


def verdict(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    sig = F.col("p_value") < alpha
    return (df.withColumn("significant", sig)
            .withColumn("verdict", F.when(sig, "statistically significant difference")
                        .otherwise("no statistically significant difference")))
