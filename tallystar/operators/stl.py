"""Seasonal-trend decomposition by loess, many series at once.

observed = trend + seasonal + remainder. A round takes the weighted mean of
the detrended values at each place of the cycle as the seasonal part (centred
over the cycle: the "periodic" smoother), then a local straight line through
the deseasonalised values as the trend. The robust form repeats the rounds
with bisquare weights from 6 x the median absolute remainder.

The line at a day is fitted to the ``trend_window`` nearest days with tricube
weights; near the ends the window stops moving and its reach grows. Its five
weighted moments are sums over one sliding frame of the date-ordered series.
Every step of a round is a window over the same dealing by series, so a job
of several rounds shuffles once; a written table between jobs keeps plans
short and survives a lost executor.

Expects one row a day (see ``series.gap_fill``); null values are left out of
all sums and come back as a null remainder. Ties of the median follow linear
interpolation. A series shorter than a cycle has the places it has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.session import cut_lineage

ROUNDS_A_JOB = 4
ROBUST_ROUNDS = 15
INNER_ROUNDS = 2


def trend_window(period: int, seasonal_window: int) -> int:
    """The usual trend window: the next odd number from 1.5 period / (1 - 1.5 / seasonal window)."""
    wide = math.ceil(1.5 * period / (1 - 1.5 / seasonal_window))
    return wide + 1 - wide % 2


def loess_line(near: Column, place: Column, n: Column, window: int, own: Column) -> Column:
    """Local line at ``place`` (0 to n - 1) from the array ``near`` of structs
    (i, z, w); ``own`` where no weight is left."""
    left = F.greatest(F.least(place - window // 2, n - window), F.lit(0))
    right = F.least(left + window - 1, n - 1)
    reach = (F.greatest(place - left, right - place) + F.when(n < window, F.floor((F.lit(window) - n) / 2)).otherwise(0)).cast("double")

    def weigh(e):
        far = F.abs(e["i"] - place).cast("double")
        u = far / F.greatest(reach, F.lit(1e-300))
        tricube = (F.when((e["i"] < left) | (e["i"] > right) | (far > 0.999 * reach), F.lit(0.0))
                   .when(far <= 0.001 * reach, F.lit(1.0)).otherwise((1 - u * u * u) * (1 - u * u * u) * (1 - u * u * u)))
        w = F.when(e["z"].isNull(), F.lit(0.0)).otherwise(tricube * e["w"])
        return F.struct(w.alias("w"), (e["i"] - place).cast("double").alias("x"), F.coalesce(e["z"], F.lit(0.0)).alias("z"))

    zero = F.struct(*[F.lit(0.0).alias(name) for name in ("s0", "s1", "s2", "t0", "t1")])
    return F.aggregate(F.transform(near, weigh), zero, lambda m, e: F.struct(
        (m["s0"] + e["w"]).alias("s0"), (m["s1"] + e["w"] * e["x"]).alias("s1"), (m["s2"] + e["w"] * e["x"] * e["x"]).alias("s2"),
        (m["t0"] + e["w"] * e["z"]).alias("t0"), (m["t1"] + e["w"] * e["x"] * e["z"]).alias("t1")),
        lambda m: _line_at_zero(m, n, own))


def _line_at_zero(m: Column, n: Column, own: Column) -> Column:
    mean, level = m["s1"] / m["s0"], m["t0"] / m["s0"]
    spread = m["s2"] / m["s0"] - mean * mean
    tilt = -mean / spread * (m["t1"] / m["s0"] - mean * level)
    steep = F.sqrt(F.greatest(spread, F.lit(0.0))) > 0.001 * (n - 1)
    return F.when(m["s0"] > 0, F.when(steep, level + tilt).otherwise(level)).otherwise(own)


def _round(df: DataFrame, keys: Sequence[str], period: int, window: int, weigh: bool) -> DataFrame:
    """seasonal and trend from the weights; then new weights if ``weigh``."""
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("date_id")
    cycle = Window.partitionBy(*keys, "_place")
    flat = F.col("observed") - F.col("trend")
    weight = F.when(F.col("observed").isNotNull(), F.col("_w"))
    df = df.withColumns({"_sw": F.sum(weight).over(cycle), "_swy": F.sum(weight * flat).over(cycle), "_sy": F.avg(flat).over(cycle)})
    df = df.withColumn("_c", F.when(F.col("_sw") > 0, F.col("_swy") / F.col("_sw")).otherwise(F.col("_sy")))
    df = df.withColumn("seasonal", F.col("_c") - F.avg(F.when(F.col("_i") < period, F.col("_c"))).over(whole))
    df = df.withColumn("_z", F.col("observed") - F.col("seasonal"))
    near = F.collect_list(F.struct(F.col("_i").alias("i"), F.col("_z").alias("z"), F.col("_w").alias("w"))).over(
        order.rowsBetween(1 - window, window - 1))
    df = df.withColumn("_near", near)
    df = df.withColumn("trend", loess_line(F.col("_near"), F.col("_i"), F.col("_n"), window, F.coalesce("_z", F.lit(0.0))))
    # Noise in the last bits must not decide weights where most remainders are zero.
    df = df.withColumn("_r", F.round(F.abs(F.col("_z") - F.col("trend")), 9))
    if weigh:
        df = df.withColumn("_h", 6.0 * F.median("_r").over(whole))
        u = F.col("_r") / F.col("_h")
        df = df.withColumn("_w", F.when(F.col("_r").isNull() | (F.col("_r") <= 0.001 * F.col("_h")), 1.0)
                           .when(F.col("_r") <= 0.999 * F.col("_h"), (1 - u * u) * (1 - u * u)).otherwise(0.0))
    return df.select(*keys, "date_id", "observed", "_i", "_n", "_place", "_w", "trend", "seasonal")


def stl(series: DataFrame, value: str = "total_orders", period: int = 7, robust: bool = False,
        window: int | None = None, keys: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """observed, trend, seasonal and remainder of every day of every series.

    ``robust``: one inner pass and 15 reweighted rounds, else two inner passes.
    ``window``: days of the trend's local lines (default: the usual choice for
    a periodic seasonal part, 11 for a weekly cycle).
    """
    k = list(keys) or ["_series"]
    if window is None:
        window = trend_window(period, 10 ** 6)
    df = series if keys else series.withColumn("_series", F.lit(0))
    whole, order = Window.partitionBy(*k), Window.partitionBy(*k).orderBy("date_id")
    df = (df.select(*k, "date_id", F.col(value).cast("double").alias("observed"))
          .withColumns({"_i": (F.row_number().over(order) - 1).cast("long"), "_n": F.count(F.lit(1)).over(whole)})
          .withColumns({"_place": F.col("_i") % period, "_w": F.lit(1.0), "trend": F.lit(0.0)}))
    rounds = ROBUST_ROUNDS + 1 if robust else INNER_ROUNDS
    for at in range(rounds):
        df = _round(df, k, period, window, robust and at < rounds - 1)
        if (at + 1) % ROUNDS_A_JOB == 0 and at < rounds - 1:
            df = cut_lineage(df)
    rest = F.col("observed") - F.col("trend") - F.col("seasonal")
    parts = {"trend": F.col("trend"), "seasonal": F.col("seasonal"), "remainder": rest}
    return df.select(*keys, "date_id", "observed",
                     *[(_shown(c, digits) if digits is not None else c).alias(name) for name, c in parts.items()])


def _shown(c: Column, digits: int) -> Column:
    """Rounded by way of 9 digits, so that noise in the last bits of an exact
    half cannot decide; without a negative zero."""
    return F.round(F.round(c, 9), digits) + F.lit(0.0)
