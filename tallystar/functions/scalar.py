"""Column-in, column-out helpers.

Everything here builds native Catalyst expressions, so it stays inside
whole-stage codegen. No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (business vocabulary).
# ---------------------------------------------------------------------------
MEAL_PERIOD_ORDER = ["Morning", "Lunch", "Afternoon", "Dinner", "Late Night"]
SIZE_ORDER = ["S", "M", "L", "XL", "XXL"]
ORDER_TYPE_ORDER = ["Single item", "Standard multi-item (2-4)", "Group/catering (5+)"]
COMPONENT_LABELS = {"observed": "Observed", "trend": "Trend",
                    "seasonal": "Seasonal", "remainder": "Remainder"}
SHARE_LABELS = {"revenue_share_pct": "Revenue Share", "volume_share_pct": "Volume Share"}
# Meal period boundaries by hour of day: [9,11) Morning, [11,15) Lunch,
# [15,18) Afternoon, [18,22) Dinner, everything else Late Night.
MEAL_PERIOD_HOURS = [(9, "Morning"), (11, "Lunch"), (15, "Afternoon"), (18, "Dinner"), (22, "Late Night")]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def meal_period(hour: str | Column) -> Column:
    """Hour of day -> meal period (a native CASE, never a Python UDF)."""
    h = col(hour)
    expr = F.when(h < MEAL_PERIOD_HOURS[0][0], F.lit("Late Night"))
    for (lo, name), (hi, _) in zip(MEAL_PERIOD_HOURS, MEAL_PERIOD_HOURS[1:]):
        expr = expr.when(h < hi, F.lit(name))
    return expr.otherwise(F.lit("Late Night"))


def level_position(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position of ``c`` in ``levels``; 0 when absent (MySQL FIELD())."""
    return F.array_position(F.array(*[F.lit(v) for v in levels]), col(c))


def strip_the(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "^The ", "")


def iso_weekday(d: str | Column) -> Column:
    """Monday=1 ... Sunday=7 (Spark's dayofweek is Sunday=1, so not that)."""
    return (F.weekday(col(d)) + F.lit(1)).cast("int")


def day_name(d: str | Column) -> Column:
    return F.date_format(col(d), "EEEE")


def month_name(d: str | Column) -> Column:
    return F.date_format(col(d), "MMMM")


def exact_round(num: str | Column, den: str | Column, scale: int = 2,
                mode: str = "half_up") -> Column:
    """Round the exact rational num/den to ``scale`` decimals, as DOUBLE.

    ``num`` and ``den`` must be whole numbers (counts, cents) and ``den > 0``.
    The quotient is computed in DECIMAL(38,0), so no floating-point tie can
    flip the last digit: any engine doing integer arithmetic prints the same
    result. Rounding is symmetric around zero.
    ``mode``: ``half_up`` (SQL ROUND) or ``half_even`` (R / pandas round).
    """
    raw = col(num).cast("decimal(38,0)")
    n = F.abs(raw) * F.lit(10 ** scale).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    r = n % d
    q = ((n - r) / d).cast("long")
    twice = r * F.lit(2)
    if mode == "half_up":
        q = F.when(twice >= d, q + 1).otherwise(q)
    elif mode == "half_even":
        q = (F.when(twice > d, q + 1)
             .when(twice == d, q + (q % 2))
             .otherwise(q))
    else:
        raise ValueError(mode)
    q = F.when(raw < 0, -q).otherwise(q)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(
        q.cast("double") / F.lit(float(10 ** scale)))


def money(c: str | Column) -> Column:
    """Exact DECIMAL money to DOUBLE, once, at the end of a plan."""
    return col(c).cast("double")


def cents(c: str | Column) -> Column:
    """DECIMAL(p<=15, 2) money -> whole cents as BIGINT, per row.

    Summing BIGINT cents keeps aggregation buffers as primitive longs (a
    DECIMAL sum widens to precision 22 and falls back to BigDecimal
    arithmetic); the sum is exact, and ANSI mode raises on overflow.
    """
    return (col(c) * F.lit(100).cast("decimal(3,0)")).cast("long")


def from_cents(c: str | Column) -> Column:
    """Whole cents -> money as DOUBLE (correctly rounded, like CAST(DECIMAL AS DOUBLE))."""
    return col(c).cast("double") / F.lit(100.0)


def share_pct(part: str | Column, total: str | Column, scale: int = 1) -> Column:
    """100 * part / total rounded half-up, for whole-number parts (units, cents)."""
    return exact_round(col(part).cast("decimal(28,0)") * F.lit(100), total, scale)
