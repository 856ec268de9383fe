"""Column expressions shared by rules, features and reports.

Everything here is a built-in expression, so it stays inside whole-stage
code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.config import AuditConfig

MICROS_PER_DAY = 86_400_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def days_floor(later: Column, earlier: Column) -> Column:
    """Whole elapsed days, rounded down (also for negative spans)."""
    span = micros(later) - micros(earlier)
    return F.floor(span.cast("double") / F.lit(float(MICROS_PER_DAY))).cast("int")


def plus_days(ts: Column, days: Column | int) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return ts + F.make_dt_interval(days.cast("int"))


def plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def month(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def is_after_hours(ts: Column, cfg: AuditConfig) -> Column:
    hour = F.hour(ts)
    return (F.weekday(ts) >= 5) | (hour < cfg.biz_hour_start) | (hour >= cfg.biz_hour_end)


def is_round(amount: Column, cfg: AuditConfig) -> Column:
    return reduce(lambda a, b: a | b, [amount % F.lit(m) == 0 for m in cfg.round_moduli])


def first_digit(amount: Column) -> Column:
    """Leading digit of the whole part; NULL below 1."""
    whole = F.floor(amount).cast("bigint")
    return F.when(amount >= 1, F.substring(whole.cast("string"), 1, 1).cast("int"))


def benford_share(digit: Column) -> Column:
    return F.log10(F.lit(1.0) + F.lit(1.0) / digit)


def deviates(amount: Column, base: Column, tolerance) -> Column:
    """|amount - base| / |base| > tolerance without a division; false at base 0."""
    gap = F.abs(amount - base)
    return (base != 0) & (gap > F.lit(tolerance) * F.abs(base))


def deviation_pct(amount: Column, base: Column) -> Column:
    d_base = base.cast("double")
    return F.try_divide((amount - base).cast("double") * 100.0, d_base)


def money(col: Column) -> Column:
    """Exact decimal to double, for result columns."""
    return col.cast("double")


def whole(col: Column) -> Column:
    """1234567.4 -> '1,234,567' (half-even, as text)."""
    return F.format_number(col, 0)


def fixed(col: Column, digits: int) -> Column:
    return F.translate(F.format_number(col, digits), ",", "")


def finite_or_zero(col: Column) -> Column:
    bad = F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(F.coalesce(col, F.lit(0.0)))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def tier(score: Column, critical: float, high: float, medium: float) -> Column:
    return (
        F.when(score >= critical, "Critical")
        .when(score >= high, "High")
        .when(score >= medium, "Medium")
        .otherwise("Low")
    )


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 when den is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
