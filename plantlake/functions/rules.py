"""Per-row rules as column expressions.

Every rule is built from JVM-side functions only, takes its columns and limits
as arguments, and behaves the same on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from plantlake.functions.columns import ColumnLike, as_col

# Labels and cut points of the plant's status rules.
CRITICAL, WARNING, NORMAL = "CRITICAL", "WARNING", "NORMAL"
CRITICALLY_LOW, LOW, OVER_FILLED, NEAR_CAPACITY = (
    "CRITICALLY_LOW", "LOW", "OVER_FILLED", "NEAR_CAPACITY")
BELOW_MIN, ABOVE_MAX, WITHIN_RANGE = "BELOW_MIN", "ABOVE_MAX", "WITHIN_RANGE"
OVERDUE, DUE_SOON, OK = "OVERDUE", "DUE_SOON", "OK"
GOOD, UNCERTAIN, BAD = "GOOD", "UNCERTAIN", "BAD"
FILL_CRITICAL_LOW, FILL_LOW, FILL_NEAR, FILL_OVER = 0.10, 0.25, 0.85, 0.95
ATTENTION_LOW, ATTENTION_HIGH, ATTENTION_WATER = 0.15, 0.92, 6.0
DUE_SOON_SHARE = 0.9


def first_match(branches: Iterable[tuple[Column, ColumnLike]], default: ColumnLike | None) -> Column:
    """Ordered CASE: the first true branch wins, a null condition counts as false."""
    result = None
    for condition, label in branches:
        value = F.lit(label) if isinstance(label, str) else as_col(label)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    if default is None:
        return result
    return result.otherwise(F.lit(default) if isinstance(default, str) else as_col(default))


def outside(value: ColumnLike, low: ColumnLike, high: ColumnLike) -> Column:
    """Strictly below ``low`` or above ``high``; three-valued."""
    v = as_col(value)
    return (v < as_col(low)) | (v > as_col(high))


def threshold_status(value, warn_low, warn_high, crit_low, crit_high) -> Column:
    """CRITICAL, WARNING or NORMAL; limits themselves are normal, and so is null."""
    return first_match(
        [(outside(value, crit_low, crit_high), CRITICAL),
         (outside(value, warn_low, warn_high), WARNING)],
        NORMAL)


def out_of_range(value, low, high, null_as_false: bool = False) -> Column:
    """Range flag; null in gives null out unless ``null_as_false``."""
    flag = outside(value, low, high)
    return F.coalesce(flag, F.lit(False)) if null_as_false else flag


def quality_label(value, warn_low, warn_high, crit_low, crit_high) -> Column:
    """BAD, UNCERTAIN or GOOD; unlike ``threshold_status`` the limits count as hit."""
    v = as_col(value)

    def hit(low, high):
        return (v <= as_col(low)) | (v >= as_col(high))

    return first_match([(hit(crit_low, crit_high), BAD), (hit(warn_low, warn_high), UNCERTAIN)], GOOD)


def clamp(value, low, high) -> Column:
    """Pull a value into ``[low, high]``; a null value stays null."""
    v = as_col(value)
    return F.when(v.isNotNull(), F.greatest(as_col(low), F.least(as_col(high), v)))


def fill_band(fill) -> Column:
    """Five fill-level bands; low bands are tested before high ones."""
    f = as_col(fill)
    return first_match(
        [(f < FILL_CRITICAL_LOW, CRITICALLY_LOW), (f < FILL_LOW, LOW),
         (f > FILL_OVER, OVER_FILLED), (f > FILL_NEAR, NEAR_CAPACITY)],
        NORMAL)


def needs_attention(fill, water) -> Column:
    """True on an extreme level or on deep bottom water; null inputs never trigger."""
    hit = outside(fill, ATTENTION_LOW, ATTENTION_HIGH) | (as_col(water) > ATTENTION_WATER)
    return F.coalesce(hit, F.lit(False))


def available_capacity(fill, volume) -> Column:
    """Whole barrels up to the 95 % mark; null where the level is zero."""
    f, v = as_col(fill), as_col(volume)
    room = F.try_divide((F.lit(FILL_OVER) - f) * v, f).try_cast("int")
    return F.when(f < FILL_OVER, room).otherwise(F.lit(0))


def operating_status(fill, low, high) -> Column:
    """Level against the tank's own limits; unknown limits count as within range."""
    f = as_col(fill)
    return first_match([(f < as_col(low), BELOW_MIN), (f > as_col(high), ABOVE_MAX)], WITHIN_RANGE)


def inventory_status(fill, low, high) -> Column:
    """Fill bands whose outer limits come from the tank itself."""
    f = as_col(fill)
    return first_match(
        [(f < as_col(low), CRITICALLY_LOW), (f < FILL_LOW, LOW),
         (f > as_col(high), OVER_FILLED), (f > FILL_NEAR, NEAR_CAPACITY)],
        NORMAL)


def maintenance_status(last, interval, as_of) -> Column:
    """OVERDUE past the interval, DUE_SOON past nine tenths of it, else OK."""
    age, limit = F.datediff(as_col(as_of), as_col(last)), as_col(interval)
    return first_match([(age > limit, OVERDUE), (age > limit * DUE_SOON_SHARE, DUE_SOON)], OK)


def days_delayed(arrived, expected) -> Column:
    """Signed days late."""
    return F.datediff(as_col(arrived), as_col(expected))


def variance(actual, typical) -> Column:
    return as_col(actual) - as_col(typical)


def safe_ratio(numerator, denominator) -> Column:
    """Double ratio; null rather than an error where the denominator is zero."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def health_score(rate, volatility) -> Column:
    """100 less penalties, floored at 0; missing inputs score 0."""
    raw = F.lit(100.0) - as_col(rate) * 500.0 - as_col(volatility) / 10.0
    return F.greatest(F.lit(0.0), raw)


def anomaly_rate(status) -> Column:
    """Aggregate: share of rows whose status is not NORMAL (null counts as normal)."""
    return F.avg(F.when(as_col(status) != NORMAL, 1.0).otherwise(0.0))


def value_when(condition: Column, value) -> Column:
    """The value where the condition holds, null elsewhere."""
    return F.when(condition, as_col(value))
