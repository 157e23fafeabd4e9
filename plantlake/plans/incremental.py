"""Gold views kept up to date from what is new in silver.

The stored form of a view are partial results per day: counts, sums, and for means and deviations the number,
mean and squared distance of the values. They merge with those of later rows without rereading
earlier ones. A refresh takes the new silver rows, merges them into their days and replaces
the view for these days only. Views that are not per day are formed anew from the partial results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plantlake.functions import rules
from plantlake.functions.columns import utc_wall
from plantlake.operators.latest import latest_per_key, tumbling
from plantlake.operators.metrics import count_where, having
from plantlake.operators.project import trailing
from plantlake.plans import gold
from plantlake.streaming.merge import bucket_of

DAY = "__day"


def reduced(rows: DataFrame, keys: dict[str, Column], sums: dict[str, Column], values: tuple[str, ...]) -> DataFrame:
    """Partial results per group: row count, sums, and the moments of the values."""
    moments = [c for v in values for c in (
        F.count(v).alias(f"{v}_n"), F.avg(v).alias(f"{v}_mean"), (F.var_pop(v) * F.count(v)).alias(f"{v}_m2"),
        F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"))]
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.count("*").alias("row_count"), *[c.alias(n) for n, c in sums.items()], *moments)


def combined(parts: DataFrame, keys: list[str], sums: list[str], values: tuple[str, ...]) -> DataFrame:
    """Partial results of coarser or equal groups, by one hash aggregation. The squared distances of the parts' means from the common
    mean come from covariances, which follow running means, so that no large squares are subtracted from each other."""
    moments = []
    for v in values:
        n, mean = F.col(f"{v}_n"), F.col(f"{v}_mean")
        common = F.sum(n * mean) / F.nullif(F.sum(n), F.lit(0))
        # sum n (mean - common)^2 = sum n mean d - common * sum n d, with d from the plain average of the means.
        between = F.count(mean) * (F.covar_pop(n * mean, mean) - common * F.covar_pop(n, mean))
        moments += [F.sum(n).alias(f"{v}_n"), common.alias(f"{v}_mean"), (F.sum(f"{v}_m2") + F.greatest(between, F.lit(0.0))).alias(f"{v}_m2"),
                    F.min(f"{v}_min").alias(f"{v}_min"), F.max(f"{v}_max").alias(f"{v}_max")]
    return parts.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in ("row_count", *sums)], *moments)


def deviation(value: str) -> Column:
    """Sample deviation from moments; null below two values."""
    n = F.col(f"{value}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{value}_m2") / (n - 1)))


def utc_date(df: DataFrame, column: str) -> Column:
    """Calendar day in UTC, the same in every session zone."""
    zoned = df.select(column).dtypes[0][1] == "timestamp"
    return F.to_date(utc_wall(column) if zoned else F.col(column))


@dataclass(frozen=True)
class Increment:
    """How a view is kept: stored rows and the part of each, and the view from them."""

    reduce: Callable[[DataFrame], DataFrame]
    combine: Callable[[DataFrame], DataFrame]
    part: Column
    finish: Callable[..., DataFrame]  #: stored rows, the view's dimensions and options
    view_part: Callable[[DataFrame], Column] | None = None  #: the part of a row of the view; without it the view is one part
    owned: bool = True


def _sums(keys: dict[str, Column], sums: dict[str, Column], values: tuple[str, ...], day: Callable[[DataFrame], Column]):
    """Steps for groups with a day each."""
    def reduce(rows: DataFrame) -> DataFrame:
        groups = reduced(rows, keys, sums, values)
        return groups.withColumn(DAY, day(groups))

    return reduce, lambda parts: combined(parts, [DAY, *keys], list(sums), values)


def alerts(width: str = "5 minutes") -> Increment:
    """Alert groups, by the day that their window starts on."""
    status, value = F.col("alert_status"), "reading_value"
    keys = {c: F.col(c) for c in ("refinery_id", "unit_id", "sensor_type")} | {"time_window": tumbling("reading_timestamp", width)}
    sums = {"critical_count": count_where(status == rules.CRITICAL), "warning_count": count_where(status == rules.WARNING)}
    reduce, combine = _sums(keys, sums, (value,), lambda df: utc_date(df, "time_window.start"))

    def finish(parts: DataFrame) -> DataFrame:
        critical, warning = F.col("critical_count"), F.col("warning_count")
        score = (critical * gold.CRITICAL_WEIGHT + warning * gold.WARNING_WEIGHT) / F.col("row_count")
        rows = parts.select(*keys, F.col("row_count").alias("reading_count"), critical, warning, F.col(f"{value}_mean").alias("avg_value"),
                            deviation(value).alias("stddev_value"), F.col(f"{value}_min").alias("min_value"), F.col(f"{value}_max").alias("max_value"),
                            score.alias("alert_severity_score"))
        return having(rows, (critical > 0) | (warning > gold.WARNINGS_TO_ALERT))

    return Increment(reduce, combine, F.col(DAY), finish, lambda df: utc_date(df, "time_window.start"))


def kpis(on_spec: str = gold.ON_SPEC) -> Increment:
    """Daily figures per site. Stored per unit, so that the units of a day are counted exactly."""
    measured = ("input_volume_barrels", "output_volume_barrels", "energy_consumed_mmbtu", "downtime_minutes")
    keys = {"refinery_id": F.col("refinery_id"), "production_date": F.to_date("production_hour"), "unit_id": F.col("unit_id")}
    sums = {c: F.sum(c) for c in measured} | {"on_spec_count": count_where(F.col("quality_grade") == on_spec)}
    reduce, combine = _sums(keys, sums, (), lambda df: F.col("production_date"))

    def finish(parts: DataFrame, sites: DataFrame) -> DataFrame:
        daily = parts.groupBy("refinery_id", "production_date").agg(
            *gold.daily_measures(F.sum("on_spec_count") / F.sum("row_count"), F.count("unit_id")))
        return gold.with_site(daily, sites)

    return Increment(reduce, combine, F.col(DAY), finish, lambda df: F.col("production_date"))


def sketched_kpis(on_spec: str = gold.ON_SPEC, bits: int = 12) -> Increment:
    """Daily figures per site with a sketch of the units of a day in the place of a row per unit, for very many units. The units are then
    counted within a relative standard error of about 1.04 / sqrt(2^``bits``), 1.6 % for 12 bits."""
    measured = ("input_volume_barrels", "output_volume_barrels", "energy_consumed_mmbtu", "downtime_minutes")
    keys = {"refinery_id": F.col("refinery_id"), "production_date": F.to_date("production_hour")}
    sums = {c: F.sum(c) for c in measured} | {"on_spec_count": count_where(F.col("quality_grade") == on_spec)}

    def reduce(rows: DataFrame) -> DataFrame:
        # The sketch takes numbers, texts and bytes; ids of other types as text.
        kind = dict(rows.dtypes)["unit_id"]
        unit = F.col("unit_id") if kind in ("int", "bigint", "string", "binary") else F.col("unit_id").cast("string")
        groups = rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
            F.count("*").alias("row_count"), *[c.alias(n) for n, c in sums.items()], F.hll_sketch_agg(unit, bits).alias("units"))
        return groups.withColumn(DAY, F.col("production_date"))

    def combine(parts: DataFrame) -> DataFrame:
        return parts.groupBy(DAY, *keys).agg(*[F.sum(s).alias(s) for s in ("row_count", *sums)], F.hll_union_agg("units").alias("units"))

    def finish(parts: DataFrame, sites: DataFrame) -> DataFrame:
        daily = parts.groupBy("refinery_id", "production_date").agg(
            *gold.daily_measures(F.sum("on_spec_count") / F.sum("row_count"), F.hll_sketch_estimate(F.hll_union_agg("units"))))
        return gold.with_site(daily, sites)

    return Increment(reduce, combine, F.col(DAY), finish, lambda df: F.col("production_date"))


def health() -> Increment:
    """Health per unit and day: counts and moments per sensor type."""
    value, status = "reading_value", F.col("alert_status")
    keys = {"unit_id": F.col("unit_id"), "sensor_type": F.col("sensor_type"), "reading_date": F.to_date("reading_timestamp")}
    reduce, combine = _sums(keys, {"flagged": count_where(status != rules.NORMAL)}, (value,), lambda df: F.col("reading_date"))

    def finish(parts: DataFrame, units: DataFrame, sites: DataFrame, as_of: Column | None = None, days: int = gold.HEALTH_DAYS) -> DataFrame:
        today = F.current_date() if as_of is None else as_of
        recent = trailing(parts, "reading_date", days, today)
        scores = recent.groupBy("unit_id", "reading_date").agg(
            F.avg(F.col("flagged") / F.col("row_count")).alias("avg_anomaly_rate"), F.avg(deviation(value)).alias("avg_volatility"))
        return gold.health_of(scores, units, sites, today)

    return Increment(reduce, combine, F.col(DAY), finish)


def yields() -> Increment:
    """Yield per feed grade and product, from the moments of each day."""
    value = "yield_percentage"
    groups = ["input_crude_type_id", "output_product_id"]
    keys = {c: F.col(c) for c in groups} | {"production_date": F.to_date("production_hour")}
    reduce, combine = _sums(keys, {}, (value,), lambda df: F.col("production_date"))

    def finish(parts: DataFrame, crudes: DataFrame, products: DataFrame) -> DataFrame:
        total = combined(parts, groups, [], (value,))
        return gold.yield_of(total.select(*groups, F.col(f"{value}_mean").alias("avg_yield"), deviation(value).alias("yield_stddev"),
                                          F.col(f"{value}_min").alias("min_yield"), F.col(f"{value}_max").alias("max_yield"),
                                          F.col("row_count").alias("sample_count")), crudes, products)

    return Increment(reduce, combine, F.col(DAY), finish)


def newest_snapshots(buckets: int = 64) -> Increment:
    """Tank levels: the newest snapshot per tank, in buckets of tanks. Any rows may come again."""
    newest = lambda rows: latest_per_key(rows, ["tank_id"], "measurement_timestamp", ["inventory_id"])
    return Increment(newest, newest, bucket_of(["tank_id"], buckets), gold.inventory_status_view, owned=False)
