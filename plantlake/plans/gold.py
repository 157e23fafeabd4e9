"""Business views over the silver tables.

Facts are aggregated before they meet a dimension wherever the dimension key is
part of the grouping: the join then runs on groups instead of rows, and a site
or unit with a third of all rows is reduced map-side first. Dimension keys are
unique, so this gives the same rows as joining first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plantlake.functions import rules
from plantlake.operators.enrich import dim_first, enrich_left, join_filtered, join_inner, lookup
from plantlake.operators.latest import latest_per_key, tumbling
from plantlake.operators.metrics import (
    by_day, count_where, distinct_count, having, ratio_of_sums, severity_of, two_level)
from plantlake.operators.project import derive_columns, trailing

# Weights and limits of the alert rule, grade label, period.
CRITICAL_WEIGHT, WARNING_WEIGHT, WARNINGS_TO_ALERT = 10.0, 3.0, 5
ON_SPEC = "On-Spec"
HEALTH_DAYS = 7
MINUTES_PER_UNIT = 60
PARTITION_DATE = "partition_date"


def anomaly_alerts(readings: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Groups of one window with a critical reading or more than five warnings."""
    status = F.col("alert_status")
    critical, warning = status == rules.CRITICAL, status == rules.WARNING
    grouped = (readings
               .groupBy("refinery_id", "unit_id", "sensor_type",
                        tumbling("reading_timestamp", width).alias("time_window"))
               .agg(F.count("*").alias("reading_count"),
                    count_where(critical).alias("critical_count"),
                    count_where(warning).alias("warning_count"),
                    F.avg("reading_value").alias("avg_value"),
                    F.stddev_samp("reading_value").alias("stddev_value"),
                    F.min("reading_value").alias("min_value"),
                    F.max("reading_value").alias("max_value"),
                    severity_of([(critical, CRITICAL_WEIGHT), (warning, WARNING_WEIGHT)])
                    .alias("alert_severity_score")))
    return having(grouped, (F.col("critical_count") > 0) | (F.col("warning_count") > WARNINGS_TO_ALERT))


def unit_scores(readings: DataFrame, as_of: Column, days: int = HEALTH_DAYS) -> DataFrame:
    """Per unit and day: means over sensor types of anomaly rate and volatility."""
    recent = trailing(readings, "reading_timestamp", days, as_of)
    if PARTITION_DATE in readings.columns:  # prunes whole partitions of a stored table
        recent = trailing(recent, PARTITION_DATE, days, as_of)
    return two_level(
        recent,
        ["unit_id", "sensor_type", F.to_date("reading_timestamp").alias("reading_date")],
        [F.stddev_samp("reading_value").alias("volatility"),
         rules.anomaly_rate("alert_status").alias("rate")],
        ["unit_id", "reading_date"],
        [F.avg("rate").alias("avg_anomaly_rate"), F.avg("volatility").alias("avg_volatility")],
        colocate=["unit_id"])


def equipment_health(readings: DataFrame, units: DataFrame, sites: DataFrame, as_of: Column | None = None,
                     days: int = HEALTH_DAYS) -> DataFrame:
    """Health and maintenance state of every unit, also of units without readings."""
    today = F.current_date() if as_of is None else as_of
    return health_of(unit_scores(readings, today, days), units, sites, today)


def health_of(scores: DataFrame, units: DataFrame, sites: DataFrame, today: Column) -> DataFrame:
    """State of every unit from its scores per day."""
    with_site = enrich_left(units, sites, "refinery_id", ["refinery_name"])
    joined = dim_first(with_site, scores, "unit_id", ["reading_date", "avg_anomaly_rate", "avg_volatility"])
    return joined.select(
        "unit_id", "unit_name", "unit_type", "refinery_id", "refinery_name", "reading_date",
        rules.health_score("avg_anomaly_rate", "avg_volatility").alias("health_score"),
        F.datediff(today, "last_maintenance_date").alias("days_since_maintenance"),
        "maintenance_interval_days",
        rules.maintenance_status("last_maintenance_date", "maintenance_interval_days", today)
        .alias("maintenance_status"))


def daily_kpis(production: DataFrame, sites: DataFrame, on_spec: str = ON_SPEC) -> DataFrame:
    """Site and day: volumes, yield, capacity use, energy, downtime and quality."""
    share = F.avg(F.when(F.col("quality_grade") == on_spec, 1.0).otherwise(0.0))
    measures = daily_measures(share, distinct_count("unit_id"))
    return with_site(by_day(production, "production_hour", ["refinery_id"], measures, "production_date"), sites)


def daily_measures(on_spec_rate: Column, units: Column) -> list[Column]:
    """Aggregates of a day; the number of units and the share on specification depend on the form of the rows."""
    return [
        F.sum("input_volume_barrels").alias("total_crude_processed"),
        F.sum("output_volume_barrels").alias("total_products_produced"),
        ratio_of_sums("output_volume_barrels", "input_volume_barrels").alias("overall_yield"),
        ratio_of_sums("energy_consumed_mmbtu", "output_volume_barrels").alias("energy_intensity"),
        F.sum("downtime_minutes").alias("total_downtime_minutes"),
        rules.safe_ratio(F.sum("downtime_minutes"), units * MINUTES_PER_UNIT).alias("downtime_percentage"),
        on_spec_rate.alias("on_spec_rate"),
    ]


def with_site(daily: DataFrame, sites: DataFrame) -> DataFrame:
    """Daily figures with the site's attributes and the use of its capacity."""
    site = ["refinery_name", "location_city", "location_state", "capacity_bpd"]
    joined = lookup(daily, sites, "refinery_id", site, how="inner")
    use = rules.safe_ratio("total_crude_processed", "capacity_bpd").alias("capacity_utilization")
    return joined.select(
        "refinery_id", *site, "production_date", "total_crude_processed", "total_products_produced",
        "overall_yield", use, "energy_intensity", "total_downtime_minutes", "downtime_percentage",
        "on_spec_rate")


def product_yield(production: DataFrame, crudes: DataFrame, products: DataFrame) -> DataFrame:
    """Yield statistics per feed grade and product, against the product's typical yield."""
    grouped = (production.groupBy("input_crude_type_id", "output_product_id")
               .agg(F.avg("yield_percentage").alias("avg_yield"),
                    F.stddev_samp("yield_percentage").alias("yield_stddev"),
                    F.min("yield_percentage").alias("min_yield"),
                    F.max("yield_percentage").alias("max_yield"),
                    F.count("*").alias("sample_count")))
    return yield_of(grouped, crudes, products)


def yield_of(grouped: DataFrame, crudes: DataFrame, products: DataFrame) -> DataFrame:
    """Yield statistics with the attributes of feed grade and product."""
    joined = join_inner(grouped, [
        (crudes, {"input_crude_type_id": "crude_type_id"},
         {"crude_name": "crude_name", "classification": "crude_class", "sweetness": "sweetness"}),
        (products, {"output_product_id": "product_id"},
         ["product_name", "product_category", "typical_yield_pct"]),
    ])
    return joined.select(
        F.col("input_crude_type_id").alias("crude_type_id"), "crude_name", "crude_class", "sweetness",
        F.col("output_product_id").alias("product_id"), "product_name", "product_category",
        "avg_yield", "yield_stddev", "min_yield", "max_yield", "sample_count",
        rules.variance("avg_yield", "typical_yield_pct").alias("yield_vs_typical"))


def inventory_by_snapshot(inventory: DataFrame, tanks: DataFrame, tie_break: list[str]) -> DataFrame:
    """Latest snapshot of every tank seen, with the tank's attributes where known."""
    newest = latest_per_key(inventory, ["tank_id"], "measurement_timestamp", tie_break)
    limits = ["min_operating_level", "max_operating_level"]
    joined = enrich_left(newest, tanks, "tank_id", ["tank_name", "capacity_barrels", *limits])
    full = derive_columns(joined, {
        "capacity_utilization": rules.safe_ratio("volume_barrels", "capacity_barrels"),
        "operating_status": rules.operating_status("fill_percentage", *limits),
    })
    wanted = ["tank_id", "tank_name", "refinery_id", "product_type", "volume_barrels",
              "capacity_barrels", "fill_percentage", "capacity_utilization", "inventory_status",
              "operating_status", "requires_attention", "available_capacity_barrels",
              "temperature_f", "water_bottom_inches", "measurement_timestamp", "processed_at"]
    return full.select(*[c for c in wanted if c in full.columns])


def inventory_by_tank(inventory: DataFrame, tanks: DataFrame, sites: DataFrame, tie_break: list[str]) -> DataFrame:
    """Active tanks with a snapshot and a known site, banded by their own limits."""
    newest = latest_per_key(
        inventory.select("tank_id", "measurement_timestamp", "volume_barrels", "fill_percentage", *tie_break),
        ["tank_id"], "measurement_timestamp", tie_break)
    with_site = join_filtered(tanks.where("is_active"), sites, "refinery_id", F.lit(True), ["refinery_name"])
    joined = lookup(with_site, newest, "tank_id",
                    {"volume_barrels": "current_volume", "fill_percentage": "fill_percentage",
                     "measurement_timestamp": "last_measured"}, how="inner")
    return joined.select(
        "tank_id", "tank_name", "refinery_id", "refinery_name", "product_type", "capacity_barrels",
        "current_volume", "fill_percentage", "last_measured",
        rules.inventory_status("fill_percentage", "min_operating_level", "max_operating_level")
        .alias("inventory_status"))


def inventory_status_view(inventory: DataFrame, tanks: DataFrame, sites: DataFrame | None = None,
                          tie_break: tuple[str, ...] = ("inventory_id",)) -> DataFrame:
    """Without sites: snapshot-first form; with sites: tank-first form."""
    ties = list(tie_break)
    if sites is None:
        return inventory_by_snapshot(inventory, tanks, ties)
    return inventory_by_tank(inventory, tanks, sites, ties)
