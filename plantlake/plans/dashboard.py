"""Queries behind the dashboards. Inputs are silver or gold frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.functions import rules
from plantlake.operators.enrich import enrich_left, lookup
from plantlake.operators.metrics import count_where, ratio_of_sums
from plantlake.operators.ordered import running_total, with_rank
from plantlake.operators.project import trailing
from plantlake.plans.gold import inventory_by_snapshot

IN_TRANSIT = "IN_TRANSIT"
SECONDS_PER_DAY = 86400.0


# --- operations -----------------------------------------------------------

def site_health(health: DataFrame, sites: DataFrame) -> DataFrame:
    """Mean health of each site's units on their latest day, with coordinates."""
    newest = (health.groupBy("refinery_id", "unit_id")
              .agg(F.max_by("health_score", F.coalesce("reading_date", F.lit("0001-01-01").cast("date")))
                   .alias("health_score")))
    means = newest.groupBy("refinery_id").agg(F.avg("health_score").alias("mean_health"),
                                              F.count("*").alias("unit_count"))
    return lookup(means, sites, "refinery_id", ["refinery_name", "latitude", "longitude"], how="inner")


def alert_feed(readings: DataFrame, n: int = 100, tie_break: str = "reading_id") -> DataFrame:
    """The newest ``n`` readings that are not normal; planned as a distributed top-n."""
    return (readings.where(F.col("alert_status") != rules.NORMAL)
            .orderBy(F.desc("reading_timestamp"), F.desc(tie_break)).limit(n))


def anomaly_heatmap(readings: DataFrame, sensor_types: list[str]) -> DataFrame:
    """Units by sensor type, cells holding the anomaly rate. The type list is given,
    so no extra job looks for it and the columns are stable."""
    return readings.groupBy("unit_id").pivot("sensor_type", sensor_types).agg(rules.anomaly_rate("alert_status"))


def trend_24h(readings: DataFrame, as_of: Column) -> DataFrame:
    """Hourly mean per sensor type over the 24 hours up to ``as_of``."""
    ts = F.col("reading_timestamp")
    return (readings.where((ts > as_of - F.expr("INTERVAL 24 HOURS")) & (ts <= as_of))
            .groupBy("sensor_type", F.date_trunc("hour", ts).cast(readings.schema["reading_timestamp"].dataType)
                     .alias("hour"))
            .agg(F.avg("reading_value").alias("avg_value"), F.count("*").alias("row_count")))


def kpi_cards(readings: DataFrame, production: DataFrame, sites: DataFrame, units: DataFrame) -> DataFrame:
    """One row of headline numbers; the parts are scalar subqueries, not a cross join."""
    alerts = readings.agg(count_where(F.col("alert_status") != rules.NORMAL).alias("n")).scalar()
    capacity = sites.agg(F.sum("capacity_bpd").alias("n")).scalar()
    active = units.agg(count_where(F.col("is_active")).alias("n")).scalar()
    volume = production.agg(F.sum("input_volume_barrels").alias("volume"),
                            F.countDistinct(F.to_date("production_hour")).alias("days"))
    return volume.select(
        alerts.alias("total_alerts"),
        rules.safe_ratio("volume", capacity * F.col("days")).alias("capacity_utilization"),
        active.alias("active_units"))


# --- production -----------------------------------------------------------

def yield_by_crude(production: DataFrame, crudes: DataFrame) -> DataFrame:
    grouped = production.groupBy("input_crude_type_id").agg(
        F.avg("yield_percentage").alias("avg_yield"), F.count("*").alias("sample_count"))
    return lookup(grouped, crudes, {"input_crude_type_id": "crude_type_id"}, ["crude_name"], how="inner")


def energy_trend(production: DataFrame) -> DataFrame:
    """Energy per unit of output by day."""
    return (production.groupBy(F.to_date("production_hour").alias("production_date"))
            .agg(ratio_of_sums("energy_consumed_mmbtu", "output_volume_barrels").alias("energy_per_barrel")))


def capacity_trend(kpis: DataFrame) -> DataFrame:
    """Capacity use per site and month, from the daily view."""
    return (kpis.groupBy("refinery_id", "refinery_name",
                         F.trunc("production_date", "month").alias("month"))
            .agg(F.avg("capacity_utilization").alias("capacity_utilization"),
                 F.count("*").alias("day_count")))


def by_category(production: DataFrame, products: DataFrame, volume: str) -> DataFrame:
    """Volume per product category; rows are summed per product before the lookup."""
    summed = production.groupBy("output_product_id").agg(F.sum(volume).alias(volume))
    return (lookup(summed, products, {"output_product_id": "product_id"}, ["product_category"], how="inner")
            .groupBy("product_category").agg(F.sum(volume).alias(volume)))


def product_mix(production: DataFrame, products: DataFrame) -> DataFrame:
    """Share of each product category in total output."""
    mix = by_category(production, products, "output_volume_barrels")
    total = mix.agg(F.sum("output_volume_barrels").alias("t")).scalar()
    return mix.withColumn("share", rules.safe_ratio("output_volume_barrels", total))


def downtime_pareto(production: DataFrame) -> DataFrame:
    """Units by downtime, largest first, with their cumulative share."""
    totals = production.groupBy("unit_id").agg(F.sum("downtime_minutes").alias("downtime_minutes"))
    run = running_total(totals, [F.desc("downtime_minutes"), F.asc("unit_id")], "downtime_minutes",
                        "running_minutes")
    everything = run.agg(F.sum("downtime_minutes").alias("t")).scalar()
    return run.withColumn("cumulative_share", rules.safe_ratio("running_minutes", everything))


def quality_vs_yield(production: DataFrame) -> DataFrame:
    """Per quality grade: mean yield, and its correlation with energy use."""
    return production.groupBy("quality_grade").agg(
        F.avg("yield_percentage").alias("avg_yield"),
        F.corr("yield_percentage", "energy_consumed_mmbtu").alias("yield_energy_corr"),
        F.count("*").alias("sample_count"))


# --- inventory and supply -------------------------------------------------

def tank_levels(inventory: DataFrame, tanks: DataFrame, tie_break: list[str]) -> DataFrame:
    """Gauge values: the snapshot-first inventory view, level columns only."""
    return inventory_by_snapshot(inventory, tanks, tie_break).select(
        "tank_id", "tank_name", "fill_percentage", "operating_status", "inventory_status")


def quality_variance(shipments: DataFrame) -> DataFrame:
    """Actual against typical quality, one point per delivered shipment."""
    return shipments.select("shipment_id", "crude_name", "api_gravity_actual", "api_gravity_typical",
                            "api_gravity_variance", "sulfur_variance")


def in_transit(shipments: DataFrame, status: str = IN_TRANSIT) -> DataFrame:
    """Shipments on their way, by port of origin."""
    return (shipments.where(F.col("status") == status).groupBy("origin_port")
            .agg(F.count("*").alias("shipment_count"), F.sum("volume_barrels").alias("volume_barrels")))


def days_of_supply(stock: DataFrame, draws: DataFrame, products: DataFrame, volume: str, ts: str, as_of: Column,
                   days: int = 30) -> DataFrame:
    """Stock of each product category divided by its mean daily draw in the trailing
    period; null without draws. Stock rows are the current amounts."""
    held = by_category(stock, products, volume).withColumnRenamed(volume, "stock_volume")
    drawn = by_category(trailing(draws, ts, days, as_of), products, volume).select(
        "product_category", (F.col(volume) / float(days)).alias("daily_draw"))
    joined = lookup(held, drawn, "product_category", ["daily_draw"])
    return joined.withColumn("days_of_supply", rules.safe_ratio("stock_volume", "daily_draw"))


def on_time_rate(shipments: DataFrame) -> DataFrame:
    """Share of shipments that arrived by the expected date, per month of arrival."""
    return (shipments.groupBy(F.trunc("arrival_date", "month").alias("month"))
            .agg(F.avg(F.when(F.col("days_delayed") <= 0, 1.0).otherwise(0.0)).alias("on_time_rate"),
                 F.count("*").alias("shipment_count")))


def stock_trend(inventory: DataFrame) -> DataFrame:
    """Fitted change of level per day for each tank."""
    day = F.unix_timestamp(F.col("measurement_timestamp").cast("timestamp")) / SECONDS_PER_DAY
    # Days are counted from a fixed origin close to the data to keep precision.
    origin = F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) / SECONDS_PER_DAY
    return inventory.groupBy("tank_id").agg(
        F.regr_slope("fill_percentage", day - origin).alias("level_change_per_day"),
        F.count("*").alias("snapshot_count"))


def blend_average(shipments: DataFrame) -> DataFrame:
    """Volume-weighted feed quality per site."""
    volume = F.col("volume_barrels")
    return shipments.groupBy("refinery_id").agg(
        rules.safe_ratio(F.sum(volume * F.col("api_gravity_actual")), F.sum(volume)).alias("api_gravity"),
        rules.safe_ratio(F.sum(volume * F.col("sulfur_content_actual")), F.sum(volume)).alias("sulfur_content"),
        F.sum(volume).alias("volume_barrels"))


# --- equipment ------------------------------------------------------------

def health_leaderboard(health: DataFrame, n: int | None = None) -> DataFrame:
    """Units ranked by health; ``n`` keeps the units ranked that high."""
    return with_rank(health.select("unit_id", "unit_name", "health_score"), "health_score", "health_rank", top=n)


def maintenance_calendar(units: DataFrame, as_of: Column) -> DataFrame:
    """Next due date of each unit and where it stands."""
    return units.select(
        "unit_id", "unit_name",
        F.date_add("last_maintenance_date", F.col("maintenance_interval_days")).alias("due_date"),
        rules.maintenance_status("last_maintenance_date", "maintenance_interval_days", as_of)
        .alias("maintenance_status"))


def rolling_anomaly(readings: DataFrame, days: int = 7) -> DataFrame:
    """Anomaly rate per unit over each day and the days before it. Readings are
    reduced to one row per unit and day first, so the window stays short."""
    daily = (readings.groupBy("unit_id", F.to_date("reading_timestamp").alias("reading_date"))
             .agg(count_where(F.col("alert_status") != rules.NORMAL).alias("__bad"), F.count("*").alias("__n")))
    span = (Window.partitionBy("unit_id").orderBy(F.unix_date("reading_date"))
            .rangeBetween(-(days - 1), Window.currentRow))
    return daily.select("unit_id", "reading_date",
                        rules.safe_ratio(F.sum("__bad").over(span), F.sum("__n").over(span))
                        .alias("rolling_anomaly_rate"))


def sensor_reliability(readings: DataFrame, quality: str = "reading_quality") -> DataFrame:
    """Share of good readings per sensor."""
    return readings.groupBy("sensor_id").agg(
        F.avg(F.when(F.col(quality) == rules.GOOD, 1.0).otherwise(0.0)).alias("good_share"),
        F.count("*").alias("reading_count"))


def risk_matrix(health: DataFrame, score_step: int = 20, day_step: int = 60) -> DataFrame:
    """Unit counts by health band and band of days since maintenance."""
    return (health.groupBy((F.floor(F.col("health_score") / score_step) * score_step).alias("score_from"),
                           (F.floor(F.col("days_since_maintenance") / day_step) * day_step).alias("days_from"))
            .agg(F.count("*").alias("unit_count")))


def unit_convert(readings: DataFrame, factors: DataFrame) -> DataFrame:
    """Readings in a common unit: value * scale + shift from a factor table; units
    without a factor are kept as they are."""
    joined = enrich_left(readings, factors, {"measurement_unit": "from_unit"}, ["to_unit", "scale", "shift"])
    value = F.col("reading_value") * F.coalesce("scale", F.lit(1.0)) + F.coalesce("shift", F.lit(0.0))
    return joined.select(
        *[c for c in readings.columns if c not in ("measurement_unit", "reading_value")],
        F.coalesce("to_unit", "measurement_unit").alias("measurement_unit"), value.alias("reading_value"))
