"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.functions.columns import inline_rows, settle
from plantlake.functions.rules import days_delayed
from plantlake.plans import dashboard as D, silver as S
from plantlake.queries import bindings as B
from plantlake.queries.aggregates import silver, silver_sql
from plantlake.queries.base import Tables, query, settled, with_bound
from plantlake.queries.datasets import KPIS, LATEST_TANKS, SILVER_TANKS, health, health_sql, kpis


def rounded(df, digits: int = 4, *names: str):
    return df.withColumns({n: settle(n, digits) for n in names})


@query("site_health", health_sql(f"""
    SELECT n.refinery_id, {settled("avg(n.health_score)")} AS mean_health, count(*) AS unit_count,
           r.refinery_name, r.latitude, r.longitude
    FROM newest n JOIN sites r ON r.refinery_id = n.refinery_id GROUP BY ALL""",
    newest="""SELECT * FROM health QUALIFY row_number() OVER (PARTITION BY unit_id
              ORDER BY reading_date DESC NULLS LAST) = 1"""))
def site_health(t: Tables):
    return rounded(D.site_health(health(t), B.sites(t.nation)), 4, "mean_health")


@query("alert_feed", silver_sql("""
    SELECT reading_id, unit_id, sensor_type, reading_timestamp, reading_value, alert_status FROM silver
    WHERE alert_status <> 'NORMAL' ORDER BY reading_timestamp DESC, reading_id DESC LIMIT 100"""))
def alert_feed(t: Tables):
    return D.alert_feed(silver(t), 100).select(
        "reading_id", "unit_id", "sensor_type", "reading_timestamp", "reading_value", "alert_status")


@query("anomaly_heatmap", silver_sql("SELECT unit_id, " + ", ".join(
    settled(f"count(*) FILTER (alert_status <> 'NORMAL' AND sensor_type = '{s}') / "
            f"nullif(count(*) FILTER (sensor_type = '{s}'), 0)", 6) + f" AS {s}" for s in B.SENSOR_TYPES)
    + " FROM silver GROUP BY unit_id"))
def anomaly_heatmap(t: Tables):
    return rounded(D.anomaly_heatmap(silver(t), B.SENSOR_TYPES), 6, *B.SENSOR_TYPES)


@query("trend_24h", silver_sql(f"""
    SELECT sensor_type, date_trunc('hour', reading_timestamp) AS hour, {settled("avg(reading_value)")} AS avg_value,
           count(*) AS row_count FROM silver
    WHERE reading_timestamp > TIMESTAMP '{B.AS_OF_READINGS} 23:00:00' - INTERVAL 24 HOURS
      AND reading_timestamp <= TIMESTAMP '{B.AS_OF_READINGS} 23:00:00' GROUP BY ALL"""))
def trend_24h(t: Tables):
    as_of = F.lit(f"{B.AS_OF_READINGS} 23:00:00").cast("timestamp_ntz")
    return rounded(D.trend_24h(silver(t), as_of), 4, "avg_value")


@query("kpi_cards", silver_sql(f"""
    SELECT (SELECT count(*) FROM silver WHERE alert_status <> 'NORMAL') AS total_alerts,
           {settled('''sum(input_volume_barrels) / ((SELECT sum(capacity_bpd) FROM sites)
                       * count(DISTINCT CAST(production_hour AS DATE)))''', 6)} AS capacity_utilization,
           (SELECT count(*) FROM units WHERE is_active) AS active_units
    FROM production""", **{n: B.SQL[n] for n in ("sites", "units", "production")}))
def kpi_cards(t: Tables):
    out = D.kpi_cards(silver(t), B.production(t.lineitem), B.sites(t.nation), B.units(t.supplier))
    return rounded(out, 6, "capacity_utilization")


@query("yield_by_crude", with_bound(f"""
    SELECT p.input_crude_type_id, {settled("avg(p.yield_percentage)", 6)} AS avg_yield, count(*) AS sample_count,
           c.crude_name
    FROM production p JOIN crudes c ON c.crude_type_id = p.input_crude_type_id GROUP BY ALL""",
    "production", "crudes"))
def yield_by_crude(t: Tables):
    return rounded(D.yield_by_crude(B.production(t.lineitem), B.crudes(t.region)), 6, "avg_yield")


@query("energy_trend", with_bound(f"""
    SELECT CAST(CAST(production_hour AS DATE) AS VARCHAR) AS production_date,
           {settled("sum(energy_consumed_mmbtu) / nullif(sum(output_volume_barrels), 0)")} AS energy_per_barrel
    FROM production GROUP BY ALL""", "production"))
def energy_trend(t: Tables):
    return rounded(D.energy_trend(B.production(t.lineitem)), 4, "energy_per_barrel")


@query("capacity_trend", with_bound(f"""
    SELECT refinery_id, refinery_name, CAST(CAST(date_trunc('month', production_date) AS DATE) AS VARCHAR) AS month,
           {settled("avg(capacity_utilization)", 6)} AS capacity_utilization, count(*) AS day_count
    FROM kpis GROUP BY ALL""", "production", "sites", kpis=KPIS))
def capacity_trend(t: Tables):
    return rounded(D.capacity_trend(kpis(t)), 6, "capacity_utilization")


@query("product_mix", with_bound(f"""
    SELECT d.product_category, {settled("sum(p.output_volume_barrels)", 2)} AS output_volume_barrels,
           {settled("sum(p.output_volume_barrels) / sum(sum(p.output_volume_barrels)) OVER ()", 6)} AS share
    FROM production p JOIN products d ON d.product_id = p.output_product_id
    GROUP BY d.product_category""", "production", "products"))
def product_mix(t: Tables):
    out = D.product_mix(B.production(t.lineitem), B.products(t.part))
    return rounded(rounded(out, 6, "share"), 2, "output_volume_barrels")


@query("downtime_pareto", with_bound(f"""
    SELECT unit_id, CAST(m AS BIGINT) AS downtime_minutes, CAST(run AS BIGINT) AS running_minutes,
           {settled("run / (SELECT sum(m) FROM totals)", 6)} AS cumulative_share
    FROM (SELECT *, sum(m) OVER (ORDER BY m DESC, unit_id ROWS UNBOUNDED PRECEDING) AS run FROM totals)""",
    "production", totals="SELECT unit_id, sum(downtime_minutes) AS m FROM production GROUP BY 1"))
def downtime_pareto(t: Tables):
    return rounded(D.downtime_pareto(B.production(t.lineitem)), 6, "cumulative_share")


@query("quality_vs_yield", with_bound(f"""
    SELECT quality_grade, {settled("avg(yield_percentage)", 6)} AS avg_yield,
           {settled("corr(yield_percentage, energy_consumed_mmbtu)", 6)} AS yield_energy_corr,
           count(*) AS sample_count FROM production GROUP BY 1""", "production"))
def quality_vs_yield(t: Tables):
    return rounded(D.quality_vs_yield(B.production(t.lineitem)), 6, "avg_yield", "yield_energy_corr")


@query("tank_levels", with_bound(f"""
    SELECT n.tank_id, k.tank_name, n.fill_percentage, {B.OPERATING} AS operating_status, n.inventory_status
    FROM newest n LEFT JOIN tanks k ON k.tank_id = n.tank_id""", "tank_inventory", "tanks",
    clean=SILVER_TANKS, newest=LATEST_TANKS))
def tank_levels(t: Tables):
    clean = S.silver_tank_inventory(B.tank_inventory(t.events), stamp=False)
    return D.tank_levels(clean, B.tanks(t.events), ["inventory_id"])


def shipped(t: Tables):
    return S.silver_shipments(B.shipments(t.orders), B.sites(t.nation), B.crudes(t.region), stamp=False)


@query("quality_variance", with_bound("""
    SELECT s.shipment_id, c.crude_name, s.api_gravity_actual, c.api_gravity_typical,
           s.api_gravity_actual - c.api_gravity_typical AS api_gravity_variance,
           s.sulfur_content_actual - c.sulfur_content_typical AS sulfur_variance
    FROM shipments s LEFT JOIN crudes c ON c.crude_type_id = s.crude_type_id""", "shipments", "crudes"))
def quality_variance(t: Tables):
    return D.quality_variance(shipped(t))


@query("in_transit", with_bound("""
    SELECT origin_port, count(*) AS shipment_count, CAST(sum(volume_barrels) AS BIGINT) AS volume_barrels
    FROM shipments WHERE status = 'IN_TRANSIT' GROUP BY 1""", "shipments"))
def in_transit(t: Tables):
    return D.in_transit(B.shipments(t.orders))


SUPPLY_DAY = "2001-06-01"


@query("days_of_supply", with_bound(f"""
    SELECT product_category, {settled("stock", 2)} AS stock_volume, {settled("draw")} AS daily_draw,
           {settled("stock / nullif(draw, 0)")} AS days_of_supply
    FROM (SELECT product_category, sum(volume) AS stock FROM made GROUP BY 1)
    LEFT JOIN (SELECT product_category, sum(volume) / 30 AS draw FROM made
               WHERE production_hour >= DATE '{SUPPLY_DAY}' - 30 GROUP BY 1) USING (product_category)""",
    "production", "products",
    made="""SELECT d.product_category, p.output_volume_barrels AS volume, p.production_hour
            FROM production p JOIN products d ON d.product_id = p.output_product_id"""))
def days_of_supply(t: Tables):
    made = B.production(t.lineitem)
    out = D.days_of_supply(made, made, B.products(t.part), "output_volume_barrels", "production_hour",
                           B.as_of(SUPPLY_DAY))
    return rounded(rounded(out, 4, "daily_draw", "days_of_supply"), 2, "stock_volume")


@query("on_time_rate", with_bound(f"""
    SELECT CAST(CAST(date_trunc('month', arrival_date) AS DATE) AS VARCHAR) AS month,
           {settled("count(*) FILTER (arrival_date <= expected_arrival_date) / count(*)", 6)} AS on_time_rate,
           count(*) AS shipment_count FROM shipments GROUP BY 1""", "shipments"))
def on_time_rate(t: Tables):
    late = days_delayed("arrival_date", "expected_arrival_date")
    return rounded(D.on_time_rate(B.shipments(t.orders).withColumn("days_delayed", late)), 6, "on_time_rate")


@query("stock_trend", with_bound(f"""
    SELECT tank_id, {settled('''regr_slope(fill_percentage,
           (epoch(measurement_timestamp) - epoch(TIMESTAMP '2024-01-01')) / 86400)''', 6)} AS level_change_per_day,
           count(*) AS snapshot_count
    FROM (SELECT * REPLACE (date_trunc('second', measurement_timestamp) AS measurement_timestamp)
          FROM tank_inventory) GROUP BY tank_id""", "tank_inventory"))
def stock_trend(t: Tables):
    return rounded(D.stock_trend(B.tank_inventory(t.events)), 6, "level_change_per_day")


@query("blend_average", with_bound(f"""
    SELECT refinery_id, {settled("sum(volume_barrels * api_gravity_actual) / sum(volume_barrels)", 6)} AS api_gravity,
           {settled("sum(volume_barrels * sulfur_content_actual) / sum(volume_barrels)", 6)} AS sulfur_content,
           CAST(sum(volume_barrels) AS BIGINT) AS volume_barrels
    FROM shipments GROUP BY 1""", "shipments"))
def blend_average(t: Tables):
    return rounded(D.blend_average(B.shipments(t.orders)), 6, "api_gravity", "sulfur_content")


@query("health_leaderboard", health_sql("""
    SELECT unit_id, unit_name, score AS health_score, rank() OVER (ORDER BY score DESC) AS health_rank
    FROM (SELECT unit_id, unit_name, {} AS score FROM health GROUP BY 1, 2)""".format(
        settled("avg(health_score)", 2))))
def health_leaderboard(t: Tables):
    means = health(t).groupBy("unit_id", "unit_name").agg(settle(F.avg("health_score"), 2).alias("health_score"))
    return D.health_leaderboard(means)


@query("maintenance_calendar", with_bound(f"""
    SELECT unit_id, unit_name, CAST(last_maintenance_date + maintenance_interval_days AS VARCHAR) AS due_date,
           {B.due(f"(DATE '{B.AS_OF_READINGS}' - last_maintenance_date)", "maintenance_interval_days")}
             AS maintenance_status
    FROM maintained_units""", "maintained_units"))
def maintenance_calendar(t: Tables):
    return D.maintenance_calendar(B.maintained_units(t.customer), B.as_of(B.AS_OF_READINGS))


@query("rolling_anomaly_7d", silver_sql(f"""
    SELECT unit_id, CAST(d AS VARCHAR) AS reading_date,
           {settled('''sum(bad) OVER w / sum(n) OVER w''', 6)} AS rolling_anomaly_rate
    FROM daily WINDOW w AS (PARTITION BY unit_id ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    daily="""SELECT unit_id, CAST(reading_timestamp AS DATE) AS d, count(*) AS n,
                    count(*) FILTER (alert_status <> 'NORMAL') AS bad FROM silver GROUP BY ALL"""))
def rolling_anomaly_7d(t: Tables):
    return rounded(D.rolling_anomaly(silver(t)), 6, "rolling_anomaly_rate")


@query("sensor_reliability", with_bound(f"""
    SELECT sensor_id, {settled("count(*) FILTER (reading_quality = 'GOOD') / count(*)", 6)} AS good_share,
           count(*) AS reading_count FROM readings GROUP BY 1""", "readings"))
def sensor_reliability(t: Tables):
    return rounded(D.sensor_reliability(B.readings(t.events)), 6, "good_share")


@query("risk_matrix", health_sql("""
    SELECT CAST(floor(score / 20) * 20 AS BIGINT) AS score_from,
           CAST(floor(days_since_maintenance / 60) * 60 AS BIGINT) AS days_from, count(*) AS unit_count
    FROM (SELECT *, {} AS score FROM health) GROUP BY ALL""".format(settled("health_score"))))
def risk_matrix(t: Tables):
    return D.risk_matrix(rounded(health(t), 4, "health_score"))


# Fixed lookup: reported unit, common unit, scale, shift.
FACTORS = [("ms", "s", 0.001, 0.0), ("usd", "kusd", 0.001, 0.0)]


@query("unit_convert", silver_sql("""
    SELECT s.reading_id, s.sensor_type, coalesce(f.to_unit, s.measurement_unit) AS measurement_unit,
           s.reading_value * coalesce(f.scale, 1) + coalesce(f.shift, 0) AS reading_value
    FROM silver s LEFT JOIN factors f ON f.from_unit = s.measurement_unit""",
    factors=f"SELECT * FROM (VALUES {B._values(FACTORS)}) AS v(from_unit, to_unit, scale, shift)"))
def unit_convert(t: Tables):
    factors = inline_rows(t.spark, ["from_unit", "to_unit", "scale", "shift"], FACTORS)
    rows = silver(t).select("reading_id", "sensor_type", "measurement_unit", "reading_value")
    return D.unit_convert(rows, factors)
