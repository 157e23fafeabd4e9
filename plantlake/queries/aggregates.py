"""Aggregations, latest row and time buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.functions import rules as R
from plantlake.functions.columns import settle
from plantlake.operators import metrics as M
from plantlake.operators.latest import flat_window, latest_per_key, tumbling
from plantlake.operators.project import trailing
from plantlake.plans.silver import silver_readings
from plantlake.queries import bindings as B
from plantlake.queries.base import Tables, query, settled, with_bound


def silver(t: Tables):
    return silver_readings([B.readings(t.events)], B.sensors(t.spark), stamp=False)


def silver_sql(body: str, **extra: str) -> str:
    return with_bound(body, "readings", "sensors", "silver", **extra)


def has_status(label: str):
    return F.col("alert_status") == label


def status_counters():
    return {"critical_count": has_status(R.CRITICAL), "warning_count": has_status(R.WARNING)}


@query("group_stats", f"""
    SELECT l_suppkey, l_returnflag, count(*) AS row_count, {settled("avg(l_quantity)")} AS avg_value,
           {settled("stddev_samp(l_quantity)")} AS stddev_value, min(l_quantity) AS min_value,
           max(l_quantity) AS max_value
    FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def group_stats(t: Tables):
    out = M.group_stats(t.lineitem, ["l_suppkey", "l_returnflag"], "l_quantity")
    return out.withColumns({c: settle(c) for c in ("avg_value", "stddev_value")})


@query("conditional_counts", silver_sql("""
    SELECT unit_id, count(*) FILTER (alert_status = 'CRITICAL') AS critical_count,
           count(*) FILTER (alert_status = 'WARNING') AS warning_count FROM silver GROUP BY unit_id"""))
def conditional_counts(t: Tables):
    return M.conditional_counts(silver(t), ["unit_id"], status_counters())


@query("severity_score", silver_sql(f"""
    SELECT unit_id, sensor_type, {settled('''sum(CASE alert_status WHEN 'CRITICAL' THEN 10 WHEN 'WARNING' THEN 3
           ELSE 0 END) / count(*)''')} AS severity_score FROM silver GROUP BY unit_id, sensor_type"""))
def severity_score(t: Tables):
    out = M.severity(silver(t), ["unit_id", "sensor_type"], [(has_status(R.CRITICAL), 10.0), (has_status(R.WARNING), 3.0)])
    return out.withColumn("severity_score", settle("severity_score"))


@query("having_alerts", silver_sql("""
    SELECT unit_id, count(*) FILTER (alert_status = 'CRITICAL') AS critical_count,
           count(*) FILTER (alert_status = 'WARNING') AS warning_count FROM silver GROUP BY unit_id
    HAVING critical_count > 2 OR warning_count > 8"""))
def having_alerts(t: Tables):
    counts = M.conditional_counts(silver(t), ["unit_id"], status_counters())
    return M.having(counts, (F.col("critical_count") > 2) | (F.col("warning_count") > 8))


@query("ratio_of_sums", with_bound(f"""
    SELECT refinery_id,
           {settled("sum(output_volume_barrels) / nullif(sum(input_volume_barrels), 0)", 6)} AS overall_yield,
           {settled("sum(energy_consumed_mmbtu) / nullif(sum(output_volume_barrels), 0)")} AS energy_intensity
    FROM production GROUP BY refinery_id""", "production"))
def ratio_of_sums(t: Tables):
    return B.production(t.lineitem).groupBy("refinery_id").agg(
        settle(M.ratio_of_sums("output_volume_barrels", "input_volume_barrels"), 6).alias("overall_yield"),
        settle(M.ratio_of_sums("energy_consumed_mmbtu", "output_volume_barrels")).alias("energy_intensity"))


@query("count_distinct", f"""
    SELECT l_shipdate, count(DISTINCT l_suppkey) AS unit_count,
           {settled("sum(l_linenumber) / (count(DISTINCT l_suppkey) * 60)", 6)} AS downtime_share
    FROM lineitem GROUP BY l_shipdate""")
def count_distinct(t: Tables):
    units = M.distinct_count("l_suppkey")
    return t.lineitem.groupBy("l_shipdate").agg(
        units.alias("unit_count"),
        settle(R.safe_ratio(F.sum("l_linenumber"), units * 60), 6).alias("downtime_share"))


@query("daily_group", f"""
    SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS row_count,
           {settled("sum(value)")} AS total_value FROM events GROUP BY ALL""")
def daily_group(t: Tables):
    return M.by_day(t.events, "ts", ["event_type"],
                    [F.count("*").alias("row_count"), settle(F.sum("value")).alias("total_value")])


@query("two_level_agg", f"""
    WITH s AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, avg(value) AS a, stddev_samp(value) AS v
               FROM events GROUP BY ALL)
    SELECT user_id, {settled("avg(a)")} AS mean_of_means, {settled("avg(v)")} AS mean_volatility,
           count(*) AS group_count FROM s GROUP BY user_id""")
def two_level_agg(t: Tables):
    return M.two_level(t.events, ["user_id", "event_type", F.to_date("ts").alias("d")],
                       [F.avg("value").alias("a"), F.stddev_samp("value").alias("v")], ["user_id"],
                       [settle(F.avg("a")).alias("mean_of_means"), settle(F.avg("v")).alias("mean_volatility"),
                        F.count("*").alias("group_count")])


@query("agg_vs_attribute", f"""
    SELECT l_partkey, {settled("avg(1 - l_discount) - any_value(p_size / 1000 + 0.9::DOUBLE)", 6)} AS yield_vs_typical
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey""")
def agg_vs_attribute(t: Tables):
    yields = t.lineitem.select("l_partkey", (1 - F.col("l_discount")).alias("y"))
    typical = t.part.select("p_partkey", (F.col("p_size") / 1000 + 0.9).alias("typical"))
    out = M.agg_minus_attr(yields, ["l_partkey"], "y", "typical", "yield_vs_typical", typical,
                           {"l_partkey": "p_partkey"})
    return out.withColumn("yield_vs_typical", settle("yield_vs_typical", 6))


@query("trailing_filter", f"""
    SELECT event_type, count(*) AS row_count, min(ts) AS first_ts FROM events
    WHERE ts >= DATE '{B.AS_OF_READINGS}' - 7 GROUP BY event_type""")
def trailing_filter(t: Tables):
    return trailing(t.events, "ts", 7, B.as_of(B.AS_OF_READINGS)).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.min("ts").alias("first_ts"))


@query("anomaly_rate", silver_sql(f"""
    SELECT unit_id, sensor_type, {settled("count(*) FILTER (alert_status <> 'NORMAL') / count(*)", 6)} AS rate
    FROM silver GROUP BY unit_id, sensor_type"""))
def anomaly_rate(t: Tables):
    return silver(t).groupBy("unit_id", "sensor_type").agg(settle(R.anomaly_rate("alert_status"), 6).alias("rate"))


@query("latest_per_key", """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest(t: Tables):
    return latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


@query("tumbling_5m", f"""
    SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end, event_type,
           count(*) AS row_count, {settled("avg(value)")} AS avg_value
    FROM events GROUP BY ALL""")
def tumbling_5m(t: Tables):
    grouped = t.events.groupBy(tumbling("ts").alias("time_window"), "event_type").agg(
        F.count("*").alias("row_count"), settle(F.avg("value")).alias("avg_value"))
    return flat_window(grouped)
