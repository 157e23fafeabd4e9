"""Streaming operators, run to the end of the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.operators.enrich import enrich_left, union_feeds
from plantlake.plans.datasets import Lake
from plantlake.plans.silver import silver_production, silver_readings
from plantlake.queries import bindings as B
from plantlake.queries.aggregates import silver_sql
from plantlake.queries.base import REGISTRY, Tables, query, with_bound
from plantlake.queries.datasets import ALERTS, shown_alerts
from plantlake.queries.sources import landed
from plantlake.session import fresh_dir
from plantlake.sources.files import parquet_stream
from plantlake.sources.snapshots import Snapshots
from plantlake.streaming.ingest import append_stream, ingest_table, run_to_end
from plantlake.streaming.live import dedup_stream, latest_stream, replace_each_batch, stream_alerts
from plantlake.streaming.merge import upsert_latest


def reading_stream(t: Tables):
    return B.readings(parquet_stream(t.spark, t.path("events")))


def as_live(readings):
    """The same readings as a second feed, with ids of their own."""
    return readings.withColumn("reading_id", -1 - F.col("reading_id"))


@query("stream_dim_left", with_bound("""
    SELECT r.reading_id, r.sensor_id, r.reading_value, s.measurement_unit, s.warning_high
    FROM readings r LEFT JOIN sensors s ON s.sensor_id = r.sensor_id AND s.is_active""", "readings", "sensors"))
def stream_dim_left(t: Tables):
    rows = reading_stream(t).select("reading_id", "sensor_id", "reading_value")
    joined = enrich_left(rows, B.sensors(t.spark).where("is_active"), "sensor_id",
                         ["measurement_unit", "warning_high"])
    return landed(t, joined, "stream-dim")


@query("stream_silver", silver_sql("""
    SELECT * FROM silver UNION ALL SELECT * REPLACE (-1 - reading_id AS reading_id) FROM silver"""))
def stream_silver(t: Tables):
    feeds = [reading_stream(t), as_live(reading_stream(t))]
    return landed(t, silver_readings(feeds, B.sensors(t.spark), stamp=False), "stream-silver")


@query("stream_dim_changes", silver_sql("""
    SELECT * FROM silver UNION ALL SELECT * REPLACE (-1 - reading_id AS reading_id) FROM silver"""))
def dim_changes(t: Tables):
    """Readings of two feeds that come before their sensors are known wait for them."""
    lake = Lake(t.spark, fresh_dir(t.spark, "lake-dims"))
    sensors = B.sensors(t.spark)
    half = F.pmod(F.xxhash64("reading_id"), F.lit(2))
    for part, known in ((0, F.col("sensor_id") < "d"), (1, F.col("sensor_id") >= "d")):
        sensors.where(known).write.mode("append").parquet(lake.path("bronze_dim_sensors"))
        rows = B.readings(t.events).where(half == part)
        rows.write.mode("append").parquet(lake.path("bronze_fact_sensor_readings"))
        as_live(rows).write.mode("append").parquet(lake.path("bronze_fact_sensor_readings_stream"))
        lake.update_when_known()
    return lake.table("silver_sensor_readings").drop("partition_date", "silver_processed_at")


@query("stream_star", REGISTRY["silver_production"].sql)
def stream_star(t: Tables):
    rows = B.production(parquet_stream(t.spark, t.path("lineitem")))
    return landed(t, silver_production(rows, B.units(t.supplier), B.sites(t.nation), B.products(t.part),
                                       B.crudes(t.region), stamp=False), "stream-star")


@query("stream_union", with_bound("""
    SELECT reading_id, reading_value FROM readings UNION ALL SELECT -1 - reading_id, reading_value FROM readings""",
    "readings"))
def stream_union(t: Tables):
    rows = reading_stream(t).select("reading_id", "reading_value")
    return landed(t, union_feeds(rows, as_live(rows)), "stream-union")


# A window is final once the watermark, ten minutes behind the newest reading, has passed its end.
@query("stream_alerts", silver_sql(f"""
    SELECT * FROM ({ALERTS}) WHERE window_end <= (SELECT max(reading_timestamp) FROM silver) - INTERVAL 10 MINUTES"""))
def alerts(t: Tables):
    rows = silver_readings([reading_stream(t)], B.sensors(t.spark), stamp=False)
    return shown_alerts(landed(t, stream_alerts(rows), "stream-alerts"))


@query("stream_alerts_stored", REGISTRY["stream_alerts"].sql)
def stored_alerts(t: Tables):
    """Alerts over the silver table as it is stored, by day."""
    stored = fresh_dir(t.spark, "stored-silver")
    rows = silver_readings([reading_stream(t)], B.sensors(t.spark), stamp=False)
    by_day = rows.withColumn("partition_date", F.to_date("reading_timestamp"))
    run_to_end(append_stream(by_day, stored, f"{stored}-checkpoint", ["partition_date"], 1))
    return shown_alerts(landed(t, stream_alerts(parquet_stream(t.spark, stored)), "stored-alerts"))


@query("stream_restart", "SELECT * FROM events")
def restarted(t: Tables):
    """Two runs on one checkpoint, the second after more rows have arrived."""
    src, dst = fresh_dir(t.spark, "restart-landing"), fresh_dir(t.spark, "restart")
    for rest in (0, 1):
        t.events.where(F.pmod("event_id", F.lit(2)) == rest).write.mode("append").parquet(src)
        out = ingest_table(t.spark, src, dst, f"{dst}-checkpoint")
    return out


@query("stream_latest", REGISTRY["latest_per_key"].sql)
def latest(t: Tables):
    dst = fresh_dir(t.spark, "stream-latest")
    rows = parquet_stream(t.spark, t.path("events"))
    run_to_end(upsert_latest(rows, dst, f"{dst}-checkpoint", ["user_id"], "ts", ["event_id"], buckets=8))
    return Snapshots(t.spark, dst).read()


@query("stream_latest_complete", REGISTRY["latest_per_key"].sql)
def latest_complete(t: Tables):
    """All keys again after every batch, for few keys."""
    dst = fresh_dir(t.spark, "stream-latest")
    rows = parquet_stream(t.spark, t.path("events"))
    run_to_end(replace_each_batch(latest_stream(rows, ["user_id"], "ts", ["event_id"]), dst, f"{dst}-checkpoint"))
    return Snapshots(t.spark, dst).read()


@query("stream_dedup", with_bound(
    "SELECT reading_id, sensor_id, reading_timestamp, reading_value FROM readings", "readings"))
def dedup(t: Tables):
    rows = reading_stream(t).select("reading_id", "sensor_id", "reading_timestamp", "reading_value")
    return landed(t, dedup_stream(union_feeds(rows, rows), ["reading_id"], "reading_timestamp", spread=4), "stream-dedup")
