"""Streams give the batch result; late and repeated rows; restarts."""

from conftest import rows
from pyspark.sql import functions as F

from plantlake.functions.columns import inline_rows
from plantlake.operators.enrich import union_feeds
from plantlake.operators.latest import flat_window, latest_per_key
from plantlake.plans import gold, silver
from plantlake.queries import bindings as B
from plantlake.sources.files import parquet_stream
from plantlake.sources.snapshots import Snapshots
from plantlake.streaming.ingest import append_stream, run_to_end
from plantlake.streaming.live import dedup_stream, latest_stream, replace_each_batch, stream_alerts


def drained(df, tmp_path, name="out"):
    run_to_end(append_stream(df, str(tmp_path / name), str(tmp_path / f"{name}-cp")))
    return df.sparkSession.read.parquet(str(tmp_path / name))


def same(a, b) -> bool:
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_silver_streams_equal_batch(spark, tables, tmp_path):
    def feed(name):
        return parquet_stream(spark, tables.path(name))

    sensors, sites, crudes = B.sensors(spark), B.sites(tables.nation), B.crudes(tables.region)
    units, products = B.units(tables.supplier), B.products(tables.part)
    pairs = [
        (lambda e: silver.silver_readings([B.readings(e)] * 2, sensors, stamp=False, salt=4, salt_by=["reading_id"]), "events"),
        (lambda o: silver.silver_shipments(B.shipments(o), sites, crudes, stamp=False, salt=4, salt_by=["shipment_id"]), "orders"),
        (lambda li: silver.silver_production(B.production(li), units, sites, products, crudes, stamp=False), "lineitem"),
        (lambda e: silver.silver_tank_inventory(B.tank_inventory(e), stamp=False), "events")]
    for n, (build, table) in enumerate(pairs):
        batch = build(getattr(tables, table))
        assert same(drained(build(feed(table)), tmp_path, f"s{n}"), batch)


def test_salted_stream_lookup_without_broadcast(spark, tables, tmp_path):
    dims = B.products(tables.part)
    build = lambda li: silver.star_enrich(
        B.production(li), [(dims, {"output_product_id": "product_id"}, ["product_name"])], salt=4, salt_by=["production_hour", "input_volume_barrels"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert same(drained(build(parquet_stream(spark, tables.path("lineitem"))), tmp_path), build(tables.lineitem))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_restart_adds_nothing(spark, tables, tmp_path):
    build = lambda: B.readings(parquet_stream(spark, tables.path("events")))
    assert drained(build(), tmp_path).count() == 1000
    assert drained(build(), tmp_path).count() == 1000


def test_alerts_are_the_closed_batch_windows(spark, tables, tmp_path):
    def rows_of(events):
        return silver.silver_readings([B.readings(events)], B.sensors(spark), stamp=False)

    got = flat_window(drained(stream_alerts(rows_of(parquet_stream(spark, tables.path("events")))), tmp_path))
    batch = flat_window(gold.anomaly_alerts(rows_of(tables.events)))
    edge = rows_of(tables.events).agg(F.max("reading_timestamp") - F.expr("INTERVAL 10 MINUTES")).collect()[0][0]
    key = ["window_start", "unit_id", "sensor_type", "critical_count"]
    closed = batch.where(F.col("window_end") <= F.lit(edge))
    assert rows(got.select(F.col("window_start").cast("timestamp_ntz"), *key[1:]), *key) == rows(closed.select(*key), *key)


def test_warning_rule_and_one_row_groups(spark):
    base = [(1, 1, "t", "2024-01-01 00:00:01", 1.0, "WARNING")]
    names = ["refinery_id", "unit_id", "sensor_type", "s", "reading_value", "alert_status"]
    data = base * 5 + [(1, 2, *base[0][2:])] * 6 + [(1, 3, "t", "2024-01-01 00:00:01", 9.0, "CRITICAL")]
    df = inline_rows(spark, names, data).withColumn("reading_timestamp", F.col("s").cast("timestamp_ntz"))
    out = {r.unit_id: r for r in gold.anomaly_alerts(df).collect()}
    assert set(out) == {2, 3}  # five warnings are not enough
    assert out[2].alert_severity_score == 3.0 and out[3].stddev_value is None


def batches(spark, tmp_path, parts):
    """Write each part as one file; read them back one file per micro-batch."""
    src = str(tmp_path / "src")
    for part in parts:
        (inline_rows(spark, ["id", "k", "s"], part).select("id", "k", F.col("s").cast("timestamp_ntz").alias("ts"))
         .coalesce(1).write.mode("append").parquet(src))
    return parquet_stream(spark, src, maxFilesPerTrigger=1)


def test_dedup_within_and_across_batches(spark, tmp_path):
    parts = [[(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:01:00")],
             [(2, "a", "2024-01-01 00:01:00"), (3, "b", "2024-01-01 00:02:00")], [(1, "x", "2024-01-01 00:01:00")]]
    for spread in (1, 4):
        folder = tmp_path / str(spread)
        folder.mkdir()
        out = drained(dedup_stream(batches(spark, folder, parts), ["id"], "ts", spread=spread), folder)
        assert out.columns == ["id", "k", "ts"] and [r.id for r in out.orderBy("id").collect()] == [1, 2, 3]


def test_dedup_deals_a_hot_id_over_tasks(spark, tmp_path):
    """A third of the feed has one id. No task of the first step gets more than a part of it, the second one gets few rows."""
    src = str(tmp_path / "src")
    spark.range(0, 6000, 1, 12).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("i"), F.lit("x").alias("v"),
                                       F.lit("2024-01-01").cast("timestamp").alias("ts")).write.parquet(src)
    stream = dedup_stream(parquet_stream(spark, src), ["i"], "ts", spread=8)
    query = run_to_end(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert tuple(spark.read.parquet(str(tmp_path / "out")).agg(F.count("*"), F.countDistinct("i")).first()) == (4001, 4001)
    first, second = [p for p in query.recentProgress if p.numInputRows][0].stateOperators[::-1]  # last operator first
    assert first.numRowsUpdated - second.numRowsUpdated in range(1, 8)
    salted = spark.read.parquet(src).groupBy("i", F.pmod(F.xxhash64("i", "v", "ts", F.spark_partition_id()), F.lit(8))).count()
    assert salted.agg(F.max("count")).first()[0] <= 1000


def test_late_row_is_dropped_by_the_watermark(spark, tmp_path):
    parts = [[(1, "a", "2024-01-01 01:00:00")], [(2, "a", "2024-01-01 02:00:00")], [(3, "a", "2024-01-01 00:00:00")],
             [(4, "a", "2024-01-01 02:01:00")]]
    out = drained(dedup_stream(batches(spark, tmp_path, parts), ["id"], "ts"), tmp_path)
    assert [r.id for r in out.orderBy("id").collect()] == [1, 2, 4]


def test_latest_stream_equals_batch(spark, tmp_path):
    parts = [[(1, "a", "2024-01-01 00:00:00"), (5, "b", "2024-01-01 00:05:00")],
             [(3, "a", "2024-01-01 00:01:00"), (2, "a", "2024-01-01 00:01:00"), (4, "b", "2024-01-01 00:00:00")]]
    stream = batches(spark, tmp_path, parts)
    run_to_end(replace_each_batch(latest_stream(stream, ["k"], "ts", ["id"]), str(tmp_path / "o"), str(tmp_path / "cp")))
    batch = latest_per_key(spark.read.parquet(str(tmp_path / "src")), ["k"], "ts", ["id"])
    assert same(Snapshots(spark, str(tmp_path / "o")).read(), batch)
    assert [r.id for r in batch.orderBy("k").collect()] == [3, 5]


def test_union_of_streams_keeps_both(spark, tables, tmp_path):
    one = parquet_stream(spark, tables.path("events")).select("event_id")
    assert drained(union_feeds(one, one), tmp_path).count() == 2000
