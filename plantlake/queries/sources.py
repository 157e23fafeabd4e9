"""Scans, file feeds, records and appends. Feeds are written by Spark from the
given tables into the shared folder, then read back by the source under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plantlake.functions.columns import utc_wall
from plantlake.queries import bindings as B
from plantlake.queries.base import REGISTRY, Tables, query, with_bound
from plantlake.session import fresh_dir
from plantlake.sources.files import RESCUED, csv_by_header, csv_stream, json_stream, parquet_stream
from plantlake.sources.records import decode_json, to_records
from plantlake.sources.tables import append_mapped, read_table, register_all, write_path, write_table
from plantlake.streaming.ingest import append_apart, append_stream, ingest_stream, ingest_table, run_to_end

TIMES = ("reading_timestamp", "event_time", "processing_time")
LANDED = """reading_id bigint, sensor_id string, unit_id bigint, refinery_id bigint, reading_timestamp timestamp_ntz,
    reading_value double, reading_quality string, is_interpolated boolean, event_time timestamp_ntz,
    processing_time timestamp_ntz"""


def landed(t: Tables, df, label: str):
    """Run a stream into a fresh bronze folder and read it."""
    dst = fresh_dir(t.spark, label)
    run_to_end(append_stream(df, dst, f"{dst}-checkpoint"))
    return read_table(t.spark, dst)


@query("scan_table", "SELECT * FROM orders")
def scan_table(t: Tables):
    return read_table(t.spark, t.path("orders"))


@query("bronze_passthrough", "SELECT * FROM lineitem")
def bronze_passthrough(t: Tables):
    dst = fresh_dir(t.spark, "passthrough")
    return ingest_table(t.spark, t.path("lineitem"), dst, f"{dst}-checkpoint")


def bronze(name: str, table: str, binding, sql_name: str, dates: tuple[str, ...] = ()):
    """Incremental ingest of one plant table, through its binding."""
    shown = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
    body = f"SELECT *{f' REPLACE ({shown})' if dates else ''} FROM {sql_name}"

    @query(f"bronze_{name}", with_bound(body, sql_name))
    def ingest(t: Tables):
        dst = fresh_dir(t.spark, f"bronze-{name}")
        source = binding(parquet_stream(t.spark, t.path(table)))
        run_to_end(ingest_stream(source, dst, f"{dst}-checkpoint"))
        return read_table(t.spark, dst)


bronze("crude_types", "region", B.crudes, "crudes")
bronze("processing_units", "supplier", B.units, "units")
bronze("products", "part", B.products, "products")
bronze("refineries", "nation", B.sites, "sites")
bronze("shipments", "orders", B.shipments, "shipments", ("shipment_date", "arrival_date", "expected_arrival_date"))
bronze("production_output", "lineitem", B.production, "production")
bronze("quality_tests", "orders", B.quality_tests, "quality_tests")
bronze("tank_inventory", "events", B.tank_inventory, "tank_inventory")

SENSOR_ROWS = """SELECT p_partkey AS sensor_id, p_partkey % 100 AS unit_id, p_partkey % 25 AS refinery_id, p_name AS sensor_name,
                        p_type AS sensor_type, CASE WHEN p_size % 2 = 0 THEN 'bar' ELSE 'degC' END AS measurement_unit,
                        p_size - 10::DOUBLE AS min_value, p_size + p_retailprice * 2 AS max_value,
                        p_size::DOUBLE AS warning_low, p_size + p_retailprice AS warning_high,
                        p_size * 0.5::DOUBLE AS critical_low, p_size + p_retailprice * 1.5::DOUBLE AS critical_high,
                        p_size * 60 AS reading_interval_seconds, p_brand AS manufacturer, 'M' || p_size AS model,
                        CAST(DATE '2020-01-01' + p_size AS VARCHAR) AS installation_date,
                        CAST(DATE '2023-01-01' + CAST(p_partkey % 300 AS INTEGER) AS VARCHAR) AS calibration_date,
                        p_size <> 7 AS is_active FROM part"""
TANK_ROWS = """SELECT c_custkey AS tank_id, c_nationkey AS refinery_id, c_name AS tank_name, 'kind ' || (c_nationkey % 5) AS tank_type,
                      c_mktsegment AS product_type, CAST(c_custkey % 900 * 1000 + 50000 AS INTEGER) AS capacity_barrels,
                      (c_custkey % 10) / 50 AS min_operating_level, 1 - (c_custkey % 7) / 20 AS max_operating_level,
                      (c_custkey % 90 + 40)::DOUBLE AS diameter_feet, (c_custkey % 30 + 20)::DOUBLE AS height_feet,
                      CASE WHEN c_custkey % 3 = 0 THEN 'alloy' ELSE 'steel' END AS material, c_custkey % 4 = 0 AS has_heating,
                      c_custkey % 5 = 0 AS has_mixer,
                      CAST(DATE '2022-01-01' + CAST(c_custkey % 700 AS INTEGER) AS VARCHAR) AS last_inspection_date,
                      c_acctbal > 0 AS is_active FROM customer"""


def day_after(start: str, days):
    return F.date_add(F.to_date(F.lit(start)), days.cast("int"))


@query("bronze_sensors", SENSOR_ROWS)
def bronze_sensors(t: Tables):
    part = parquet_stream(t.spark, t.path("part"))
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    return landed(t, part.select(
        key.alias("sensor_id"), (key % 100).alias("unit_id"), (key % 25).alias("refinery_id"), F.col("p_name").alias("sensor_name"),
        F.col("p_type").alias("sensor_type"), F.when(size % 2 == 0, "bar").otherwise("degC").alias("measurement_unit"),
        (size - 10).cast("double").alias("min_value"), (size + price * 2).alias("max_value"),
        size.cast("double").alias("warning_low"), (size + price).alias("warning_high"),
        (size * 0.5).alias("critical_low"), (size + price * 1.5).alias("critical_high"),
        (size * 60).alias("reading_interval_seconds"), F.col("p_brand").alias("manufacturer"),
        F.concat(F.lit("M"), size.cast("string")).alias("model"), day_after("2020-01-01", size).alias("installation_date"),
        day_after("2023-01-01", key % 300).alias("calibration_date"), (size != 7).alias("is_active")), "bronze-sensors")


@query("bronze_storage_tanks", TANK_ROWS)
def bronze_storage_tanks(t: Tables):
    customer = parquet_stream(t.spark, t.path("customer"))
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return landed(t, customer.select(
        key.alias("tank_id"), nation.alias("refinery_id"), F.col("c_name").alias("tank_name"),
        F.concat(F.lit("kind "), (nation % 5).cast("string")).alias("tank_type"), F.col("c_mktsegment").alias("product_type"),
        (key % 900 * 1000 + 50000).cast("int").alias("capacity_barrels"), (key % 10 / 50).alias("min_operating_level"),
        (1 - key % 7 / 20).alias("max_operating_level"), (key % 90 + 40).cast("double").alias("diameter_feet"),
        (key % 30 + 20).cast("double").alias("height_feet"), F.when(key % 3 == 0, "alloy").otherwise("steel").alias("material"),
        (key % 4 == 0).alias("has_heating"), (key % 5 == 0).alias("has_mixer"),
        day_after("2022-01-01", key % 700).alias("last_inspection_date"), (F.col("c_acctbal") > 0).alias("is_active")), "bronze-tanks")


@query("bronze_projected", with_bound("""
    SELECT reading_id, sensor_id, unit_id, refinery_id, reading_timestamp, reading_value, reading_quality,
           is_interpolated, event_time, processing_time FROM readings""", "readings"))
def bronze_projected(t: Tables):
    dst = fresh_dir(t.spark, "projected")
    source = B.readings(parquet_stream(t.spark, t.path("events"))).withColumn("extra", F.lit(1))
    names = [c for c in source.columns if c != "extra"]
    run_to_end(ingest_stream(source, dst, f"{dst}-checkpoint", columns=names))
    return read_table(t.spark, dst)


@query("bronze_tenant", "SELECT *, 'tenant_b' AS tenant FROM events")
def bronze_tenant(t: Tables):
    dst = fresh_dir(t.spark, "tenant")
    return ingest_table(t.spark, t.path("events"), dst, f"{dst}-checkpoint", tenant="tenant_b")


FEED = REGISTRY["bronze_projected"].sql


def records(df):
    """Readings as JSON text, as the live feed carries them."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    rows = df.withColumns({c: F.date_format(c, iso) for c in TIMES})
    return rows.select(F.to_json(F.struct("*")).alias("value"))


@query("json_decode", FEED)
def json_decode(t: Tables):
    raw = records(B.readings(t.events))
    out = decode_json(raw, "value", LANDED.replace("timestamp_ntz", "string"))
    return out.withColumns({c: utc_wall(F.to_timestamp(c)) for c in TIMES})


@query("json_decode_lenient", FEED)
def json_decode_lenient(t: Tables):
    quoted = F.regexp_replace("value", r'"reading_value":([0-9.Ee+-]+)', r'"reading_value":"$1"')
    raw = records(B.readings(t.events)).select(quoted.cast("binary").alias("value"))
    out = decode_json(raw, "value", LANDED.replace("timestamp_ntz", "timestamp"), lenient=True)
    return out.withColumns({c: utc_wall(c) for c in TIMES})


@query("bronze_live_readings", FEED)
def bronze_live_readings(t: Tables):
    feed = records(B.readings(parquet_stream(t.spark, t.path("events"))))
    out = landed(t, decode_json(feed, "value", LANDED.replace("timestamp_ntz", "timestamp"), lenient=True), "live")
    return out.withColumns({c: utc_wall(c) for c in TIMES})


@query("csv_ingest", """
    SELECT event_id AS reading_id, event_type AS sensor_id, ts AS reading_timestamp,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0 THEN value END AS reading_value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) = 0 AS was_rescued FROM events""")
def csv_ingest(t: Tables):
    """Rows whose k is 0 carry text in the number field."""
    src = fresh_dir(t.spark, "csv-landing")
    text = F.when(B.k() == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    (t.events.select(F.col("event_id").alias("reading_id"), F.col("event_type").alias("sensor_id"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("reading_timestamp"),
                     text.alias("reading_value"))
     .write.option("header", True).csv(src))
    stream = csv_stream(t.spark, src, "reading_id bigint, sensor_id string, reading_timestamp timestamp_ntz, "
                                      "reading_value double")
    return landed(t, stream, "csv").select("reading_id", "sensor_id", "reading_timestamp", "reading_value",
                                           F.col(RESCUED).isNotNull().alias("was_rescued"))


@query("jsonl_ingest", FEED)
def jsonl_ingest(t: Tables):
    src = fresh_dir(t.spark, "jsonl-landing")
    (B.readings(t.events)
     .write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(src))
    return landed(t, json_stream(t.spark, src, LANDED), "jsonl")


# Records of which some are broken: by k of the event, text that is no JSON, a cut record, and a number field with text.
BROKEN = """CASE k %% 10 WHEN 0 THEN 'broken ' || event_id WHEN 1 THEN '{"reading_id": ' || event_id WHEN 2 THEN '{"reading_id": ' || event_id || ', "reading_value": "n/a"}'
                     ELSE '{"reading_id": ' || event_id || ', "reading_value": ' || user_id || '.5}' END""".replace("%%", "%")
RESCUE_SQL = f"""
    WITH numbered AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
    records AS (SELECT event_id, user_id, k % 10 < 3 AS bad, {BROKEN} AS value FROM numbered)
    SELECT CASE WHEN NOT bad THEN event_id END AS reading_id, CASE WHEN NOT bad THEN user_id + 0.5::DOUBLE END AS reading_value,
           CASE WHEN bad THEN value END AS raw FROM records"""


def broken_records(events):
    kinds = F.expr(BROKEN)
    return events.withColumn("k", B.k()).select(kinds.alias("value"))


@query("json_rescue", RESCUE_SQL)
def json_rescue(t: Tables):
    out = decode_json(broken_records(t.events), "value", "reading_id bigint, reading_value double", rescued="raw")
    return out.select("reading_id", "reading_value", "raw")


@query("json_rescue_lenient", RESCUE_SQL.replace("CASE WHEN NOT bad THEN event_id END", "CASE WHEN NOT bad OR k = 2 THEN event_id END").replace(
    "k % 10 < 3 AS bad", "k % 10 AS k, k % 10 < 3 AS bad"))
def json_rescue_lenient(t: Tables):
    """The field that fits is kept beside the raw text."""
    return decode_json(broken_records(t.events), "value", "reading_id bigint, reading_value double", lenient=True, rescued="raw")


@query("jsonl_quarantine", RESCUE_SQL)
def jsonl_quarantine(t: Tables):
    """Lines set apart by two streams; together they are all lines."""
    src, dst = fresh_dir(t.spark, "broken-landing"), fresh_dir(t.spark, "jsonl-apart")
    broken_records(t.events).write.text(src)
    stream = json_stream(t.spark, src, "reading_id bigint, reading_value double", rescue=True)
    for q in append_apart(stream, RESCUED, dst, f"{dst}-quarantine", f"{dst}-checkpoint"):
        run_to_end(q)
    good, bad = read_table(t.spark, dst), read_table(t.spark, f"{dst}-quarantine").withColumnRenamed(RESCUED, "raw")
    return good.unionByName(bad, allowMissingColumns=True)


@query("csv_by_header", """
    SELECT event_id AS reading_id, event_type AS sensor_id, CASE WHEN event_id % 3 <> 2 THEN ts END AS reading_timestamp, value AS reading_value,
           false AS was_rescued FROM events""")
def by_header(t: Tables):
    """Three kinds of files in one folder: columns in another order, with further columns, and without one."""
    src = fresh_dir(t.spark, "csv-kinds")
    rows = t.events.select("event_id", F.col("event_id").alias("reading_id"), F.col("event_type").alias("sensor_id"), F.col("value").cast("string").alias("reading_value"),
                           F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("reading_timestamp"), F.lit("a, b").alias("note"))
    kinds = [["reading_id", "sensor_id", "reading_timestamp", "reading_value"], ["note", "reading_value", "sensor_id", "reading_id", "reading_timestamp"],
             ["reading_value", "reading_id", "sensor_id"]]
    for k, names in enumerate(kinds):
        rows.where(F.col("event_id") % 3 == k).select(*names).write.mode("append").option("header", True).csv(src)
    stream = csv_by_header(t.spark, src, "reading_id bigint, sensor_id string, reading_timestamp timestamp_ntz, reading_value double")
    return landed(t, stream, "csv-kinds").withColumn("was_rescued", F.col(RESCUED).isNotNull()).drop(RESCUED)


@query("append_mapped", with_bound("""
    SELECT reading_id, sensor_id, reading_value, processing_time FROM readings UNION ALL
    SELECT l_orderkey, 'line ' || l_linenumber, l_quantity, NULL FROM lineitem""", "readings"))
def append_rows(t: Tables):
    dst = fresh_dir(t.spark, "append")
    write_path(B.readings(t.events).select("reading_id", "sensor_id", "reading_value", "processing_time"), dst)
    append_mapped(t.lineitem, dst, {
        "reading_id": "l_orderkey", "reading_value": "l_quantity", "processing_time": None,
        "sensor_id": F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))})
    return read_table(t.spark, dst)


@query("to_records", """
    SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || strftime(ts, ',"ts":"%Y-%m-%dT%H:%M:%S.%f"') ||
           ',"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value ||
           ',"props":' || to_json(props) || '}' AS value FROM events""")
def keyed_records(t: Tables):
    return to_records(t.events, "event_id")


@query("write_table", "SELECT * FROM orders")
def stored_as_table(t: Tables):
    name = f"plantlake_orders_{uuid.uuid4().hex}"
    write_table(t.orders, name)
    return read_table(t.spark, name)


@query("write_path", "SELECT * FROM orders")
def stored_by_status(t: Tables):
    dst = fresh_dir(t.spark, "by-status")
    write_path(t.orders, dst, ["o_orderstatus"])
    return read_table(t.spark, dst)


@query("register_all", "SELECT o_orderkey, o_orderstatus, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def registered(t: Tables):
    root, schema = fresh_dir(t.spark, "registered"), f"plantlake_{uuid.uuid4().hex}"
    write_path(t.orders, f"{root}/orders")
    write_path(t.customer, f"{root}/customer")
    register_all(t.spark, root, ["orders"], schema)
    register_all(t.spark, root, ["customer"], schema, external=True)
    return t.spark.sql(f"SELECT o_orderkey, o_orderstatus, c_name FROM {schema}.orders JOIN {schema}.customer ON o_custkey = c_custkey")
