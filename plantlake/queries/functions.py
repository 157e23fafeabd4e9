"""Scalar function families, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.functions.columns import settle, utc_instant, utc_wall
from plantlake.operators.project import stamped
from plantlake.plans.synth import numbered
from plantlake.queries.base import Tables, query, settled
from plantlake.queries.bindings import k


@query("fn_string", """
    SELECT c_custkey, 'UNIT-' || lpad(CAST(c_custkey AS VARCHAR), 
             CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')
             AS label,
           substr(c_name, 10) AS tail, substr(c_mktsegment, 1, 3) AS head,
           chr(CAST(65 + c_custkey % 26 AS INTEGER)) AS letter FROM customer""")
def fn_string(t: Tables):
    return t.customer.select(
        "c_custkey", numbered("UNIT-", F.col("c_custkey"), 5).alias("label"),
        F.expr("substring(c_name, 10)").alias("tail"), F.substring("c_mktsegment", 1, 3).alias("head"),
        F.char(F.col("c_custkey") % 26 + 65).alias("letter"))


@query("fn_math", f"""
    SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, o_orderkey % 7 AS remainder,
           {settled("o_totalprice / 3", 2)} AS third, least(o_totalprice, 250000) AS capped,
           greatest(o_totalprice - 250000, 0) AS excess FROM orders""")
def fn_math(t: Tables):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.floor(price / 1000).alias("thousands"), (F.col("o_orderkey") % 7).alias("remainder"),
        settle(price / 3, 2).alias("third"), F.least(price, F.lit(250000.0)).alias("capped"),
        F.greatest(price - 250000, F.lit(0.0)).alias("excess"))


@query("fn_date", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
           CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) AS VARCHAR) AS due,
           CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS week_before,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS age FROM orders""")
def fn_date(t: Tables):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", day.alias("day"), F.date_add(day, (F.col("o_orderkey") % 45).cast("int")).alias("due"),
        F.date_sub(day, 7).alias("week_before"), F.datediff(F.lit("2001-08-02").cast("date"), day).alias("age"))


@query("fn_time", """
    SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, date_trunc('second', ts) AS whole_second,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS iso, ts AS parsed, date_trunc('hour', ts) AS hour,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight
    FROM events""")
def fn_time(t: Tables):
    zoned = utc_instant("ts")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return t.events.select(
        "event_id", F.unix_timestamp(zoned).alias("seconds"),
        utc_wall(F.timestamp_seconds(F.unix_timestamp(zoned))).alias("whole_second"), iso.alias("iso"),
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("parsed"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.to_timestamp(F.to_date("ts")).cast("timestamp_ntz").alias("midnight"))


@query("fn_array", """
    SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Radar' WHEN 1 THEN 'Manual' WHEN 2 THEN 'Float' END AS gauge
    FROM part""")
def fn_array(t: Tables):
    gauges = F.array(*[F.lit(g) for g in ("Radar", "Manual", "Float")])
    return t.part.select("p_partkey", F.try_element_at(gauges, F.col("p_size") % 4 + 1).alias("gauge"))


@query("fn_conditional", """
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'debt' WHEN s_acctbal > 5000 THEN 'rich' ELSE 'fair' END AS state,
           CASE WHEN s_acctbal > 0 THEN s_acctbal END AS positive, CAST(trunc(s_acctbal) AS INTEGER) AS whole,
           TRY_CAST(substr(s_name, 10) AS BIGINT) AS number, TRY_CAST(substr(s_name, 1, 3) AS DOUBLE) AS no_number
    FROM supplier""")
def fn_conditional(t: Tables):
    balance = F.col("s_acctbal")
    return t.supplier.select(
        "s_suppkey", F.when(balance < 0, "debt").when(balance > 5000, "rich").otherwise("fair").alias("state"),
        F.when(balance > 0, balance).alias("positive"), balance.cast("int").alias("whole"),
        F.expr("substring(s_name, 10)").try_cast("bigint").alias("number"),
        F.substring("s_name", 1, 3).try_cast("double").alias("no_number"))


@query("fn_json", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS encoded FROM events""")
def fn_json(t: Tables):
    parsed = F.from_json("props", "k int")
    return t.events.select("event_id", parsed["k"].alias("k"),
                           F.to_json(F.struct("event_id", "event_type")).alias("encoded"))


# Random and time-of-run values cannot be repeated by another engine.
# What holds for every one of them can.
@query("fn_random", """
    SELECT event_id, true AS in_range, true AS is_finite, true AS is_uuid, true AS is_past,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def fn_random(t: Tables):
    rows = stamped(t.events.select("event_id", F.rand(1).alias("uniform"), F.randn(2).alias("gaussian"),
                                   F.uuid().alias("uuid"), k().alias("k")), "stamp")
    uniform, gaussian = F.col("uniform"), F.col("gaussian")
    return rows.select(
        "event_id", ((uniform >= 0) & (uniform < 1)).alias("in_range"), (gaussian.isNotNull() & (F.abs(gaussian) < 40)).alias("is_finite"),
        F.col("uuid").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("is_uuid"),
        (F.col("stamp") <= F.current_timestamp()).alias("is_past"), "k")
