"""Lookups and unions."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from plantlake.operators import enrich as E
from plantlake.operators.metrics import row_audit
from plantlake.operators.ordered import indexed_lookup
from plantlake.queries import bindings as B
from plantlake.queries.base import Tables, query, with_bound


@query("star_enrich", with_bound("""
    SELECT p.unit_id, p.production_hour, p.output_product_id, p.output_volume_barrels, p.energy_consumed_mmbtu,
           u.unit_name, u.unit_type, r.refinery_name, d.product_name, d.product_category, c.crude_name
    FROM production p LEFT JOIN units u ON p.unit_id = u.unit_id
    LEFT JOIN sites r ON p.refinery_id = r.refinery_id
    LEFT JOIN products d ON p.output_product_id = d.product_id
    LEFT JOIN crudes c ON p.input_crude_type_id = c.crude_type_id""",
    "production", "units", "sites", "products", "crudes"))
def star_enrich(t: Tables):
    joined = E.star_enrich(B.production(t.lineitem), [
        (B.units(t.supplier), "unit_id", ["unit_name", "unit_type"]),
        (B.sites(t.nation), "refinery_id", ["refinery_name"]),
        (B.products(t.part), {"output_product_id": "product_id"}, ["product_name", "product_category"]),
        (B.crudes(t.region), {"input_crude_type_id": "crude_type_id"}, ["crude_name"])])
    return joined.select(
        "unit_id", "production_hour", "output_product_id", "output_volume_barrels", "energy_consumed_mmbtu",
        "unit_name", "unit_type", "refinery_name", "product_name", "product_category", "crude_name")


@query("inner_dims", with_bound("""
    SELECT s.shipment_id, s.volume_barrels, r.refinery_name, c.crude_name
    FROM shipments s JOIN sites r ON s.refinery_id = r.refinery_id
    JOIN crudes c ON s.crude_type_id = c.crude_type_id""", "shipments", "sites", "crudes"))
def inner_dims(t: Tables):
    return E.join_inner(B.shipments(t.orders).select("shipment_id", "volume_barrels", "refinery_id", "crude_type_id"), [
        (B.sites(t.nation), "refinery_id", ["refinery_name"]),
        (B.crudes(t.region), "crude_type_id", ["crude_name"])]).drop("refinery_id", "crude_type_id")


@query("broadcast_derived_key", """
    SELECT o_orderkey, o_custkey, c_mktsegment FROM orders
    JOIN customer ON o_custkey = CAST(substr(c_name, 10) AS BIGINT)""")
def broadcast_derived_key(t: Tables):
    return E.join_derived_key(t.orders.select("o_orderkey", "o_custkey"), t.customer, "o_custkey",
                              F.expr("substring(c_name, 10)").try_cast("bigint"), ["c_mktsegment"])


@query("broadcast_left", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, s_name, s_nationkey
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def broadcast_left(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey")
    return E.enrich_left(rows, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_name", "s_nationkey"]).drop("l_suppkey")


@query("left_using", with_bound("""
    SELECT tank_id, inventory_id, fill_percentage, tank_name, capacity_barrels
    FROM tank_inventory LEFT JOIN (SELECT tank_id, tank_name, capacity_barrels FROM tanks) USING (tank_id)""",
    "tank_inventory", "tanks"))
def left_using(t: Tables):
    return E.enrich_left(B.tank_inventory(t.events).select("tank_id", "inventory_id", "fill_percentage"),
                         B.tanks(t.events), "tank_id", ["tank_name", "capacity_barrels"])


@query("dim_first_left", """
    SELECT c_custkey, c_name, coalesce(n, 0) AS order_count
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    ON o_custkey = c_custkey""")
def dim_first_left(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = E.dim_first(t.customer.select("c_custkey", "c_name"), counts, {"c_custkey": "o_custkey"})
    return joined.select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"))


@query("join_with_predicate", with_bound("""
    SELECT k.tank_id, k.tank_name, i.fill_percentage, i.measurement_timestamp
    FROM tanks k JOIN ranked i ON k.tank_id = i.tank_id AND i.rn = 1""", "tank_inventory", "tanks",
    ranked="""SELECT *, row_number() OVER (PARTITION BY tank_id
                       ORDER BY measurement_timestamp DESC, inventory_id DESC) AS rn FROM tank_inventory"""))
def join_with_predicate(t: Tables):
    newest = Window.partitionBy("tank_id").orderBy(F.desc("measurement_timestamp"), F.desc("inventory_id"))
    ranked = B.tank_inventory(t.events).withColumn("rn", F.row_number().over(newest))
    return E.join_filtered(B.tanks(t.events).select("tank_id", "tank_name"), ranked, "tank_id", F.col("rn") == 1,
                           ["fill_percentage", "measurement_timestamp"])


@query("indexed_lookup", """
    WITH d AS (SELECT s_name, s_nationkey, row_number() OVER (ORDER BY s_name) - 1 AS i FROM supplier)
    SELECT o_orderkey, s_name, s_nationkey FROM orders
    JOIN d ON d.i = o_orderkey % (SELECT count(*) FROM supplier)""")
def lookup_by_index(t: Tables):
    size = t.supplier.agg(F.count("*").alias("n")).scalar()
    rows = t.orders.select("o_orderkey", (F.col("o_orderkey") % size).alias("i"))
    return indexed_lookup(rows, t.supplier, "i", [F.asc("s_name")], ["s_name", "s_nationkey"]).drop("i")


@query("union_feeds", with_bound("""
    SELECT reading_id, sensor_id, reading_timestamp, reading_value FROM readings UNION ALL
    SELECT reading_id, sensor_id, reading_timestamp, reading_value + 1 FROM readings""",
    "readings"))
def union_feeds(t: Tables):
    names = ["reading_id", "sensor_id", "reading_timestamp", "reading_value"]
    live = B.readings(t.events).withColumn("reading_value", F.col("reading_value") + 1)
    return E.union_feeds(B.readings(t.events).select(*names), live)


AUDITED = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")


@query("row_audit", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
    for n in AUDITED))
def audit(t: Tables):
    return row_audit({n: getattr(t, n) for n in
                      AUDITED})
