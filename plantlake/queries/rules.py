"""Per-row rules and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.functions import rules as R
from plantlake.functions.columns import settle
from plantlake.operators import project as P
from plantlake.operators.enrich import enrich_left
from plantlake.plans.silver import SENSOR_LIMITS
from plantlake.queries import bindings as B
from plantlake.queries.base import Tables, query, settled, with_bound


def limited_readings(t: Tables):
    """Readings next to their sensor's limits; a value is missing where k is 0."""
    rows = B.readings(t.events.withColumn("value", F.when(B.k() != 0, F.col("value"))))
    return enrich_left(rows, B.sensors(t.spark), "sensor_id")


LIMITED = dict(
    holed="""SELECT r.* REPLACE (CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) <> 0
                                      THEN r.reading_value END AS reading_value)
             FROM readings r JOIN events e ON e.event_id = r.reading_id""",
    limited="""SELECT h.*, s.* EXCLUDE (sensor_id) FROM holed h LEFT JOIN sensors s ON h.sensor_id = s.sensor_id""")


def limited_sql(body: str) -> str:
    return with_bound(body, "readings", "sensors", **LIMITED)


@query("derive_columns", """
    SELECT *, l_extendedprice * (1 - l_discount) AS net_price,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_price FROM lineitem""")
def derive_columns(t: Tables):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return P.derive_columns(t.lineitem, {"net_price": net, "gross_price": net * (1 + F.col("l_tax"))})


@query("active_enriched", with_bound("""
    SELECT r.reading_id, r.sensor_id, r.reading_value, s.measurement_unit
    FROM readings r JOIN sensors s ON r.sensor_id = s.sensor_id WHERE s.is_active""", "readings", "sensors"))
def active_enriched(t: Tables):
    joined = enrich_left(B.readings(t.events), B.sensors(t.spark), "sensor_id", ["measurement_unit", "is_active"])
    return P.active_only(joined).select("reading_id", "sensor_id", "reading_value", "measurement_unit")


@query("validity_filter", with_bound("""
    SELECT inventory_id, tank_id, volume_barrels, fill_percentage FROM tank_inventory
    WHERE volume_barrels >= 0 AND fill_percentage >= 0 AND fill_percentage <= 1""", "tank_inventory"))
def validity_filter(t: Tables):
    rows = B.tank_inventory(t.events).select("inventory_id", "tank_id", "volume_barrels", "fill_percentage")
    return P.valid_rows(rows, "volume_barrels", "fill_percentage")


@query("project_reorder", """
    SELECT s_name AS unit_name, s_suppkey AS unit_id, s_acctbal AS balance FROM supplier""")
def project_reorder(t: Tables):
    return P.project(t.supplier, drop=("s_nationkey",),
                     rename={"s_suppkey": "unit_id", "s_name": "unit_name", "s_acctbal": "balance"},
                     order=["unit_name", "unit_id", "balance"])


@query("threshold_classify", limited_sql("""
    SELECT reading_id,
           CASE WHEN reading_value IS NULL THEN 'NORMAL'
                WHEN reading_value NOT BETWEEN critical_low AND critical_high THEN 'CRITICAL'
                WHEN reading_value NOT BETWEEN warning_low AND warning_high THEN 'WARNING'
                ELSE 'NORMAL' END AS alert_status
    FROM limited"""))
def threshold_classify(t: Tables):
    return limited_readings(t).select(
        "reading_id", R.threshold_status("reading_value", *SENSOR_LIMITS).alias("alert_status"))


@query("range_flag", limited_sql("""
    SELECT reading_id, coalesce(CAST(reading_value NOT BETWEEN min_value AND max_value AS VARCHAR), 'unknown')
           AS is_out_of_range FROM limited"""))
def range_flag(t: Tables):
    flag = R.out_of_range("reading_value", "min_value", "max_value")
    return limited_readings(t).select(
        "reading_id", F.coalesce(flag.cast("string"), F.lit("unknown")).alias("is_out_of_range"))


@query("range_flag_strict", limited_sql("""
    SELECT reading_id, CASE WHEN reading_value NOT BETWEEN min_value AND max_value THEN true ELSE false END
           AS is_out_of_range FROM limited"""))
def range_flag_strict(t: Tables):
    return limited_readings(t).select(
        "reading_id", R.out_of_range("reading_value", "min_value", "max_value", null_as_false=True)
        .alias("is_out_of_range"))


@query("quality_label", limited_sql("""
    SELECT reading_id,
           CASE WHEN reading_value <= critical_low OR reading_value >= critical_high THEN 'BAD'
                WHEN reading_value <= warning_low OR reading_value >= warning_high THEN 'UNCERTAIN'
                ELSE 'GOOD' END AS quality
    FROM limited"""))
def quality_label(t: Tables):
    return limited_readings(t).select("reading_id", R.quality_label("reading_value", *SENSOR_LIMITS).alias("quality"))


@query("clamp_range", limited_sql("""
    SELECT reading_id, CASE WHEN reading_value < warning_low THEN warning_low
                            WHEN reading_value > warning_high THEN warning_high
                            ELSE reading_value END AS clamped FROM limited"""))
def clamp_range(t: Tables):
    return limited_readings(t).select(
        "reading_id", R.clamp("reading_value", "warning_low", "warning_high").alias("clamped"))


@query("fill_band", with_bound(f"SELECT inventory_id, {B.BAND} AS band FROM tank_inventory", "tank_inventory"))
def fill_band(t: Tables):
    return B.tank_inventory(t.events).select("inventory_id", R.fill_band("fill_percentage").alias("band"))


@query("attention_flag", with_bound(
    f"SELECT inventory_id, {B.NEEDS_LOOK} AS requires_attention FROM tank_inventory", "tank_inventory"))
def attention_flag(t: Tables):
    return B.tank_inventory(t.events).select(
        "inventory_id", R.needs_attention("fill_percentage", "water_bottom_inches").alias("requires_attention"))


@query("available_capacity", with_bound(
    f"SELECT inventory_id, {B.ROOM} AS available_capacity_barrels FROM tank_inventory",
    "tank_inventory"))
def available_capacity(t: Tables):
    return B.tank_inventory(t.events).select(
        "inventory_id", R.available_capacity("fill_percentage", "volume_barrels").alias("available_capacity_barrels"))


def tank_rows(t: Tables):
    return enrich_left(B.tank_inventory(t.events), B.tanks(t.events), "tank_id",
                       ["min_operating_level", "max_operating_level"])


TANK_ROWS = "tank_inventory i LEFT JOIN tanks k ON i.tank_id = k.tank_id"


@query("operating_status", with_bound(
    f"SELECT i.inventory_id, {B.OPERATING} AS operating_status FROM {TANK_ROWS}", "tank_inventory", "tanks"))
def operating_status(t: Tables):
    return tank_rows(t).select("inventory_id", R.operating_status(
        "fill_percentage", "min_operating_level", "max_operating_level").alias("operating_status"))


@query("inventory_status", with_bound(
    f"SELECT i.inventory_id, {B.OWN_BAND} AS inventory_status FROM {TANK_ROWS}", "tank_inventory", "tanks"))
def inventory_status(t: Tables):
    return tank_rows(t).select("inventory_id", R.inventory_status(
        "fill_percentage", "min_operating_level", "max_operating_level").alias("inventory_status"))


@query("maintenance_status", f"""
    WITH last AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1),
    aged AS (SELECT c_custkey AS unit_id, 200 + (c_custkey % 5) * 60 AS interval_days,
                    date_diff('day', last_day, DATE '{B.AS_OF_ORDERS}') AS age
             FROM customer LEFT JOIN last ON o_custkey = c_custkey)
    SELECT unit_id, if(age IS NULL, 'OK', {B.due("age", "interval_days")}) AS maintenance_status FROM aged""")
def maintenance_status(t: Tables):
    last = t.orders.groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("last_day"))
    rows = enrich_left(t.customer.select("c_custkey"), last, {"c_custkey": "o_custkey"}, ["last_day"])
    return rows.select(F.col("c_custkey").alias("unit_id"), R.maintenance_status(
        "last_day", F.col("c_custkey") % 5 * 60 + 200, B.as_of(B.AS_OF_ORDERS)).alias("maintenance_status"))


@query("days_delayed", with_bound("""
    SELECT shipment_id, CAST(date_diff('day', expected_arrival_date, arrival_date) AS INTEGER) AS days_delayed
    FROM shipments""", "shipments"))
def days_delayed(t: Tables):
    return B.shipments(t.orders).select(
        "shipment_id", R.days_delayed("arrival_date", "expected_arrival_date").alias("days_delayed"))


@query("variance_vs_typical", with_bound("""
    SELECT s.shipment_id, s.api_gravity_actual - c.api_gravity_typical AS api_gravity_variance,
           s.sulfur_content_actual - c.sulfur_content_typical AS sulfur_variance
    FROM shipments s LEFT JOIN crudes c ON s.crude_type_id = c.crude_type_id""", "shipments", "crudes"))
def variance_vs_typical(t: Tables):
    rows = enrich_left(B.shipments(t.orders), B.crudes(t.region), "crude_type_id",
                       ["api_gravity_typical", "sulfur_content_typical"])
    return rows.select("shipment_id",
                       R.variance("api_gravity_actual", "api_gravity_typical").alias("api_gravity_variance"),
                       R.variance("sulfur_content_actual", "sulfur_content_typical").alias("sulfur_variance"))


@query("safe_ratios", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
           l_extendedprice / nullif(l_quantity * (1 - l_discount), 0) AS energy_per_unit,
           l_quantity / nullif(l_discount, 0) AS volume_over_loss, (1 - l_discount) / 0.95::DOUBLE AS efficiency_ratio
    FROM lineitem""")
def safe_ratios(t: Tables):
    kept = 1 - F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        R.safe_ratio("l_extendedprice", F.col("l_quantity") * kept).alias("energy_per_unit"),
        R.safe_ratio("l_quantity", "l_discount").alias("volume_over_loss"),
        R.safe_ratio(kept, 0.95).alias("efficiency_ratio"))


@query("health_score", f"""
    WITH s AS (SELECT user_id, avg(CASE WHEN value > 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rate,
                      stddev_samp(value) AS volatility FROM events GROUP BY 1)
    SELECT c_custkey AS unit_id,
           {settled("greatest(0::DOUBLE, 100 - rate * 500 - volatility / 10)")} AS health_score
    FROM customer LEFT JOIN s ON user_id = c_custkey""")
def health_score(t: Tables):
    stats = t.events.groupBy("user_id").agg(
        F.avg(F.when(F.col("value") > 100, 1.0).otherwise(0.0)).alias("rate"),
        F.stddev_samp("value").alias("volatility"))
    rows = enrich_left(t.customer.select("c_custkey"), stats, {"c_custkey": "user_id"}, ["rate", "volatility"])
    return rows.select(F.col("c_custkey").alias("unit_id"),
                       settle(R.health_score("rate", "volatility")).alias("health_score"))


@query("conditional_null", """
    SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN p_brand END AS brand_unless_economy,
           CASE WHEN p_size > 25 THEN p_retailprice END AS price_of_large FROM part""")
def conditional_null(t: Tables):
    return t.part.select("p_partkey",
                         R.value_when(F.col("p_type") != "ECONOMY", "p_brand").alias("brand_unless_economy"),
                         R.value_when(F.col("p_size") > 25, "p_retailprice").alias("price_of_large"))
