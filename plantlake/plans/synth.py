"""Synthetic plant tables as Spark jobs.

Every builder turns a frame of row numbers (one bigint column ``id``) into a
table. A random value is a fixed arithmetic mix of row number, seed and column
name, so it does not depend on partitioning, is the same on a retried task, and
any other engine can compute it too. Parents are found by a join on the number
inside their id; no id list passes the driver.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantlake.functions.columns import inline_rows
from plantlake.functions.rules import value_when
from plantlake.operators.enrich import join_derived_key, lookup
from plantlake.operators.metrics import row_audit
from plantlake.operators.ordered import indexed_lookup
from plantlake.plans import synth_values as V
from plantlake.schema import column_names
from plantlake.sources.tables import read_table, write_path

PRIME = 2147483647
HISTORY_START, HISTORY_DAYS = "2024-01-01", 365


def rows(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions)


def mix_constants(seed: int, name: str) -> tuple[int, int, int]:
    """Two multipliers and an offset for one column of one seed."""
    return tuple(1 + zlib.crc32(f"{seed}/{name}/{part}".encode()) % (PRIME - 1) for part in "abc")


def _sql(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


class Draws:
    """Seeded random columns for one table, computed from its ``id`` column.

    Expressions are given as SQL text: one call each instead of one per operator.
    Each draw is referenced without a condition, so generated code computes it once.
    """

    def __init__(self, seed: int, table: str):
        self.seed, self.table = seed, table

    def _unit(self, name: str) -> str:
        a, b, c = mix_constants(self.seed, f"{self.table}.{name}")
        x = f"((id % {PRIME}) * {a} + (id div {PRIME}) * 7919 + {c}) % {PRIME}"
        return f"((({x}) * (({x}) + {b})) % {PRIME} / {PRIME}D)"

    def unit(self, name: str) -> Column:
        """Uniform in [0, 1). Products stay below 2**63."""
        return F.expr(self._unit(name))

    def below(self, name: str, n) -> Column:
        """Uniform whole number in [0, n)."""
        return F.floor(self.unit(name) * n)

    def whole(self, name: str, low: int, high: int, step: int = 1) -> Column:
        """Uniform over low, low + step, .., high."""
        return F.expr(f"cast(floor({self._unit(name)} * {(high - low) // step + 1}) * {step} + {low} as int)")

    def real(self, name: str, low: float, high: float) -> Column:
        return F.expr(f"{self._unit(name)} * {high - low!r}D + {low!r}D")

    def date(self, name: str, first: str, last: str) -> Column:
        days = f"(datediff(DATE '{last}', DATE '{first}') + 1)"
        return F.expr(f"date_add(DATE '{first}', cast(floor({self._unit(name)} * {days}) as int))")

    def chance(self, name: str, share: float) -> Column:
        return F.expr(f"{self._unit(name)} < {share!r}D")

    def choice(self, name: str, values: list) -> Column:
        listed = ", ".join(_sql(v) for v in values)
        return F.expr(f"element_at(array({listed}), cast(floor({self._unit(name)} * {len(values)}) as int) + 1)")

    def weighted(self, name: str, pairs: list[tuple]) -> Column:
        """Choice by weight: position is the number of cumulative weights reached."""
        u = self._unit(name)
        bounds = [round(b, 9) for b in accumulate(w for _, w in pairs)][:-1]
        reached = " + ".join(f"cast({u} >= {b!r}D as int)" for b in bounds)
        return F.expr(f"element_at(array({', '.join(_sql(v) for v, _ in pairs)}), 1 + {reached})")

    def text_id(self, name: str) -> Column:
        """Id text in UUID layout."""
        h = f"md5(cast(concat('{self.seed}/{self.table}.{name}/', id) as binary))"
        parts = ", ".join(f"substring({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return F.expr(f"concat_ws('-', {parts})")


def numbered(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-filled number; longer numbers are kept whole."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def number_in(column: str, prefix: str) -> Column:
    return F.substring(F.col(column), len(prefix) + 1, 20).cast("bigint")


def size_of(parents: DataFrame) -> Column:
    return parents.agg(F.count("*").alias("n")).scalar()


def at_time(seconds: Column) -> Column:
    """Timestamp this many seconds after the start of the history."""
    start = F.lit(HISTORY_START).cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("timestamp")


def with_kind(df: DataFrame, index: Column, names: list[str], table: list[tuple]) -> DataFrame:
    """Add the columns of one row of a fixed list, picked by 0-based position."""
    listed = inline_rows(df.sparkSession, ["__no", *names], [(n, *row) for n, row in enumerate(table)])
    return lookup(df.withColumn("__kind", index), listed, {"__kind": "__no"}, names, how="inner").drop("__kind")


def build_refineries(ids: DataFrame, seed: int = 0) -> DataFrame:
    d = Draws(seed, "refineries")
    placed = with_kind(ids.select("id"), d.below("city", len(V.CITIES)),
                       ["location_city", "location_state", "location_country", "__lat", "__lon"], V.CITIES)
    return placed.select(
        numbered("REF-", F.col("id"), 3).alias("refinery_id"),
        F.concat("location_city", F.lit(" Refinery "), F.char(F.col("id") % 26 + 65)).alias("refinery_name"),
        "location_city", "location_state", "location_country",
        (F.col("__lat") + d.real("lat", -0.25, 0.25)).alias("latitude"),
        (F.col("__lon") + d.real("lon", -0.25, 0.25)).alias("longitude"),
        d.whole("capacity", 50000, 700000, 10000).alias("capacity_bpd"),
        d.real("complexity", 5.0, 15.0).alias("complexity_index"),
        d.date("commissioned", "1960-01-01", "2020-12-31").alias("commissioned_date"),
        d.choice("operator", V.OPERATORS).alias("operator_name"),
        d.chance("active", 0.95).alias("is_active"),
        d.date("turnaround", "2020-01-01", "2024-06-30").alias("last_turnaround_date"))


def build_units(ids: DataFrame, refineries: DataFrame, seed: int = 0) -> DataFrame:
    d = Draws(seed, "units")
    drawn = ids.select("id", d.below("refinery", size_of(refineries)).alias("__parent"),
                       d.choice("maker", V.UNIT_MAKERS).alias("manufacturer"))
    drawn = with_kind(drawn, d.below("type", len(V.UNIT_TYPES)),
                      ["unit_type", "unit_subtype", "design_efficiency"], V.UNIT_TYPES)
    placed = join_derived_key(drawn, refineries, "__parent", number_in("refinery_id", "REF-"), ["refinery_id"])
    return placed.select(
        numbered("UNIT-", F.col("id"), 5).alias("unit_id"), "refinery_id",
        F.concat(F.substring("unit_type", 1, 3), F.lit("-"),
                 (F.col("id") % 10 + 1).cast("string")).alias("unit_name"),
        "unit_type", "unit_subtype",
        d.whole("capacity", 10000, 200000, 5000).alias("capacity_bpd"),
        "design_efficiency",
        d.date("installed", "1980-01-01", "2023-12-31").alias("installation_date"),
        d.date("maintained", "2023-01-01", "2025-06-30").alias("last_maintenance_date"),
        d.choice("interval", V.MAINTENANCE_INTERVALS).alias("maintenance_interval_days"),
        "manufacturer",
        F.concat(F.substring("manufacturer", 1, 2), F.lit("-"), d.whole("model", 1000, 9999).cast("string"))
        .alias("model_number"),
        d.chance("active", 0.97).alias("is_active"))


def build_sensors(ids: DataFrame, units: DataFrame, seed: int = 0) -> DataFrame:
    d = Draws(seed, "sensors")
    limits = ["min_value", "max_value", "warning_low", "warning_high", "critical_low", "critical_high"]
    drawn = ids.select("id", d.below("unit", size_of(units)).alias("__parent"),
                       d.choice("maker", V.SENSOR_MAKERS).alias("manufacturer"))
    drawn = with_kind(drawn, d.below("type", len(V.SENSOR_TYPES)), ["sensor_type", "measurement_unit", *limits],
                      V.SENSOR_TYPES)
    placed = join_derived_key(drawn, units, "__parent", number_in("unit_id", "UNIT-"), ["unit_id", "refinery_id"])
    return placed.select(
        numbered("SENS-", F.col("id"), 6).alias("sensor_id"), "unit_id", "refinery_id",
        F.concat(F.substring("sensor_type", 1, 4), F.lit("-"),
                 F.lpad((F.col("id") % 1000).cast("string"), 3, "0")).alias("sensor_name"),
        "sensor_type", "measurement_unit", *limits,
        d.weighted("every", V.READING_INTERVALS).alias("reading_interval_seconds"),
        "manufacturer",
        F.concat(F.substring("manufacturer", 1, 3), F.lit("-"), d.whole("model", 100, 999).cast("string"))
        .alias("model"),
        d.date("installed", "2015-01-01", "2025-01-01").alias("installation_date"),
        d.date("calibrated", "2023-06-01", "2025-06-30").alias("calibration_date"),
        d.chance("active", 0.98).alias("is_active"))


def build_crude_types(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, column_names("dim_crude_types"), V.CRUDE_TYPES)


def build_products(spark: SparkSession) -> DataFrame:
    names = column_names("dim_products")
    return inline_rows(spark, names[:-1], V.PRODUCTS).withColumn(names[-1], F.lit("barrels"))


def build_tanks(ids: DataFrame, refineries: DataFrame, seed: int = 0) -> DataFrame:
    d = Draws(seed, "tanks")
    drawn = ids.select("id", d.below("refinery", size_of(refineries)).alias("__parent"))
    placed = join_derived_key(drawn, refineries, "__parent", number_in("refinery_id", "REF-"), ["refinery_id"])
    return placed.select(
        numbered("TANK-", F.col("id"), 5).alias("tank_id"), "refinery_id",
        numbered("TK-", F.col("id") % 500 + 100, 3).alias("tank_name"),
        d.weighted("type", V.TANK_TYPES).alias("tank_type"),
        d.weighted("product", V.TANK_PRODUCTS).alias("product_type"),
        d.weighted("capacity", V.TANK_CAPACITIES).alias("capacity_barrels"),
        d.real("min", 0.08, 0.15).alias("min_operating_level"),
        d.real("max", 0.90, 0.98).alias("max_operating_level"),
        d.real("diameter", 100.0, 350.0).alias("diameter_feet"),
        d.real("height", 40.0, 65.0).alias("height_feet"),
        d.weighted("material", V.TANK_MATERIALS).alias("material"),
        d.chance("heating", 0.4).alias("has_heating"),
        d.chance("mixer", 0.5).alias("has_mixer"),
        d.date("inspected", "2022-01-01", "2025-06-30").alias("last_inspection_date"),
        d.chance("active", 0.95).alias("is_active"))


def build_readings(ids: DataFrame, sensors: DataFrame, seed: int = 0, days: int = HISTORY_DAYS) -> DataFrame:
    """Values sit inside the sensor's range; one in 200 is raised by 0.3 of it."""
    d = Draws(seed, "readings")
    drawn = ids.select(
        "id", d.below("sensor", size_of(sensors)).alias("__parent"),
        at_time(d.below("day", days) * 86400 + d.below("second", 86400)).alias("reading_timestamp"),
        (d.real("base", 0.3, 0.7) + d.real("noise", -0.05, 0.05)
         + F.when(d.unit("anomaly") > 0.995, 0.3).otherwise(0.0)).alias("__level"))
    placed = join_derived_key(drawn, sensors, "__parent", number_in("sensor_id", "SENS-"),
                              ["sensor_id", "unit_id", "refinery_id", "min_value", "max_value"])
    return placed.select(
        d.text_id("reading").alias("reading_id"), "sensor_id", "unit_id", "refinery_id", "reading_timestamp",
        (F.col("min_value") + F.col("__level") * (F.col("max_value") - F.col("min_value"))).alias("reading_value"),
        d.weighted("quality", V.QUALITY_LABELS).alias("reading_quality"),
        d.chance("interpolated", 0.01).alias("is_interpolated"),
        F.col("reading_timestamp").alias("event_time"),
        (F.col("reading_timestamp") + F.expr("INTERVAL 1 SECOND")).alias("processing_time"))


def build_shipments(ids: DataFrame, refineries: DataFrame, tanks: DataFrame, seed: int = 0) -> DataFrame:
    """Every shipment goes to one of the tanks that hold crude."""
    d = Draws(seed, "shipments")
    crude_tanks = tanks.where(F.col("product_type") == "Crude Oil").select("tank_id")
    drawn = ids.select(
        "id", d.below("refinery", size_of(refineries)).alias("__site"),
        d.below("tank", size_of(crude_tanks)).alias("__tank"),
        d.date("shipped", "2020-01-01", "2024-12-31").alias("shipment_date"),
        d.whole("transit", 5, 45).alias("__days"),
        d.whole("volume", 100000, 2500000, 50000).alias("volume_barrels"),
        d.real("price", 40.0, 120.0).alias("price_per_barrel"))
    placed = join_derived_key(drawn, refineries, "__site", number_in("refinery_id", "REF-"), ["refinery_id"])
    sent = indexed_lookup(placed, crude_tanks, "__tank", [F.asc("tank_id")], {"tank_id": "destination_tank_id"},
                          how="left")
    arrival = F.date_add("shipment_date", F.col("__days"))
    return sent.select(
        numbered("SHIP-", F.col("id"), 7).alias("shipment_id"), "refinery_id",
        d.choice("crude", [c[0] for c in V.CRUDE_TYPES]).alias("crude_type_id"),
        numbered("SUPP-", d.whole("supplier", 1, 50), 3).alias("supplier_id"),
        F.concat(F.lit("MT "), d.choice("vessel", V.VESSELS)).alias("vessel_name"),
        d.weighted("mode", V.TRANSPORT_MODES).alias("transport_mode"),
        d.choice("port", V.PORTS).alias("origin_port"),
        "shipment_date", arrival.alias("arrival_date"),
        F.date_sub(arrival, d.below("early", 3).cast("int")).alias("expected_arrival_date"),
        "volume_barrels",
        d.real("gravity", 20.0, 50.0).alias("api_gravity_actual"),
        d.real("sulfur", 0.05, 4.0).alias("sulfur_content_actual"),
        d.real("water", 0.0, 1.0).alias("water_content_pct"),
        "price_per_barrel", (F.col("volume_barrels") * F.col("price_per_barrel")).alias("total_cost"),
        "destination_tank_id", d.weighted("status", V.SHIPMENT_STATUSES).alias("status"),
        F.to_timestamp("shipment_date").alias("created_at"), F.to_timestamp(arrival).alias("updated_at"))


def build_quality_tests(ids: DataFrame, refineries: DataFrame, tanks: DataFrame, seed: int = 0) -> DataFrame:
    """Sample and tank numbers are drawn freely, so some refer to nothing."""
    d = Draws(seed, "tests")
    drawn = ids.select("id", d.below("refinery", size_of(refineries)).alias("__site"),
                       d.weighted("source", V.SAMPLE_SOURCES).alias("sample_source_type"),
                       numbered("TANK-", d.below("tank", size_of(tanks)), 5).alias("__tank"),
                       d.date("day", "2020-01-01", "2024-12-30").alias("__day"),
                       d.below("second", 86400).alias("__second"))
    placed = join_derived_key(drawn, refineries, "__site", number_in("refinery_id", "REF-"), ["refinery_id"])
    tested = (F.col("__day").cast("timestamp_ntz")
              + F.make_dt_interval(secs=F.col("__second").cast("decimal(18,6)"))).cast("timestamp")
    return placed.select(
        numbered("TEST-", F.col("id"), 8).alias("test_id"), "refinery_id", "sample_source_type",
        numbered("SRC-", d.below("sample", 1000000), 7).alias("sample_source_id"),
        value_when(F.col("sample_source_type") == "Tank Sample", "__tank").alias("tank_id"),
        tested.alias("test_datetime"),
        d.weighted("type", V.TEST_TYPES).alias("test_type"),
        numbered("TECH-", d.whole("technician", 1, 100), 3).alias("technician_id"),
        d.real("gravity", 18.0, 55.0).alias("api_gravity"),
        d.real("sulfur", 0.01, 5.0).alias("sulfur_content_pct"),
        d.real("sediment", 0.0, 2.0).alias("water_sediment_pct"),
        d.real("viscosity", 1.0, 500.0).alias("viscosity_cst"),
        d.real("pour", -40.0, 60.0).alias("pour_point_f"),
        d.real("vapor", 5.0, 15.0).alias("reid_vapor_pressure"),
        value_when(d.chance("has_octane", 0.7), d.real("octane", 85.0, 95.0)).alias("octane_number"),
        value_when(d.chance("has_cetane", 0.7), d.real("cetane", 40.0, 55.0)).alias("cetane_number"),
        d.real("flash", 100.0, 250.0).alias("flash_point_f"),
        d.weighted("status", V.TEST_STATUSES).alias("test_result_status"),
        d.choice("notes", V.TEST_NOTES).alias("notes"))


def build_tank_inventory(ids: DataFrame, tanks: DataFrame, seed: int = 0, days: int = HISTORY_DAYS) -> DataFrame:
    d = Draws(seed, "inventory")
    drawn = ids.select(
        "id", d.below("tank", size_of(tanks)).alias("__parent"),
        at_time(d.below("day", days) * 86400 + d.below("slot", 96) * 900).alias("measurement_timestamp"),
        d.real("fill", 0.15, 0.92).alias("fill_percentage"))
    placed = join_derived_key(drawn, tanks, "__parent", number_in("tank_id", "TANK-"),
                              ["tank_id", "refinery_id", "product_type", "capacity_barrels"])
    crude = F.col("product_type") == "Crude Oil"
    return placed.select(
        d.text_id("inventory").alias("inventory_id"), "tank_id", "refinery_id", "measurement_timestamp",
        (F.col("fill_percentage") * F.col("capacity_barrels")).cast("int").alias("volume_barrels"),
        "fill_percentage",
        d.real("temperature", 60.0, 120.0).alias("temperature_f"),
        d.real("water", 0.0, 12.0).alias("water_bottom_inches"),
        "product_type",
        value_when(crude, numbered("CRUDE-", d.whole("crude", 1, len(V.CRUDE_TYPES)), 3)).alias("crude_type_id"),
        value_when(~crude, numbered("PROD-", d.whole("item", 1, len(V.PRODUCTS)), 3)).alias("product_id"),
        d.weighted("gauge", V.GAUGES).alias("measurement_method"),
        d.chance("verified", 0.05).alias("is_verified"))


def build_production(ids: DataFrame, units: DataFrame, seed: int = 0, days: int = HISTORY_DAYS) -> DataFrame:
    d = Draws(seed, "production")
    drawn = ids.select(
        "id", d.below("unit", size_of(units)).alias("__parent"),
        at_time(d.below("day", days) * 86400 + d.below("hour", 24) * 3600).alias("production_hour"),
        d.whole("input", 3000, 10000, 100).alias("input_volume_barrels"),
        d.real("yield", 0.75, 0.98).alias("yield_percentage"))
    placed = join_derived_key(drawn, units, "__parent", number_in("unit_id", "UNIT-"), ["unit_id", "refinery_id"])
    return placed.select(
        d.text_id("output").alias("output_id"), "unit_id", "refinery_id", "production_hour",
        "input_volume_barrels",
        d.choice("crude", [c[0] for c in V.CRUDE_TYPES]).alias("input_crude_type_id"),
        d.choice("product", [p[0] for p in V.PRODUCTS]).alias("output_product_id"),
        (F.col("input_volume_barrels") * F.col("yield_percentage")).cast("int").alias("output_volume_barrels"),
        "yield_percentage",
        d.real("energy", 500.0, 2500.0).alias("energy_consumed_mmbtu"),
        d.real("temperature", 400.0, 900.0).alias("operating_temperature_f"),
        d.real("pressure", 20.0, 100.0).alias("operating_pressure_psi"),
        d.choice("downtime", V.DOWNTIME_MINUTES).alias("downtime_minutes"),
        d.weighted("grade", V.GRADES).alias("quality_grade"),
        d.choice("shift", V.SHIFTS).alias("shift_id"))


# Rows at scale 1.0
FULL_SIZES = {
    "fact_crude_shipments": 10_000_000,
    "fact_quality_tests": 15_000_000,
    "fact_sensor_readings": 500_000 * 8_640 * 365 // 10,
}


def build_all(spark: SparkSession, root: str, scale: float = 0.01, seed: int = 0,
              refineries: int = 500) -> DataFrame:
    """Write all eleven tables below ``root`` and return their row counts.

    ``scale`` applies to every fact table. Each table is evaluated once: later
    builders and the counts read what was written.
    """
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{root.rstrip('/')}/{name}"
        write_path(df.select(*column_names(name)), paths[name])
        return read_table(spark, paths[name])

    unit_rows, tank_rows = refineries * 10, refineries * 4
    sites = put("dim_refineries", build_refineries(rows(spark, refineries), seed))
    put("dim_crude_types", build_crude_types(spark))
    put("dim_products", build_products(spark))
    units = put("dim_processing_units", build_units(rows(spark, unit_rows), sites, seed))
    tanks = put("dim_storage_tanks", build_tanks(rows(spark, tank_rows), sites, seed))
    sensors = put("dim_sensors", build_sensors(rows(spark, unit_rows * 100), units, seed))

    def scaled(n: float) -> DataFrame:
        return rows(spark, max(1, int(n * scale)))

    put("fact_crude_shipments", build_shipments(scaled(FULL_SIZES["fact_crude_shipments"]), sites, tanks, seed))
    put("fact_quality_tests", build_quality_tests(scaled(FULL_SIZES["fact_quality_tests"]), sites, tanks, seed))
    put("fact_tank_inventory", build_tank_inventory(scaled(tank_rows * 96 * HISTORY_DAYS), tanks, seed))
    put("fact_production_output", build_production(scaled(unit_rows * 24 * HISTORY_DAYS / 10), units, seed))
    put("fact_sensor_readings", build_readings(scaled(FULL_SIZES["fact_sensor_readings"]), sensors, seed))
    return row_audit({name: read_table(spark, path) for name, path in paths.items()})
