"""Synthetic plant tables grown from the keys of the given tables.

The oracle states the generator's arithmetic in SQL: per column a mix of row
number and constants taken from seed and column name.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from plantlake.plans import synth as S, synth_values as V
from plantlake.queries.base import Tables, query
from plantlake.session import fresh_dir
from plantlake.sources.tables import read_table, write_path

SEED = 7
P = S.PRIME

# Which key column numbers the rows of each table.
IDS = {"refineries": ("supplier", "s_suppkey"), "units": ("customer", "c_custkey"), "sensors": ("part", "p_partkey"),
       "tanks": ("part", "p_partkey"), "readings": ("events", "event_id"), "shipments": ("orders", "o_orderkey"),
       "tests": ("orders", "o_orderkey"), "inventory": ("events", "event_id"), "production": ("orders", "o_orderkey")}


def ids(t: Tables, name: str) -> DataFrame:
    table, key = IDS[name]
    return getattr(t, table).select(F.col(key).alias("id"))


class Sql:
    """SQL text of the draws of one table."""

    def __init__(self, table: str):
        self.table = table

    def unit(self, name: str) -> str:
        a, b, c = S.mix_constants(SEED, f"{self.table}.{name}")
        x = f"(((id % {P}) * {a} + (id // {P}) * 7919 + {c}) % {P})"
        return f"((({x} * ({x} + {b})) % {P}) / {P})"

    def below(self, name: str, n) -> str:
        return f"CAST(floor({self.unit(name)} * {n}) AS BIGINT)"

    def whole(self, name: str, low: int, high: int, step: int = 1) -> str:
        return f"CAST({self.below(name, (high - low) // step + 1)} * {step} + {low} AS INTEGER)"

    def real(self, name: str, low: float, high: float) -> str:
        return f"({self.unit(name)} * {high - low!r}::DOUBLE + {low!r}::DOUBLE)"

    def date(self, name: str, first: str, last: str) -> str:
        days = f"(date_diff('day', DATE '{first}', DATE '{last}') + 1)"
        return f"(DATE '{first}' + CAST({self.below(name, days)} AS INTEGER))"

    def day(self, name: str, first: str, last: str) -> str:
        return f"CAST({self.date(name, first, last)} AS VARCHAR)"

    def chance(self, name: str, share: float) -> str:
        return f"({self.unit(name)} < {share!r}::DOUBLE)"

    def choice(self, name: str, values: list) -> str:
        return f"{array(values)}[{self.below(name, len(values))} + 1]"

    def weighted(self, name: str, pairs: list[tuple]) -> str:
        bounds = [round(b, 9) for b in accumulate(w for _, w in pairs)]
        cases = " ".join(f"WHEN {self.unit(name)} < {b!r}::DOUBLE THEN {v!r}" for (v, _), b in
                         list(zip(pairs, bounds))[:-1])
        return f"CASE {cases} ELSE {pairs[-1][0]!r} END"

    def text_id(self, name: str) -> str:
        h = f"md5('{SEED}/{self.table}.{name}/' || id)"
        return " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def array(values: list) -> str:
    return "[" + ", ".join(f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v) for v in values) + "]"


def numbered(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def column(table: list[tuple], position: int) -> str:
    return f"{array([r[position] for r in table])}[kind + 1]"


def at_time(seconds: str) -> str:
    return f"(TIMESTAMP '{S.HISTORY_START}' + to_seconds({seconds}))"


def draws(name: str, parent: str | None = None, key: str = "parent", **extra: str) -> str:
    """CTE body: row numbers with the drawn parent number and more columns."""
    table, col = IDS[name]
    cols = dict(extra)
    if parent:
        cols[key] = Sql(name).below(parent, f"(SELECT count(*) FROM {parents(parent)})")
    shown = "".join(f", {e} AS {n}" for n, e in cols.items())
    return f"SELECT id{shown} FROM (SELECT {col} AS id FROM {table})"


def parents(parent: str) -> str:
    return {"refinery": "refineries", "unit": "units", "sensor": "sensors", "tank": "tanks"}[parent]


r, u, s, k = Sql("refineries"), Sql("units"), Sql("sensors"), Sql("tanks")
d, sh, q, i, p = Sql("readings"), Sql("shipments"), Sql("tests"), Sql("inventory"), Sql("production")

REFINERIES = f"""
    SELECT {numbered('REF-', 'id', 3)} AS refinery_id,
           {column(V.CITIES, 0)} || ' Refinery ' || chr(CAST(65 + id % 26 AS INTEGER)) AS refinery_name,
           {column(V.CITIES, 0)} AS location_city, {column(V.CITIES, 1)} AS location_state,
           {column(V.CITIES, 2)} AS location_country, {column(V.CITIES, 3)} + {r.real('lat', -0.25, 0.25)} AS latitude,
           {column(V.CITIES, 4)} + {r.real('lon', -0.25, 0.25)} AS longitude,
           {r.whole('capacity', 50000, 700000, 10000)} AS capacity_bpd,
           {r.real('complexity', 5.0, 15.0)} AS complexity_index,
           {r.day('commissioned', '1960-01-01', '2020-12-31')} AS commissioned_date,
           {r.choice('operator', V.OPERATORS)} AS operator_name, {r.chance('active', 0.95)} AS is_active,
           {r.day('turnaround', '2020-01-01', '2024-06-30')} AS last_turnaround_date
    FROM ({draws('refineries', kind=r.below('city', len(V.CITIES)))})"""

UNITS = f"""
    SELECT {numbered('UNIT-', 'id', 5)} AS unit_id, f.refinery_id,
           substr({column(V.UNIT_TYPES, 0)}, 1, 3) || '-' || (id % 10 + 1) AS unit_name,
           {column(V.UNIT_TYPES, 0)} AS unit_type, {column(V.UNIT_TYPES, 1)} AS unit_subtype,
           {u.whole('capacity', 10000, 200000, 5000)} AS capacity_bpd, {column(V.UNIT_TYPES, 2)} AS design_efficiency,
           {u.day('installed', '1980-01-01', '2023-12-31')} AS installation_date,
           {u.day('maintained', '2023-01-01', '2025-06-30')} AS last_maintenance_date,
           {u.choice('interval', V.MAINTENANCE_INTERVALS)} AS maintenance_interval_days, manufacturer,
           substr(manufacturer, 1, 2) || '-' || {u.whole('model', 1000, 9999)} AS model_number,
           {u.chance('active', 0.97)} AS is_active
    FROM ({draws('units', 'refinery', kind=u.below('type', len(V.UNIT_TYPES)),
                 manufacturer=u.choice('maker', V.UNIT_MAKERS))}) x
    JOIN refineries f ON CAST(substr(f.refinery_id, 5) AS BIGINT) = x.parent"""

LIMITS = ["min_value", "max_value", "warning_low", "warning_high", "critical_low", "critical_high"]
SENSORS = f"""
    SELECT {numbered('SENS-', 'id', 6)} AS sensor_id, f.unit_id, f.refinery_id,
           substr({column(V.SENSOR_TYPES, 0)}, 1, 4) || '-' || lpad(CAST(id % 1000 AS VARCHAR), 3, '0') AS sensor_name,
           {column(V.SENSOR_TYPES, 0)} AS sensor_type, {column(V.SENSOR_TYPES, 1)} AS measurement_unit,
           {", ".join(f"{column(V.SENSOR_TYPES, n)} AS {c}" for n, c in enumerate(LIMITS, start=2))},
           {s.weighted('every', V.READING_INTERVALS)} AS reading_interval_seconds, x.manufacturer,
           substr(x.manufacturer, 1, 3) || '-' || {s.whole('model', 100, 999)} AS model,
           {s.day('installed', '2015-01-01', '2025-01-01')} AS installation_date,
           {s.day('calibrated', '2023-06-01', '2025-06-30')} AS calibration_date,
           {s.chance('active', 0.98)} AS is_active
    FROM ({draws('sensors', 'unit', kind=s.below('type', len(V.SENSOR_TYPES)),
                 manufacturer=s.choice('maker', V.SENSOR_MAKERS))}) x
    JOIN units f ON CAST(substr(f.unit_id, 6) AS BIGINT) = x.parent"""

TANKS = f"""
    SELECT {numbered('TANK-', 'id', 5)} AS tank_id, f.refinery_id, {numbered('TK-', '(id % 500 + 100)', 3)} AS tank_name,
           {k.weighted('type', V.TANK_TYPES)} AS tank_type, {k.weighted('product', V.TANK_PRODUCTS)} AS product_type,
           {k.weighted('capacity', V.TANK_CAPACITIES)} AS capacity_barrels,
           {k.real('min', 0.08, 0.15)} AS min_operating_level, {k.real('max', 0.90, 0.98)} AS max_operating_level,
           {k.real('diameter', 100.0, 350.0)} AS diameter_feet, {k.real('height', 40.0, 65.0)} AS height_feet,
           {k.weighted('material', V.TANK_MATERIALS)} AS material, {k.chance('heating', 0.4)} AS has_heating,
           {k.chance('mixer', 0.5)} AS has_mixer, {k.day('inspected', '2022-01-01', '2025-06-30')} AS last_inspection_date,
           {k.chance('active', 0.95)} AS is_active
    FROM ({draws('tanks', 'refinery')}) x JOIN refineries f ON CAST(substr(f.refinery_id, 5) AS BIGINT) = x.parent"""

READINGS = f"""
    SELECT {d.text_id('reading')} AS reading_id, f.sensor_id, f.unit_id, f.refinery_id, moment AS reading_timestamp,
           f.min_value + level * (f.max_value - f.min_value) AS reading_value,
           {d.weighted('quality', V.QUALITY_LABELS)} AS reading_quality,
           {d.chance('interpolated', 0.01)} AS is_interpolated, moment AS event_time,
           moment + INTERVAL 1 SECOND AS processing_time
    FROM ({draws('readings', 'sensor', moment=at_time(f"{d.below('day', S.HISTORY_DAYS)} * 86400 + {d.below('second', 86400)}"),
                 level=f'''{d.real('base', 0.3, 0.7)} + {d.real('noise', -0.05, 0.05)}
                           + CASE WHEN {d.unit('anomaly')} > 0.995::DOUBLE THEN 0.3::DOUBLE ELSE 0::DOUBLE END''')}) x
    JOIN sensors f ON CAST(substr(f.sensor_id, 6) AS BIGINT) = x.parent"""

SHIPMENTS = f"""
    SELECT {numbered('SHIP-', 'id', 7)} AS shipment_id, f.refinery_id,
           {sh.choice('crude', [c[0] for c in V.CRUDE_TYPES])} AS crude_type_id,
           {numbered('SUPP-', sh.whole('supplier', 1, 50), 3)} AS supplier_id,
           'MT ' || {sh.choice('vessel', V.VESSELS)} AS vessel_name,
           {sh.weighted('mode', V.TRANSPORT_MODES)} AS transport_mode, {sh.choice('port', V.PORTS)} AS origin_port,
           CAST(shipped AS VARCHAR) AS shipment_date, CAST(shipped + days AS VARCHAR) AS arrival_date,
           CAST(shipped + days - CAST({sh.below('early', 3)} AS INTEGER) AS VARCHAR) AS expected_arrival_date,
           volume AS volume_barrels, {sh.real('gravity', 20.0, 50.0)} AS api_gravity_actual,
           {sh.real('sulfur', 0.05, 4.0)} AS sulfur_content_actual, {sh.real('water', 0.0, 1.0)} AS water_content_pct,
           price AS price_per_barrel, volume * price AS total_cost, c.tank_id AS destination_tank_id,
           {sh.weighted('status', V.SHIPMENT_STATUSES)} AS status, CAST(shipped AS TIMESTAMP) AS created_at,
           CAST(shipped + days AS TIMESTAMP) AS updated_at
    FROM ({draws('shipments', 'refinery', shipped=sh.date('shipped', '2020-01-01', '2024-12-31'),
                 days=sh.whole('transit', 5, 45), volume=sh.whole('volume', 100000, 2500000, 50000),
                 price=sh.real('price', 40.0, 120.0), tank=sh.below('tank', '(SELECT count(*) FROM crude_tanks)'))}) x
    JOIN refineries f ON CAST(substr(f.refinery_id, 5) AS BIGINT) = x.parent
    LEFT JOIN crude_tanks c ON c.n = x.tank"""
CRUDE_TANKS = """SELECT tank_id, row_number() OVER (ORDER BY tank_id) - 1 AS n FROM tanks
                 WHERE product_type = 'Crude Oil'"""

TESTS = f"""
    SELECT {numbered('TEST-', 'id', 8)} AS test_id, f.refinery_id, source AS sample_source_type,
           {numbered('SRC-', q.below('sample', 1000000), 7)} AS sample_source_id,
           CASE WHEN source = 'Tank Sample' THEN {numbered('TANK-', 'tank', 5)} END AS tank_id,
           CAST({q.date('day', '2020-01-01', '2024-12-30')} AS TIMESTAMP) + to_seconds({q.below('second', 86400)})
             AS test_datetime,
           {q.weighted('type', V.TEST_TYPES)} AS test_type,
           {numbered('TECH-', q.whole('technician', 1, 100), 3)} AS technician_id,
           {q.real('gravity', 18.0, 55.0)} AS api_gravity, {q.real('sulfur', 0.01, 5.0)} AS sulfur_content_pct,
           {q.real('sediment', 0.0, 2.0)} AS water_sediment_pct, {q.real('viscosity', 1.0, 500.0)} AS viscosity_cst,
           {q.real('pour', -40.0, 60.0)} AS pour_point_f, {q.real('vapor', 5.0, 15.0)} AS reid_vapor_pressure,
           CASE WHEN {q.chance('has_octane', 0.7)} THEN {q.real('octane', 85.0, 95.0)} END AS octane_number,
           CASE WHEN {q.chance('has_cetane', 0.7)} THEN {q.real('cetane', 40.0, 55.0)} END AS cetane_number,
           {q.real('flash', 100.0, 250.0)} AS flash_point_f,
           {q.weighted('status', V.TEST_STATUSES)} AS test_result_status, {q.choice('notes', V.TEST_NOTES)} AS notes
    FROM ({draws('tests', 'refinery', source=q.weighted('source', V.SAMPLE_SOURCES),
                 tank=q.below('tank', '(SELECT count(*) FROM tanks)'))}) x
    JOIN refineries f ON CAST(substr(f.refinery_id, 5) AS BIGINT) = x.parent"""

INVENTORY = f"""
    SELECT {i.text_id('inventory')} AS inventory_id, f.tank_id, f.refinery_id, moment AS measurement_timestamp,
           CAST(trunc(fill * f.capacity_barrels) AS INTEGER) AS volume_barrels, fill AS fill_percentage,
           {i.real('temperature', 60.0, 120.0)} AS temperature_f, {i.real('water', 0.0, 12.0)} AS water_bottom_inches,
           f.product_type,
           CASE WHEN f.product_type = 'Crude Oil' THEN {numbered('CRUDE-', i.whole('crude', 1, 15), 3)} END
             AS crude_type_id,
           CASE WHEN f.product_type <> 'Crude Oil' THEN {numbered('PROD-', i.whole('item', 1, 14), 3)} END
             AS product_id,
           {i.weighted('gauge', V.GAUGES)} AS measurement_method, {i.chance('verified', 0.05)} AS is_verified
    FROM ({draws('inventory', 'tank', fill=i.real('fill', 0.15, 0.92),
                 moment=at_time(f"{i.below('day', S.HISTORY_DAYS)} * 86400 + {i.below('slot', 96)} * 900"))}) x
    JOIN tanks f ON CAST(substr(f.tank_id, 6) AS BIGINT) = x.parent"""

PRODUCTION = f"""
    SELECT {p.text_id('output')} AS output_id, f.unit_id, f.refinery_id, moment AS production_hour,
           volume AS input_volume_barrels, {p.choice('crude', [c[0] for c in V.CRUDE_TYPES])} AS input_crude_type_id,
           {p.choice('product', [x[0] for x in V.PRODUCTS])} AS output_product_id,
           CAST(trunc(volume * share) AS INTEGER) AS output_volume_barrels, share AS yield_percentage,
           {p.real('energy', 500.0, 2500.0)} AS energy_consumed_mmbtu,
           {p.real('temperature', 400.0, 900.0)} AS operating_temperature_f,
           {p.real('pressure', 20.0, 100.0)} AS operating_pressure_psi,
           {p.choice('downtime', V.DOWNTIME_MINUTES)} AS downtime_minutes, {p.weighted('grade', V.GRADES)} AS quality_grade,
           {p.choice('shift', V.SHIFTS)} AS shift_id
    FROM ({draws('production', 'unit', volume=p.whole('input', 3000, 10000, 100), share=p.real('yield', 0.75, 0.98),
                 moment=at_time(f"{p.below('day', S.HISTORY_DAYS)} * 86400 + {p.below('hour', 24)} * 3600"))}) x
    JOIN units f ON CAST(substr(f.unit_id, 6) AS BIGINT) = x.parent"""

CTES = {"refineries": REFINERIES, "units": UNITS, "sensors": SENSORS, "tanks": TANKS, "crude_tanks": CRUDE_TANKS}


def chain(body: str, *needed: str) -> str:
    if not needed:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in needed) + body


def staged(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """Parents are written once: their count and size then come from the files."""
    path = fresh_dir(t.spark, f"synth-{name}")
    write_path(df, path)
    return read_table(t.spark, path)


def refineries(t: Tables) -> DataFrame:
    return S.build_refineries(ids(t, "refineries"), SEED)


def units(t: Tables) -> DataFrame:
    return S.build_units(ids(t, "units"), staged(t, refineries(t), "refineries"), SEED)


def sensors(t: Tables) -> DataFrame:
    return S.build_sensors(ids(t, "sensors"), staged(t, units(t), "units"), SEED)


def tanks(t: Tables) -> DataFrame:
    return S.build_tanks(ids(t, "tanks"), staged(t, refineries(t), "refineries"), SEED)


def sites_and_tanks(t: Tables) -> tuple[DataFrame, DataFrame]:
    sites = staged(t, refineries(t), "refineries")
    return sites, staged(t, S.build_tanks(ids(t, "tanks"), sites, SEED), "tanks")


query("synth_refineries", chain(REFINERIES))(refineries)
query("synth_processing_units", chain(UNITS, "refineries"))(units)
query("synth_sensors", chain(SENSORS, "refineries", "units"))(sensors)
query("synth_storage_tanks", chain(TANKS, "refineries"))(tanks)


@query("synth_sensor_readings", chain(READINGS, "refineries", "units", "sensors"))
def synth_readings(t: Tables):
    return S.build_readings(ids(t, "readings"), staged(t, sensors(t), "sensors"), SEED)


@query("synth_crude_shipments", chain(SHIPMENTS, "refineries", "tanks", "crude_tanks"))
def synth_shipments(t: Tables):
    return S.build_shipments(ids(t, "shipments"), *sites_and_tanks(t), SEED)


@query("synth_quality_tests", chain(TESTS, "refineries", "tanks"))
def synth_tests(t: Tables):
    return S.build_quality_tests(ids(t, "tests"), *sites_and_tanks(t), SEED)


@query("synth_tank_inventory", chain(INVENTORY, "refineries", "tanks"))
def synth_inventory(t: Tables):
    return S.build_tank_inventory(ids(t, "inventory"), staged(t, tanks(t), "tanks"), SEED)


@query("synth_production_output", chain(PRODUCTION, "refineries", "units"))
def synth_production(t: Tables):
    return S.build_production(ids(t, "production"), staged(t, units(t), "units"), SEED)
