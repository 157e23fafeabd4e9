"""Silver and gold datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlake.functions.columns import settle
from plantlake.operators.latest import flat_window
from plantlake.plans import datasets as D, gold as G, silver as S
from plantlake.plans.datasets import Lake
from plantlake.queries import bindings as B
from plantlake.queries.aggregates import silver, silver_sql
from plantlake.queries.base import REGISTRY, Tables, query, settled, with_bound
from plantlake.session import fresh_dir
from plantlake.sources.files import parquet_stream
from plantlake.sources.tables import write_path
from plantlake.streaming.ingest import append_stream, run_to_end


@query("silver_readings", silver_sql("SELECT * FROM silver"))
def silver_readings(t: Tables):
    return silver(t)


@query("silver_shipments", with_bound("""
    SELECT s.*, r.refinery_name, r.location_city, r.location_state, r.capacity_bpd AS refinery_capacity_bpd,
           c.crude_name, c.classification AS crude_classification, c.sweetness AS crude_sweetness,
           c.api_gravity_typical, c.sulfur_content_typical,
           s.api_gravity_actual - c.api_gravity_typical AS api_gravity_variance,
           s.sulfur_content_actual - c.sulfur_content_typical AS sulfur_variance,
           CAST(s.arrival_date - s.expected_arrival_date AS INTEGER) AS days_delayed,
           s.total_cost / nullif(s.volume_barrels, 0) AS cost_per_barrel
    FROM shipped s LEFT JOIN sites r ON r.refinery_id = s.refinery_id
    LEFT JOIN crudes c ON c.crude_type_id = s.crude_type_id""", "shipments", "sites", "crudes",
    shipped="SELECT * FROM shipments").replace("SELECT s.*,", """SELECT s.* REPLACE (
           CAST(s.shipment_date AS VARCHAR) AS shipment_date, CAST(s.arrival_date AS VARCHAR) AS arrival_date,
           CAST(s.expected_arrival_date AS VARCHAR) AS expected_arrival_date),"""))
def silver_shipments(t: Tables):
    return S.silver_shipments(B.shipments(t.orders), B.sites(t.nation), B.crudes(t.region), stamp=False)


@query("silver_production", with_bound("""
    SELECT p.*, u.unit_name, u.unit_type, u.design_efficiency, u.capacity_bpd AS unit_capacity_bpd,
           r.refinery_name, d.product_name, d.product_category, c.crude_name,
           p.yield_percentage / u.design_efficiency AS efficiency_ratio,
           p.output_volume_barrels / (u.capacity_bpd / 24) AS capacity_utilization,
           p.energy_consumed_mmbtu / nullif(p.output_volume_barrels, 0) AS energy_per_barrel
    FROM production p LEFT JOIN units u ON u.unit_id = p.unit_id
    LEFT JOIN sites r ON r.refinery_id = p.refinery_id
    LEFT JOIN products d ON d.product_id = p.output_product_id
    LEFT JOIN crudes c ON c.crude_type_id = p.input_crude_type_id""",
    "production", "units", "sites", "products", "crudes"))
def silver_production(t: Tables):
    return S.silver_production(B.production(t.lineitem), B.units(t.supplier), B.sites(t.nation),
                               B.products(t.part), B.crudes(t.region), stamp=False)


SILVER_TANKS = f"""
    SELECT *, {B.BAND} AS inventory_status, {B.NEEDS_LOOK} AS requires_attention,
           {B.ROOM} AS available_capacity_barrels
    FROM tank_inventory WHERE volume_barrels >= 0 AND fill_percentage BETWEEN 0 AND 1"""


@query("silver_tank_inventory", with_bound("SELECT * FROM clean", "tank_inventory", clean=SILVER_TANKS))
def silver_tank_inventory(t: Tables):
    return S.silver_tank_inventory(B.tank_inventory(t.events), stamp=False)


ALERTS = f"""
    SELECT time_bucket(INTERVAL 5 MINUTES, reading_timestamp) AS window_start,
           time_bucket(INTERVAL 5 MINUTES, reading_timestamp) + INTERVAL 5 MINUTES AS window_end,
           refinery_id, unit_id, sensor_type, count(*) AS reading_count,
           count(*) FILTER (alert_status = 'CRITICAL') AS critical_count,
           count(*) FILTER (alert_status = 'WARNING') AS warning_count,
           {settled("avg(reading_value)")} AS avg_value, {settled("stddev_samp(reading_value)")} AS stddev_value,
           min(reading_value) AS min_value, max(reading_value) AS max_value,
           {settled('''sum(CASE alert_status WHEN 'CRITICAL' THEN 10 WHEN 'WARNING' THEN 3 ELSE 0 END)
                       / count(*)''')} AS alert_severity_score
    FROM silver GROUP BY ALL HAVING critical_count > 0 OR warning_count > 5"""


def shown_alerts(df):
    out = flat_window(df)
    return out.withColumns({c: settle(c) for c in ("avg_value", "stddev_value", "alert_severity_score")})


@query("gold_alerts", silver_sql(ALERTS))
def gold_alerts(t: Tables):
    return shown_alerts(G.anomaly_alerts(silver(t)))


HEALTH = f"""
    SELECT u.unit_id, u.unit_name, u.unit_type, u.refinery_id, r.refinery_name, s.reading_date,
           greatest(0::DOUBLE, 100 - s.rate * 500 - s.volatility / 10) AS health_score,
           CAST(DATE '{B.AS_OF_READINGS}' - u.last_maintenance_date AS INTEGER) AS days_since_maintenance,
           u.maintenance_interval_days,
           {B.due(f"(DATE '{B.AS_OF_READINGS}' - u.last_maintenance_date)", "u.maintenance_interval_days")}
             AS maintenance_status
    FROM maintained_units u LEFT JOIN scores s ON s.unit_id = u.unit_id
    LEFT JOIN sites r ON r.refinery_id = u.refinery_id"""
HEALTH_CTES = dict(
    typed=f"""SELECT unit_id, sensor_type, CAST(reading_timestamp AS DATE) AS reading_date,
                     stddev_samp(reading_value) AS volatility,
                     count(*) FILTER (alert_status <> 'NORMAL') / count(*) AS rate
              FROM silver WHERE reading_timestamp >= DATE '{B.AS_OF_READINGS}' - 7 GROUP BY ALL""",
    scores="""SELECT unit_id, reading_date, avg(rate) AS rate, avg(volatility) AS volatility
              FROM typed GROUP BY unit_id, reading_date""",
    health=HEALTH)


def health_sql(body: str, **extra: str) -> str:
    return with_bound(body, "readings", "sensors", "silver", "maintained_units", "sites", **HEALTH_CTES, **extra)


def health(t: Tables):
    return G.equipment_health(silver(t), B.maintained_units(t.customer), B.sites(t.nation),
                              B.as_of(B.AS_OF_READINGS))


@query("gold_equipment_health", health_sql(f"""
    SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date, {settled("health_score")} AS health_score)
    FROM health"""))
def gold_equipment_health(t: Tables):
    return health(t).withColumn("health_score", settle("health_score"))


KPIS = """
    SELECT r.refinery_id, r.refinery_name, r.location_city, r.location_state, r.capacity_bpd,
           CAST(p.production_hour AS DATE) AS production_date,
           sum(p.input_volume_barrels) AS total_crude_processed,
           sum(p.output_volume_barrels) AS total_products_produced,
           sum(p.output_volume_barrels) / sum(p.input_volume_barrels) AS overall_yield,
           sum(p.input_volume_barrels) / r.capacity_bpd AS capacity_utilization,
           sum(p.energy_consumed_mmbtu) / sum(p.output_volume_barrels) AS energy_intensity,
           CAST(sum(p.downtime_minutes) AS BIGINT) AS total_downtime_minutes,
           sum(p.downtime_minutes) / (count(DISTINCT p.unit_id) * 60) AS downtime_percentage,
           count(*) FILTER (p.quality_grade = 'N') / count(*) AS on_spec_rate
    FROM production p JOIN sites r ON r.refinery_id = p.refinery_id GROUP BY 1, 2, 3, 4, 5, 6"""
KPI_ROUNDED = ["total_products_produced", "overall_yield", "capacity_utilization", "energy_intensity",
               "downtime_percentage", "on_spec_rate"]


def kpis(t: Tables):
    return G.daily_kpis(B.production(t.lineitem), B.sites(t.nation), on_spec=B.ON_SPEC)


@query("gold_daily_kpis", with_bound(f"""
    SELECT * REPLACE (CAST(production_date AS VARCHAR) AS production_date,
                      {", ".join(f"{settled(c)} AS {c}" for c in KPI_ROUNDED)}) FROM kpis""",
    "production", "sites", kpis=KPIS))
def gold_daily_kpis(t: Tables):
    return kpis(t).withColumns({c: settle(c) for c in KPI_ROUNDED})


@query("refresh_gold", REGISTRY["gold_daily_kpis"].sql)
def refreshed_kpis(t: Tables):
    """The same figures through stored bronze and silver datasets."""
    lake = Lake(t.spark, fresh_dir(t.spark, "lake"))
    plant = {"fact_production_output": B.production(t.lineitem), "dim_processing_units": B.units(t.supplier),
             "dim_refineries": B.sites(t.nation), "dim_products": B.products(t.part), "dim_crude_types": B.crudes(t.region)}
    for name, rows in plant.items():
        landing = fresh_dir(t.spark, name)
        write_path(rows, landing)
        lake.ingest(f"bronze_{name}", landing)
    lake.update("silver_production", files_per_partition=1)
    lake.refresh("gold_refinery_kpis", on_spec=B.ON_SPEC)
    return lake.table("gold_refinery_kpis").withColumns({c: settle(c) for c in KPI_ROUNDED})


@query("gold_product_yield", with_bound(f"""
    SELECT c.crude_type_id, c.crude_name, c.classification AS crude_class, c.sweetness, d.product_id,
           d.product_name, d.product_category, {settled("avg(p.yield_percentage)", 6)} AS avg_yield,
           {settled("stddev_samp(p.yield_percentage)", 6)} AS yield_stddev, min(p.yield_percentage) AS min_yield,
           max(p.yield_percentage) AS max_yield, count(*) AS sample_count,
           {settled("avg(p.yield_percentage) - any_value(d.typical_yield_pct)", 6)} AS yield_vs_typical
    FROM production p JOIN crudes c ON c.crude_type_id = p.input_crude_type_id
    JOIN products d ON d.product_id = p.output_product_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7""", "production", "crudes", "products"))
def gold_product_yield(t: Tables):
    out = G.product_yield(B.production(t.lineitem), B.crudes(t.region), B.products(t.part))
    return out.withColumns({c: settle(c, 6) for c in ("avg_yield", "yield_stddev", "yield_vs_typical")})


LATEST_TANKS = """SELECT * FROM clean QUALIFY row_number() OVER (
                  PARTITION BY tank_id ORDER BY measurement_timestamp DESC, inventory_id DESC) = 1"""


@query("gold_inventory_a", with_bound(f"""
    SELECT n.tank_id, k.tank_name, n.refinery_id, n.product_type, n.volume_barrels, k.capacity_barrels,
           n.fill_percentage, n.volume_barrels / k.capacity_barrels AS capacity_utilization, n.inventory_status,
           {B.OPERATING} AS operating_status,
           n.requires_attention, n.available_capacity_barrels, n.temperature_f, n.water_bottom_inches,
           n.measurement_timestamp
    FROM newest n LEFT JOIN tanks k ON k.tank_id = n.tank_id""", "tank_inventory", "tanks",
    clean=SILVER_TANKS, newest=LATEST_TANKS))
def gold_inventory_a(t: Tables):
    return G.inventory_status_view(S.silver_tank_inventory(B.tank_inventory(t.events), stamp=False), B.tanks(t.events))


@query("gold_inventory_b", with_bound(f"""
    SELECT k.tank_id, k.tank_name, k.refinery_id, r.refinery_name, k.product_type, k.capacity_barrels,
           n.volume_barrels AS current_volume, n.fill_percentage, n.measurement_timestamp AS last_measured,
           {B.OWN_BAND} AS inventory_status
    FROM tanks k JOIN newest n ON n.tank_id = k.tank_id JOIN sites r ON r.refinery_id = k.refinery_id
    WHERE k.is_active""", "tank_inventory", "tanks", "sites", clean=SILVER_TANKS, newest=LATEST_TANKS))
def gold_inventory_b(t: Tables):
    return G.inventory_status_view(S.silver_tank_inventory(B.tank_inventory(t.events), stamp=False), B.tanks(t.events),
                                   B.sites(t.nation))


def kept_view(t: Tables, view: str, table: str, silver_of, ts: str, dims: dict, settings: dict | None = None, **options):
    """A view kept up to date over a silver table that grows twice. The second half reaches every day again."""
    lake, src = Lake(t.spark, fresh_dir(t.spark, "lake")), fresh_dir(t.spark, "landing")
    for name, rows in dims.items():
        write_path(rows, lake.path(name))
    silver_name = D.DATASETS[view].inputs[0]
    rows_of = getattr(t, table)
    half = F.pmod(F.xxhash64(*rows_of.columns), F.lit(2))
    for part in (0, 1):
        rows_of.where(half == part).write.mode("append").parquet(src)
        rows = silver_of(parquet_stream(t.spark, src)).withColumn(G.PARTITION_DATE, F.trunc(F.to_date(ts), "month"))
        run_to_end(append_stream(rows, lake.path(silver_name), lake.checkpoint(silver_name), [G.PARTITION_DATE], 1))
        lake.refresh_new(view, settings, **options)
    return lake.table(view)


def silver_of_events(t: Tables):
    return lambda events: S.silver_readings([B.readings(events)], B.sensors(t.spark), stamp=False)


@query("refresh_incremental", REGISTRY["gold_alerts"].sql)
def kept_alerts(t: Tables):
    return shown_alerts(kept_view(t, "gold_anomaly_alerts", "events", silver_of_events(t), "reading_timestamp", {}))


@query("refresh_incremental_kpis", REGISTRY["gold_daily_kpis"].sql)
def kept_kpis(t: Tables):
    out = kept_view(t, "gold_refinery_kpis", "lineitem", B.production, "production_hour", {"bronze_dim_refineries": B.sites(t.nation)},
                    {"on_spec": B.ON_SPEC})
    return out.withColumns({c: settle(c) for c in KPI_ROUNDED})


@query("refresh_incremental_health", REGISTRY["gold_equipment_health"].sql)
def kept_health(t: Tables):
    dims = {"bronze_dim_processing_units": B.maintained_units(t.customer), "bronze_dim_refineries": B.sites(t.nation)}
    out = kept_view(t, "gold_equipment_health", "events", silver_of_events(t), "reading_timestamp", dims, as_of=B.as_of(B.AS_OF_READINGS))
    return out.withColumn("health_score", settle("health_score"))


@query("refresh_incremental_yield", REGISTRY["gold_product_yield"].sql)
def kept_yield(t: Tables):
    dims = {"bronze_dim_crude_types": B.crudes(t.region), "bronze_dim_products": B.products(t.part)}
    out = kept_view(t, "gold_product_yield", "lineitem", B.production, "production_hour", dims)
    return out.withColumns({c: settle(c, 6) for c in ("avg_yield", "yield_stddev", "yield_vs_typical")})


@query("refresh_incremental_inventory", REGISTRY["gold_inventory_a"].sql)
def kept_inventory(t: Tables):
    dims = {"bronze_dim_storage_tanks": B.tanks(t.events)}
    return kept_view(t, "gold_inventory_status", "events", lambda e: S.silver_tank_inventory(B.tank_inventory(e), stamp=False),
                     "measurement_timestamp", dims, {"buckets": 8})
