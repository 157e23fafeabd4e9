"""Synthetic tables: counts, keys, bounds, weights, repeatability; bronze to gold on them."""

import pytest
from pyspark.sql import functions as F

from plantlake.plans import synth as S, synth_values as V
from plantlake.plans.datasets import DATASETS, LIVE, TENANT, Lake
from plantlake.schema import PLANT_TABLES, column_names
from plantlake.sources.records import to_records
from plantlake.sources.tables import read_table


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plant"))
    # 0.00001 of the fact sizes on 12 sites
    counts = S.build_all(spark, folder, scale=0.00001, seed=3, refineries=12)
    return folder, {r.table_name: r.row_count for r in counts.collect()}


def test_all_tables_have_their_columns_and_rows(spark, root):
    folder, counts = root
    assert set(counts) == set(PLANT_TABLES)
    assert counts["dim_refineries"] == 12 and counts["dim_processing_units"] == 120
    assert counts["dim_sensors"] == 12000 and counts["dim_crude_types"] == 15 and counts["dim_products"] == 14
    assert counts["fact_sensor_readings"] == int(S.FULL_SIZES["fact_sensor_readings"] * 0.00001)
    for name in PLANT_TABLES:
        assert read_table(spark, f"{folder}/{name}").columns == column_names(name)


@pytest.mark.parametrize("table, key", [
    ("dim_refineries", "refinery_id"), ("dim_processing_units", "unit_id"), ("dim_sensors", "sensor_id"),
    ("dim_storage_tanks", "tank_id"), ("fact_crude_shipments", "shipment_id"), ("fact_quality_tests", "test_id"),
    ("fact_tank_inventory", "inventory_id"), ("fact_production_output", "output_id"),
    ("fact_sensor_readings", "reading_id")])
def test_keys_are_unique(spark, root, table, key):
    df = read_table(spark, f"{root[0]}/{table}")
    assert df.select(key).distinct().count() == df.count()


def test_references_and_bounds(spark, root):
    def t(name):
        return read_table(spark, f"{root[0]}/{name}")

    assert t("dim_sensors").join(t("dim_processing_units"), ["unit_id", "refinery_id"], "left_anti").isEmpty()
    assert t("fact_sensor_readings").join(t("dim_sensors"), ["sensor_id", "unit_id"], "left_anti").isEmpty()
    crude = t("dim_storage_tanks").where("product_type = 'Crude Oil'")
    assert t("fact_crude_shipments").join(crude, F.col("destination_tank_id") == F.col("tank_id"), "left_anti").isEmpty()
    inventory = t("fact_tank_inventory")
    assert inventory.where("not (fill_percentage between 0.15 and 0.92)").isEmpty()
    assert inventory.where("(crude_type_id is null) = (product_id is null)").isEmpty()
    shipments = t("fact_crude_shipments")
    assert shipments.where("datediff(arrival_date, shipment_date) not between 5 and 45").isEmpty()
    assert shipments.where("datediff(arrival_date, expected_arrival_date) not between 0 and 2").isEmpty()
    assert shipments.where("volume_barrels % 50000 <> 0 or volume_barrels not between 100000 and 2500000").isEmpty()
    readings = t("fact_sensor_readings")
    assert readings.where("not (reading_timestamp between '2024-01-01' and '2024-12-31')").isEmpty()
    tests = t("fact_quality_tests")
    assert tests.where("(sample_source_type = 'Tank Sample') <> (tank_id is not null)").isEmpty()


def test_draws_are_uniform_and_weighted(spark):
    d = S.Draws(11, "x")
    df = S.rows(spark, 40000).select(
        d.unit("a").alias("a"), d.unit("b").alias("b"), d.weighted("q", V.QUALITY_LABELS).alias("q"),
        d.whole("w", 10, 20, 5).alias("w"), d.choice("c", ["x", "y", "z"]).alias("c"))
    r = df.agg(F.avg("a"), F.stddev("a"), F.corr("a", "b"), F.min("a"), F.max("a"),
               F.avg((F.col("q") == "GOOD").cast("int")), F.avg((F.col("q") == "BAD").cast("int")),
               F.collect_set("w"), F.collect_set("c")).collect()[0]
    assert abs(r[0] - 0.5) < 0.01 and abs(r[1] - 0.2887) < 0.01 and abs(r[2]) < 0.02
    assert 0 <= r[3] and r[4] < 1
    assert abs(r[5] - 0.97) < 0.01 and abs(r[6] - 0.005) < 0.003
    assert set(r[7]) == {10, 15, 20} and set(r[8]) == {"x", "y", "z"}


def test_large_row_numbers_do_not_overflow(spark):
    d = S.Draws(5, "x")
    ids = spark.range(2 ** 52, 2 ** 52 + 50)
    r = ids.select(d.unit("a").alias("a")).agg(F.countDistinct("a"), F.min("a"), F.max("a")).collect()[0]
    assert r[0] == 50 and 0 <= r[1] and r[2] < 1


def test_same_seed_same_rows_whatever_the_partitions(spark):
    def built(parts, seed):
        sites = S.build_refineries(S.rows(spark, 50, parts), seed)
        return S.build_units(S.rows(spark, 200, parts), sites, seed)

    assert built(1, 4).exceptAll(built(7, 4)).isEmpty()
    assert built(1, 4).exceptAll(built(1, 5)).count() > 100


def test_long_numbers_are_not_cut(spark):
    out = spark.range(998, 1002).select(S.numbered("REF-", F.col("id"), 3)).collect()
    assert [r[0] for r in out] == ["REF-998", "REF-999", "REF-1000", "REF-1001"]


def test_bronze_to_gold(spark, root, tmp_path):
    folder, counts = root
    lake = Lake(spark, str(tmp_path))
    for table in PLANT_TABLES:
        lake.ingest(f"bronze_{table}", f"{folder}/{table}")
    # The live feed redelivers the history as JSON records.
    landing = str(tmp_path / "landing")
    history = read_table(spark, f"{folder}/fact_sensor_readings")
    to_records(history.withColumn("reading_id", F.concat(F.lit("live-"), "reading_id")), "sensor_id").write.parquet(landing)
    from plantlake.sources.files import parquet_stream
    lake.ingest_live(parquet_stream(spark, landing))
    assert lake.table(LIVE).where("reading_timestamp is null or reading_value is null").isEmpty()
    lake.ingest(TENANT, f"{folder}/fact_sensor_readings", tenant="other")
    assert lake.table(TENANT).where("tenant = 'other'").count() == counts["fact_sensor_readings"]
    lake.update("silver_sensor_readings", files_per_partition=1)
    for name in ("silver_shipments", "silver_production", "silver_tank_inventory"):
        lake.update(name)
    for name, d in DATASETS.items():
        if d.layer == "gold":
            options = {"as_of": F.to_date(F.lit("2024-12-31"))} if name == "gold_equipment_health" else {}
            lake.refresh(name, **options)
    silver = lake.table("silver_sensor_readings")
    active = read_table(spark, f"{folder}/dim_sensors").where("is_active")
    assert silver.count() == 2 * history.join(active, "sensor_id", "left_semi").count()
    assert lake.table("silver_shipments").count() == counts["fact_crude_shipments"]
    assert lake.table("silver_production").where("refinery_name is null or crude_name is null").isEmpty()
    health = lake.table("gold_equipment_health")
    assert health.select("unit_id").distinct().count() == counts["dim_processing_units"]
    assert health.where("health_score not between 0 and 100").isEmpty()
    kpis = lake.table("gold_refinery_kpis")
    produced = lake.table("silver_production").agg(F.sum("output_volume_barrels")).collect()[0][0]
    assert kpis.agg(F.sum("total_products_produced")).collect()[0][0] == produced
    assert kpis.where("on_spec_rate not between 0 and 1").isEmpty()
    tanks = lake.table("gold_inventory_status")
    assert tanks.count() == lake.table("silver_tank_inventory").select("tank_id").distinct().count()
    assert lake.table("gold_product_yield").agg(F.sum("sample_count")).collect()[0][0] == counts["fact_production_output"]
    assert lake.table("gold_anomaly_alerts").where("critical_count = 0 and warning_count <= 5").isEmpty()
    assert lake.table("gold_inventory_by_tank").where("refinery_name is null").isEmpty()
    lake.publish("plant", ["silver_production", "gold_refinery_kpis"])
    assert spark.table("plant.silver_production").count() == counts["fact_production_output"]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED plant.gold_refinery_kpis").collect()}
    assert described["Comment"] == DATASETS["gold_refinery_kpis"].comment and "quality=gold" in described["Table Properties"]
    lake.update("silver_sensor_readings")  # nothing new
    assert lake.table("silver_sensor_readings").count() == silver.count()


def test_redelivered_live_records_are_stored_once(spark, root, tmp_path):
    from plantlake.sources.files import parquet_stream
    folder, counts = root
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    history = read_table(spark, f"{folder}/fact_sensor_readings")
    to_records(history.union(history), "sensor_id").write.parquet(landing)
    lake.ingest_live(parquet_stream(spark, landing), unique_within="10 minutes")
    assert lake.table(LIVE).count() == counts["fact_sensor_readings"]


def test_continuous_feed_keeps_running(spark, root, tmp_path):
    from plantlake.sources.files import parquet_stream
    folder, counts = root
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    to_records(read_table(spark, f"{folder}/fact_sensor_readings"), "sensor_id").write.parquet(landing)
    query = lake.ingest_live(parquet_stream(spark, landing), continuous="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and lake.table(LIVE).count() == counts["fact_sensor_readings"]
    finally:
        query.stop()
