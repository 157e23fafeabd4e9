"""Readings that wait for their sensor, and a dimension that changes under a running stream."""

import pytest
from conftest import rows

from plantlake.plans.datasets import Lake
from plantlake.queries import bindings as B
from plantlake.sources.snapshots import Snapshots

FEEDS = ("bronze_fact_sensor_readings", "bronze_fact_sensor_readings_stream")


class Plant:
    def __init__(self, spark, tables, root):
        self.spark, self.lake = spark, Lake(spark, str(root / "lake"))
        self.readings, self.sensors = B.readings(tables.events), B.sensors(spark)
        self.add("reading_id < 0", feed=1)

    def know(self, *ids):
        self.sensors.where(self.sensors.sensor_id.isin(*ids)).write.mode("append").parquet(self.lake.path("bronze_dim_sensors"))

    def add(self, condition, feed=0):
        self.readings.where(condition).coalesce(1).write.mode("append").parquet(self.lake.path(FEEDS[feed]))

    def waiting(self):
        return Snapshots(self.spark, f"{self.lake.root}/_waiting/silver_sensor_readings")

    def silver(self):
        return rows(self.lake.table("silver_sensor_readings").select("reading_id", "sensor_id", "warning_high"), "reading_id")

    def expected(self, condition, *ids):
        known = self.sensors.where(self.sensors.sensor_id.isin(*ids)).where("is_active")
        return rows(self.readings.where(condition).join(known, "sensor_id").select("reading_id", "sensor_id", "warning_high"), "reading_id")


@pytest.fixture
def plant(spark, tables, tmp_path):
    return Plant(spark, tables, tmp_path)


def test_earlier_readings_of_a_later_sensor(plant):
    plant.know("click", "view")
    plant.add("reading_id < 400")
    plant.lake.update_when_known()
    assert plant.silver() == plant.expected("reading_id < 400", "click")
    held = plant.readings.where("reading_id < 400 and sensor_id not in ('click', 'view')").count()
    assert plant.waiting().read().count() == held > 0
    plant.know("error")
    plant.add("reading_id between 400 and 700")
    plant.lake.update_when_known()
    assert plant.silver() == plant.expected("reading_id <= 700", "click", "error")
    plant.know("purchase", "signup")
    plant.add("reading_id > 700", feed=1)
    plant.lake.update_when_known()
    assert plant.silver() == plant.expected("true", "click", "error", "purchase", "signup")
    assert plant.waiting().read().count() == 0
    plant.lake.update_when_known()  # nothing new
    assert plant.silver() == plant.expected("true", "click", "error", "purchase", "signup")


@pytest.mark.parametrize("step", ["before the commit", "after the commit"])
def test_crash_while_the_dimension_changes(plant, monkeypatch, step):
    plant.know("click")
    plant.add("reading_id < 500")
    real = Snapshots.replace

    def broken(self, *args, **options):
        if step == "after the commit":
            real(self, *args, **options)
        raise OSError("lost")

    monkeypatch.setattr(Snapshots, "replace", broken)
    with pytest.raises(Exception):
        plant.lake.update_when_known()
    monkeypatch.setattr(Snapshots, "replace", real)
    plant.know("error")  # the repeated batch sees another dimension than the first attempt
    plant.lake.update_when_known()
    plant.add("reading_id >= 500")
    plant.lake.update_when_known()
    assert plant.silver() == plant.expected("true", "click", "error")
    assert plant.waiting().read().count() == plant.readings.where("sensor_id not in ('click', 'error')").count()


def test_running_stream_sees_new_sensors(plant):
    plant.know("click")
    plant.add("reading_id < 300")
    query = plant.lake.update_when_known(continuous="1 second")
    try:
        query.processAllAvailable()
        assert plant.silver() == plant.expected("reading_id < 300", "click")
        plant.know("purchase")
        plant.add("reading_id between 300 and 600")
        query.processAllAvailable()
        assert query.isActive and plant.silver() == plant.expected("reading_id <= 600", "click", "purchase")
    finally:
        query.stop()


def test_silver_can_be_streamed_on(plant):
    plant.know("click")
    plant.add("reading_id < 300")
    plant.lake.update_when_known()
    plant.lake.refresh_new("gold_anomaly_alerts")
    first = plant.lake.table("gold_anomaly_alerts").count()
    plant.know("error")
    plant.add("reading_id >= 300")
    plant.lake.update_when_known()
    plant.lake.refresh_new("gold_anomaly_alerts")
    from plantlake.plans import gold
    whole = gold.anomaly_alerts(plant.lake.table("silver_sensor_readings"))
    got = plant.lake.table("gold_anomaly_alerts")
    pick = ["unit_id", "sensor_type", "reading_count", "critical_count", "min_value"]
    assert got.count() > first and rows(got.select(*pick), *pick) == rows(whole.select(*pick), *pick)
