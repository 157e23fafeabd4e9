"""Schemas that grow, and distinct counts that merge."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantlake.plans import gold, incremental
from plantlake.plans.datasets import Lake
from plantlake.queries import bindings as B
from plantlake.schema import struct
from plantlake.sources.schemas import SchemaChange, merged, source_schema, widened

NAME = "bronze_dim_products"


def land(spark, src, ddl, *values):
    spark.createDataFrame(list(values), ddl).coalesce(1).write.mode("append").parquet(src)


def test_new_columns_and_wider_types_are_kept(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "src")
    land(spark, src, "id int, v float", (1, 1.5))
    lake.ingest(NAME, src)
    assert rows(lake.table(NAME), "id") == [(1, 1.5)]
    land(spark, src, "id int, v float, name string", (2, 2.5, "x"))
    lake.ingest(NAME, src)
    land(spark, src, "name string, id bigint, v double", ("y", 1 << 40, 0.1))
    lake.ingest(NAME, src)
    assert rows(lake.table(NAME), "id") == [(1, 1.5, None), (2, 2.5, "x"), (1 << 40, 0.1, "y")]
    land(spark, src, "id int", (4,))  # a file that lacks columns changes nothing
    lake.ingest(NAME, src)
    lake.ingest(NAME, src)
    assert lake.table(NAME).count() == 4
    assert [v.simpleString() for v in lake.schemas(NAME).versions()] == [
        "struct<id:int,v:float>", "struct<id:int,v:float,name:string>", "struct<id:bigint,v:double,name:string>"]
    out = str(tmp_path / "out")
    lake.stream(NAME).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
    assert rows(spark.read.parquet(out), "id") == rows(lake.table(NAME), "id")


def test_another_type_stops_with_its_column(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "src")
    land(spark, src, "id int, v double", (1, 1.5))
    lake.ingest(NAME, src)
    land(spark, src, "id int, v string", (2, "text"))
    with pytest.raises(SchemaChange, match="column v changed from double to string"):
        lake.ingest(NAME, src)
    assert rows(lake.table(NAME), "id") == [(1, 1.5)] and len(lake.schemas(NAME).versions()) == 1


def test_tenant_and_chosen_columns(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "src")
    land(spark, src, "id int, v double", (1, 1.5))
    lake.ingest(NAME, src, tenant="north")
    land(spark, src, "id int, v double, more string", (2, 2.5, "m"))
    lake.ingest(NAME, src, tenant="north")
    assert rows(lake.table(NAME).select("id", "v", "tenant", "more"), "id") == [(1, 1.5, "north", None), (2, 2.5, "north", "m")]
    lake.ingest("bronze_dim_sensors", src, columns=["id"])
    assert rows(lake.table("bronze_dim_sensors"), "id") == [(1,), (2,)]


def test_rules():
    wide = lambda a, b: widened(struct(f"x {a}")["x"].dataType, struct(f"x {b}")["x"].dataType, "x").simpleString()
    assert wide("int", "bigint") == wide("bigint", "int") == "bigint" and wide("float", "double") == "double"
    assert wide("decimal(10,2)", "decimal(8,4)") == "decimal(12,4)" and wide("array<int>", "array<bigint>") == "array<bigint>"
    assert wide("struct<a:int>", "struct<a:bigint,b:string>") == "struct<a:bigint,b:string>"
    for a, b in (("string", "int"), ("bigint", "double"), ("timestamp", "date"), ("decimal(38,0)", "decimal(38,10)"), ("boolean", "int")):
        with pytest.raises(SchemaChange, match="column x"):
            wide(a, b)
    both = merged(struct("A int, b string"), struct("c date, a bigint"))
    assert both.simpleString() == "struct<A:bigint,b:string,c:date>" and all(f.nullable for f in both.fields)


def test_source_schema_of_folders(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, f"{src}/day=2024-01-01", "id int", (1,))
    land(spark, f"{src}/day=2024-01-02", "id bigint, w string", (2, "x"))
    assert source_schema(spark, src).simpleString() == "struct<id:bigint,w:string,day:date>"


def test_sketched_units_merge(spark, tables):
    """Sketches of pieces of a day give the same estimate as one of the whole day, close to the exact count."""
    rows_in = spark.range(60_000).select(F.lit(3).alias("refinery_id"), (F.col("id") % 20_000).alias("unit_id"), F.timestamp_seconds(F.lit(0)).alias("production_hour"),
                                         *[F.lit(1.0).alias(c) for c in ("input_volume_barrels", "output_volume_barrels", "energy_consumed_mmbtu")],
                                         F.lit(6).alias("downtime_minutes"), F.lit("On-Spec").alias("quality_grade"))
    inc, sites = incremental.sketched_kpis(), B.sites(tables.nation)
    pieces = [inc.reduce(rows_in.where(F.col("unit_id") % 3 == k)) for k in range(3)]
    merged_once = inc.combine(pieces[0].unionByName(pieces[1]))
    got = inc.finish(inc.combine(merged_once.unionByName(pieces[2])), sites).collect()
    whole = inc.finish(inc.reduce(rows_in), sites).collect()
    assert got == whole and len(got) == 1
    exact = gold.daily_kpis(rows_in, sites).first()
    assert abs(exact.downtime_percentage / got[0].downtime_percentage - 1) < 4 * 1.04 / 64
    assert (got[0].total_crude_processed, got[0].on_spec_rate) == (exact.total_crude_processed, exact.on_spec_rate) == (60_000.0, 1.0)
