"""Sources, sinks and record encoding."""

import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from plantlake.functions.columns import inline_rows
from plantlake.schema import PLANT_TABLES, READING_RECORD, column_names, struct, table_schema
from plantlake.sources.files import RESCUED, _pattern, csv_by_header, csv_stream, json_stream
from plantlake.sources.kafka import kafka_options
from plantlake.sources.records import decode_json, to_records
from plantlake.sources.tables import append_mapped, mapped, read_table, register_all, write_path, write_table
from plantlake.streaming.ingest import append_apart, append_stream, ingest_table, run_to_end


def test_schemas(spark):
    assert len(PLANT_TABLES) == 11
    assert table_schema("dim_sensors")["critical_low"].dataType.simpleString() == "double"
    assert len(struct(READING_RECORD).fields) == 13
    assert column_names("fact_sensor_readings")[-1] == "processing_time"


def test_scan_prunes_and_pushes_down(tables):
    text = plan(tables.orders.where("o_totalprice > 400000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,400000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_overwrite_sinks(spark, tmp_path):
    df = inline_rows(spark, ["a", "d"], [(1, "x"), (2, "y"), (3, "x")])
    path = str(tmp_path / "t")
    for _ in range(2):
        write_path(df, path, partition_by=["d"])
    assert read_table(spark, path).count() == 3 and (tmp_path / "t" / "d=x").is_dir()
    for _ in range(2):
        write_table(df, "overwritten")
    assert read_table(spark, "overwritten").count() == 3


def test_append_mapped_by_position_with_typed_null(spark, tmp_path):
    target = inline_rows(spark, ["id", "v", "t"], [(1, 1.5, "2024-01-01")]).withColumn("t", F.col("t").cast("timestamp"))
    source = inline_rows(spark, ["w", "id"], [(7, 2)])
    mapping = {"v": "w", "t": None}
    assert [f.dataType for f in mapped(source, target, mapping).schema] == [f.dataType for f in target.schema]
    write_table(target, "append_target")
    append_mapped(source, "append_target", mapping)
    path = str(tmp_path / "target")
    write_path(target, path)
    append_mapped(source, path, mapping)
    for name in ("append_target", path):
        assert rows(read_table(spark, name).select("id", "v", F.col("t").isNull()), "id") == [(1, 1.5, False), (2, 7.0, True)]


def test_register_all(spark, tmp_path):
    for name in ("one", "two"):
        write_path(inline_rows(spark, ["a"], [(1,), (2,)]), str(tmp_path / name))
    assert register_all(spark, str(tmp_path), ["one", "two"], "plant") == ["plant.one", "plant.two"]
    assert spark.table("plant.two").count() == 2
    register_all(spark, str(tmp_path), ["one"], "plant_ext", external=True)
    assert spark.table("plant_ext.one").count() == 2


def test_kafka_options():
    options = kafka_options("broker:9092", "readings", security={"security.protocol": "SASL_SSL"}, maxOffsetsPerTrigger="5")
    assert options == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "readings", "startingOffsets": "latest",
                       "kafka.security.protocol": "SASL_SSL", "maxOffsetsPerTrigger": "5"}


LINES = ["reading_id,reading_value,reading_timestamp", "a,1.5,2024-01-01T00:00:00", "b,oops,2024-01-01T00:00:01",
         "c,2.5,2024-01-01T00:00:02,extra", "d,,"]


def test_csv_rescues_bad_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("\n".join(LINES) + "\n")
    stream = csv_stream(spark, str(tmp_path / "in"), "reading_id string, reading_value double, reading_timestamp timestamp")
    run_to_end(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    out = rows(spark.read.parquet(str(tmp_path / "out")).select("reading_id", "reading_value", RESCUED), "reading_id")
    assert out == [("a", 1.5, None), ("b", None, LINES[2]), ("c", 2.5, LINES[3]), ("d", None, None)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text('{"reading_id": "a", "reading_value": 2}\n{bad\n')
    stream = json_stream(spark, str(tmp_path / "in"), "reading_id string, reading_value double")
    run_to_end(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "reading_id") == [(None, None), ("a", 2.0)]


RECORDS = ['{"reading_id":"a","reading_value":1.5,"is_interpolated":true,"event_time":"2024-01-01T00:00:00.000001Z"}',
           '{"reading_id":"b","reading_value":"2.5","is_interpolated":"false"}', '{"reading_id":"c","reading_value":"x"}',
           "not json", None]
FIELDS = "reading_id string, reading_value double, is_interpolated boolean, event_time timestamp"


def test_decode_json_strict_and_lenient(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    strict = decode_json(df, "value", FIELDS)
    assert strict.schema == struct(FIELDS)
    got = [tuple(r)[:3] for r in strict.collect()]
    assert got == [("a", 1.5, True), ("b", None, None), ("c", None, None), (None, None, None), (None, None, None)]
    binary = df.select(F.col("value").cast("binary").alias("value"))
    lenient = decode_json(binary, "value", FIELDS, lenient=True).collect()
    assert [tuple(r)[:3] for r in lenient] == [
        ("a", 1.5, True), ("b", 2.5, False), ("c", None, None), (None, None, None), (None, None, None)]
    assert lenient[0].event_time.microsecond == 1


def test_rescue_keeps_the_text_of_what_does_not_fit(spark):
    odd = [*RECORDS, '[{"reading_id":"d"}]', '{"reading_id":"e"', "", '{"other":1}', '{"reading_id":null}', '"text"', '{"reading_id":"f","reading_value":1e3}']
    df = spark.createDataFrame([(n, r) for n, r in enumerate(odd)], "n int, value string")
    strict = {r.n: r for r in decode_json(df, "value", FIELDS, keep=("n",), rescued="raw").collect()}
    lenient = {r.n: r for r in decode_json(df, "value", FIELDS, lenient=True, keep=("n",), rescued="raw").collect()}
    fits = {0: "a", 4: None, 8: None, 9: None, 11: "f"}
    for n, text in enumerate(odd):
        assert strict[n].raw == (None if n in fits else text), n
        assert strict[n].reading_id == fits.get(n)
        assert lenient[n].raw == (None if n in {**fits, 1: "b"} else text), n
    assert lenient[1].reading_value == 2.5 and lenient[2].reading_id == "c" and lenient[2].reading_value is None and lenient[11].reading_value == 1000.0


def test_broken_lines_go_to_quarantine_once(spark, tmp_path):
    src, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    (tmp_path / "in").mkdir()
    run = lambda: [run_to_end(q) for q in append_apart(json_stream(spark, src, "a int, b string", rescue=True), RESCUED, out, bad, str(tmp_path / "cp"))]
    (tmp_path / "in" / "1.json").write_text('{"a":1,"b":"x"}\n\n{bad\n{"a":"no number"}\n')
    run()
    (tmp_path / "in" / "2.json").write_text('{"a":2}\nnot at all\n')
    run()
    run()
    assert rows(spark.read.parquet(out), "a") == [(1, "x"), (2, None)]
    assert rows(spark.read.parquet(bad), RESCUED) == [("not at all",), ('{"a":"no number"}',), ("{bad",)]


def test_live_records_with_quarantine(spark, tmp_path):
    from plantlake.plans.datasets import LIVE, Lake
    from plantlake.sources.files import parquet_stream
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "in")
    texts = ['{"reading_id":"a","reading_value":1.5}', '{"reading_id":"b","reading_value":"none"}', "oops"]
    spark.createDataFrame([(x,) for x in texts], "value string").write.parquet(src)
    lake.ingest_live(parquet_stream(spark, src), quarantine=True)
    assert rows(lake.table(LIVE).select("reading_id", "reading_value"), "reading_id") == [("a", 1.5)]
    assert rows(lake.table(f"{LIVE}_quarantine"), RESCUED) == [("oops",), (texts[1],)]
    with pytest.raises(ValueError):
        lake.ingest_live(parquet_stream(spark, src), quarantine=True, unique_within="1 minute")


def test_csv_is_mapped_by_each_files_header(spark, tmp_path):
    import gzip
    folder = tmp_path / "in"
    folder.mkdir()
    run = lambda: run_to_end(append_stream(csv_by_header(spark, str(folder), "id int, v double, t string"), str(tmp_path / "out"), str(tmp_path / "cp")))
    (folder / "plain.csv").write_text("id,v,t\n1,1.5,a\n2,oops,b\n3,,\n")
    (folder / "shuffled.csv").write_text('\ufeff"t", v ,more,id\n"x, y",2.5,z,4\nshort,3.5\n')
    (folder / "lacking.csv").write_text("t\nonly\nt\n")
    (folder / "none.csv").write_text("")
    (folder / "head.csv").write_text("v,id\n")
    with gzip.open(folder / "packed.csv.gz", "wt") as file:
        file.write("id,t\n9,z,surplus\n")
    run()
    (folder / "later.csv").write_text("v,id,t\n7.5,7,c\n")
    run()
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=str) == sorted([
        (1, 1.5, "a", None), (2, None, "b", "2,oops,b"), (3, None, None, None), (4, 2.5, "x, y", None), (None, 3.5, "short", "short,3.5"),
        (None, None, "only", None), (9, None, "z", "9,z,surplus"), (7, 7.5, "c", None)], key=str)


def test_csv_file_without_known_header_fails(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id\n1\n")
    stream = csv_by_header(spark, str(folder), "id int")
    (folder / "b.csv").write_text("other,id\n2,3\n")
    with pytest.raises(Exception, match="no header was read"):
        run_to_end(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    again = csv_by_header(spark, str(folder), "id int")
    run_to_end(append_stream(again, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id"), "id") == [(1,), (3,)]


def test_to_records_round_trip(spark):
    df = inline_rows(spark, ["sensor_id", "v"], [("s1", 1.5), ("s2", None)])
    out = {r.key: json.loads(r.value) for r in to_records(df, "sensor_id").collect()}
    assert out == {"s1": {"sensor_id": "s1", "v": 1.5}, "s2": {"sensor_id": "s2"}}


def test_ingest_is_incremental(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))
    df = inline_rows(spark, ["a", "b"], [(1, "x"), (2, "y")])
    df.write.parquet(src)
    assert ingest_table(spark, src, dst, cp).count() == 2
    assert ingest_table(spark, src, dst, cp).count() == 2  # nothing new
    df.write.mode("append").parquet(src)
    assert ingest_table(spark, src, dst, cp).count() == 4  # only the new files


def test_ingest_projected_and_tenant(spark, tables, tmp_path):
    out = ingest_table(spark, tables.path("events"), str(tmp_path / "d"), str(tmp_path / "c"),
                       columns=["event_id", "ts"], tenant="north")
    assert out.columns == ["event_id", "ts", "tenant"] and out.where("tenant = 'north'").count() == 1000


def test_partitioned_backfill_writes_few_files(spark, tables, tmp_path):
    from plantlake.sources.files import parquet_stream
    rows_in = parquet_stream(spark, tables.path("events")).withColumn("d", F.to_date("ts"))
    run_to_end(append_stream(rows_in, str(tmp_path / "d"), str(tmp_path / "c"), ["d"], files_per_partition=2))
    folders = list((tmp_path / "d").glob("d=*"))
    assert len(folders) == 30 and all(len(list(f.glob("*.parquet"))) <= 2 for f in folders)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1000


def test_pattern(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "one.parquet").write_text("")
    assert _pattern(spark, f"{tmp_path}/folder/") == f"{tmp_path}/folder"
    assert _pattern(spark, f"{tmp_path}/one.parquet") == f"{tmp_path}/one.parque[t]"
    assert _pattern(spark, f"{tmp_path}/*.parquet") == f"{tmp_path}/*.parquet"


def test_stream_of_a_sink_reads_committed_files_only(spark, tables, tmp_path):
    from plantlake.sources.files import parquet_stream
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    spark.range(100).write.parquet(src)
    query = (spark.readStream.schema("id bigint").parquet(src).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c1"))
             .trigger(availableNow=True).start(sink))
    query.awaitTermination()
    spark.range(10).coalesce(1).write.mode("append").parquet(str(tmp_path / "stray"))
    stray = next((tmp_path / "stray").glob("part-*.parquet"))
    (tmp_path / "sink" / stray.name).write_bytes(stray.read_bytes())
    out = str(tmp_path / "out")
    parquet_stream(spark, sink).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 100


def test_stream_of_a_partitioned_folder(spark, tables, tmp_path):
    from pyspark.sql import functions as F
    from plantlake.sources.files import parquet_stream
    src, out = str(tmp_path / "days"), str(tmp_path / "all")
    tables.events.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(src)
    parquet_stream(spark, src).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == tables.events.count()


def test_csv_with_other_header_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("reading_value,reading_id\n7,5\n")
    stream = csv_stream(spark, str(tmp_path / "in"), "reading_id string, reading_value double")
    with pytest.raises(Exception):
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o")).awaitTermination()
