"""Snapshot tables, merged streams, and gold views kept from what is new."""

import math
import shutil

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from plantlake.functions.columns import inline_rows
from plantlake.operators.latest import latest_per_key
from plantlake.plans import gold, incremental
from plantlake.plans.datasets import Lake
from plantlake.sources.files import parquet_stream
from plantlake.sources.snapshots import LISTING, Snapshots
from plantlake.streaming.ingest import append_stream, run_to_end
from plantlake.streaming.merge import merge_stream, upsert_latest

NAMES = ["refinery_id", "unit_id", "sensor_type", "s", "reading_value", "alert_status"]


def frame(spark, *pairs):
    return inline_rows(spark, ["p", "v"], list(pairs))


def test_parts_are_replaced_in_one_commit(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"))
    assert not store.exists() and store.commit().version == -1
    with pytest.raises(ValueError):
        store.read()
    store.replace(frame(spark, ("a", 1), ("b", 2), (None, 3)), F.col("p"))
    before, first = store.read(), store.commit()
    assert rows(before.select("v"), "v") == [(1,), (2,), (3,)] and before.columns == ["p", "v"]
    store.replace(frame(spark, ("b", 20), ("b", 21)), F.col("p"), ["b", "c"], "q", 4)
    now = store.commit()
    assert rows(store.read().select("v"), "v") == [(1,), (3,), (20,), (21,)]
    assert rows(store.read(["b", "null"]).select("v"), "v") == [(3,), (20,), (21,)]
    assert {p for p in now.parts if now.parts[p] != first.parts.get(p)} == {"b"}
    assert rows(before.select("v"), "v") == [(1,), (2,), (3,)]  # a reader of the older commit is not disturbed
    assert store.holds("q", 4) and store.holds("q", 3) and not store.holds("q", 5) and not store.holds("other", 1)
    store.replace(frame(spark, ("a", 1)).where("v > 9"), F.col("p"), ["a", "b", "null"])
    assert store.read().count() == 0 and store.read().columns == ["p", "v"]


def test_rows_of_other_parts_and_lost_races(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "t"))
    store.replace(frame(spark, ("a", 1)), F.col("p"))
    with pytest.raises(ValueError, match="other parts"):
        store.replace(frame(spark, ("a", 1), ("z", 1)), F.col("p"), ["a"])
    stale = store.commit()
    store.replace(frame(spark, ("a", 2)), F.col("p"), ["a"])
    racing = Snapshots(spark, str(tmp_path / "t"))
    monkeypatch.setattr(racing, "commit", lambda version=None: stale)
    with pytest.raises(Exception):
        racing.replace(frame(spark, ("a", 3)), F.col("p"), ["a"])
    assert rows(store.read().select("v"), "v") == [(2,)]


def test_failed_write_leaves_the_table(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"))
    store.replace(frame(spark, ("a", 1)), F.col("p"))
    with pytest.raises(Exception):
        store.replace(frame(spark, ("a", 1)).select("p", F.raise_error(F.lit("broken")).alias("v")), F.col("p"))
    assert rows(store.read().select("v"), "v") == [(1,)]


def test_vacuum(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"))
    for k in range(5):
        store.replace(frame(spark, ("a", k), ("b", k)) if not k else frame(spark, ("a", k)), F.col("p"), ["a", "b"] if not k else ["a"])
    store.vacuum(keep=2)
    assert store.commits() == [3, 4] and len(list((tmp_path / "t" / "data").iterdir())) == 3
    assert rows(store.read(), "p") == [("a", 4), ("b", 0)] and rows(store.read(version=3), "p") == [("a", 3), ("b", 0)]


def readings(spark, data):
    return (inline_rows(spark, NAMES, data).withColumn("reading_timestamp", F.col("s").cast("timestamp")).drop("s")
            .withColumn(gold.PARTITION_DATE, F.to_date("reading_timestamp")))


def some(day, n, unit=1, value=1.0, status="CRITICAL", minute=0):
    return [(1, unit, "t", f"2024-01-{day:02d} 10:{minute:02d}:{k:02d}", value + k, status) for k in range(n)]


class Silver:
    """A silver table that grows."""

    def __init__(self, spark, root):
        self.spark, self.lake = spark, Lake(spark, str(root / "lake"))
        self.src = str(root / "landing")

    def add(self, data):
        rows_in = readings(self.spark, data)
        rows_in.coalesce(1).write.mode("append").parquet(self.src)
        name = "silver_sensor_readings"
        run_to_end(append_stream(parquet_stream(self.spark, self.src), self.lake.path(name), self.lake.checkpoint(name), [gold.PARTITION_DATE]))

    def full(self):
        return shown(gold.anomaly_alerts(self.lake.table("silver_sensor_readings")))


def shown(alerts):
    out = []
    for r in alerts.collect():
        d = r.asDict(recursive=True)
        out.append(tuple((k, round(v, 9) if isinstance(v, float) else str(v)) for k, v in sorted(d.items())))
    return sorted(out)


VIEW = "gold_anomaly_alerts"


def test_refresh_rewrites_touched_days_only(spark, tmp_path):
    silver = Silver(spark, tmp_path)
    silver.add([r for d in range(1, 6) for r in some(d, 3)])
    silver.lake.refresh_new(VIEW)
    store = silver.lake.store(VIEW)
    first, before = store.commit(), silver.lake.table(VIEW)
    old = shown(before)
    assert len(first.parts) == 5 and old == silver.full()
    # A window of day 2 grows, day 9 is new; groups without alerts have no row in the view, but count later.
    silver.add([*some(2, 4, value=100.0), *some(9, 5, unit=2, status="WARNING"), *some(2, 1, unit=3, status="NORMAL")])
    silver.lake.refresh_new(VIEW)
    second = store.commit()
    assert {d for d, f in second.parts.items() if first.parts.get(d) != f} == {"2024-01-02"}
    assert shown(silver.lake.table(VIEW)) == silver.full() != old
    assert shown(before) == old  # a reader of before the refresh
    silver.add(some(9, 1, unit=2, status="WARNING", value=50.0))  # the sixth warning
    silver.lake.refresh_new(VIEW)
    third = store.commit()
    assert {d for d, f in third.parts.items() if second.parts.get(d) != f} == {"2024-01-09"}
    assert shown(silver.lake.table(VIEW)) == silver.full()
    silver.lake.refresh_new(VIEW)  # nothing new
    assert store.commit() == third
    silver.lake.refresh(VIEW)
    assert shown(silver.lake.table(VIEW)) == silver.full()
    silver.add(some(3, 2, value=7.0))
    silver.lake.refresh_new(VIEW)  # after a full refresh as well
    assert shown(silver.lake.table(VIEW)) == silver.full()


def test_refresh_goes_on_after_a_crash_between_its_commits(spark, tmp_path, monkeypatch):
    silver = Silver(spark, tmp_path)
    silver.add(some(1, 3))
    silver.lake.refresh_new(VIEW)
    silver.add([*some(1, 2, value=9.0), *some(2, 3)])
    real = Snapshots.replace

    def broken(self, *args, **options):
        if self.root.endswith(f"lake/{VIEW}"):
            raise OSError("lost")
        return real(self, *args, **options)

    monkeypatch.setattr(Snapshots, "replace", broken)
    with pytest.raises(Exception):
        silver.lake.refresh_new(VIEW)
    monkeypatch.setattr(Snapshots, "replace", real)
    assert len(silver.lake.store(VIEW).commit().parts) == 1
    silver.lake.refresh_new(VIEW)  # repeats the batch, whose sums are in the store already
    assert shown(silver.lake.table(VIEW)) == silver.full()


def test_sums_belong_to_one_checkpoint(spark, tmp_path):
    silver = Silver(spark, tmp_path)
    silver.add(some(1, 3))
    silver.lake.refresh_new(VIEW)
    shutil.rmtree(silver.lake.checkpoint(VIEW))
    with pytest.raises(Exception, match="another checkpoint"):
        silver.lake.refresh_new(VIEW)
    assert shown(silver.lake.table(VIEW)) == silver.full()


def test_published_view_reads_a_commit(spark, tmp_path):
    silver = Silver(spark, tmp_path)
    silver.add([*some(1, 3), *some(2, 3)])
    silver.lake.refresh_new(VIEW)
    silver.lake.publish("kept", [VIEW])
    assert shown(spark.table(f"kept.{VIEW}")) == silver.full()
    silver.add(some(2, 2, value=9.0))
    silver.lake.refresh_new(VIEW)
    assert shown(spark.table(f"kept.{VIEW}")) != silver.full()
    silver.lake.publish("kept", [VIEW])
    assert shown(spark.table(f"kept.{VIEW}")) == silver.full()


def test_moments_merge_without_cancelling(spark):
    data = [(k % 2, k % 7, 1e9 + (k % 13) * 0.001) for k in range(400)] + [(0, 1, None), (2, 0, None), (3, 0, 5.0)]
    df = spark.createDataFrame(data, "g int, p int, v double")
    parts = incremental.reduced(df, {"g": F.col("g"), "p": F.col("p")}, {"total": F.sum("p")}, ("v",))
    got = incremental.combined(parts, ["g"], ["total"], ("v",)).withColumn("dev", incremental.deviation("v"))
    want = {r.g: r for r in df.groupBy("g").agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.stddev_samp("v").alias("d"), F.sum("p").alias("t"),
                                                F.min("v").alias("a"), F.max("v").alias("b")).collect()}
    for r in got.collect():
        w = want[r.g]
        assert (r.row_count, r.total, r.v_min, r.v_max) == (w.n, w.t, w.a, w.b)
        assert (r.v_mean is None) == (w.m is None) and (w.m is None or math.isclose(r.v_mean, w.m, rel_tol=1e-15))
        assert (r.dev is None) == (w.d is None) and (w.d is None or math.isclose(r.dev, w.d, rel_tol=1e-4))  # squares of 1e18 would leave no digit


def test_moments_merge_without_sorted_windows(spark):
    data = [(g, p, 1e6 + g + 0.25 * p + 0.5 * k) for g in range(5) for p in range(6) for k in range(p % 3 + 1)]
    df = spark.createDataFrame([*data, (7, 0, None)], "g int, p int, v double")
    parts = incremental.reduced(df, {"g": F.col("g"), "p": F.col("p")}, {}, ("v",))
    got = incremental.combined(parts, ["g"], [], ("v",))
    assert "Window" not in plan(got) and "Sort" not in plan(got)  # which held all rows of a task in memory, twice
    want = {r.g: r for r in df.groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_samp("v").alias("d")).collect()}
    for r in got.withColumn("dev", incremental.deviation("v")).collect():
        w = want[r.g]
        assert r.v_n == w.n and (r.v_mean is None) == (w.m is None) and (w.m is None or math.isclose(r.v_mean, w.m, rel_tol=1e-15))
        assert (r.dev is None) == (w.d is None) and (w.d is None or math.isclose(r.dev, w.d, rel_tol=1e-9))
    lone = incremental.combined(parts, ["g", "p"], [], ("v",)).select(sorted(parts.columns))
    assert rows(lone, "g", "p") == rows(parts.select(sorted(parts.columns)), "g", "p")  # a part by itself stays as it is


def test_parts_of_far_apart_sizes_and_means(spark):
    parts = spark.createDataFrame([(1, 10 ** 9, 10 ** 9, 5.0, 4e9, 0.0, 9.0), (1, 1, 1, 50.0, 0.0, 50.0, 50.0)],
                                  "g int, row_count long, v_n long, v_mean double, v_m2 double, v_min double, v_max double")
    got = incremental.combined(parts, ["g"], [], ("v",)).first()
    assert got.v_n == 10 ** 9 + 1 and math.isclose(got.v_m2, 4e9 + 45.0 ** 2, rel_tol=1e-12)


def test_first_batch_is_stored_without_merging(spark, tmp_path):
    src, calls = str(tmp_path / "src"), []
    summed = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))

    def combine(df):
        calls.append(df)
        return summed(df)

    store, then = Snapshots(spark, str(tmp_path / "t")), []
    for wave in (1, 2):
        spark.range(20).select((F.col("id") % 3).alias("k"), F.lit(wave).cast("long").alias("n")).write.mode("append").parquet(src)
        run_to_end(merge_stream(parquet_stream(spark, src), store, summed, combine, F.col("k"), str(tmp_path / "cp"),
                                lambda parts, query, batch: then.append(sorted(parts)), owned=True))
        assert len(calls) == wave - 1 and then == [["0", "1", "2"]] * wave
    assert rows(store.read(), "k") == [(0, 21), (1, 21), (2, 18)]


def test_many_parts_are_listed_by_few_tasks(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"))
    store.replace(spark.range(90).select("id"), F.col("id"))
    before = spark.conf.get(LISTING)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        df = store.read()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
        stages = [s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
        tasks = sum(spark.sparkContext.statusTracker().getStageInfo(s).numTasks for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < tasks <= 4 * spark.sparkContext.defaultParallelism < 90
    assert df.count() == 90 and spark.conf.get(LISTING) == before


def batches(spark, src, part):
    inline_rows(spark, ["id", "k", "s"], part).select("id", "k", F.col("s").cast("timestamp_ntz").alias("ts")).coalesce(1).write.mode("append").parquet(src)


def test_upsert_rewrites_buckets_of_changed_keys(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))
    run = lambda: run_to_end(upsert_latest(parquet_stream(spark, src), dst, cp, ["k"], "ts", ["id"], buckets=16))
    store = Snapshots(spark, dst)
    batches(spark, src, [(k, f"k{k}", "2024-01-01 00:00:00") for k in range(60)])
    run()
    first = store.commit()
    batches(spark, src, [(100, "k3", "2024-01-02 00:00:00"), (101, "k3", "2024-01-02 00:00:00"), (102, "k4", "2023-01-01 00:00:00"), (103, None, "2024-01-01 00:00:00")])
    run()
    second = store.commit()
    assert 1 <= sum(first.parts.get(p) != f for p, f in second.parts.items()) <= 3 < len(second.parts)
    want = latest_per_key(spark.read.parquet(src), ["k"], "ts", ["id"])
    assert rows(store.read(), "k") == rows(want, "k")
    # The same batch once more, as after a crash before its commit in the checkpoint: nothing changes.
    (tmp_path / "cp" / "commits" / "1").unlink()
    for crc in (tmp_path / "cp" / "commits").glob(".1.crc"):
        crc.unlink()
    run()
    assert store.commit() == second


def test_upsert_of_a_crowded_key(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))
    spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
                             F.timestamp_seconds(F.col("id") % 50).alias("ts")).repartition(4).write.parquet(src)
    run_to_end(upsert_latest(parquet_stream(spark, src), dst, cp, ["k"], "ts", ["id"], buckets=4))
    assert rows(Snapshots(spark, dst).read(), "k") == rows(latest_per_key(spark.read.parquet(src), ["k"], "ts", ["id"]), "k")
