"""Operators against brute force on small rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from plantlake.functions.columns import inline_rows
from plantlake.operators import enrich as E, metrics as M
from plantlake.operators.latest import flat_window, latest_per_key, tumbling
from plantlake.operators.ordered import indexed_lookup, running_total, with_index, with_rank
from plantlake.operators.project import active_only, derive_columns, project, stamped, trailing, valid_rows


@pytest.fixture(scope="module")
def fact(spark):
    # Two thirds of the rows share key 1; some keys are missing or unknown.
    data = [(i, 1 if i % 3 else (i % 7 or None), float(i)) for i in range(300)]
    return inline_rows(spark, ["id", "k", "v"], data)


@pytest.fixture(scope="module")
def dim(spark):
    return inline_rows(spark, ["k", "name", "ok"], [(1, "one", True), (2, "two", False), (3, "three", True)])


NAMES = {1: "one", 2: "two", 3: "three"}


@pytest.mark.parametrize("options, node", [
    ({}, "BroadcastHashJoin"), ({"salt": 1}, "SortMergeJoin"), ({"salt": 5, "salt_by": ["id"]}, "SortMergeJoin")])
def test_lookup_strategies_agree(spark, fact, dim, options, node):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if options:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left = E.enrich_left(fact, dim, "k", ["name"], **options)
        inner = E.join_inner(fact, [(dim, "k", ["name"])], **options)
        assert left.columns == inner.columns == ["id", "k", "v", "name"]
        assert node in plan(left)
        expected = [(r.id, r.k, r.v, NAMES.get(r.k)) for r in fact.collect()]
        assert rows(left, "id") == expected
        assert rows(inner, "id") == [r for r in expected if r[3]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_salt_needs_columns(fact, dim):
    with pytest.raises(ValueError):
        E.enrich_left(fact, dim, "k", ["name"], salt=3)


def test_unused_columns_are_pruned_without_broadcast(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = E.enrich_left(tables.lineitem, tables.part, {"l_partkey": "p_partkey"}, ["p_name"]).select("l_orderkey", "p_name")
        assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_key_is_spread_over_tasks(spark):
    """A key with two thirds of the rows: no reduce task of the salted join sees most of it."""
    facts = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("k"))
    dims = spark.range(30000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    saved = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                            "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for c, v in zip(saved, ("-1", "16", "false")):
            spark.conf.set(c, v)
        def largest(salt):
            out = E.enrich_left(facts, dims, "k", ["twice"], salt=salt, salt_by=["id"])
            assert out.where("twice <> 2 * k or twice is null").isEmpty()
            return out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
        assert largest(1) > 20000 and largest(8) < 12000
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)


def test_adaptive_execution_splits_the_unsalted_join(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}
    saved = {c: spark.conf.get(c) for c in settings}
    facts = spark.range(0, 200000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("k"))
    dims = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    facts = facts.withColumn("tags", F.create_map("k", "id"))
    try:
        for c, v in settings.items():
            spark.conf.set(c, v)
        out = E.enrich_left(facts, dims, "k", ["twice"], salt=1)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)


def test_star_and_rename(spark, fact, dim):
    out = E.star_enrich(fact, [(dim, "k", {"name": "first"}), (dim, {"k": "k"}, {"name": "second"})])
    assert out.columns == ["id", "k", "v", "first", "second"]
    assert out.where("first <=> second").count() == 300


def test_active_filter_after_left_join_is_an_inner_join(fact, dim):
    out = active_only(E.enrich_left(fact, dim, "k", ["ok"]), "ok")
    assert "Inner" in plan(out) and "LeftOuter" not in plan(out)
    assert out.where("k = 2 or k is null").count() == 0


def test_derived_key_and_predicate(spark, dim):
    coded = inline_rows(spark, ["code", "x"], [("K-0001", 10), ("K-0002", 20), ("K-0009", 90)])
    facts = inline_rows(spark, ["n"], [(1,), (2,), (5,)])
    out = E.join_derived_key(facts, coded, "n", F.substring("code", 3, 10).cast("int"), ["x"])
    assert rows(out, "n") == [(1, 10), (2, 20)]
    kept = E.join_filtered(facts, dim, {"n": "k"}, F.col("ok"), ["name"])
    assert rows(kept, "n") == [(1, "one")]


def test_dim_first_keeps_dims_without_facts(spark, dim):
    facts = inline_rows(spark, ["k", "day"], [(1, 5), (1, 6), (9, 7)])
    assert rows(E.dim_first(dim, facts, "k", ["day"]).select("k", "day"), "k", "day") == [
        (1, 5), (1, 6), (2, None), (3, None)]


def test_union_keeps_duplicates_and_matches_by_name(spark):
    a = inline_rows(spark, ["x", "y"], [(1, "a"), (1, "a")])
    b = inline_rows(spark, ["y", "z", "x"], [("a", 0, 1)])
    assert rows(E.union_feeds(a, b), "x") == [(1, "a")] * 3


def test_project_valid_trailing(spark):
    df = inline_rows(spark, ["a", "b", "c"], [(1, 0.0, "x"), (-1, 0.5, "y"), (2, 1.0, "z"), (3, 1.01, "w"), (None, 0.5, "n")])
    assert project(df, drop=("c",), rename={"a": "n"}, order=["b", "n"]).columns == ["b", "n"]
    assert [r.c for r in valid_rows(df, "a", "b").orderBy("c").collect()] == ["x", "z"]
    assert derive_columns(df, {"d": F.col("a") + 1}).columns == ["a", "b", "c", "d"]
    assert stamped(df, "at").schema["at"].dataType.simpleString() == "timestamp"
    ts = inline_rows(spark, ["s"], [("2024-01-23 00:00:00",), ("2024-01-22 23:59:59",), ("2024-02-01 00:00:00",)]).select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    assert trailing(ts, "t", 7, F.to_date(F.lit("2024-01-30"))).count() == 2


def test_group_stats_one_row_has_no_deviation(spark):
    df = inline_rows(spark, ["k", "v"], [("a", 1.0), ("b", 1.0), ("b", 3.0)])
    out = {r.k: r for r in M.group_stats(df, ["k"], "v").collect()}
    assert out["a"].stddev_value is None and out["a"].row_count == 1
    assert out["b"].avg_value == 2.0 and abs(out["b"].stddev_value - 2 ** 0.5) < 1e-12


def test_counts_severity_having_ratio(spark):
    df = inline_rows(spark, ["k", "s", "n"], [("a", "C", 0), ("a", "W", 2), ("a", "N", 2), ("a", None, 4), ("b", "N", 0)])
    crit, warn = F.col("s") == "C", F.col("s") == "W"
    counts = M.conditional_counts(df, ["k"], {"c": crit, "w": warn})
    assert rows(counts, "k") == [("a", 1, 1), ("b", 0, 0)]
    assert rows(M.having(counts, F.col("c") > 0), "k") == [("a", 1, 1)]
    assert rows(M.severity(df, ["k"], [(crit, 10), (warn, 3)]), "k") == [("a", 3.25), ("b", 0.0)]
    ratio = df.groupBy("k").agg(M.ratio_of_sums("n", "n").alias("r"))
    assert rows(ratio, "k") == [("a", 1.0), ("b", None)]
    assert rows(df.groupBy("k").agg(M.distinct_count("n").alias("d")), "k") == [("a", 3), ("b", 1)]


def test_two_level_weighs_groups_equally_with_and_without_colocation(spark):
    df = inline_rows(spark, ["u", "t", "v"], [(1, "a", 0.0), (1, "a", 0.0), (1, "a", 3.0), (1, "b", 5.0), (2, "a", 7.0)])
    args = (["u", "t"], [F.avg("v").alias("m")], ["u"], [F.avg("m").alias("mm")])
    expected = [(1, 3.0), (2, 7.0)]
    assert rows(M.two_level(df, *args), "u") == expected
    assert rows(M.two_level(df, *args, colocate=["u"]), "u") == expected


def test_agg_minus_attr_by_day_and_audit(spark):
    df = inline_rows(spark, ["k", "v", "a", "s"], [(1, 2.0, 1.0, "2024-01-01 23:59:59"), (1, 4.0, 1.0, "2024-01-02 00:00:00")])
    assert rows(M.agg_minus_attr(df, ["k"], "v", "a", "d"), "k") == [(1, 2.0)]
    dim = inline_rows(spark, ["k", "a"], [(1, 1.0), (2, 5.0)])
    assert rows(M.agg_minus_attr(df.drop("a"), ["k"], "v", "a", "d", dim), "k") == [(1, 2.0)]
    daily = M.by_day(df.withColumn("s", F.col("s").cast("timestamp_ntz")), "s", ["k"], [F.count("*").alias("n")])
    assert [(r.day.isoformat(), r.n) for r in daily.orderBy("day").collect()] == [("2024-01-01", 1), ("2024-01-02", 1)]
    assert rows(M.row_audit({"x": df, "empty": df.where("k > 9")}), "table_name") == [("empty", 0), ("x", 2)]


def test_latest_breaks_ties_and_prunes_before_the_shuffle(spark, tables):
    df = inline_rows(spark, ["k", "t", "id"], [(1, 5, 1), (1, 5, 3), (1, 5, 2), (2, 1, 9), (None, 1, 8)])
    assert rows(latest_per_key(df, ["k"], "t", ["id"]), "k") == [(None, 1, 8), (1, 5, 3), (2, 1, 9)]
    text = plan(latest_per_key(tables.events, ["user_id"], "ts", ["event_id"]))
    partial = text.index("row_number(), 1, Partial")
    assert "WindowGroupLimit" in text and text.index("Exchange") < partial  # below the exchange in the tree


def test_tumbling_buckets(spark):
    df = inline_rows(spark, ["s"], [("2024-01-01 00:04:59.999",), ("2024-01-01 00:05:00",), ("2024-01-01 00:00:00",)])
    grouped = df.groupBy(tumbling(F.col("s").cast("timestamp_ntz")).alias("time_window")).agg(F.count("*").alias("n"))
    assert rows(flat_window(grouped), "window_start") == [
        (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5), 2),
        (dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 1, 1, 0, 10), 1)]


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_running_total_equals_one_task_sum(spark, slices):
    rng = random.Random(slices)
    # Most values are equal, so one value spans several slices.
    data = [(i, rng.choice([0, 0, 0, 0, 5, 9])) for i in range(200)]
    df = inline_rows(spark, ["id", "v"], data)
    out = running_total(df, [F.desc("v"), F.asc("id")], "v", "run", slices=slices)
    total, expected = 0, {}
    for i, v in sorted(data, key=lambda r: (-r[1], r[0])):
        total += v
        expected[i] = total
    assert {r.id: r.run for r in out.collect()} == expected
    index = {r.id: r.row_index for r in with_index(df, [F.desc("v"), F.asc("id")], slices=slices).collect()}
    assert index == {i: n for n, (i, v) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])))}


def test_rank_with_a_large_tie(spark):
    data = [(i, 0.0 if i % 3 else float(i % 10)) for i in range(120)]
    df = inline_rows(spark, ["id", "score"], data)
    got = {r.id: r["rank"] for r in with_rank(df, "score").collect()}
    scores = [s for _, s in data]
    assert got == {i: 1 + sum(x > s for x in scores) for i, s in data}


def test_rank_of_null_scores_and_of_the_top(spark):
    data = [(i, None if i % 7 == 0 else float(i % 10)) for i in range(90)]
    df = inline_rows(spark, ["id", "score"], data)
    ahead = lambda s: sum(x is not None and (s is None or x > s) for _, x in data)
    want = {i: 1 + ahead(s) for i, s in data}
    assert {r.id: r["rank"] for r in with_rank(df, "score").collect()} == want
    context = spark.sparkContext
    for top in (1, 9, 10, 89, 200):
        context.setJobGroup(f"rank-{top}", "")
        best = with_rank(df, "score", top=top)
        assert not context.statusTracker().getJobIdsForGroup(f"rank-{top}")  # nothing runs or is stored ahead
        assert {r.id: r["rank"] for r in best.collect()} == {i: k for i, k in want.items() if k <= top}
    context.setLocalProperty("spark.jobGroup.id", None)
    assert with_rank(df.where("id > 500"), "score", top=3).count() == 0


def test_no_whole_table_window(spark):
    df = inline_rows(spark, ["id", "v"], [(i, i) for i in range(50)])
    out = running_total(df, [F.asc("id")], "v", "run", slices=4)
    text = plan(out)
    assert "Window" in text and text.count("SinglePartition") <= 1  # one row per slice only
    assert indexed_lookup(df.select("id"), df.withColumnRenamed("id", "i"), "id", [F.desc("i")], ["v"]).where(
        "id + v <> 49").count() == 0


def test_empty_input(spark):
    df = inline_rows(spark, ["id", "v"], [(1, 1)]).where("id > 5")
    assert running_total(df, [F.asc("id")], "v", "run").count() == 0
    assert latest_per_key(df, ["id"], "v", []).count() == 0
