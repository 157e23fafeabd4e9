"""Every registered query against its oracle SQL, and the plans of the main ones."""

import re

import pytest
from conftest import SF, plan

import check
from __spark_entry__ import entry, oracle_sql as all_sql, queries
from plantlake.queries import REGISTRY

NAMES = list(REGISTRY)


def oracle_sql():
    return {k: v for k, v in all_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return check.oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    assert check.compare(spark, con, SF, name) is None


def test_entry_and_names(spark):
    assert entry(spark).columns and len(NAMES) > 100
    assert set(oracle_sql()) == set(NAMES)


BATCH = [n for n in NAMES if not n.startswith(("bronze_", "stream_", "synth_", "csv_", "jsonl_", "append_"))]


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BatchEvalPython|ArrowEvalPython|MapInPandas", text)


def test_trailing_filter_reaches_the_scan(spark):
    for name in ("trailing_filter", "gold_equipment_health"):
        assert re.search(r"GreaterThanOrEqual\(ts,2024-01-23T00:00", plan(queries()[name](spark, SF)))


@pytest.mark.parametrize("name, columns", [
    ("gold_daily_kpis", {"l_orderkey", "l_tax", "l_partkey", "l_linestatus"}),
    ("gold_product_yield", {"l_quantity", "l_tax", "l_shipdate", "l_suppkey"}),
    ("gold_alerts", {"props", "event_id"})])
def test_unused_columns_are_not_read(spark, name, columns):
    read = " ".join(re.findall(r"ReadSchema: (struct<[^\n]*)", plan(queries()[name](spark, SF))))
    assert not [c for c in columns if re.search(rf"\b{c}:", read)]


@pytest.mark.parametrize("name, shuffles", [
    ("silver_readings", 0), ("silver_production", 0), ("silver_shipments", 0), ("gold_alerts", 1),
    ("gold_product_yield", 1), ("gold_daily_kpis", 2), ("latest_per_key", 1)])
def test_shuffle_count(spark, name, shuffles):
    assert len(re.findall("Exchange hashpartitioning", plan(queries()[name](spark, SF)))) == shuffles
