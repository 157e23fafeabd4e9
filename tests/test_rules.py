"""Boundary rows of every rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantlake.functions import rules as R
from plantlake.functions.columns import inline_rows, settle


def values(spark, column, names, data):
    df = inline_rows(spark, ["i", *names], [(i, *r) for i, r in enumerate(data)])
    return [r[0] for r in df.select("i", column.alias("out")).orderBy("i").select("out").collect()]


@pytest.mark.parametrize("value, expected", [
    (None, "NORMAL"), (0.9, "CRITICAL"), (1.0, "WARNING"), (1.9, "WARNING"), (2.0, "NORMAL"), (5.0, "NORMAL"),
    (8.0, "NORMAL"), (8.1, "WARNING"), (9.0, "WARNING"), (9.1, "CRITICAL")])
def test_threshold_status_limits_are_not_hits(spark, value, expected):
    column = R.threshold_status(F.col("v").cast("double"), 2.0, 8.0, 1.0, 9.0)
    assert values(spark, column, ["v"], [(value,)]) == [expected]


@pytest.mark.parametrize("value, expected", [
    (None, "GOOD"), (1.0, "BAD"), (1.1, "UNCERTAIN"), (2.0, "UNCERTAIN"), (2.1, "GOOD"), (7.9, "GOOD"),
    (8.0, "UNCERTAIN"), (9.0, "BAD")])
def test_quality_label_limits_are_hits(spark, value, expected):
    column = R.quality_label(F.col("v").cast("double"), 2.0, 8.0, 1.0, 9.0)
    assert values(spark, column, ["v"], [(value,)]) == [expected]


def test_threshold_status_with_missing_limits(spark):
    column = R.threshold_status("v", F.col("l").cast("double"), 8.0, F.col("l").cast("double"), 9.0)
    assert values(spark, column, ["v", "l"], [(0.0, None), (9.5, None), (8.5, None)]) == [
        "NORMAL", "CRITICAL", "WARNING"]


def test_out_of_range_forms(spark):
    data = [(None,), (0.0,), (-0.1,), (10.0,), (10.1,)]
    value = F.col("v").cast("double")
    assert values(spark, R.out_of_range(value, 0.0, 10.0), ["v"], data) == [None, False, True, False, True]
    assert values(spark, R.out_of_range(value, 0.0, 10.0, null_as_false=True), ["v"], data) == [
        False, False, True, False, True]


def test_fill_band_edges(spark):
    fills = [0.0, 0.0999, 0.10, 0.2499, 0.25, 0.85, 0.8501, 0.95, 0.9501, None]
    assert values(spark, R.fill_band(F.col("f").cast("double")), ["f"], [(f,) for f in fills]) == [
        "CRITICALLY_LOW", "CRITICALLY_LOW", "LOW", "LOW", "NORMAL", "NORMAL", "NEAR_CAPACITY", "NEAR_CAPACITY",
        "OVER_FILLED", "NORMAL"]


def test_needs_attention(spark):
    data = [(0.15, 0.0), (0.1499, 0.0), (0.92, 6.0), (0.9201, 6.0), (0.5, 6.1), (None, None), (None, 7.0), (0.5, None)]
    column = R.needs_attention(F.col("f").cast("double"), F.col("w").cast("double"))
    assert values(spark, column, ["f", "w"], data) == [False, True, False, True, True, False, True, False]


def test_available_capacity(spark):
    data = [(0.0, 100), (0.5, 100), (0.95, 100), (1.0, 100), (None, 100), (0.5, None), (1e-12, 2000000000)]
    column = R.available_capacity(F.col("f").cast("double"), F.col("v").cast("int"))
    # 0.45 * 100 / 0.5 is just below 90 in doubles. Zero level and int overflow give null.
    assert values(spark, column, ["f", "v"], data) == [None, 89, 0, 0, 0, None, None]


def test_status_against_own_limits(spark):
    data = [(0.1, 0.2, 0.9), (0.2, 0.2, 0.9), (0.22, 0.2, 0.9), (0.9, 0.2, 0.9), (0.91, 0.2, 0.9), (0.86, 0.2, 0.99),
            (0.1, None, None)]
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    assert values(spark, R.operating_status("f", lo, hi), ["f", "lo", "hi"], data) == [
        "BELOW_MIN", "WITHIN_RANGE", "WITHIN_RANGE", "WITHIN_RANGE", "ABOVE_MAX", "WITHIN_RANGE", "WITHIN_RANGE"]
    assert values(spark, R.inventory_status("f", lo, hi), ["f", "lo", "hi"], data) == [
        "CRITICALLY_LOW", "LOW", "LOW", "NEAR_CAPACITY", "OVER_FILLED", "NEAR_CAPACITY", "LOW"]


def test_maintenance_status(spark):
    as_of = F.to_date(F.lit("2024-04-10"))
    data = [("2024-01-01", 100), ("2024-01-01", 99), ("2024-01-11", 100), ("2024-01-10", 100), (None, 100)]
    column = R.maintenance_status(F.col("d").cast("date"), "n", as_of)
    assert values(spark, column, ["d", "n"], data) == ["DUE_SOON", "OVERDUE", "OK", "DUE_SOON", "OK"]


def test_days_delayed_is_signed(spark):
    column = R.days_delayed(F.col("a").cast("date"), F.col("e").cast("date"))
    assert values(spark, column, ["a", "e"], [("2024-03-05", "2024-03-01"), ("2024-02-28", "2024-03-01")]) == [4, -2]


def test_safe_ratio_and_variance(spark):
    data = [(6, 4), (1, 0), (0, 0), (None, 2)]
    assert values(spark, R.safe_ratio("a", "b"), ["a", "b"], data) == [1.5, None, None, None]
    assert values(spark, R.variance("a", "b"), ["a", "b"], data) == [2, 1, 0, None]


def test_health_score_of_missing_inputs_is_zero(spark):
    data = [(0.0, 0.0), (0.1, 100.0), (1.0, 0.0), (None, 1.0), (0.1, None)]
    column = R.health_score(F.col("r").cast("double"), F.col("v").cast("double"))
    assert values(spark, column, ["r", "v"], data) == [100.0, 40.0, 0.0, 0.0, 0.0]


def test_clamp_and_value_when(spark):
    data = [(-1.0,), (0.0,), (0.5,), (2.0,), (None,)]
    v = F.col("v").cast("double")
    assert values(spark, R.clamp(v, 0.0, 1.0), ["v"], data) == [0.0, 0.0, 0.5, 1.0, None]
    assert values(spark, R.value_when(v > 0, v), ["v"], data) == [None, None, 0.5, 2.0, None]


def test_anomaly_rate_counts_null_as_normal(spark):
    df = inline_rows(spark, ["s"], [("NORMAL",), ("WARNING",), (None,), ("CRITICAL",)])
    assert df.agg(R.anomaly_rate("s")).collect()[0][0] == 0.5


def test_settle_does_not_sit_on_short_decimals(spark):
    data = [(0.12345,), (0.12344,), (-1.5,), (2.00005,)]
    assert values(spark, settle("x"), ["x"], data) == [0.1235, 0.1234, -1.5, 2.0001]


def test_rules_are_jvm_expressions(spark):
    df = spark.range(3).select(R.fill_band(F.col("id") / 3), R.health_score(F.col("id") / 3, "id"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_oracle_rules_agree_on_null():
    """The SQL twins give what the rules give where inputs are missing."""
    import duckdb
    from plantlake.queries import bindings as B
    none = "SELECT NULL::DOUBLE AS fill_percentage, NULL::DOUBLE AS water_bottom_inches, NULL::INTEGER AS volume_barrels, " \
           "NULL::DOUBLE AS min_operating_level, NULL::DOUBLE AS max_operating_level, NULL::INTEGER AS age"
    got = duckdb.connect().execute(f"SELECT {B.BAND}, {B.NEEDS_LOOK}, {B.ROOM}, {B.OPERATING}, {B.OWN_BAND}, {B.due('age', '10')} FROM ({none})").fetchone()
    assert got == ("NORMAL", False, 0, "WITHIN_RANGE", "NORMAL", "OK")


def test_rules_on_null(spark):
    from pyspark.sql import functions as F
    from plantlake.functions import rules as R
    x = F.lit(None).cast("double")
    row = spark.range(1).select(R.fill_band(x), R.needs_attention(x, x), R.available_capacity(x, x), R.operating_status(x, x, x),
                                R.inventory_status(x, x, x), R.maintenance_status(F.lit(None).cast("date"), F.lit(10), F.lit("2024-01-01").cast("date"))).first()
    assert tuple(row) == ("NORMAL", False, 0, "WITHIN_RANGE", "NORMAL", "OK")
