"""Aggregations. Every aggregate here combines map-side before its shuffle, so a
key that holds a large share of the rows costs no more than any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plantlake.functions.columns import as_col
from plantlake.functions.rules import safe_ratio
from plantlake.operators.enrich import lookup


def group_stats(df: DataFrame, keys: list, value: str) -> DataFrame:
    """Count, mean, sample deviation (null for one row), least and greatest."""
    return df.groupBy(*keys).agg(*stats_of(value))


def stats_of(value: str, prefix: str = "") -> list[Column]:
    return [F.count("*").alias(f"{prefix}row_count"),
            F.avg(value).alias(f"{prefix}avg_value"),
            F.stddev_samp(value).alias(f"{prefix}stddev_value"),
            F.min(value).alias(f"{prefix}min_value"),
            F.max(value).alias(f"{prefix}max_value")]


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def conditional_counts(df: DataFrame, keys: list, conditions: dict[str, Column]) -> DataFrame:
    """One pass, one counter per condition."""
    return df.groupBy(*keys).agg(*[count_where(c).alias(n) for n, c in conditions.items()])


def severity_of(weights: list[tuple[Column, float]]) -> Column:
    """Aggregate: mean weight of the first condition each row meets, 0 for none."""
    ladder = reduce(lambda acc, w: acc.when(w[0], F.lit(float(w[1]))), weights[1:],
                    F.when(weights[0][0], F.lit(float(weights[0][1]))))
    return F.avg(ladder.otherwise(0.0))


def severity(df: DataFrame, keys: list, weights: list[tuple[Column, float]]) -> DataFrame:
    return df.groupBy(*keys).agg(severity_of(weights).alias("severity_score"))


def having(aggregated: DataFrame, condition: Column) -> DataFrame:
    """Filter on aggregate outputs."""
    return aggregated.where(condition)


def ratio_of_sums(numerator, denominator) -> Column:
    """Aggregate: sum over sum, null where the lower sum is zero."""
    return safe_ratio(F.sum(as_col(numerator)), F.sum(as_col(denominator)))


def distinct_count(column, streaming: bool = False) -> Column:
    """Exact distinct count; streams only support the approximate form."""
    return F.approx_count_distinct(column) if streaming else F.countDistinct(column)


def by_day(df: DataFrame, ts: str, keys: list, aggs: list[Column], name: str = "day") -> DataFrame:
    """Aggregate per key and calendar day."""
    return df.groupBy(*keys, F.to_date(ts).alias(name)).agg(*aggs)


def two_level(df: DataFrame, inner_keys: list, inner_aggs: list[Column],
              outer_keys: list, outer_aggs: list[Column], colocate: list[str] | None = None) -> DataFrame:
    """Aggregate, then aggregate the groups, each group weighing the same.

    ``colocate`` names outer keys to shuffle the groups by, so a later join on just
    those keys needs no further shuffle. Raw rows are already reduced by then.
    """
    inner = df.groupBy(*inner_keys).agg(*inner_aggs)
    if colocate:
        inner = inner.repartition(*colocate)
    return inner.groupBy(*outer_keys).agg(*outer_aggs)


def agg_minus_attr(df: DataFrame, keys: list[str], value: str, attr: str, name: str,
                   dim: DataFrame | None = None, on: str | dict[str, str] | None = None) -> DataFrame:
    """Mean of a measure less an attribute that is constant within the keys. The
    attribute is a column of ``df``, or of ``dim``, which the groups are then
    looked up in after the aggregation."""
    if dim is None:
        grouped = df.groupBy(*keys, attr).agg(F.avg(value).alias("__mean"))
    else:
        means = df.groupBy(*keys).agg(F.avg(value).alias("__mean"))
        grouped = lookup(means, dim, on or keys[0], [attr], how="inner")
    return grouped.select(*keys, (F.col("__mean") - F.col(attr)).alias(name))


def row_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table in one job; parquet footers answer it without reading columns."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)
