"""Whole-table ordering without a single-task window.

An unpartitioned window sends every row through one task. Here rows are range
partitioned, pinned by a reliable checkpoint so both passes see the same slices,
and each slice starts from the total of the slices before it. Only one row per
slice is ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.functions.columns import as_col
from plantlake.operators.enrich import lookup
from plantlake.session import pinned

_SLICE = "__slice"


def running_total(df: DataFrame, order: list[Column], value, name: str, exclusive: bool = False,
                  slices: int | None = None) -> DataFrame:
    """Running sum of ``value`` in a total order of the rows. The order must be
    unique: then a large group of equal leading values still splits over slices."""
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = pinned(df.withColumn("__v", as_col(value))
                   .repartitionByRange(slices, *order)
                   .withColumn(_SLICE, F.spark_partition_id()))
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    offsets = (parts.groupBy(_SLICE).agg(F.sum("__v").alias("__t"))
               .select(F.col(_SLICE).alias("__s"),
                       F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__before")))
    inside = Window.partitionBy(_SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = parts.join(F.broadcast(offsets), parts[_SLICE] == offsets["__s"])  # at most `slices` rows
    total = F.col("__before") + F.sum("__v").over(inside)
    if exclusive:
        total = total - F.col("__v")
    return joined.select(*df.columns, total.alias(name))


def with_index(df: DataFrame, order: list[Column], name: str = "row_index", slices: int | None = None) -> DataFrame:
    """Dense 0-based position of each row in a unique order."""
    return running_total(df, order, F.lit(1).cast("bigint"), name, exclusive=True, slices=slices)


def with_rank(df: DataFrame, score: str, name: str = "rank", slices: int | None = None, top: int | None = None) -> DataFrame:
    """SQL ``rank()`` by descending score over the whole table, null scores last. Equal scores are
    counted first, so ties of any size stay one row while they are ordered.

    ``top`` keeps the rows ranked that high: they hold at most ``top`` different scores, so every task
    keeps that many and nothing is stored ahead; the rows of ``df`` must be the same when read again."""
    if top is None:
        df = pinned(df)  # read twice below; also keeps both reads equal
    counts = df.groupBy(F.col(score).alias("__score")).agg(F.count("*").alias("__n"))
    order = [F.desc_nulls_last("__score")]
    if top is None:
        ahead = running_total(counts, order, "__n", "__ahead", exclusive=True, slices=slices)
    else:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # at most `top` rows
        ahead = (counts.orderBy(*order).limit(top).withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0)))
                 .where(F.col("__ahead") < top))
    ranks = ahead.select("__score", (F.col("__ahead") + 1).alias(name))
    return df.join(ranks, df[score].eqNullSafe(ranks["__score"])).drop("__score")


def indexed_lookup(df: DataFrame, dim: DataFrame, idx_col: str, order_by: list[Column], cols,
                   how: str = "inner") -> DataFrame:
    """Pick the dimension row at a 0-based position of its sort order."""
    return lookup(df, with_index(dim, order_by, "__idx"), {idx_col: "__idx"}, cols, how=how)
