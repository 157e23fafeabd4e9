"""Latest row per key and tumbling time buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.functions.columns import ColumnLike, as_col


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tie_break: list[str]) -> DataFrame:
    """One row per key, the newest. ``tie_break`` orders rows of equal time, so
    reruns agree. The limit on the row number is planned as a group limit that
    prunes each partition to one row per key before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(ts), *[F.desc(c) for c in tie_break])
    return df.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


def tumbling(ts: ColumnLike, width: str = "5 minutes") -> Column:
    """Grouping key: struct of bucket start and end."""
    return F.window(as_col(ts), width)


def flat_window(df: DataFrame, name: str = "time_window") -> DataFrame:
    """Replace a window struct by ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != name]
    return df.select(F.col(f"{name}.start").alias("window_start"),
                     F.col(f"{name}.end").alias("window_end"), *rest)
