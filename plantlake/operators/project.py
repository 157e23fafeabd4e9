"""Projections and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plantlake.functions.columns import as_col


def derive_columns(df: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """All input columns plus the derived ones, in one projection."""
    return df.select("*", *[expr.alias(name) for name, expr in derived.items()])


def active_only(df: DataFrame, flag: str = "is_active") -> DataFrame:
    """Keep rows whose flag is true. After a left join this rejects unmatched
    rows too, which lets the optimizer plan the join as an inner one."""
    return df.where(F.col(flag))


def valid_rows(df: DataFrame, nonneg: str, bounded: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Non-negative ``nonneg`` and ``bounded`` within ``[low, high]``."""
    return df.where((F.col(nonneg) >= 0) & F.col(bounded).between(low, high))


def project(df: DataFrame, drop: tuple[str, ...] = (), rename: dict[str, str] | None = None,
            order: list[str] | None = None) -> DataFrame:
    """Drop, rename and reorder. ``order`` uses the new names and also selects."""
    rename = rename or {}
    kept = [c for c in df.columns if c not in set(drop)]
    out = df.select(*[F.col(c).alias(rename.get(c, c)) for c in kept])
    return out.select(*order) if order else out


def stamped(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """Add the processing time of the batch."""
    return df.withColumn(name, F.current_timestamp())


def trailing(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows not older than ``days`` before the ``as_of`` date; there is no upper
    limit. The bound is constant-folded and reaches the scan."""
    bound = F.date_sub(as_col(as_of), days).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) >= bound)
