"""Registry that keeps each query next to its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plantlake.sources.tables import read_table


class Tables:
    """The given tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return comparable(self.run(Tables(spark, folder)))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    """Register a function of the tables; ``sql`` is the same result for DuckDB."""
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return register


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps without zone, as in the oracle results."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def settled(expr: str, digits: int = 4) -> str:
    """SQL twin of ``functions.columns.settle``."""
    scale = f"{float(10 ** digits)!r}::DOUBLE"
    return f"floor(({expr}) * {scale} + 0.50012345::DOUBLE) / {scale}"


def with_bound(body: str, *names: str, **extra: str) -> str:
    """Prefix ``body`` with the CTEs of the named bindings, then extra ones."""
    from plantlake.queries.bindings import SQL

    ctes = {n: SQL[n] for n in names} | extra
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes.items()) + "\n" + body.strip()
