"""Batch tables: scans, overwrites, appends and registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Parquet path or catalog table."""
    return spark.read.parquet(name_or_path) if is_path(name_or_path) else spark.read.table(name_or_path)


def _writer(df: DataFrame, partition_by: list[str] | None):
    if not partition_by:
        return df.write.mode("overwrite")
    # Rebalancing keeps the file count per partition low and splits a partition
    # value that holds much of the data over several tasks.
    return df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a managed table."""
    _writer(df, partition_by).saveAsTable(name)


def write_path(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet folder."""
    _writer(df, partition_by).parquet(path)


def mapped(df: DataFrame, target: DataFrame, mapping: dict[str, str | Column | None]) -> DataFrame:
    """Project ``df`` onto the columns of ``target``, in its order and types.

    A target column missing from the mapping takes the input column of its own
    name; one mapped to None becomes a typed null.
    """
    def source(field):
        given = mapping.get(field.name, field.name)
        if given is None:
            value = F.lit(None)
        else:
            value = F.col(given) if isinstance(given, str) else given
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[source(f) for f in target.schema.fields])


def append_mapped(df: DataFrame, target: str, mapping: dict[str, str | Column | None]) -> None:
    """Append by position to a catalog table, or to a parquet folder."""
    spark = df.sparkSession
    rows = mapped(df, read_table(spark, target), mapping)
    if is_path(target):
        rows.write.mode("append").parquet(target)
    else:
        rows.write.insertInto(target, overwrite=False)


def register_all(spark: SparkSession, root: str, names: list[str], schema: str,
                 external: bool = False) -> list[str]:
    """Make each parquet folder ``root/name`` a table of ``schema``: copied into a
    managed table, or with ``external`` left in place. The loop is over table
    names; rows never pass the driver."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name in names:
        if external:
            spark.catalog.createTable(f"{schema}.{name}", path=f"{root}/{name}", source="parquet")
        else:
            write_table(read_table(spark, f"{root}/{name}"), f"{schema}.{name}")
    return [f"{schema}.{name}" for name in names]
