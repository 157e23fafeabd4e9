"""Schemas that grow: one log of versions per dataset.

A source that gains a column, or whose numbers get wider, gets a new version; the dataset is read with the newest one, so that
earlier rows have nulls or widened values there. Any other change of a type stops with an error that names the column.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, types as T

from plantlake.sources.snapshots import Snapshots

# Types that values of a type may be read as, narrow to wide, as the Parquet readers do.
WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"),
    "float": ("double",), "date": ("timestamp_ntz",)}


class SchemaChange(ValueError):
    """A column changed to a type that the stored values don't fit."""


def widened(old: T.DataType, new: T.DataType, column: str) -> T.DataType:
    """The type that holds the values of both."""
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged(old, new, f"{column}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{column}[]"))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    for narrow, wide in ((a, b), (b, a)):
        if wide in WIDER.get(narrow, ()):
            return new if wide == b else old
    raise SchemaChange(f"column {column} changed from {a} to {b}")


def merged(old: T.StructType, new: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of ``old`` in their order, wide enough for both, then the further ones of ``new``. All may be null."""
    came = {f.name.lower(): f for f in new.fields}
    fields = [T.StructField(f.name, widened(f.dataType, came[f.name.lower()].dataType, prefix + f.name) if f.name.lower() in came else f.dataType)
              for f in old.fields]
    known = {f.name.lower() for f in old.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in known])


def source_schema(spark: SparkSession, path: str, known: T.StructType | None = None) -> T.StructType:
    """What the files of a parquet folder, after the ``known`` columns, have in common after widening. Spark merges the footers of all files in a job;
    only where types differ does the driver look at the files one by one."""
    frame = spark.read.parquet(path)
    try:
        return merged(spark.read.option("mergeSchema", True).parquet(path).schema, T.StructType([]))
    except Exception as error:  # comes as an error of the gateway
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    files = sorted(frame.inputFiles())
    with ThreadPoolExecutor(16) as pool:
        shapes = list(pool.map(lambda f: spark.read.parquet(f).schema, files))
    out = known or T.StructType([])
    for shape in shapes:
        out = merged(out, shape)
    return merged(out, frame.schema)  # with the columns of the folders


class SchemaLog:
    """Versions of the schema of one dataset, as the commits of a table without rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, Snapshots(spark, root)

    def current(self) -> T.StructType | None:
        now = self.store.commit().schema
        return None if now is None else T.StructType.fromJson(json.loads(now))

    def versions(self) -> list[T.StructType]:
        return [T.StructType.fromJson(json.loads(self.store.commit(v).schema)) for v in self.store.commits()]

    def grow(self, came: T.StructType) -> T.StructType:
        """The schema from now on, logged if it is another one."""
        old = self.current()
        new = merged(old or T.StructType([]), came)
        if old is None or new != old:
            self.store.declare(new)
        return new


def read_as(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """A parquet folder with a logged schema, or with its own."""
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
