"""Streaming file sources."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plantlake.schema import struct
from plantlake.sources.records import decode_json

RESCUED = "_rescued_data"


def _as_struct(schema: str | T.StructType) -> T.StructType:
    return struct(schema) if isinstance(schema, str) else schema


def _pattern(spark: SparkSession, path: str) -> str:
    """Folders as they are, so that a stream's sink log and partition columns count. The
    file source takes a single file only as a pattern, here one that matches just it."""
    path = path.rstrip("/")
    if any(c in path for c in "*?[{"):
        return path
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    one = files.exists(place) and not files.getFileStatus(place).isDirectory()
    return f"{path[:-1]}[{path[-1]}]" if one else path


def parquet_stream(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                   **options) -> DataFrame:
    """Parquet folder or file as a stream. Without a schema the footer's is used."""
    resolved = _as_struct(schema) if schema is not None else spark.read.parquet(path).schema
    return spark.readStream.schema(resolved).options(**options).parquet(_pattern(spark, path))


def csv_stream(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """CSV with a header row, whose names must be those of the schema in its order; a file with other
    names or another order fails the stream. A line that does not fit the schema keeps the
    fields that do, and its raw text goes to ``_rescued_data``."""
    full = T.StructType([*_as_struct(schema).fields, T.StructField(RESCUED, T.StringType())])
    return (spark.readStream.schema(full)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED).option("enforceSchema", False)
            .options(**options).csv(path))


def header_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> dict[str, str]:
    """First line of every file below a folder or matched by a pattern. The driver opens each file once, several at a time."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files, conf = place.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jsc.hadoopConfiguration()
    found = []
    for status in files.globStatus(place) or []:
        each = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s.getPath().toString() for s in each if not s.isDirectory() and s.getPath().getName()[0] not in "._" and s.getLen() > 0]

    def first(name: str) -> str:
        one = jvm.org.apache.hadoop.fs.Path(name)
        raw = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(one)
        stream = files.open(one)
        try:
            stream = stream if raw is None else raw.createInputStream(stream)
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine()
            return (line or "").removeprefix("\ufeff")
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(found, pool.map(first, found)))


def csv_by_header(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",") -> DataFrame:
    """CSV files whose header rows name their columns, in any order and each file its own, as one stream with the columns of
    the schema. A column that a file lacks is null, further ones are left out. A line with more or fewer fields than its
    header, or with a value that does not fit its type, keeps what fits, and its raw text goes to ``_rescued_data``.

    Files are grouped by their header line, with one reader schema per group. The lines are read when the stream is made: made
    anew for each available-now run, it knows all files of that run. A file that came after that fails the
    stream, and the next run takes it. A value may not contain a line break; a row that repeats the header is a header.
    """
    target = _as_struct(schema)
    headers = header_lines(spark, path)
    lines = sorted(set(headers.values()))
    text = spark.readStream.text(_pattern(spark, path)).select("value", F.col("_metadata.file_path").alias("__file"))
    forms = spark.createDataFrame([(f, lines.index(h)) for f, h in headers.items()], "__file string, __form int")
    placed = text.join(forms, "__file", "left")
    form = F.coalesce("__form", F.raise_error(F.concat(F.lit("no header was read of "), F.col("__file"))).cast("int"))
    plain = F.ltrim(F.col("value"), F.lit("\ufeff"))
    rows = placed.select("value", plain.alias("__line"), form.alias("__form")).where(F.length("value") > 0)

    def read(line: str) -> Column:
        names = [c.strip() for c in next(csv.reader([line], delimiter=sep), [])]
        own = T.StructType([T.StructField(f"c{i}", target[n].dataType if n in target.names else T.StringType()) for i, n in enumerate(names)]
                           + [T.StructField("bad", T.StringType())])
        parsed = F.from_csv("value", own.toDDL(), {"sep": sep, "columnNameOfCorruptRecord": "bad", "mode": "PERMISSIVE"})

        def chosen(r: Column) -> Column:
            return F.struct(*[(r[f"c{names.index(f.name)}"] if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
                              for f in target.fields], r["bad"].alias(RESCUED))

        return F.get(F.transform(F.array(parsed), chosen), F.lit(0))  # parses a line once for all its fields

    shape = T.StructType([*target.fields, T.StructField(RESCUED, T.StringType())])
    row = F.lit(None).cast(shape)
    for k, line in enumerate(lines):
        row = F.when((F.col("__form") == k) & (F.col("__line") != line), read(line)).otherwise(row)
    return rows.select(row.alias("__row")).where("__row is not null").select("__row.*")


def json_stream(spark: SparkSession, path: str, schema: str | T.StructType, rescue: bool = False, **options) -> DataFrame:
    """JSON lines. With ``rescue`` a line that is no record of the schema has null fields, and its raw text goes to
    ``_rescued_data``."""
    if rescue:
        lines = spark.readStream.options(**options).text(path).select("value")
        return decode_json(lines.where(F.trim("value") != ""), "value", schema, rescued=RESCUED)
    return spark.readStream.schema(_as_struct(schema)).options(**options).json(path)
