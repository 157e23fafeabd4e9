"""Incremental ingest: append-only tables fed by checkpointed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake.sources.files import parquet_stream


def append_stream(df: DataFrame, dst: str, checkpoint: str, partition_by: list[str] | None = None,
                  files_per_partition: int | None = None, continuous: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per checkpoint. By default
    everything available is taken and the query ends; ``continuous`` is the
    interval of a query that keeps running.

    A backfill that spans many partition values would write one file per task and
    value; ``files_per_partition`` shuffles the rows so that each value is written
    by that many tasks. Live feeds touch few values and need no shuffle.
    """
    if partition_by and files_per_partition:
        spread = F.pmod(F.xxhash64(*[c for c in df.columns if c not in partition_by]), F.lit(files_per_partition))
        df = df.repartition(*partition_by, spread)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", dst).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query; its failure is raised here."""
    query.awaitTermination()
    return query


def append_apart(df: DataFrame, rescued: str, dst: str, quarantine: str, checkpoint: str, **options) -> tuple[StreamingQuery, StreamingQuery]:
    """Append the rows whose column ``rescued`` is null to ``dst``, without it, and that column of all others to ``quarantine``. Two
    streams with a checkpoint each, so that every row gets to one of the folders exactly once, also over restarts."""
    good = append_stream(df.where(F.col(rescued).isNull()).drop(rescued), dst, checkpoint, **options)
    only = {k: v for k, v in options.items() if k == "continuous"}
    return good, append_stream(df.where(F.col(rescued).isNotNull()).select(rescued), quarantine, f"{checkpoint}-{rescued}", **only)


def ingest_stream(src: DataFrame, dst: str, checkpoint: str, columns: list[str] | None = None,
                  tenant: str | None = None, **options) -> StreamingQuery:
    """Bronze ingest of a source stream: whole rows, or the listed columns only, or
    with a column that names the tenant they came from."""
    rows = src.select(*columns) if columns else src
    if tenant is not None:
        rows = rows.withColumn("tenant", F.lit(tenant))
    return append_stream(rows, dst, checkpoint, **options)


def ingest_table(spark: SparkSession, src: str, dst: str, checkpoint: str, **options) -> DataFrame:
    """Ingest what is new in a parquet source and return the whole target."""
    run_to_end(ingest_stream(parquet_stream(spark, src), dst, checkpoint, **options))
    return spark.read.parquet(dst)
