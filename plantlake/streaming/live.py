"""Streaming forms of the operators that need state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake.functions.columns import utc_instant
from plantlake.plans.gold import anomaly_alerts
from plantlake.sources.snapshots import Snapshots

LATENESS = "10 minutes"


def with_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp; times without zone are UTC."""
    kind = dict(df.dtypes)[ts]
    return df.withColumn(ts, utc_instant(ts) if kind == "timestamp_ntz" else F.col(ts).cast("timestamp"))


def stream_alerts(readings: DataFrame, width: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Windowed alerts over a stream of silver readings. A window is emitted once,
    when the watermark passes its end; its state is then dropped."""
    timed = with_event_time(readings, "reading_timestamp").withWatermark("reading_timestamp", lateness)
    return anomaly_alerts(timed, width)


def latest_stream(df: DataFrame, keys: list[str], ts: str, tie_break: list[str]) -> DataFrame:
    """Newest row per key. State holds one row per key; use complete or update mode."""
    newest = F.max_by(F.struct("*"), F.struct(ts, *tie_break))
    kept = df.groupBy(*keys).agg(newest.alias("__row"))
    return kept.select("__row.*")


def dedup_stream(df: DataFrame, ids: list[str], ts: str, lateness: str = LATENESS, spread: int = 16) -> DataFrame:
    """Drop redelivered rows. An id is remembered until the watermark passes its
    event time by ``lateness``, which bounds the state.

    It takes two stateful steps: copies of an id are first dealt over ``spread`` tasks, which keep one each, and these meet in one
    task. So an id that holds a large share of a feed loads no task with more than its share by ``spread``. The salt
    is a hash of the row and its input partition: a retried task gives the same salts, and equal copies
    of different partitions get different ones. With ``spread`` 1 there is one step.
    """
    timed = with_event_time(df, ts).withWatermark(ts, lateness)
    if spread > 1:
        salt = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(spread))
        timed = timed.withColumn("__salt", salt).dropDuplicatesWithinWatermark([*ids, "__salt"]).drop("__salt")
    return timed.dropDuplicatesWithinWatermark(ids)


def replace_each_batch(df: DataFrame, dst: str, checkpoint: str) -> StreamingQuery:
    """Complete-mode sink that replaces ``dst`` in one commit per batch, for results small enough to rewrite."""
    store = Snapshots(df.sparkSession, dst)

    def overwrite(batch: DataFrame, _batch_id: int) -> None:
        store.replace(batch, F.lit("all"))
        store.vacuum()

    return (df.writeStream.outputMode("complete").foreachBatch(overwrite)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
