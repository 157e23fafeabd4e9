"""Streams merged into stored results: each micro-batch rewrites only the parts that it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake.operators.latest import latest_per_key
from plantlake.session import fresh_dir
from plantlake.sources.snapshots import Snapshots

Step = Callable[[DataFrame], DataFrame]


def merge_stream(df: DataFrame, store: Snapshots, reduce: Step, combine: Step, part: Column, checkpoint: str,
                 then: Callable[[list[str], str, int], None] | None = None, owned: bool = False, keep: int = 20,
                 continuous: str | None = None) -> StreamingQuery:
    """Merge a stream into ``store``. A batch is reduced, joined with the stored rows of the parts that it touches, and
    these parts are replaced in one commit; a batch that is already in the store changes nothing.

    reduce   rows of a batch to stored rows, as few as can be merged; those of the first batch are stored as they are
    combine  old and new stored rows to stored rows
    part     part of a stored row; at most as many as days or buckets of a batch are collected
    then     called after the commit with the touched parts, the query and the batch, also for a repeated batch
    owned    for sums: the store must hold rows of this checkpoint only, since another one would add them again
    keep     commits that stay readable
    """
    def take(rows: DataFrame, batch: int) -> None:
        spark = store.spark
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        now = store.commit()
        if owned and now.parts and now.query not in (None, query):
            raise ValueError(f"{store.root} holds rows of another checkpoint; remove it to start anew")
        if now.version < 0:
            # Nothing to merge with: the reduced rows are the stored ones, and their folders tell the parts.
            touched = list(store.replace(reduce(rows), part, query=query, batch=batch).parts)
            if touched and then:
                then(touched, query, batch)
            return
        # Stored once, since it is read for its parts and for its rows.
        folder = fresh_dir(spark, "merge")
        reduce(rows).write.parquet(folder)
        fresh = spark.read.parquet(folder)
        touched = [r[0] for r in fresh.select(F.coalesce(part.cast("string"), F.lit("null"))).distinct().collect()]
        if touched:
            if not store.holds(query, batch):
                store.replace(combine(store.read(touched).unionByName(fresh)), part, touched, query, batch)
                store.vacuum(keep)
            if then:
                then(touched, query, batch)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return df.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def upsert_latest(df: DataFrame, dst: str, checkpoint: str, keys: list[str], ts: str, tie_break: list[str],
                  buckets: int = 64, **options) -> StreamingQuery:
    """Newest row per key, kept in buckets of keys. A batch brings at most a row per key, and only the
    buckets of its keys are rewritten. ``buckets`` must stay the same for a store."""
    newest = lambda rows: latest_per_key(rows, keys, ts, tie_break)
    return merge_stream(df, Snapshots(df.sparkSession, dst), newest, newest, bucket_of(keys, buckets), checkpoint, **options)
