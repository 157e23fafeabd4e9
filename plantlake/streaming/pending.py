"""Streams enriched by a dimension that changes while they run, and rows that wait for their dimension row."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plantlake.sources.snapshots import Snapshots
from plantlake.streaming.merge import bucket_of

BATCH = "__batch"


def enrich_when_known(df: DataFrame, dim: Callable[[], DataFrame], key: str, build: Callable[[DataFrame, DataFrame], DataFrame], dst: str,
                      waiting: Snapshots, checkpoint: str, partition_by: list[str] | None = None, buckets: int = 16,
                      continuous: str | None = None) -> StreamingQuery:
    """Append ``build(rows, dimension)`` to the folder ``dst`` for all rows whose key the dimension has. The dimension is read anew for
    each micro-batch. Rows of unknown keys wait, in buckets of keys, and go through as soon as their key is there.

    Each batch is written aside, then the waiting rows are replaced in a commit that names what was written aside, then that
    is moved into ``dst`` as a folder of its own. A batch that is repeated after a crash is written anew, or, if its commit was
    made, just moved: so no row is lost or doubled, even if the dimension changed in between. ``dst`` needs a file system that
    moves folders in one step. Waiting rows are not given up; a key that never comes keeps its rows waiting.
    """
    spark = waiting.spark
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(dst).getFileSystem(spark._jsc.hadoopConfiguration())

    def publish(aside: str | None, query: str, batch: int) -> None:
        if aside and files.exists(path(aside)):
            files.mkdirs(path(dst))
            final = path(f"{dst}/{BATCH}={query[:8]}-{batch:012d}")
            if files.exists(final) or not files.rename(path(aside), final):
                raise OSError(f"{aside} could not be moved to {final}")

    def take(rows: DataFrame, batch: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if waiting.commit().query not in (None, query):
            raise ValueError(f"{waiting.root} holds rows of another checkpoint; remove it and {dst} to start anew")
        if not waiting.holds(query, batch):
            now, bucket = dim(), bucket_of([key], buckets).cast("string")
            keys = now.select(key).distinct()
            ready, left = rows.join(keys, key, "left_semi"), rows.join(keys, key, "left_anti")
            moved = left.select(bucket.alias("b"))
            held = waiting.read() if waiting.exists() else None
            if held is not None:
                freed = held.join(keys, key, "left_semi")
                ready, moved = ready.unionByName(freed), moved.union(freed.select(bucket.alias("b")))
            touched = sorted(r.b for r in moved.distinct().collect())  # at most ``buckets``
            if held is not None and touched:
                left = left.unionByName(waiting.read(touched).join(keys, key, "left_anti"))
            aside = f"{dst}/_aside/{uuid.uuid4().hex}"
            writer = build(ready, now).write
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(aside)
            waiting.replace(left, bucket, touched, query, batch, aside)
            waiting.vacuum()
        publish(waiting.commit().note, query, batch)

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()
