"""Parquet tables whose parts, such as a day or a bucket of keys, are replaced as a whole.

A replacement writes the new parts into a folder of its own, and then one small commit file that names the folder
of every part. Readers take the newest commit, so they see all of a replacement or nothing of it, and a failed
write leaves the table as it was. Two writers can't make the same commit: the later one fails. A
commit can carry the query and micro-batch that it comes from, so that a repeated batch is known.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

PART = "__part"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class Commit:
    version: int = -1
    parts: dict[str, str] = field(default_factory=dict)  #: folder of each part
    schema: str | None = None
    query: str | None = None  #: streaming query that the rows come from, and its last batch
    batch: int = -1
    note: str | None = None  #: of the writer


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._files.listStatus(place)) if self._files.exists(place) else []

    def exists(self) -> bool:
        return self._files.exists(self._path(f"{self.root}/_commits"))

    def commits(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("_commits") if n.endswith(".json") and n[0] != "."]

    def commit(self, version: int | None = None) -> Commit:
        """The newest commit, or an older one."""
        if version is None:
            version = max(self.commits(), default=-1)
        if version < 0:
            return Commit()
        stream = self._files.open(self._path(f"{self.root}/_commits/{version:012d}.json"))
        try:
            return Commit(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def read(self, parts: list[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows of all parts, or of those named; parts that don't exist have no rows."""
        now = self.commit(version)
        if now.schema is None:
            raise ValueError(f"{self.root} has no commit yet")
        schema = T.StructType.fromJson(json.loads(now.schema))
        folders = [f for p, f in now.parts.items() if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self._listed(schema, [f"{self.root}/{f}" for f in folders])

    def _listed(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        """The folders as a table. A task lists many folders: Spark's default is one task for each, which takes longer than the listing."""
        conf, tasks = self.spark.conf, 4 * self.spark.sparkContext.defaultParallelism
        before = conf.get(LISTING)
        conf.set(LISTING, str(min(int(before), tasks)))
        try:
            return self.spark.read.schema(schema).parquet(*folders)  # lists them now
        finally:
            conf.set(LISTING, before)

    def holds(self, query: str, batch: int) -> bool:
        """Whether a batch of a query is already in the table."""
        now = self.commit()
        return now.query == query and batch <= now.batch

    def replace(self, rows: DataFrame, part: Column, parts: list[str] | None = None, query: str | None = None, batch: int = -1,
                note: str | None = None) -> Commit:
        """Put ``rows`` in the place of the named parts; without names, of all. ``part`` gives each row's part, a text fit
        for a folder name."""
        now = self.commit()
        version = now.version + 1
        folder = f"data/{version:012d}-{uuid.uuid4().hex[:8]}"
        placed = rows.withColumn(PART, F.coalesce(part.cast("string"), F.lit("null")))
        placed.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        made = [n.removeprefix(f"{PART}=") for n in self._names(folder) if n.startswith(f"{PART}=")]
        if parts is not None and set(made) - set(parts):
            raise ValueError(f"rows of other parts: {sorted(set(made) - set(parts))[:5]}")
        kept = {} if parts is None else {p: f for p, f in now.parts.items() if p not in set(parts)}
        new = Commit(version, kept | {p: f"{folder}/{PART}={p}" for p in made}, json.dumps(rows.schema.jsonValue()), query, batch, note)
        self._publish(new)
        return new

    def declare(self, schema: T.StructType) -> None:
        """A commit that changes nothing but the schema."""
        now = self.commit()
        self._publish(replace(now, version=now.version + 1, schema=json.dumps(schema.jsonValue())))

    def _publish(self, new: Commit) -> None:
        jvm = self.spark._jvm
        draft, final = (self._path(f"{self.root}/_commits/{n}") for n in (f".{uuid.uuid4().hex}", f"{new.version:012d}.json"))
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(asdict(new)).encode()))
        finally:
            stream.close()
        # Unlike a plain rename, this one fails where the name is taken.
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, final, plain)

    def vacuum(self, keep: int = 20) -> None:
        """Remove commits before the last ``keep`` and folders that no kept one names. Readers of older commits fail then."""
        versions = self.commits()
        held = {f.split("/")[1] for v in versions[-keep:] for f in self.commit(v).parts.values()}
        for name in self._names("data"):
            if name not in held and int(name.split("-")[0]) <= versions[-1]:
                self._files.delete(self._path(f"{self.root}/data/{name}"), True)
        for v in versions[:-keep]:
            self._files.delete(self._path(f"{self.root}/_commits/{v:012d}.json"), False)
