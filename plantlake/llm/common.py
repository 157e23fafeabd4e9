"""Helpers shared by the operators: written tables, packed arrays, batches of documents."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from plantlake.session import fresh_dir

#: Bytes of text that one step of a task works on. A longer text is a step of its own.
STEP = 4 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, stored once in the shared folder and read from there. Cuts the
    lineage: a lost executor makes later steps read files, not recompute."""
    spark: SparkSession = df.sparkSession
    folder = fresh_dir(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.stored_at = folder
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a ``written`` table that no later step reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def strings(column: pa.Array) -> list[bytes]:
    """UTF-8 of a text column; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def steps(batches: Iterable[pa.RecordBatch], size: int = STEP) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches, each with about ``size`` bytes in its column ``text``."""
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            n = min(int(np.searchsorted(ends, before + size)) + 1, len(ends)) - start
            yield batch.slice(start, n), strings(column.slice(start, n))  # only one step's texts are Python objects
            start += n


def merged(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """As ``steps``, but small batches are put together up to ``size`` bytes."""
    held, texts, total = [], [], 0
    for batch, own in steps(batches, size):
        held.append(batch)
        texts += own
        total += sum(map(len, own))
        if total >= size:
            yield pa.concat_batches(held), texts
            held, texts, total = [], [], 0
    if held:
        yield pa.concat_batches(held), texts


def shard_numbers() -> Iterator[int]:
    """Numbers that no other task of the same job uses. Rows carrying them must be stored before
    they are read twice."""
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 32
    n = 0
    while True:
        yield first + n
        n += 1


def give_back() -> None:
    """Return what this Python worker has freed to the system. Spark keeps workers for a minute after their task; what they
    hold then counts beside the next stage."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving back its memory at the end of each task."""
    def task(batches):
        yield from run(batches)
        give_back()

    return task


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` for ``applyInArrow`` over large groups, giving back its memory after each."""
    def group(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return group


_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()  # a worker runs one task at a time


def packed(values: np.ndarray) -> bytes:
    """Compressed array; the bytes of each place go together, which suits sorted or small numbers."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T
    return _PACKER.compress(planes.tobytes())


def packed_runs(values: np.ndarray, stops: np.ndarray) -> list[bytes]:
    """``packed`` of each of the runs of ``values`` that end at ``stops``."""
    raw = np.ascontiguousarray(values)
    planes = [np.ascontiguousarray(x).tobytes() for x in raw.view(np.uint8).reshape(len(raw), raw.itemsize).T]
    ends = stops.tolist()
    return [_PACKER.compress(b"".join([p[a:b] for p in planes])) for a, b in zip([0, *ends], ends)]


def unpacked(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_UNPACKER.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def packed_sorted(values: np.ndarray) -> bytes:
    """``packed`` for ascending numbers, as steps between them."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_next_batch()


def crc_of_id(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


Reader = Callable[[SparkSession, str], DataFrame]
