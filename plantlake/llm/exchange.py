"""Looking up what the whole corpus knows about a shard's keys.

Texts are stored as shards, rows of a few megabytes. A shard sends each of its distinct 64-bit keys
once, in compressed runs, to the bucket of the key; a bucket combines what all shards sent and
answers each of them in the order of its keys; the answers meet the shard again. Since a key
leaves a shard once however often it occurs there, a frequent word, passage or group of copies
loads its bucket no more than a rare key does, and nothing is dropped or salted. Buckets are ranges of
the hashed key and their number follows the number of keys, so memory per task stays the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantlake.llm.common import lean, lean_group, merged, packed, packed_sorted, rows_to_batch, shard_numbers, to_ipc, unpacked, unpacked_sorted, written

#: Text bytes of a shard (unless one text is longer) and keys of a bucket, roughly.
SHARD, KEYS = 12 << 20, 2 << 20

SHARDS = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("payload", pa.binary())])
SHARDS_SQL = "shard long, kind int, n long, payload binary"
SENT = pa.schema([("level", pa.int32()), ("bucket", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("values", pa.list_(pa.binary()))])
SENT_SQL = "level int, bucket int, shard long, keys binary, values array<binary>"
ANSWER = pa.schema([("shard", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()), ("answers", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])
ANSWER_SQL = "shard long, level int, bucket int, answers array<binary>, sums array<bigint>"


def shards(docs: DataFrame, columns: list[str], kind_of: Callable[[dict], int] | None = None, label: str = "shards") -> DataFrame:
    """Store ``docs`` (``columns`` and ``text``) as shards. ``n`` is the number of text bytes.
    ``kind_of`` puts rows of different kinds (0 to 3) into different shards; the kind is also the
    shard number's rest by 4."""
    source = docs.select(*columns, docs["text"].cast("string").alias("text"))

    def pack(batches):
        numbers = shard_numbers()
        for batch, texts in merged(batches, SHARD):
            kinds = [0] * batch.num_rows if kind_of is None else [kind_of(r) for r in batch.select(columns).to_pylist()]
            for kind in sorted(set(kinds)):
                own = batch if len(set(kinds)) == 1 else batch.filter(pa.array([k == kind for k in kinds]))
                size = sum(len(t) for t, k in zip(texts, kinds) if k == kind)
                yield rows_to_batch([(4 * next(numbers) + kind, kind, size, to_ipc(own))], SHARDS)

    return written(source.mapInArrow(lean(pack), SHARDS_SQL), label)


def buckets_for(keys: int) -> int:
    return max(1, -(-keys // KEYS))


def send(level: int, shard: int, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row per bucket for ascending distinct keys and arrays alongside."""
    cuts = bucket_cuts(keys, buckets)
    rows = [(level, b, shard, packed_sorted(keys[i:j]), [packed(v[i:j]) for v in values])
            for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if j > i]
    return rows_to_batch(rows, SENT)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in ascending keys."""
    lows = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, lows), [len(keys)]])


def combined(sent: DataFrame, kinds: list, combine: Callable[[int, np.ndarray, np.ndarray, list[np.ndarray]], tuple[list[np.ndarray], list[int]]],
             label: str) -> DataFrame:
    """Bring the keys of each bucket together. ``combine(level, index, distinct keys, values)`` gets
    every sent key's place among the distinct ones and gives arrays for the distinct keys, to be
    answered, and sums for the bucket, stored once under shard -1."""
    def answer(table: pa.Table) -> pa.Table:
        level, bucket = table.column("level")[0].as_py(), table.column("bucket")[0].as_py()
        keys = [unpacked_sorted(k, np.uint64) for k in table.column("keys").to_pylist()]
        stops = np.cumsum([0, *map(len, keys)])
        sent_values = table.column("values").to_pylist()
        values = [np.concatenate([unpacked(v[i], kind) for v in sent_values]) for i, kind in enumerate(kinds)]
        distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
        answers, sums = combine(level, index, distinct, values)
        rows = [(-1, level, bucket, [], [int(s) for s in sums])]
        for shard, a, b in zip(table.column("shard").to_pylist(), stops[:-1], stops[1:]):
            rows.append((shard, level, bucket, [packed(x[index[a:b]]) for x in answers], []))
        return pa.Table.from_batches([rows_to_batch(rows, ANSWER)])

    return written(sent.groupBy("level", "bucket").applyInArrow(lean_group(answer), ANSWER_SQL), label)


def answered(stored: DataFrame, answers: DataFrame, run: Callable[[int, int, bytes, dict[int, list[np.ndarray]]], list[pa.RecordBatch]],
             kinds: list, schema: str, arrow: pa.Schema) -> DataFrame:
    """``run(shard, kind, payload, {level: arrays})`` for every stored shard, with the answers for
    its ascending distinct keys at each level."""
    both = stored.select("shard", "kind", "payload", F.lit(None).cast("int").alias("level"), F.lit(None).cast("int").alias("bucket"),
                         F.lit(None).cast("array<binary>").alias("answers")).unionByName(
        answers.where("shard >= 0").select("shard", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("binary").alias("payload"), "level", "bucket", "answers"))

    def one(table: pa.Table) -> pa.Table:
        parts: dict[int, list] = {}
        kind = payload = None
        for row in table.sort_by("bucket").to_pylist():
            if row["payload"] is not None:
                kind, payload = row["kind"], row["payload"]
            else:
                parts.setdefault(row["level"], []).append(row["answers"])
        if payload is None:
            return arrow.empty_table()
        found = {level: [np.concatenate([unpacked(a[i], k) for a in some]) for i, k in enumerate(kinds)] for level, some in parts.items()}
        shard = table.column("shard")[0].as_py()
        return pa.Table.from_batches(run(shard, kind, payload, found), schema=arrow)

    return both.groupBy("shard").applyInArrow(lean_group(one), schema)
