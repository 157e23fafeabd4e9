"""Exact removal of repeated word windows by level-wise doubling.

A window of ``length`` words can only repeat if the shorter windows inside it do. Level by level
(``base`` words, twice as many, and so on up to ``length``) only those windows are kept as
candidates that occur more than once, and two repeated windows side by side (at the last level,
overlapping) make a candidate of the next length. Texts without candidates are finished at once
and are not stored or moved again; it ends when no candidates survive or the full length is reached. At
the full length each candidate learns the smallest doc id that its words start in.

Repetition is decided by bucket of hashed windows (``exchange``), so a passage that a third of all
documents share costs each shard one key. Shorter levels use as many hash bits as the
corpus needs to keep chance repeats rare (they only cost work); the full length uses 64 bits. Two
different windows sharing those would need about as many windows as there are hash values squared:
below 1 in 2,000 for the whole of 100 million windows.

A null text has no words. Rows with a null doc id are kept whole and don't count as sources. Rows
that share a doc id count as one document. Further columns go along as asked for.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantlake.llm.common import discard, from_ipc, lean, strings, to_ipc, written
from plantlake.llm.exchange import SENT_SQL, answered, buckets_for, combined, send, shards
from plantlake.llm.spans import span_hashes, window_hashes, words


def lengths_of_levels(length: int, base: int) -> list[int]:
    out = []
    while base < length:
        out.append(base)
        base *= 2
    return [*out, length]


class _Shard:
    """Word hashes of a stored shard and its candidate places for windows of ``length`` words."""

    def __init__(self, payload: bytes, length: int, hashed: bool = True):
        self.batch = from_ipc(payload)
        self.texts = strings(self.batch.column("text"))
        buf, starts, ends, self.first = words(self.texts, lower=False)
        self.words = span_hashes(buf, starts, ends) if hashed else None
        self.doc = np.repeat(np.arange(len(self.texts)), np.diff(self.first))
        ids = self.batch.column("doc_id").cast(pa.int64())
        self.named = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.length = length
        masks = self.batch.column("candidates").to_pylist()
        self.candidates = np.ones(len(self.doc), bool)
        for mask, a, b in zip(masks, self.first[:-1], self.first[1:]):
            if mask is not None:
                self.candidates[a:b] = np.unpackbits(np.frombuffer(mask, np.uint8), count=b - a)
        self.candidates &= self.whole(length) & self.named[self.doc]

    def whole(self, length: int) -> np.ndarray:
        """Where a window of ``length`` words stays in its document."""
        out = np.zeros(len(self.doc), bool)
        n = len(self.doc) - length + 1
        if n > 0:
            out[:n] = self.doc[:n] == self.doc[length - 1:]
        return out

    def places(self) -> np.ndarray:
        return np.flatnonzero(self.candidates)

    def keys(self, places: np.ndarray, bits: int) -> np.ndarray:
        h = window_hashes(self.words, self.length, seed=self.length)
        return h[places] >> np.uint64(64 - bits) << np.uint64(64 - bits) if len(places) else h[:0]


def _least(doc_ids: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """Smallest doc id per group."""
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, index, doc_ids)
    return out


def deduplicated(docs: DataFrame, length: int = 13, base: int = 3, carry: tuple[str, ...] = ("doc_id",), with_text: bool = True) -> DataFrame:
    """``(*carry, n_words, n_removed, kept_sha256[, text])`` for every row. ``text`` is the text as it was where
    nothing was removed, else the kept words joined by spaces. ``carry`` must hold ``doc_id``."""
    levels = lengths_of_levels(length, base)
    names = [c for c in carry if c != "text"]
    # The candidates of the first level are all windows, so no mask is stored.
    current = texts = shards(docs.withColumn("candidates", F.lit(None).cast("binary")), [*names, "candidates"], label="substring-texts")
    kinds = dict(docs.dtypes)
    arrow = pa.schema([*_arrow_fields(docs, names), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept_sha256", pa.string()),
                       pa.field("text", pa.string()), pa.field("shard", pa.int64()), pa.field("kind", pa.int32()), pa.field("n", pa.int64()), pa.field("payload", pa.binary())])
    sql = (", ".join(f"`{c}` {kinds[c]}" for c in names)
           + ", n_words long, n_removed long, kept_sha256 string, text string, shard long, kind int, n long, payload binary")
    finished = []
    for level, size in enumerate(levels):
        last = size == length
        total = current.agg(F.sum("n")).first()[0] or 0
        keys = total // 6 if level == 0 else total  # first bytes of text, then candidate places
        if last and level and not total:
            break
        bits = 64 if last else min(64, max(32, int(keys).bit_length() + 11))
        buckets = buckets_for(keys)

        def ask(batches, size=size, last=last, bits=bits, buckets=buckets):
            for batch in batches:
                for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    shard = _Shard(payload, size)
                    at = shard.places()
                    if not len(at):
                        continue
                    own = shard.keys(at, bits)
                    if last:
                        distinct, index = np.unique(own, return_inverse=True)
                        values = _least(shard.ids[shard.doc[at]], index, len(distinct))
                    else:
                        distinct, counts = np.unique(own, return_counts=True)
                        values = counts > 1
                    yield send(0, number, distinct, [values], buckets)

        def meet(level, index, distinct, values, last=last):
            if last:
                return [_least(values[0], index, len(distinct))], []
            return [(np.bincount(index, minlength=len(distinct)) > 1) | (np.bincount(index, values[0], len(distinct)) > 0)], []

        def decide(number, kind, payload, found, size=size, last=last, bits=bits, following=None if last else levels[level + 1]):
            shard = _Shard(payload, size)
            at = shard.places()
            answer = np.empty(0, np.int64 if last else bool)
            if len(at):
                _, index = np.unique(shard.keys(at, bits), return_inverse=True)
                answer = found[0][0][index]
            if last:
                hit = at[answer < shard.ids[shard.doc[at]]]
                edge = np.bincount(hit, minlength=len(shard.doc) + 1) - np.bincount(hit + size, minlength=len(shard.doc) + 1)
                return [_results(shard, names, with_text, np.cumsum(edge)[:-1] > 0, np.arange(len(shard.texts)), arrow)]
            again = np.zeros(len(shard.doc), bool)
            again[at[answer]] = True
            move = following - size
            following_ok = shard.whole(following)
            following_ok[:max(len(again) - move, 0)] &= again[:-move] & again[move:]
            more = np.bincount(shard.doc[following_ok], minlength=len(shard.texts)) > 0
            out = [_results(shard, names, with_text, None, np.flatnonzero(~more), arrow)]
            if more.any():
                rows = np.flatnonzero(more)
                masks = [np.packbits(following_ok[shard.first[i]:shard.first[i + 1]]).tobytes() for i in rows]
                rest = shard.batch.take(pa.array(rows))
                rest = rest.set_column(rest.schema.get_field_index("candidates"), "candidates", pa.array(masks, pa.binary()))
                empty = [pa.nulls(1, f.type) for f in arrow][:-4]
                out.append(pa.RecordBatch.from_arrays([*empty, pa.array([number]), pa.array([kind], pa.int32()), pa.array([int(following_ok.sum())]),
                                                       pa.array([to_ipc(rest)], pa.binary())], schema=arrow))
            return out

        sent = current.select("shard", "payload").mapInArrow(lean(ask), SENT_SQL)
        answers = combined(sent, [np.int64 if last else np.bool_], meet, f"substring-level-{size}")
        out = answered(current, answers, decide, [np.int64 if last else np.bool_], sql, arrow)
        columns = [*names, "n_words", "n_removed", "kept_sha256", *(["text"] if with_text else [])]
        if last:
            finished.append(out.select(*columns))
            break
        stored = written(out, f"substring-after-{size}")
        finished.append(stored.where("payload is null").select(*columns))
        discard(texts if level == 0 else answers)
        current = stored.where("payload is not null").select("shard", "kind", "n", "payload")
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result


def _arrow_fields(docs: DataFrame, names: list[str]) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(docs.select(*names).schema))


def _results(shard: _Shard, names: list[str], with_text: bool, removed: np.ndarray | None, rows: np.ndarray, arrow: pa.Schema) -> pa.RecordBatch:
    """Result rows of the documents ``rows``; ``removed`` marks words, None for no word."""
    n, gone, sha, texts = [], [], [], []
    for i in rows.tolist():
        text = shard.texts[i]
        own, a, b = text.split(), shard.first[i], shard.first[i + 1]
        cut = int(removed[a:b].sum()) if removed is not None else 0
        kept = b" ".join(compress(own, (~removed[a:b]).tolist()) if cut else own)
        n.append(len(own))
        gone.append(cut)
        sha.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            texts.append(kept.decode() if cut else text.decode())
    some = shard.batch.take(pa.array(rows))
    if with_text:
        null = some.column("text").is_null()
        texts = [None if x else t for x, t in zip(null.to_pylist(), texts)]
    columns = [some.column(c).cast(arrow.field(c).type) for c in names]
    tail = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
            pa.array(texts, pa.string()) if with_text else pa.nulls(len(n), pa.string())]
    return pa.RecordBatch.from_arrays([*columns, *tail, *(pa.nulls(len(n), f.type) for f in list(arrow)[-4:])], schema=arrow)
