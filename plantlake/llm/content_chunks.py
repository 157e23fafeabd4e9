"""Document fingerprints from content-defined chunks.

A text is cut where a gear hash of its last 32 bytes has zero bits: many of them before the normal
chunk size, few after it (normalised chunking), so sizes gather around the normal one. An insertion
moves only the cuts next to it; all other chunks, and so their digests, stay. The fingerprint
lists the distinct chunk digests with the bytes that each stands for, as hexadecimal text:
12 digits of digest and 8 of length each, ascending. The likeness of two fingerprints is the
length of their common chunks over the total length of the smaller, i.e. the containment of one in
the other.

Neighbours by doc id come from a range shuffle: compressed texts go to ranges of ids, each range
also gets the first document of the next one, and a task walks its ranges in order. No task holds
more than one step of texts.

Null is the empty text; empty fingerprints are alike (1.0) to each other and unlike (0.0) all
others. Null doc ids come first. Equal doc ids are ordered by their compressed text. A single
document is its own next one. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from plantlake.llm.common import steps
from plantlake.llm.ranges import id_bounds, part_of
from plantlake.llm.spans import joined, span_hashes

SMALLEST, NORMAL, LARGEST = 48, 96, 512
STRICT, LOOSE = np.uint32(0xFF << 24), np.uint32(0x1F << 27)
GEAR = np.random.default_rng(2016).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """Sum of the weights of the last 32 bytes, each shifted by its distance, for every place."""
    h = GEAR[buf]
    for k in (1, 2, 4, 8, 16):
        moved = h[:-k] << np.uint32(k)
        h[k:] += moved
    return h


def chunk_edges(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(edges, first)``: chunk ends of all texts in order; those of text i are ``first[i]:first[i + 1]``."""
    h = gear_hashes(buf)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = loose[(h[loose] & STRICT) == 0]
    loose, strict = (loose + 1).tolist(), (strict + 1).tolist()
    loose.append(len(buf) + LARGEST)
    strict.append(len(buf) + LARGEST)
    edges, first = [], [0]
    for start, stop in zip(at[:-1].tolist(), (at[1:] - 1).tolist()):
        while stop - start > SMALLEST:
            cut = strict[bisect_left(strict, start + SMALLEST)]
            if cut >= start + NORMAL:
                cut = min(loose[bisect_left(loose, start + NORMAL)], start + LARGEST)
            if cut >= stop:
                break
            edges.append(cut)
            start = cut
        if stop > start:
            edges.append(stop)
        first.append(len(edges))
    return np.array(edges, np.int64), np.array(first, np.int64)


def chunk_sets(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct chunk digests (48 bits, ascending) of each text and the bytes that each stands for."""
    buf, at = joined(texts)
    edges, first = chunk_edges(buf, at)
    starts = np.concatenate([np.zeros(1, np.int64), edges[:-1]]) if len(edges) else edges
    full = np.diff(first) > 0
    starts[first[:-1][full]] = at[:-1][full]
    digests, lengths = span_hashes(buf, starts, edges) >> np.uint64(16), edges - starts
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((digests, owner))
    digests, lengths, owner = digests[order], lengths[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(lengths, heads) if len(heads) else lengths
    digests, cuts = digests[heads], np.searchsorted(owner[heads], np.arange(len(texts) + 1))
    return [(digests[a:b], sums[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def as_text(chunks: tuple[np.ndarray, np.ndarray]) -> str:
    both = np.empty((len(chunks[0]), 10), np.uint8)
    both[:, :6] = chunks[0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    both[:, 6:] = chunks[1].astype(">u4").view(np.uint8).reshape(-1, 4)
    return both.tobytes().hex()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Containment by length, from 0 to 1."""
    total = min(int(a[1].sum()), int(b[1].sum()))
    if total == 0:
        return float(len(a[0]) == len(b[0]))
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    return float(np.minimum(a[1][same], b[1][at[same]]).sum() / total)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the next text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    bounds = id_bounds(docs, parts)
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(lowest))
    part = F.array_size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= key)) if len(bounds) else F.lit(0)
    # The first id of each range that has rows: at most ``parts`` rows.
    firsts = sorted((r.p, r.k) for r in docs.select(part.alias("p"), key.alias("k")).groupBy("p").agg(F.min("k").alias("k")).collect())
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}  # the range that also needs this document; the first wraps around
    chosen = docs.select(key.alias("doc_id"), docs["text"].cast("string").alias("text"))

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch, texts in steps(batches):
            ids = batch.column(0).to_pylist()
            rows = list(zip(part_of(batch.column(0), bounds).tolist(), [False] * len(ids), ids, [pack.compress(t) for t in texts]))
            rows += [(before[d], True, d, z) for _, _, d, z in rows if d in before]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))],
                                             names=["part", "tail", "doc_id", "text"])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def described(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        """All rows but the last, which is only the next of the one before."""
        texts = [t for _, t in rows]
        plain = [t.decode() for t in texts]
        changed = [edited(a, b).encode() for a, b in zip(plain, plain[1:])]
        own, other = chunk_sets(texts), chunk_sets(changed)
        return pa.RecordBatch.from_arrays(
            [pa.array([None if d == lowest else d for d, _ in rows[:-1]], pa.int64()), pa.array([len(t) for t in plain[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in changed]), pa.array([as_text(c) for c in own[:-1]], pa.string()),
             pa.array([as_text(c) for c in other], pa.string()), pa.array([likeness(a, b) for a, b in zip(own, other)]),
             pa.array([likeness(a, b) for a, b in zip(own, own[1:])])], names=names)

    def walk(batches):
        unpack, held, size, current, closed = zstandard.ZstdDecompressor(), [], 0, None, False
        for batch in batches:
            for p, tail, d, z in zip(*(c.to_pylist() for c in batch.columns)):
                if p != current:
                    held, size, current, closed = [], 0, p, False
                if closed:
                    continue  # a further document with the id of the next range's first
                held.append((d, unpack.decompress(z)))
                size += len(held[-1][1])
                closed = tail
                if len(held) > 1 and (tail or size >= 2 << 20):
                    yield described(held)
                    held, size = held[-1:], len(held[-1][1])

    dealt = chosen.mapInArrow(deal, "part int, tail boolean, doc_id long, text binary")
    placed = dealt.repartition(parts, "part").sortWithinPartitions("part", "tail", "doc_id", "text")
    return placed.mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
