"""Token counts by byte-pair merging with a heap and a linked list.

The lowest-ranked adjacent pair is popped again and again; a text has as many tokens as it has
bytes less the merges made. No ids are made. The vocabulary file is read on the driver and
travels with the job, so executors need no copy of it.

Texts are cut into units whose edges are always token edges (``spans.units``). Each unit is
counted once per task step, and counts of units seen before are kept in the Python worker.
Work is one pass over the scan, without a shuffle, so no key, source or copy can load one task
more than its rows do.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated results, null ids
pass through, further columns are ignored. Special strings inside a text count as one token each.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plantlake.llm.common import steps
from plantlake.llm.spans import exact_distinct, units

#: Units whose counts a worker keeps, each of so many bytes at most; beyond it the memory starts anew. Results don't depend on it.
REMEMBERED, KEPT = 1_000_000, 64


def byte_letters() -> dict[str, int]:
    """Letter that byte-level vocabulary files write for each byte: printable bytes stand for
    themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks and special strings of a byte-level tokenizer file (JSON)."""

    def __init__(self, data: bytes, pattern: str):
        made = json.loads(data)
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        raw = lambda token: bytes(letters[c] for c in token)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            a, b = raw(a), raw(b)
            new = number.setdefault(a + b, len(number))
            self.pairs.setdefault((number[a], number[b]), (rank, new))
        self.special = [t["content"].encode() for t in made.get("added_tokens", [])]
        self.cut = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) \
            if self.special else None
        self.pattern = regex.compile(pattern)
        self.words: dict[str, int] = {}
        self.units: dict[bytes, int] = {}

    def count(self, text: str) -> int:
        """Tokens of one text, without special strings."""
        total = 0
        for word in self.pattern.findall(text):
            n = self.words.get(word)
            if n is None:
                symbols = list(word.encode())
                n = len(symbols) - merges(symbols, self.pairs)
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                if len(word) <= KEPT:
                    self.words[word] = n
            total += n
        return total


def merges(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Merge ``symbols`` as far as it goes and return the number of merges. Equal ranks merge from
    the left. Merged-away places hold -1 afterwards."""
    n, done = len(symbols), 0
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*pairs[key], i, *key) for i, key in enumerate(zip(symbols, symbols[1:])) if key in pairs]
    heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, new, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = new, -1
        done += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (found := pairs.get((new, symbols[k]))) is not None:
                heapq.heappush(heap, (found[0], i, found[1], new, symbols[k]))
        if (p := before[i]) >= 0 and (found := pairs.get((symbols[p], new))) is not None:
            heapq.heappush(heap, (found[0], p, found[1], symbols[p], new))
    return done


def count_step(texts: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each text."""
    parts, owner, extra = texts, np.arange(len(texts)), np.zeros(len(texts), np.int64)
    if vocabulary.cut is not None and any(s in t for t in texts for s in vocabulary.special):
        cut = [vocabulary.cut.split(t) for t in texts]
        parts = [p for some in cut for p in some]
        owner = np.repeat(owner, [len(some) for some in cut])
        extra = np.array([len(some) - 1 for some in cut], np.int64)
    buf, starts, ends, first = units(parts)
    at, each = exact_distinct(buf, starts, ends)
    known, data = vocabulary.units, buf.tobytes()
    if len(known) > REMEMBERED:
        known.clear()
    counts = np.empty(len(at), np.int64)
    for i, (a, b) in enumerate(zip(starts[at].tolist(), ends[at].tolist())):
        unit = data[a:b]
        n = known.get(unit)
        if n is None:
            n = vocabulary.count(unit.decode())
            if b - a <= KEPT:
                known[unit] = n
        counts[i] = n
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[each])])
    return extra + np.bincount(owner, sums[first[1:]] - sums[first[:-1]], len(texts)).astype(np.int64)


_LOADED: dict[int, Vocabulary] = {}


def token_counts(docs: DataFrame, vocabulary_file: str, pattern: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row."""
    with open(vocabulary_file, "rb") as file:
        data = file.read()
    kind = dict(docs.dtypes)[id_col]

    def count(batches):
        vocabulary = _LOADED.get(key := hash((data, pattern)))
        if vocabulary is None:
            vocabulary = _LOADED[key] = Vocabulary(data, pattern)
        for batch, texts in steps(batches):
            n = count_step(texts, vocabulary)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return chosen.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
