"""Words and token-boundary units of many texts at once, as offsets and 64-bit hashes.

A span's hash is a pair of polynomials over random byte weights modulo a prime, taken from running sums, so that a task
never makes a Python object for a word that it has seen before. Two hashes with different
``seed`` are independent. Where equal hashes must mean equal bytes, ``exact_distinct`` compares the bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

U = np.uint64
_BLOCK = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)  # ASCII marks that always end a run of letters; the apostrophe may start a contraction
_MARK[[x for x in range(33, 127) if not chr(x).isalnum() and x != 39]] = True
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: White space outside ASCII, in UTF-8.
_WIDE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

PRIME = (1 << 31) - 1
#: Spans beyond this many bytes are compared as Python bytes.
_LONG = 4096

_SEEDS: dict[int, list[tuple[np.ndarray, int, int]]] = {}
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
_BASES: dict[int, int] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all bits."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0x9E3779B97F4A7C15)
    return h ^ (h >> U(32))


def _seeded(seed: int) -> list[tuple[np.ndarray, int, int]]:
    """Weights, base and inverse base of both polynomials."""
    if seed not in _SEEDS:
        rng = np.random.default_rng(7919 + seed)
        bases = [int(x) for x in rng.integers(1 << 20, PRIME - 1, 2)]
        _SEEDS[seed] = [(rng.integers(1, PRIME, 256, dtype=np.int64).astype(U), base, pow(base, -1, PRIME)) for base in bases]
    return _SEEDS[seed]


def _row_of_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * U(pow(base, have, PRIME)) % U(PRIME)
        have += more
    return out


def _powers(seed: int, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if (seed, k) not in _POWERS or len(_POWERS[seed, k][0]) < n:
        _, base, inverse = _seeded(seed)[k]
        both = _row_of_powers(base, n), _row_of_powers(inverse, n)
        if n > 4 * _BLOCK:
            return both
        _POWERS[seed, k] = both
    return _POWERS[seed, k]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each span of bytes; spans ascend and don't overlap. Works in blocks of the buffer."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + _BLOCK, side="right")))
        last = int(ends[j - 1])
        a, b, parts = starts[i:j] - first, ends[i:j] - first, []
        for k, (weights, _, _) in enumerate(_seeded(seed)):
            up, down = _powers(seed, k, max(_BLOCK, last - first) + 1)
            terms = weights[buf[first:last]] * up[:last - first]
            terms = (terms & U(PRIME)) + (terms >> U(31))  # below 2^32, so that running sums fit
            sums = np.zeros(last - first + 1, U)
            np.cumsum(terms, out=sums[1:])
            parts.append((sums[b] - sums[a]) % U(PRIME) * down[a] % U(PRIME))
        out[i:j] = mixed((parts[0] << U(32) | parts[1]) + (b - a).astype(U) * U(0x9E3779B97F4A7C15))
        i = j
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ascending distinct keys, a place of each, number of each key's distinct one)``."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def differing(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Numbers of the spans whose bytes are not those of span ``other`` (a number for each)."""
    sizes = ends - starts
    odd = sizes != sizes[other]
    live = np.flatnonzero(~odd & (other != np.arange(len(starts))) & (sizes > 0))
    data = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(buf) + 1,), "<u8", data, strides=(1,))  # eight bytes from every place on
    step = 0
    for i in live[sizes[live] > _LONG].tolist():
        j = other[i]
        odd[i] = buf[starts[i]:ends[i]].tobytes() != buf[starts[j]:ends[j]].tobytes()
    live = live[sizes[live] <= _LONG]
    while len(live):
        size = sizes[live]
        at = np.minimum(step, np.maximum(size - 8, 0))
        spare = U(8) * np.maximum(8 - size, 0).astype(U)  # bits of a short span's load that are not its own
        odd[live] |= ((eight[starts[live] + at] ^ eight[starts[other[live]] + at]) << spare) != 0
        step += 8
        live = live[(size > step) & ~odd[live]]
    return np.flatnonzero(odd)


def _ends_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of each span as numbers. A span of fewer has all in the first and 0 in the second."""
    data = np.concatenate([np.zeros(8, np.uint8), buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(buf) + 9,), "<u8", data, strides=(1,))  # eight bytes from every place on, from 8 before the first
    sizes = ends - starts
    short = np.flatnonzero(sizes < 8)
    low, high = eight[starts + 8], eight[ends]
    low[short] <<= U(8) * (8 - sizes[short]).astype(U)
    low[sizes == 0] = high[short] = 0
    return low, high


def exact_distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(a place of each distinct span, number of each span's distinct one)``, told apart by their bytes. Only spans of
    over 16 bytes have others between their ends; those are hashed and compared byte by byte."""
    sizes = ends - starts
    low, high = _ends_of(buf, starts, ends)
    keys = mixed(low + mixed(high + sizes.astype(U) * U(0x9E3779B97F4A7C15)))
    long = np.flatnonzero(sizes > 16)
    if len(long):
        lengths = sizes[long]
        stop = np.cumsum(lengths)
        if 2 * int(stop[-1]) < len(buf):
            keys[long] ^= span_hashes(buf[np.repeat(starts[long] - (stop - lengths), lengths) + np.arange(stop[-1])], stop - lengths, stop)
        else:
            keys[long] ^= span_hashes(buf, starts[long], ends[long])
    each = pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)  # numbers in order of first places
    if len(each) == 0:
        return each, each.copy()
    at = np.flatnonzero(np.diff(np.maximum.accumulate(each), prepend=-1))
    other = at[each]
    wrong = (sizes != sizes[other]) | (low != low[other]) | (high != high[other])
    live = np.flatnonzero((sizes > 16) & ~wrong)
    if len(live):
        place = np.zeros(len(starts), np.int64)
        place[live] = np.arange(len(live))
        wrong[live[differing(buf, starts[live], ends[live], place[other[live]])]] = True
    odd = np.flatnonzero(wrong)
    if len(odd):  # other spans of the same key
        found: dict[bytes, int] = {}
        places = at.tolist()
        for i in odd.tolist():
            name = buf[starts[i]:ends[i]].tobytes()
            if name not in found:
                found[name] = len(places)
                places.append(i)
            each[i] = found[name]
        at = np.array(places, np.int64)
    return at, each


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` neighbours in an array of word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, U)
    out = np.zeros(n, U)
    if seed not in _BASES:
        _BASES[seed] = int(np.random.default_rng(104729 + seed).integers(1 << 62, 1 << 63)) | 5
    for k in range(length):
        out *= U(_BASES[seed])
        out += words[k:k + n]
    return mixed(out)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer with a line end after each, and where each starts (one more at the end)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), at


def words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(buffer, starts, ends, first)``: runs of other than ASCII white space; the words of text i
    are ``first[i]:first[i + 1]``."""
    buf, at = joined([t.translate(LOWER) for t in texts] if lower else texts)
    edge = np.diff(np.concatenate([np.zeros(1, np.int8), (~_SPACE[buf]).view(np.int8), np.zeros(1, np.int8)]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return buf, starts, ends, np.searchsorted(starts, at)


def units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(buffer, starts, ends, first)`` as ``words``, for spans that a byte-level tokenizer with the
    usual pattern splits the same wherever they stand: every span edge is a token edge. Edges are
    put before white space, after a lone line end and between an ASCII letter and a mark."""
    buf, at = joined(texts)
    wide = _WIDE.search(buf.tobytes()) is not None
    space = _SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    if len(buf) > 1:
        low = buf < 128 if wide else np.ones(len(buf), bool)
        cut[1:-1] = (space[1:] & ~space[:-1] & low[:-1]) | (_LETTER[buf[:-1]] & _MARK[buf[1:]])
        cut[2:-1] |= (buf[1:-1] == 10) & ~space[2:] & ~space[:-2] & low[2:] & low[:-2]
    cut[at] = cut[at[1:] - 1] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    real = np.ones(len(starts), bool)
    real[np.searchsorted(starts, at[1:] - 1)] = False  # the line ends that join the texts
    starts, ends = starts[real], ends[real]
    return buf, starts, ends, np.searchsorted(starts, at)
