"""Byte-level BPE encoding and decoding as folds over the byte arrays of distinct words.

Three steps, without a shuffle of texts:

1. A task cuts its texts into pattern matches (words) and numbers the distinct ones, a shard of texts at
   a time. What the last step needs of a shard goes to a file in the shared folder; its words are rows of one
   table, dealt into buckets by their bytes. Both are stored, so that a lost executor costs no second cutting.
2. Each bucket of words keeps the distinct ones, so a word is encoded once however many shards have it. Spark's higher-order
   functions encode it: ``aggregate`` folds merges over the array of its bytes, each time joining the leftmost adjacent
   pair of lowest rank. Ranks come from a literal rank map, dealt into small maps by checksum so that a lookup compares a
   few keys. Decoding looks the ids up in a literal array of byte pieces and concatenates them.
3. Ids and bytes of the words go back to the shards that have them, where a task puts each document together.

A byte is written as the letter of the same number, so byte arrays are strings in the fold.
The fold looks at every pair for every merge. Words of over ``FOLD_BYTES`` bytes are therefore
merged with a heap in step 2, by the same rule. Vocabulary files are read on the driver.

The most frequent words of a sample of texts are folded and decoded first and travel with the job, ``SEED_WORDS`` of them
at most from about ``SEED_DOCS`` texts; only other words go to the buckets. Results don't depend on the sample. A word
that the pattern cuts further when it stands alone is not among them, so a unit that equals one of them needs no cutting.

Shard files are written through Arrow, which knows the paths that ``ranges.storage`` names. A file has a name of its own,
which the rows of its words carry, so a repeated task can't mix two cuttings.

Null and empty texts give no ids. Null and repeated doc ids pass through, row by row. Further
columns are kept only on request (``keep``); special strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from plantlake.llm.common import from_ipc, give_back, lean, merged, packed, to_ipc, unpacked, written
from plantlake.llm.heap_bpe import merges
from plantlake.llm.ranges import storage
from plantlake.llm.spans import exact_distinct, units
from plantlake.session import fresh_dir

FOLD_BYTES = 64
#: Small maps that the rank map is dealt into; a power of two.
MAPS = 8192
#: Bytes of text in a shard and in a step of its making, unless one text is longer.
SHARD, PIECE = 4 << 20, 2 << 20
SEED_WORDS, SEED_DOCS = 150_000, 25_000
#: Words in a row that is folded, and buckets of words for each shuffle partition.
FOLD_ROW, BUCKETS = 1024, 4


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 of the bytes and the rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Codec:
    """Column expressions for one vocabulary. The literal tables stand in a plan once per call of ``encoded`` or ``decoded``; below it they are variables."""

    def __init__(self, ranks: dict[bytes, int]):
        maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
        for token, rank in ranks.items():
            letters = token.decode("latin-1")
            maps[zlib.crc32(letters.encode()) % MAPS][letters] = rank
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        # Both are constant expressions, which the optimizer folds into literals.
        self.maps = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
        self.pieces = F.from_json(F.lit(json.dumps([base64.b64encode(p).decode() for p in pieces])), "array<binary>")

    def encoded(self, words: Column) -> Column:
        """Ids of each word of an array; null for null."""
        return let(self.maps, lambda maps: F.transform(words, lambda w: F.when(w.isNotNull(), self.encode(maps, w))))

    def decoded(self, ids: Column) -> Column:
        """Bytes of each list of ids."""
        return let(self.pieces, lambda pieces: F.transform(ids, lambda some: self.decode(pieces, some)))

    def rank(self, maps: Column, token: Column) -> Column:
        at = F.crc32(token.cast("binary")).bitwiseAND(F.lit(MAPS - 1).cast("long")).cast("int")
        return F.try_element_at(F.get(maps, at), token)

    def merged_once(self, maps: Column, parts: Column) -> Column:
        """Parts after the merge of lowest rank. An empty part in front says that none is left; such parts stay."""
        ranks = F.zip_with(parts, F.slice(parts, F.lit(2), F.size(parts)), lambda a, b: self.rank(maps, F.concat(a, b)))
        join = lambda at: F.concat(
            F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
            F.slice(parts, at + 2, F.size(parts)))
        done = F.concat(F.array(F.lit("")), parts)
        return F.when(F.get(parts, F.lit(0)) == "", parts).otherwise(
            let(ranks, lambda r: let(F.array_position(r, F.array_min(r)).cast("int"), lambda at: F.when(at > 0, join(at)).otherwise(done))))

    def encode(self, maps: Column, word: Column) -> Column:
        """Ids of one word, whose letters stand for bytes."""
        letters = F.filter(F.split(word, ""), lambda x: x != "")
        parts = F.when(F.length(word) > 1, F.aggregate(
            F.sequence(F.lit(2), F.greatest(F.length(word), F.lit(2))), letters, lambda acc, _: self.merged_once(maps, acc))
        ).otherwise(letters)
        return let(self.rank(maps, word), lambda own: F.when(own.isNotNull(), F.array(own))
                   .otherwise(F.transform(F.filter(parts, lambda p: p != ""), lambda p: self.rank(maps, p))))

    def decode(self, pieces: Column, ids: Column) -> Column:
        """Bytes of the ids: their pieces, concatenated."""
        return F.aggregate(ids, F.lit(bytearray()), lambda acc, i: F.concat(acc, F.get(pieces, i)))


class RankPairs:
    """The rank rule for ``heap_bpe.merges``: a pair's rank is that of its joined bytes. Symbols are ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pieces = ranks, {r: t for t, r in ranks.items()}

    def get(self, pair: tuple[int, int]) -> tuple[int, int] | None:
        rank = self.ranks.get(self.pieces[pair[0]] + self.pieces[pair[1]])
        return None if rank is None else (rank, rank)

    __getitem__ = get

    def __contains__(self, pair: tuple[int, int]) -> bool:
        return self.get(pair) is not None

    def ids(self, word: bytes) -> list[int]:
        symbols = [self.ranks[bytes([b])] for b in word]
        merges(symbols, self)
        return [s for s in symbols if s >= 0]


def cut(data: bytes, stops: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data``, which end at ``stops``."""
    edges = np.concatenate([np.zeros(1, np.int64), stops]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data)])


def runs(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of equal ``column``, also over several batches, as one batch each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(column)
        new = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if held and keys[a] != held[-1].column(column)[0]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def numbers(column: pa.Array, kind) -> np.ndarray:
    """The arrays in a binary column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _runs(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``begin``, one run after the other."""
    stop = np.cumsum(lengths)
    return np.repeat(begin - (stop - lengths), lengths) + np.arange(stop[-1] if len(stop) else 0)


def _shard(batch: pa.RecordBatch, texts: list[bytes], pattern, place: dict[bytes, int], buckets: int) -> tuple[bytes, pa.RecordBatch]:
    """The file of a shard (documents and the word numbers of each text) and a row for each bucket of its words. Words folded
    ahead have their places as numbers, the others follow in the order of the rows. Texts
    are cut a step at a time; a unit that is a word folded ahead is not cut at all, any other once per shard."""
    ahead = len(place)
    number: dict[bytes, int] = {}
    split: dict[bytes, bytes] = {}
    codes, edges = [], [np.zeros(1, np.int64)]
    i = total = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and size < PIECE:
            size += len(texts[j])
            j += 1
        buf, starts, ends, first = units(texts[i:j])
        at, each = exact_distinct(buf, starts, ends)
        data, own = buf.tobytes(), []
        names = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        known = np.fromiter(map(place.get, names, repeat(-1)), np.int32, len(names))
        rest = np.flatnonzero(known < 0)
        for k in rest.tolist():
            unit = names[k]
            words = split.get(unit)
            if words is None:
                words = array("i")
                for w in pattern.findall(unit.decode()):
                    w = w.encode()
                    code = place.get(w)
                    words.append(ahead + number.setdefault(w, len(number)) if code is None else code)
                words = split[unit] = words.tobytes()
            own.append(words)
        sizes = np.ones(len(names), np.int64)
        sizes[rest] = np.fromiter(map(len, own), np.int64, len(own)) // 4
        begin = np.cumsum(sizes) - sizes
        pool = np.empty(int(sizes.sum()), np.int32)
        alone = known >= 0
        pool[begin[alone]] = known[alone]
        pool[_runs(begin[rest], sizes[rest])] = np.frombuffer(b"".join(own), np.int32)
        lengths = sizes[each]
        stop = np.cumsum(lengths)
        codes.append(pool[_runs(begin[each], lengths)])
        edges.append(total + np.concatenate([np.zeros(1, np.int64), stop])[first[1:]])
        total += len(codes[-1])
        i = j
    del split
    words = list(number)
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    moved = np.empty(len(words), np.int32)
    moved[order] = np.arange(ahead, ahead + len(words))
    numbered = np.concatenate(codes) if codes else np.empty(0, np.int32)
    new = numbered >= ahead
    numbered[new] = moved[numbered[new] - ahead]
    words = [words[i] for i in order.tolist()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    stops = np.append(first[1:], len(words))
    if len(words) == 0:  # a shard has at least one row
        bucket, first, stops = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    own = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    file = pa.RecordBatch.from_arrays([pa.array([to_ipc(batch)]), pa.array([packed(np.concatenate(edges))]), pa.array([packed(numbered)])],
                                      names=["docs", "edges", "codes"])
    rows = pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].astype(np.int32)), cut(sizes.astype(np.uint32).tobytes(), 4 * stops), cut(b"".join(words), own[stops])], names=["bucket", "sizes", "letters"])
    return to_ipc(file), rows


_SEEDS: dict[tuple[str, str], object] = {}


def _seeds(data: bytes, digest: str, use: str):
    """Words folded ahead, unpacked once by a Python worker: the place of each (``use`` is ``words``), or ids of each, all ids and bytes of each."""
    if (digest, use) not in _SEEDS:
        _SEEDS.clear()
        batch = from_ipc(data)
        if use == "words":
            _SEEDS[digest, use] = {w.encode("latin-1"): i for i, w in enumerate(batch.column("word").to_pylist())}
        else:
            ids = batch.column("ids")
            _SEEDS[digest, use] = np.diff(ids.offsets.to_numpy()).astype(np.int64), ids.values.to_numpy(), batch.column("back").to_pylist()
    return _SEEDS[digest, use]


def _distinct(bucket: pa.RecordBatch, pairs: RankPairs) -> pa.RecordBatch:
    """Rows of the distinct words of a bucket; a last row has the words of each shard as numbers of distinct ones."""
    sizes = numbers(bucket.column("sizes"), np.uint32).astype(np.int64)
    counts = pc.binary_length(bucket.column("sizes")).to_numpy() // 4
    data = b"".join(bucket.column("letters").to_pylist())
    stops = np.cumsum(sizes)
    at, each = exact_distinct(np.frombuffer(data, np.uint8), stops - sizes, stops)
    part = np.arange(len(at)) // FOLD_ROW + np.cumsum(sizes[at]) // PIECE
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(at)] if len(at) else []
    words, known = [], []
    for i in at.tolist():
        word = data[stops[i] - sizes[i]:stops[i]]
        long = len(word) > FOLD_BYTES
        words.append(None if long else word.decode("latin-1"))
        known.append(pairs.ids(word) if long else None)
    ends = list(zip(edges, edges[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([None] * len(ends) + [bucket.column("bucket")[0].as_py()], pa.int32()), pa.array([None] * len(ends) + [bucket.column("shard").to_pylist()], pa.list_(pa.string())),
         pa.array([None] * len(ends) + [packed(counts.astype(np.int32))], pa.binary()), pa.array([None] * len(ends) + [packed(each.astype(np.int32))], pa.binary()),
         pa.array([words[a:b] for a, b in ends] + [[]], pa.list_(pa.string())), pa.array([known[a:b] for a, b in ends] + [[]], pa.list_(pa.list_(pa.int32())))],
        names=["bucket", "shards", "counts", "each", "words", "known"])


def _dealt(rows: list[tuple[pa.Array, pa.Array]], bucket: int, shards: pa.Array, counts: np.ndarray, each: np.ndarray, kind) -> pa.RecordBatch:
    """The encoded words of a bucket as a row for each shard: ids of each word, all ids, bytes of each word, all bytes."""
    at = pa.array(each)
    ids = pa.concat_arrays([a for a, _ in rows]).take(at) if rows else pa.array([], pa.list_(pa.int32()))
    back = pa.concat_arrays([b for _, b in rows]).take(at) if rows else pa.array([], pa.binary())
    n, size = pc.list_value_length(ids).to_numpy(), pc.binary_length(back).to_numpy()
    stops = np.cumsum(counts)
    total = lambda x: np.concatenate([np.zeros(1, np.int64), np.cumsum(x, dtype=np.int64)])[stops]
    return pa.RecordBatch.from_arrays(
        [shards.cast(pa.string()), pa.array([bucket] * len(shards), pa.int32()), cut(n.astype(np.uint32).tobytes(), 4 * stops),
         cut(ids.flatten().to_numpy().astype(kind).tobytes(), np.dtype(kind).itemsize * total(n)),
         cut(size.astype(np.uint32).tobytes(), 4 * stops), cut(b"".join(back.to_pylist()), total(size))], names=["shard", "bucket", "n", "ids", "sizes", "back"])


_SEEDED = pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int32())), ("back", pa.binary())])


def fold_ahead(source: DataFrame, codec: Codec, pattern: str) -> bytes:
    """The most frequent words of a sample of the texts, with their ids and the bytes that these decode to."""
    total = source.count()
    share = min(1.0, SEED_DOCS / max(total, 1))
    sample = source.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("text")

    def count(batches):
        find = regex.compile(pattern)
        for batch, texts in merged(batches, PIECE):
            buf, starts, ends, _ = units(texts)
            at, each = exact_distinct(buf, starts, ends)
            data, n = buf.tobytes(), Counter()
            for j, k in zip(at, np.bincount(each, minlength=len(at)).tolist()):
                for w in find.findall(data[starts[j]:ends[j]].decode()):
                    n[w] += k
            rows = [(w.encode().decode("latin-1"), k) for w, k in n.items() if len(w.encode()) <= FOLD_BYTES]
            for i in range(0, len(rows), 50_000):
                some = rows[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some]), pa.array([k for _, k in some], pa.int64())], names=["word", "n"])

    words = sample.mapInArrow(lean(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    chosen = words.orderBy(F.desc("n"), "word").limit(SEED_WORDS)
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = chosen.repartition(parts, "word").select("word", "n", codec.encoded(F.array("word")).alias("lists"))
    table = folded.select("word", F.get("lists", F.lit(0)).alias("ids"), F.get(codec.decoded(F.col("lists")), F.lit(0)).alias("back"), "n").toArrow()
    table = table.sort_by([("n", "descending"), ("word", "ascending")]).drop_columns("n").cast(_SEEDED)  # frequent words get small numbers
    find = regex.compile(pattern).findall
    table = table.filter(pa.array([find(w := x.encode("latin-1").decode()) == [w] for x in table.column("word").to_pylist()], pa.bool_()))
    data = to_ipc(table.combine_chunks().to_batches()[0] if len(table) else pa.RecordBatch.from_pylist([], table.schema))
    del table
    give_back()
    return data


def round_trip(docs: DataFrame, ranks_file: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """Encode every text and decode the ids. Gives the columns ``keep`` (default ``doc_id``) and
    ``n_tokens, ids_sha256, decoded_sha256, ids`` (little-endian u32) and ``decoded`` (bytes)."""
    keep = ["doc_id"] if keep is None else keep
    ranks = load_ranks(ranks_file)
    codec = Codec(ranks)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], docs["text"].cast("string").alias("text"))

    ahead = fold_ahead(source, codec, pattern)
    digest = hashlib.sha256(ahead).hexdigest()

    folder = fresh_dir(docs.sparkSession, "fold-texts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = np.uint16 if max(ranks.values(), default=0) < 1 << 16 else np.uint32

    def shards(batches):
        find, place = regex.compile(pattern), _seeds(ahead, digest, "words")
        files, root = storage(folder)
        for batch, texts in merged(batches, SHARD):
            data, rows = _shard(batch.select(range(len(keep))), texts, find, place, BUCKETS * parts)
            name = uuid.uuid4().hex
            with files.open_output_stream(f"{root}/{name}") as file:
                file.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([name] * rows.num_rows), *rows.columns], names=["shard", *rows.schema.names])

    def distinct(batches):
        pairs = RankPairs(ranks)
        for bucket in runs(batches, "bucket"):
            yield _distinct(bucket, pairs)

    def dealt(batches):
        rows = []
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column(0)[i].as_py()
                if bucket is None:
                    rows.append((batch.column(4)[i].values, batch.column(5)[i].values))
                else:
                    counts, each = (unpacked(batch.column(k)[i].as_py(), np.int32) for k in (2, 3))
                    yield _dealt(rows, bucket, batch.column(1)[i].values, counts, each, small)
                    rows = []

    def documents(batches):
        seed_sizes, seed_ids, seed_back = _seeds(ahead, digest, "ids")
        files, root = storage(folder)
        for rows in runs(batches, "shard"):
            with files.open_input_file(f"{root}/{rows.column('shard')[0].as_py()}") as file:
                held = from_ipc(file.read())
            own, edges, codes = from_ipc(held.column(0)[0].as_py()), unpacked(held.column(1)[0].as_py(), np.int64), unpacked(held.column(2)[0].as_py(), np.int32)
            sizes = np.concatenate([seed_sizes, numbers(rows.column("n"), np.uint32).astype(np.int64)])
            flat = np.concatenate([seed_ids, numbers(rows.column("ids"), small).astype(np.int32)])
            begin = np.cumsum(sizes) - sizes
            data, stops = b"".join(rows.column("back").to_pylist()), np.cumsum(numbers(rows.column("sizes"), np.uint32), dtype=np.int64).tolist()
            piece = [*seed_back, *(data[a:b] for a, b in zip([0, *stops], stops))].__getitem__
            for k in range(0, own.num_rows, 256):
                some, n, sha, back, raw, text = own.slice(k, 256), [], [], [], [], []
                for a, b in zip(edges[k:k + 256], edges[k + 1:k + 1 + some.num_rows]):
                    c = codes[a:b]
                    lengths = sizes[c]
                    stop = np.cumsum(lengths)
                    at = np.repeat(begin[c] - (stop - lengths), lengths) + np.arange(stop[-1] if len(c) else 0)
                    out, decoded = flat[at].astype("<u4").tobytes(), b"".join(map(piece, c.tolist()))
                    n.append(len(out) // 4)
                    sha.append(hashlib.sha256(out).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                    raw.append(out)
                    text.append(decoded)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string()),
                     pa.array(raw, pa.binary()), pa.array(text, pa.binary())],
                    names=[*some.schema.names, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])

    made = written(source.mapInArrow(lean(shards), "shard string, bucket int, sizes binary, letters binary"), "fold-words")
    words = made.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lean(distinct), "bucket int, shards array<string>, counts binary, each binary, words array<string>, known array<array<int>>")
    coded = words.select("bucket", "shards", "counts", "each", F.zip_with("known", codec.encoded(F.col("words")), lambda known, made: F.coalesce(known, made)).alias("ids"))
    both = coded.select("bucket", "shards", "counts", "each", "ids", codec.decoded(F.col("ids")).alias("pieces"))
    back = both.mapInArrow(lean(dealt), "shard string, bucket int, n binary, ids binary, sizes binary, back binary")
    kinds = dict(source.dtypes)
    out = back.repartition(parts, "shard").sortWithinPartitions("shard", "bucket").mapInArrow(lean(documents), ", ".join(f"k{i} {kinds[f'k{i}']}" for i in range(len(keep)))
                                                                                             + ", n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded binary")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
