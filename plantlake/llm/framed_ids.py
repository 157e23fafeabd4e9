"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds consecutive documents in ascending id order::

    file    frame ... frame, table
    frame   one zstandard frame with content checksum, of a block:
            u32 documents n, n x i64 doc ids, n x u64 lengths, the ids of all n as u32
    table   one zstandard skippable frame (magic 0x184D2A5E): for each frame 8 x 8 bytes (offset,
            stored bytes, block bytes, first doc id, last doc id, documents, ids, xxh64 of the
            stored bytes), then u64 number of frames and the 8 bytes ``FRMTABLE``

All numbers are little-endian. A reader takes the table from the file's end, finds the frames
that can hold a document and reads only those, checking each against its checksum first.

Ids are encoded before the shuffle and move compressed; ranges of doc ids come from quantiles of
the id column, so files are even whatever source or group of copies a document belongs to. Files
are written under a name of the task's own and then renamed, so a retried task replaces its own file.

Null texts are empty and get just the end id. Null doc ids are stored as the smallest 64-bit
number and come first, repeated doc ids keep an entry each. Further columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from plantlake.llm.common import lean, packed_runs, steps, unpacked, written
from plantlake.llm.ranges import id_bounds, part_of, storage
from plantlake.llm.spans import exact_distinct, units
from plantlake.session import fresh_dir

NULL_ID = -(1 << 63)
SKIPPABLE, END = 0x184D2A5E, b"FRMTABLE"
ENTRY = struct.Struct("<QQQqqQQQ")
#: Ids per frame at least, unless the file ends.
FRAME_IDS = 1 << 18
#: Units whose ids a worker keeps, each of so many bytes at most. Results don't depend on it.
REMEMBERED, KEPT = 1_000_000, 64


class Encoder:
    """Ids of many texts through the tokenizers library; units seen before are not encoded again."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(data)
        special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.special = [s for s in special if s]
        self.units: dict[bytes, bytes] = {}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # byte-level vocabularies write one letter per byte

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of units that each are one space and further letters: they split the same side by
        side, so the library gets many at once, and token lengths tell where each ends."""
        texts = [b"".join(pieces[k:k + 64]).decode() for k in range(0, len(pieces), 64)]
        ids = array("I")
        for e in self.library.encode_batch_fast(texts, add_special_tokens=False):
            ids.extend(e.ids)
        flat = np.frombuffer(ids, np.uint32) if len(ids) else np.empty(0, np.uint32)
        at, ends = np.cumsum(self.bytes_of[flat]), np.cumsum([len(p) for p in pieces])
        cuts = np.searchsorted(at, ends)
        if len(cuts) and (cuts[-1] >= len(at) or not np.array_equal(at[cuts], ends)):
            return self.whole([p.decode() for p in pieces])
        data, stops = flat.tobytes(), ((cuts + 1) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        plain = list(texts)
        for i in odd:  # special strings are no units; the library takes these texts whole
            plain[i] = b""
        buf, starts, ends, first = units(plain)
        at, each = exact_distinct(buf, starts, ends)
        if len(self.units) > REMEMBERED:
            self.units.clear()
        known, data = self.units, buf.tobytes()
        names = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        own: dict[bytes, bytes] = {}
        found = list(map(known.get, names))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        new = [names[i] for i in fresh]
        for k in range(0, len(new), 4096):
            some = new[k:k + 4096]
            spaced = [x for x in some if x[:1] == b" " and x[1:2] > b" "]
            own.update(zip(spaced, self.together(spaced)))
            others = [x for x in some if x[:1] != b" " or x[1:2] <= b" "]
            own.update(zip(others, self.whole([x.decode() for x in others])))
        for i, name in zip(fresh, new):
            found[i] = own[name]
            if len(name) <= KEPT:
                known[name] = found[i]
        pool = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(sizes) - sizes
        lengths = sizes[each]
        stop = np.cumsum(lengths)
        flat = pool[np.repeat(begin[each] - (stop - lengths), lengths) + np.arange(stop[-1] if len(stop) else 0)]
        edges = np.concatenate([np.zeros(1, np.int64), stop])[first]
        out = [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]
        for i, ids in zip(odd, self.whole([texts[i].decode() for i in odd])):
            out[i] = np.frombuffer(ids, np.uint32)
        return out


_LOADED: dict[int, Encoder] = {}


class FrameWriter:
    """One file of the format, written to a storage folder."""

    def __init__(self, folder: str, name: str):
        self.fs, self.root = storage(folder)
        self.name, self.temp = f"{self.root}/{name}", f"{self.root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)
        self.entries, self.docs, self.held, self.offset = [], [], 0, 0
        self.n_docs = self.n_ids = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids.astype("<u4")))
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        ids, lengths = [d for d, _ in self.docs], [len(x) for _, x in self.docs]
        block = b"".join([struct.pack("<I", len(ids)), np.array(ids, "<i8").tobytes(), np.array(lengths, "<u8").tobytes(),
                          *(x.tobytes() for _, x in self.docs)])
        frame = zstandard.ZstdCompressor(level=1, write_checksum=True).compress(block)
        self.out.write(frame)
        self.entries.append((self.offset, len(frame), len(block), ids[0], ids[-1], len(ids), self.held, xxhash.xxh64_intdigest(frame)))
        self.offset += len(frame)
        self.n_docs += len(ids)
        self.n_ids += self.held
        self.docs, self.held = [], 0

    def close(self) -> None:
        if self.docs:
            self._frame()
        table = b"".join(ENTRY.pack(*e) for e in self.entries) + struct.pack("<Q", len(self.entries)) + END
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.temp, self.name)


class FrameReader:
    """Reads a file of the format by its table."""

    def __init__(self, folder: str, name: str):
        fs, root = storage(folder)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        self.file.seek(size - 16)
        count, end = struct.unpack("<Q8s", self.file.read(16))
        if end != END:
            raise ValueError(f"{name} has no seek table")
        self.file.seek(size - 16 - count * ENTRY.size)
        table = self.file.read(count * ENTRY.size)
        self.entries = [ENTRY.unpack_from(table, i * ENTRY.size) for i in range(count)]

    def frame(self, entry: tuple) -> list[tuple[int, np.ndarray]]:
        offset, stored, size, _, _, n, _, checksum = entry
        self.file.seek(offset)
        data = self.file.read(stored)
        if xxhash.xxh64_intdigest(data) != checksum:
            raise ValueError(f"frame at {offset} is damaged")
        block = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
        ids = np.frombuffer(block, "<i8", n, 4)
        lengths = np.frombuffer(block, "<u8", n, 4 + 8 * n).astype(np.int64)
        values = np.frombuffer(block, "<u4", offset=4 + 16 * n)
        stops = np.cumsum(lengths)
        return [(int(d), values[b - k:b]) for d, k, b in zip(ids, lengths, stops)]

    def documents(self, wanted: list[int]) -> list[tuple[int, np.ndarray]]:
        """The wanted documents; only frames whose id range holds one of them are read."""
        want = set(wanted)
        return [x for e in self.entries if any(e[3] <= w <= e[4] for w in want) for x in self.frame(e) if x[0] in want]

    def close(self) -> None:
        self.file.close()


def write_ids(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = 0, files: int | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write the files. Gives one row per file, in doc id order:
    ``(part, name, n_docs, n_ids)``."""
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as file:
        data = file.read()
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(docs, files)
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))

    def encode(batches):
        encoder = _LOADED.get(key := hash(data))
        if encoder is None:
            encoder = _LOADED[key] = Encoder(data)
        tail = np.array([end_id], np.uint32)
        for batch, texts in steps(batches):
            ids = encoder(texts)
            stops = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) + 1)
            flat = np.concatenate([y for x in ids for y in (x, tail)] or [tail[:0]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of(batch.column(0), bounds), pa.int32()), batch.column(0),
                 pa.array(packed_runs(flat, stops), pa.binary())], names=["part", "doc_id", "ids"])

    def store(batches):
        part, writer, made = None, None, []
        for batch in batches:
            for p, d, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if writer:
                        writer.close()
                        made.append((part, f"ids-{part:06d}.frames", writer.n_docs, writer.n_ids))
                    part, writer = p, FrameWriter(folder, f"ids-{p:06d}.frames")
                writer.add(NULL_ID if d is None else d, unpacked(ids, np.uint32))
        if writer:
            writer.close()
            made.append((part, f"ids-{part:06d}.frames", writer.n_docs, writer.n_ids))
        columns = list(zip(*made)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                                         names=["part", "name", "n_docs", "n_ids"])

    ids = chosen.mapInArrow(lean(encode), "part int, doc_id long, ids binary")
    placed = ids.repartition(files, "part").sortWithinPartitions("part", "doc_id", "ids")
    return written(placed.mapInArrow(lean(store), "part int, name string, n_docs long, n_ids long"), "id-files")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: ``(doc_id, start, n_tokens, ids_crc32)``."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("part", "name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    count = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        for batch in batches:
            for name, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = FrameReader(folder, name)
                for entry in reader.entries:
                    docs = reader.frame(entry)
                    sizes = np.array([len(x) for _, x in docs], np.int64)
                    starts = at + np.cumsum(sizes) - sizes
                    at += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if d == NULL_ID else d for d, _ in docs], pa.int64()), pa.array(starts), pa.array(sizes),
                         pa.array([zlib.crc32(x.tobytes()) for _, x in docs], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                reader.close()

    return (files.select("name", "first").repartition(count, "name")
            .mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def framed_ids(docs: DataFrame, tokenizer_file: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to a new folder of the shared storage and read the files back."""
    folder = fresh_dir(docs.sparkSession, "framed-ids")
    return read_ids(write_ids(docs, folder, tokenizer_file, end_id), folder)
