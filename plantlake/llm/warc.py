"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges.

Writing. Of records with equal payloads the one with the largest page id is a ``response``, the
others are ``revisit`` records that name it. Which one that is follows from an aggregation over
digests (two short columns), so pages of one large group of copies are never brought together;
pages then meet their decision on page id and digest. Each attempt of a task writes files of its
own name, under a temporary one at first. The manifest names those of the attempt that counted, so
another attempt cannot replace them and readers see whole ones only.

Reading. A task gets a byte range of a file, looks for gzip magic, and takes a candidate as a
record only if it decompresses to a WARC header. A range owns the records that start inside it,
also where they end beyond it; bytes that look like magic inside a record are never reached, since
the search goes on behind each record.

Nothing is passed over. A file starts with a record, a record follows right behind each other one up
to the size in the manifest, and each range makes sure of the record after its last, wherever that
starts. So a damaged, cut or missing file is an error, also where a range begins at the damage.

Null html is the empty payload, null urls have no target header. Null page ids have no id header
and read back as null; they are never referred to. Repeated page ids keep a record each, and
equal records with the largest id are all responses. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantlake.llm.common import written
from plantlake.llm.ranges import storage
from plantlake.session import fresh_dir

MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Bytes of a file, roughly, and of a range that one reading task gets.
FILE_BYTES, RANGE_BYTES = 64 << 20, 4 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<{(uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')).urn}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    block = HTTP + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n") + packer.flush()


def parsed(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and block of a decompressed record; None where it isn't one."""
    end = record.find(b"\r\n\r\n")
    if end < 0 or not record.startswith(b"WARC/1."):
        return None
    headers = dict(line.split(": ", 1) for line in record[:end].decode().split("\r\n")[1:] if ": " in line)
    size = headers.get("Content-Length", "")
    if not size.isdigit() or len(record) < end + 4 + int(size):
        return None
    return headers, record[end + 4:end + 4 + int(size)]


class _Window:
    """Bytes of a file from a place on, read further as needed."""

    def __init__(self, file, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, b""

    def grow(self, upto: int) -> None:
        have = self.start + len(self.data)
        if (want := min(upto, self.size)) > have:
            self.file.seek(have)
            self.data += self.file.read(want - have)

    def member_at(self, place: int) -> tuple[bytes, int] | None:
        """The decompressed member at ``place`` and where it ends; None where there is none. A
        candidate is given up as soon as its first bytes are no WARC header."""
        unpack, out, seen, at, step = zlib.decompressobj(31), [], b"", place, 1 << 12
        try:
            while not unpack.eof:
                self.grow(at + step)
                piece = self.data[at - self.start:at - self.start + step]
                if not piece:
                    return None
                at += len(piece)
                out.append(unpack.decompress(piece))
                seen = seen or out[-1][:7]
                if seen and not b"WARC/1.".startswith(seen[:7]):
                    return None
                step = 1 << 16
        except zlib.error:
            return None
        return b"".join(out), at - len(unpack.unused_data)


def records(file, size: int, start: int, end: int, name: str = "the file"):
    """Records that start in ``start:end`` of an open file of ``size`` bytes. ``ValueError`` where it does not go on with a record."""
    window = _Window(file, start, size)
    window.grow(end + len(MAGIC) - 1)
    at, following = start, start == 0
    while at < end or following:
        if not following:
            found = window.data.find(MAGIC, at - start, end - start + len(MAGIC) - 1)
            if found < 0:
                return
            at = start + found
        got = window.member_at(at)
        record = parsed(got[0]) if got else None
        if record is not None:
            if at >= end:
                return  # whole, and owned by a later range
            yield record
            at, following = got[1], got[1] < size
        elif following:
            raise ValueError(f"damaged archive: no whole record at byte {at} of {size} in {name}")
        else:
            at += 1


def decided(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``refers_to``: the page that a revisit record names, else null."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                         pages["html"].cast("string").alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    short = pages.where(F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes).select("page_id", "sha")
    winners = short.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("sha", "refers_to")
    revisits = short.join(winners, "sha").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    r = revisits.select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "refers_to")
    return (pages.join(r, pages["page_id"].eqNullSafe(r["p"]) & (pages["sha"] == r["s"]), "left")
            .select("page_id", "url", "html", "refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages. Gives ``(name, size, n_records)`` for each file."""
    storage(folder)  # a folder that tasks cannot write fails here

    def store(batches):
        files, root = storage(folder)
        context = TaskContext.get()
        task, made, out, held, n = f"{context.partitionId():06d}-{context.taskAttemptId()}", [], None, 0, 0

        def close():
            out.close()
            name = f"pages-{task}-{len(made):04d}.warc.gz"
            files.move(temp, f"{root}/{name}")
            made.append((name, held, n))

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    temp, held, n = f"{root}/.{uuid.uuid4().hex}", 0, 0
                    out = files.open_output_stream(temp)
                data = member(page_id, url, (html or "").encode(), refers_to)
                out.write(data)
                held, n = held + len(data), n + 1
                if held >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        columns = list(zip(*made)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
                                         names=["name", "size", "n_records"])

    return written(decided(pages, least_bytes).mapInArrow(store, "name string, size long, n_records long"), "warc-files")


def read_archives(manifest: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record: ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)``.
    The payload is null for revisits. Files that are not whole records from end to end, and responses whose payload fails its digest, are errors."""
    count = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = manifest.where("size > 0").select("name", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def read(batches):
        files, root = storage(folder)
        whole = lambda x: None if x is None else int(x)
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                with files.open_input_file(f"{root}/{name}") as file:
                    for head, block in records(file, size, start, min(size, start + range_bytes), name):
                        payload = block.split(b"\r\n\r\n", 1)[1] if head["WARC-Type"] == "response" else None
                        stated = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if payload is not None and digest(payload) != stated:
                            raise ValueError(f"damaged record in {name}")
                        rows.append((whole(head.get("X-Page-ID")), head.get("WARC-Target-URI"), int(head["X-Payload-Length"]), stated,
                                     head["WARC-Type"], whole(head.get("X-Refers-To-Page-ID")), payload))
                for k in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 512]), kinds)], names=names)

    return ranges.repartition(count, "name", "start").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to a new folder of the shared storage and read every record back."""
    folder = fresh_dir(spark, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder)
