"""WARC archives as seekable Zstandard bundles, with a record index.

A bundle is a run of independent Zstandard frames, each holding some whole WARC records, and at its end
a skippable frame with the seek table: compressed and plain size of every frame, their number, and
the format's closing mark. Any reader of Zstandard can unpack a bundle from front to back; a
reader of the table can go to one frame. The record index maps each record's identifier, of which there is one of a kind, to its bundle, frame and
the place in that frame, and reading back goes by it.

Pages with equal payloads are stored once: the one with the largest page_id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh_folder, slices, written

# Fixed values of the seekable Zstandard format: marks of the skippable frame and of the table's end.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES = 1 << 20  # plain bytes after which a frame is closed
BUNDLE_BYTES = 1 << 30  # compressed bytes after which a bundle is closed
LEVEL = 3
SALTS = 16


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, mark: str = "") -> str:
    """The identifier of the one response with a payload; records that it doesn't tell apart have a mark of their own."""
    return f"urn:page:{'none' if page_id is None else page_id}:{digest}{mark and ':' + mark}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool, date: str, mark: str = "") -> bytes:
    """One WARC record; a revisit holds the page's HTTP head and names the response that has its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = quote(url, safe="/:?#[]@!$&'()*+,;=%-._~") if url else "about:blank"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, digest, mark)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers, digest)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes | memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at `at`, and where the next one begins."""
    data = bytes(data) if not isinstance(data, bytes) else data
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"a record of the wrong length at {at}")
    return headers, data[begin:stop], stop + 4


class BundleWriter:
    """Writes frames of records to one bundle, and the seek table at its end."""

    def __init__(self, name: str, level: int = LEVEL):
        store, path = fs.FileSystem.from_uri(name)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)  # else packed again for its name
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.at = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """The frame and the place in it that the record will have."""
        place = (len(self.table), self.held)
        self.open.append(data)
        self.held += len(data)
        if self.held >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.out.write(packed)
            self.table.append((len(packed), self.held))
            self.at += len(packed)
            self.open, self.held = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Frames of one bundle by number, found through the seek table."""

    def __init__(self, name: str):
        store, path = fs.FileSystem.from_uri(name)
        self.source = store.open_input_file(path)
        size = self.source.size()
        count, flags, mark = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if mark != SEEKABLE or flags & 0x7C:
            raise ValueError(f"no seek table at the end of {name}")
        width = 12 if flags & 0x80 else 8
        length = count * width + 9
        head = struct.unpack("<II", self.source.read_at(8, size - length - 8))
        if head != (SKIPPABLE, length):
            raise ValueError(f"a broken seek table at the end of {name}")
        entries = self.source.read_at(count * width, size - length)
        rows = np.frombuffer(entries, "<u4").reshape(count, width // 4).astype(np.int64)
        self.packed, self.plain = rows[:, 0], rows[:, 1]
        self.starts = np.cumsum(self.packed) - self.packed

    def __len__(self) -> int:
        return len(self.packed)

    def frame(self, n: int) -> bytes:
        data = self.source.read_at(int(self.packed[n]), int(self.starts[n]))
        out = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.plain[n]))
        if len(out) != self.plain[n]:
            raise ValueError(f"frame {n} has the wrong length")
        return out

    def close(self) -> None:
        self.source.close()


def read_record(bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of the record at a place that the index names; one frame is unpacked."""
    reader = BundleReader(bundle)
    try:
        headers, block, _ = parse(reader.frame(frame), offset)
    finally:
        reader.close()
    return headers, block.partition(b"\r\n\r\n")[2]


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """`page_id`, `url`, `payload`, `sha1`, `revisit`, `refers_to` and `marked` of each page.

    Among rows with equal payloads of at least `least` bytes that with the largest page_id is the response (any id before a null
    one; of several, that with the largest url) and the others revisit it. Of rows equal in all of that one is the
    response: they are counted, not looked at one by one, and one row with their payload stands for all. `marked` rows need
    more than page and payload to be told apart. A shared payload is one row of the small side of the join, and
    is dealt over salts, so that the pages that share it do not meet in one task.
    """
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    base = base.withColumn("sha1", F.sha1("payload"))
    wide = F.octet_length("payload") >= least
    each = base.groupBy("sha1", "page_id", "url", wide.alias("wide")).agg(F.count("*").alias("n"))
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url", "n")
    shared = written(each.groupBy("sha1", "wide").agg(F.max(rank).alias("top"), F.sum("n").alias("n")).where("n > 1"), "payloads")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = shared.select(F.col("sha1").alias("_sha1"), "wide", "top", salts.alias("_salt"))
    salted = base.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(dealt, (F.col("sha1") == F.col("_sha1")) & (F.col("salt") == F.col("_salt")), "left")
    own = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    known = F.col("top").isNotNull()
    revisit = known & F.col("wide") & ~own
    columns = ["page_id", "url", "payload", "sha1"]
    told = [revisit.alias("revisit"), F.when(revisit, F.col("top.page_id")).alias("refers_to"), (known & ~(F.col("wide") & own)).alias("marked")]
    repeated = known & F.col("wide") & own & (F.col("top.n") > 1)
    if shared.where("wide AND top.n > 1").isEmpty():
        return joined.select(*columns, *told)
    one = joined.where(repeated).groupBy("page_id", "url", "sha1").agg(F.first("payload").alias("payload"), F.count("*").alias("n"))
    copies = one.select(*columns, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("at"))
    again = F.col("at") > 1
    copies = copies.select(*columns, again.alias("revisit"), F.when(again, F.col("page_id")).alias("refers_to"), again.alias("marked"))
    return joined.where(~repeated).select(*columns, *told).unionByName(copies)


def write_bundles(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """Writes every page to bundles in `folder`; returns the record index as a stored table.

    Its rows are `record_id`, `page_id`, `record_type`, `payload_digest`, `refers_to`, `bundle`, `frame`, `frame_start` (in the bundle),
    `offset` (in the unpacked frame) and `size`. Bundle names hold the task attempt, and the
    index names only bundles of attempts that ended well, so a lost executor leaves no half bundle in use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer, name, number, done = None, "", 0, 0
        for batch in slices(batches, "payload"):
            rows: list[tuple] = []
            for page, url, payload, sha1, revisit, refers, marked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"{folder}/bundle-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.zst"
                    writer, number = BundleWriter(name), number + 1
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                start = writer.at
                mark = f"{context.partitionId()}-{context.taskAttemptId()}-{done}" if marked else ""
                done += 1
                data = record(page, url, payload, digest, refers, revisit, date, mark)
                frame, offset = writer.add(data)
                kind = "revisit" if revisit else "response"
                rows.append((record_id(page, digest, mark), page, kind, digest, refers, name, frame, start, offset, len(data)))
                if writer.at >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_pylist([dict(zip(index.names, r, strict=True)) for r in rows], schema=index)
        if writer is not None:
            writer.close()

    index = pa.schema(
        [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
        + [("bundle", pa.string()), ("frame", pa.int64()), ("frame_start", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())]
    )
    schema = "record_id string, page_id long, record_type string, payload_digest string, refers_to long, bundle string, frame long, frame_start long, offset long, size long"
    return written(mark_revisits(pages, least).mapInArrow(run, schema), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """`record_id`, `page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to` of all records of the index, from the bundles.

    Each identifier is looked up in its bundle, frame and place, and must be the one that stands there. A response's digest is
    computed anew from its payload and must be the one it states; a revisit's size
    and digest are those its headers state. A bundle's records are read by one task, each frame once.
    """

    def page_of(urn: str) -> int | None:
        named = urn.split(":")[2]
        return None if named == "none" else int(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bundle, frame, data = None, None, None, b""
        for batch in batches:
            rows = []
            for wanted, name, n, at in zip(*(batch.column(c).to_pylist() for c in ("record_id", "bundle", "frame", "offset")), strict=True):
                if name != bundle:
                    if reader is not None:
                        reader.close()
                    reader, bundle, frame = BundleReader(name), name, None
                if n != frame:
                    frame, data = n, reader.frame(n)
                headers, block, _ = parse(data, at)
                http, _, payload = block.partition(b"\r\n\r\n")
                stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(http.rpartition(b"Content-Length: ")[2])
                found = headers["WARC-Record-ID"].strip("<>")
                if found != wanted:
                    raise ValueError(f"{found} in the place of {wanted} in frame {n} of {name}")
                if headers["WARC-Type"] == "response" and (len(payload), bare_digest(payload)) != (size, stated):
                    raise ValueError(f"a damaged payload in frame {n} of {name}")
                refers = headers.get("WARC-Refers-To")
                rows.append((found, page_of(found), size, stated, headers["WARC-Type"], page_of(refers.strip("<>")) if refers else None))
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], schema=out)
        if reader is not None:
            reader.close()

    out = pa.schema(
        [("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64())]
    )
    places = index.select("record_id", "bundle", "frame", "offset")
    n = max(1, places.select("bundle").distinct().count())
    schema = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return places.repartition(n, "bundle").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes all pages and gives what reading the archives back tells of each."""
    return read_bundles(write_bundles(pages, fresh_folder(pages.sparkSession, "warc"), least=least))


# `round_trip` over the table pages; base32 from five hexadecimal digits at a time.
SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, first(page_id) OVER w AS top_id, row_number() OVER w > 1 AS revisit
      FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST))
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN top_id END AS refers_to
FROM r
"""
