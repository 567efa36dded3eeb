"""WARC archives as seekable Zstandard bundles.

A bundle is one file: records are grouped into frames that are compressed independently, so any of them can be
read alone; a skippable frame maps record identifiers to the frame, offset and length of each record; the
last, skippable too, is the seek table of the Zstandard seekable format (sizes and checksums of all frames, number
of frames, magic). Any Zstandard tool unpacks a bundle to plain WARC/1.1.

Equal payloads are found by digest before packing: the first becomes a response record, the others revisit it.
Spark's text writer stores the bundles: it writes bytes as they are, one row a file, and ends the row by its
separator, here the seek table's magic. So files appear by Spark's commit, and a retried task leaves none behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm.components import shared_folder
from accesslens.llm.skew import attached

LEAST_REVISIT = 0  # bytes of a payload from which equal ones are revisited
FRAME_BYTES = 256 << 10  # of records in a frame, one record at least
BUNDLE_BYTES = 8 << 20  # of records in a bundle, one frame at least
DATE = "1970-01-01T00:00:00Z"  # the table has no capture time
ID = "urn:accesslens:page:"
# Fixed values of the Zstandard frame and seekable formats, and of WARC.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = b"\xb1\xea\x92\x8f"  # 0x8F92EAB1, little-endian
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = re.compile(rb"(?:^|\r\n)([A-Za-z-]+): ([^\r\n]*)")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_id(urn: str | None) -> int | None:
    """The key in a record identifier; a null key's identifier ends with the prefix."""
    key = (urn or "").strip("<>").removeprefix(ID).partition("#")[0]
    return int(key) if key else None


def _urn(key: int | None) -> str:
    return f"<{ID}{'' if key is None else key}>"


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC/1.1 record of an HTTP response; a revisit has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # A URL comes back as it is from its quoted form; one that is missing has no header.
    target = [] if url is None else [("WARC-Target-URI", urllib.parse.quote(url, safe="!#$&'()*+,/:;=?@[]~"))]
    first = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))] if revisit else []
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(key)), ("WARC-Date", date), *target, *first,
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """What a record says. Raises ValueError where its parts don't fit each other."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.decode(): v.decode() for k, v in _HEAD.findall(head)}
    size = int(fields["Content-Length"])
    block = rest[:size]
    if not head.startswith(b"WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block differs from its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(_HEAD.findall(http))[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload differs from its header")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": page_id(fields["WARC-Record-ID"]), "url": None if url is None else urllib.parse.unquote(url), "payload_bytes": length,
        "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": page_id(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload,
    }


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class Bundle:
    """Collects records; ``packed`` is the file without the last four bytes, the seek table's magic."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes, self.coder = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.index: list[str] = []
        self.open: list[bytes] = []
        self.held = self.size = 0

    def add(self, key: int | None, raw: bytes) -> None:
        if self.held and self.held + len(raw) > self.frame_bytes:
            self._close()
        self.index.append(f"{'' if key is None else key} {len(self.frames)} {self.held} {len(raw)}")
        self.open.append(raw)
        self.held += len(raw)
        self.size += len(raw)

    def _close(self) -> None:
        plain = b"".join(self.open)
        self._frame(self.coder.compress(plain), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)
        self.open, self.held = [], 0

    def _frame(self, frame: bytes, size: int, check: int) -> None:
        self.frames.append(frame)
        self.table.append((len(frame), size, check))

    def packed(self) -> bytes:
        if self.held:
            self._close()
        self._frame(_skippable(SKIPPABLE_INDEX, self.coder.compress("\n".join(self.index).encode())), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        return b"".join(self.frames) + _skippable(SKIPPABLE_SEEK, rows + struct.pack("<IB", len(self.table), 0x80) + SEEK_MAGIC)[:-4]


class Reader:
    """Random access to one bundle: the seek table is read from the end, frames only when a record is asked for."""

    def __init__(self, content: bytes):
        if content[-4:] != SEEK_MAGIC:
            raise ValueError("no seek table at the end")
        count, flags = struct.unpack("<IB", content[-9:-4])
        step = 12 if flags & 0x80 else 8
        begin = len(content) - 9 - count * step
        if struct.unpack("<II", content[begin - 8 : begin]) != (SKIPPABLE_SEEK, count * step + 9):
            raise ValueError("the seek table is damaged")
        self.content, self.sizes, self.starts, self.last = content, [], [], (-1, b"")
        at = 0
        for i in range(count):
            row = struct.unpack_from("<III" if step == 12 else "<II", content, begin + i * step)
            self.starts.append(at)
            self.sizes.append(row)
            at += row[0]

    def frame(self, number: int) -> bytes:
        """The plain bytes of one frame, checked."""
        if self.last[0] != number:
            start, (size, plain, *check) = self.starts[number], self.sizes[number]
            found = zstandard.ZstdDecompressor().decompress(self.content[start : start + size], max_output_size=max(plain, 1))
            if check and check[0] != xxhash.xxh64_intdigest(found) & 0xFFFFFFFF:
                raise ValueError(f"frame {number} is damaged")
            self.last = number, found
        return self.last[1]

    def index(self) -> list[tuple[int | None, int, int, int]]:
        """key, frame, offset in the frame, and length of every record, in order."""
        start, size = self.starts[-1], self.sizes[-1][0]
        if struct.unpack_from("<I", self.content, start)[0] != SKIPPABLE_INDEX:
            raise ValueError("no index before the seek table")
        body = self.content[start + 8 : start + size]
        text = zstandard.ZstdDecompressor().decompress(body).decode()
        rows = [line.split(" ") for line in text.split("\n")] if text else []
        return [(int(k) if k else None, int(f), int(o), int(n)) for k, f, o, n in rows]

    def read(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]


def marked(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """id, url, payload, refers_to, revisit: which record every page becomes. Payloads are equal if length, SHA-1 and
    SHA-256 are. The smallest id of equal ones isn't a revisit; where only null ids have the payload, none is."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    size = F.octet_length("payload")
    same = F.when(size >= least, F.concat_ws(":", F.sha1("payload"), F.sha2("payload", 256), size.cast("string")))
    rows = rows.withColumn("same", same).withColumn("spread", F.xxhash64("id", "url"))
    groups = rows.groupBy("same").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("same IS NOT NULL AND n > 1")
    found = attached(rows, groups, ["same"], "spread")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return found.select("id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> None:
    """Writes the archives of all pages below ``path``, a new folder in a store that all executors share.

    A null text is an empty payload. Pages that repeat are written each; those with the smallest id of equal
    payloads are responses all. Null ids and URLs come back as such, other columns aren't read. A record may be as
    long as Spark lets a value be. An empty table makes a folder without bundles.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(frame_bytes)
        for batch in batches:
            for i, u, payload, first, revisit in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to", "revisit"))):
                bundle.add(i, record(i, u, payload, first, revisit, date))
                if bundle.size >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.packed()], pa.binary())], ["content"])
                    bundle = Bundle(frame_bytes)
        if bundle.size:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.packed()], pa.binary())], ["content"])

    bundles = marked(pages, key, url, html, least).mapInArrow(pack, "content binary")
    # A cast doesn't look into the bytes, and the text writer stores them as they are.
    bundles.select(F.col("content").cast("string").alias("value")).write.options(
        maxRecordsPerFile=1, encoding="ISO-8859-1", lineSep=SEEK_MAGIC.decode("latin-1")).text(path)


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def index(spark: SparkSession, path: str) -> DataFrame:
    """page_id, path, frame, offset, length: where every record lies. No frame is unpacked."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = Reader(content).index()
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), pa.array([name] * len(rows), pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                    ["page_id", "path", "frame", "offset", "length"])

    return _bundles(spark, path).mapInArrow(task, "page_id long, path string, frame long, offset long, length long")


RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _records(reader: Reader, places: Iterable[tuple[int, int, int]], step: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for place in places:
        held.append(parsed(reader.read(*place)))
        if len(held) == step:
            yield pa.RecordBatch.from_pylist(held, RECORDS)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, RECORDS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``: page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload (null in a revisit). Every record is fetched by its place in the index and checked against its digests."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                reader = Reader(content)
                yield from _records(reader, (place for _, *place in reader.index()))

    return _bundles(spark, path).select("content").mapInArrow(task, FIELDS)


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """As ``read``, for the page ids in the first column of ``wanted``: only bundles that hold one are joined with their
    places, and only the frames named are unpacked."""
    ids = wanted.select(F.col(wanted.columns[0]).cast("long").alias("page_id")).distinct()
    places = index(spark, path).join(ids, "page_id").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length"))).alias("places"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, found in zip(batch.column("content").to_pylist(), batch.column("places").to_pylist()):
                yield from _records(Reader(content), ((p["frame"], p["offset"], p["length"]) for p in found))

    return _bundles(spark, path).join(places, "path").select("content", "places").mapInArrow(task, FIELDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read(spark, path).drop("url", "payload")


SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
    SELECT html, min(page_id) AS first FROM p GROUP BY html
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)
        FOR i IN range(32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN g USING (html)
"""
