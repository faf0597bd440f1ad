"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a bundle is a file of frames with a seek
table in a skippable frame at its end (the published seekable format), and the index maps every
record identifier to its bundle, frame and offset in the frame. Of equal payloads of at least ``MIN_REVISIT`` bytes, the
one with the smallest id is the response; others are revisit records without a payload.

Scale: only digests are shuffled to find equal payloads. Pages are written where they are
scanned, and joined with the revisits alone: broadcast when their counted number is below a bound, by shuffle otherwise.
Bundles have a bounded size. A task that is repeated writes a new file name, and only files that the
returned index names are ever read, so lost executors leave no half-written bundle in a result.

Defined edge cases: null payload is empty; null url has no target header, other urls are read back as they were; a null id is
kept as an empty identifier; of repeated rows with the smallest id all are responses; a payload larger than a frame is a
frame of its own, held whole by one task; an empty table gives an empty index; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, bounded_batches, map_arrow, slices

MIN_REVISIT = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: At most so many revisit rows (about 150 bytes each) are broadcast.
BROADCAST_ROWS = 100_000
#: Tasks that read archives; beyond it a task reads several bundles.
MOST_TASKS = 50_000
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = "page_id long, record_id string, bundle string, frame int, frame_offset long, frame_bytes long, record_offset long, record_bytes long"


def open_store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI; Hadoop spells local ones ``file:/path``."""
    local = path.startswith("file:") and not path.startswith("file://")
    return pyarrow.fs.FileSystem.from_uri(path.removeprefix("file:") if local else path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP header only; its Content-Length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if url is not None:
        # as it is, unless it holds what would end or blur a header line; then percent signs are escaped as well
        plain = url.isprintable() and url == url.strip()
        head += [f"WARC-Target-URI: {url}"] if plain else [f"WARC-Target-URI: {quote(url, safe='')}", "X-Target-URI-Escaped: yes"]
    if is_revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{record_id(refers_to, digest)}>",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_records(data: bytes) -> Iterator[dict]:
    """The records of a decompressed frame: their headers, HTTP header fields, payload and place."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        begin, size = stop + 4, int(head["Content-Length"])
        block = data[begin : begin + size]
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
        yield {"head": head, "http": fields, "payload": payload, "offset": at, "bytes": begin + size + 4 - at}
        at = begin + size + 4


class BundleWriter:
    """Writes frames to one file, then the seek table."""

    def __init__(self, folder: str, level: int = LEVEL):
        import zstandard

        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = open_store(self.path)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.table: list[tuple[int, int]] = []
        self.offset = 0

    def frame(self, data: bytes) -> tuple[int, int, int]:
        """Number, offset and compressed size of the new frame."""
        packed = self.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data)))
        self.offset += len(packed)
        return len(self.table) - 1, self.offset - len(packed), len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.out.close()


class BundleReader:
    """Random access by frame, from the seek table alone."""

    def __init__(self, path: str):
        import zstandard

        store, inner = open_store(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        entry = 12 if flags & 0x80 else 8
        raw = self.file.read_at(frames * entry, size - 9 - frames * entry)
        self.sizes = [struct.unpack_from("<II", raw, i * entry) for i in range(frames)]
        self.offsets = [0]
        for packed, _ in self.sizes:
            self.offsets.append(self.offsets[-1] + packed)
        self.unpack = zstandard.ZstdDecompressor().decompress

    def frame(self, number: int) -> bytes:
        packed, full = self.sizes[number]
        return self.unpack(self.file.read_at(packed, self.offsets[number]), max_output_size=full)

    def record(self, number: int, offset: int, size: int) -> dict:
        return next(decode_records(self.frame(number)[offset : offset + size]))

    def close(self) -> None:
        self.file.close()


def revisits(pages: DataFrame, scratch: Scratch, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, digest, refers_to of every row that revisits another."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = scratch.table(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n")).filter(F.col("n") >= min_bytes), "digests"
    )
    groups = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_rows")).filter("_rows > 1 AND refers_to IS NOT NULL")
    return scratch.table(rows.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct(), "revisits")


def write(pages: DataFrame, folder: str, scratch: Scratch, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Writes the bundles and returns the index: a row for each record."""
    bounded_batches(pages.sparkSession)
    again = revisits(pages, scratch, min_bytes)
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    again = again.toDF("_page", "_digest", "refers_to")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("html"), F.sha2(html, 256).alias("digest"))
    joined = own.join(again, own["page_id"].eqNullSafe(again["_page"]) & (own["digest"] == again["_digest"]), "left")
    source = joined.select("page_id", "url", "html", "digest", "refers_to", F.col("_digest").isNotNull().alias("revisit"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: BundleWriter | None = None
        parts: list[bytes] = []
        ids: list[tuple] = []
        size = written = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, written
            number, offset, packed = bundle.frame(b"".join(parts))
            written += packed
            at, rows = 0, []
            for (page, rid), part in zip(ids, parts, strict=True):
                rows.append((page, rid, bundle.path, number, offset, packed, at, len(part)))
                at += len(part)
            parts.clear()
            ids.clear()
            size = 0
            types = [pa.int64(), pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 4
            names = [x.split()[0] for x in INDEX.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for part in slices(batch, "html"):
                for r in part.to_pylist():
                    if bundle is None:
                        bundle, written = BundleWriter(folder), 0
                    data = encode_record(r["page_id"], r["url"], r["html"], r["digest"], r["refers_to"], r["revisit"])
                    parts.append(data)
                    ids.append((r["page_id"], record_id(r["page_id"], r["digest"])))
                    size += len(data)
                    if size >= frame_bytes:
                        yield flush()
                    if written >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if parts:
            yield flush()
        if bundle is not None:
            bundle.close()

    return scratch.table(source.mapInArrow(put, INDEX), "index")


def read(spark: SparkSession, index: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload: every record of the indexed bundles.

    Size and digest are taken from the payload itself; for a revisit, from its header.
    """
    # a task for each bundle, as near as a hash deals them; the index is too small to split by its size
    bundles = index.select("bundle").distinct().count()
    frames = index.select("bundle", "frame").distinct().repartition(max(1, min(bundles, MOST_TASKS)), "bundle")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def make():
        open_: dict[str, BundleReader] = {}

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path not in open_:
                    for old in open_.values():
                        old.close()
                    open_.clear()
                    open_[path] = BundleReader(path)
                rows = []
                for r in decode_records(open_[path].frame(number)):
                    head, full = r["head"], r["head"]["WARC-Type"] == "response"
                    rows.append(
                        (
                            int(head["X-Page-ID"]) if head["X-Page-ID"] else None,
                            unquote(head["WARC-Target-URI"]) if "X-Target-URI-Escaped" in head else head.get("WARC-Target-URI"),
                            head["WARC-Type"],
                            None if full else int(head["X-Refers-To-Page-ID"]),
                            len(r["payload"]) if full else int(r["http"]["Content-Length"]),
                            hashlib.sha256(r["payload"]).hexdigest() if full else head["WARC-Payload-Digest"].split(":")[1],
                            r["payload"] if full else None,
                        )
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in schema.split(", ")])

        return step

    return map_arrow(frames.sortWithinPartitions("bundle", "frame"), schema, make)


def lookup(index: DataFrame, record_ids: list[str]) -> list[dict]:
    """Single records by identifier: one seek and one frame each."""
    out = []
    for r in index.filter(F.col("record_id").isin(record_ids)).toLocalIterator():
        reader = BundleReader(r["bundle"])
        out.append(reader.record(r["frame"], r["record_offset"], r["record_bytes"]))
        reader.close()
    return out


def archive(pages: DataFrame, folder: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Writes the archives (below the shared folder unless one is named) and reads them back: index, records."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    index = write(pages, folder or scratch.folder("bundles"), scratch, **options)
    return index, scratch.own(read(spark, index))
