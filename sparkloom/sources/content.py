"""Types of files by their content: signatures of leading bytes, and a look into containers.

Signatures lie in a tree by byte, with a step for bytes that may be anything, so one walk over the first bytes tells the longest that
fits. Zip, RIFF, MP4 and old office containers are told apart by what lies in them; what has no signature is text if its bytes are. Only the
first ``HEAD`` bytes of a file are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.ship import ship

HEAD = 4096
OTHER = "application/octet-stream"

# Leading bytes (.. for any byte) and the types that they announce.
SIGNATURES = {
    "25 50 44 46 2D": "application/pdf",
    "89 50 4E 47 0D 0A 1A 0A": "image/png",
    "FF D8 FF": "image/jpeg",
    "47 49 46 38 37 61": "image/gif",
    "47 49 46 38 39 61": "image/gif",
    "42 4D": "image/bmp",
    "49 49 2A 00": "image/tiff",
    "4D 4D 00 2A": "image/tiff",
    "50 4B 03 04": "application/zip",
    "50 4B 05 06": "application/zip",
    "52 49 46 46 .. .. .. .. 57 41 56 45": "audio/x-wav",
    "52 49 46 46 .. .. .. .. 57 45 42 50": "image/webp",
    "52 49 46 46 .. .. .. .. 41 56 49 20": "video/x-msvideo",
    ".. .. .. .. 66 74 79 70": "video/mp4",
    "49 44 33": "audio/mpeg",
    "FF FB": "audio/mpeg",
    "FF F3": "audio/mpeg",
    "FF F2": "audio/mpeg",
    "66 4C 61 43": "audio/flac",
    "4F 67 67 53": "application/ogg",
    "D0 CF 11 E0 A1 B1 1A E1": "application/x-ole-storage",
    "1F 8B 08": "application/gzip",
    "42 5A 68": "application/x-bzip2",
    "28 B5 2F FD": "application/zstd",
    "37 7A BC AF 27 1C": "application/x-7z-compressed",
    "50 41 52 31": "application/vnd.apache.parquet",
    "7F 45 4C 46": "application/x-executable",
    "7B 5C 72 74 66": "text/rtf",
}
# What a member's name says of a zip file, and a brand of an MP4 container.
ZIP_MEMBERS = {
    "word/": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xl/": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "ppt/": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "META-INF/": "application/java-archive",
    "Contents/": "application/hwp+zip",
}
BRANDS = {"M4A": "audio/mp4", "M4B": "audio/mp4", "qt": "video/quicktime", "heic": "image/heic", "mif1": "image/heic", "avif": "image/avif", "3gp": "video/3gpp"}


@lru_cache(maxsize=1)
def tree() -> dict:
    """Signatures by byte; ``None`` is the step of any byte, ``""`` holds the type."""
    root: dict = {}
    for signature, kind in SIGNATURES.items():
        node = root
        for byte in signature.split():
            node = node.setdefault(None if byte == ".." else int(byte, 16), {})
        node[""] = kind
    return root


def signed(head: bytes) -> str | None:
    """The type of the longest signature that the first bytes fit."""
    best, live = (0, None), [(tree(), 0)]
    while live:
        node, at = live.pop()
        if "" in node and at > best[0]:
            best = (at, node[""])
        if at < len(head):
            live += [(node[step], at + 1) for step in (head[at], None) if step in node]
    return best[1]


def zip_members(head: bytes) -> Iterator[tuple[str, bytes]]:
    """Names and stored contents of the members whose local headers lie in the first bytes."""
    at = 0
    while (at := head.find(b"PK\x03\x04", at)) >= 0 and len(head) >= at + 30:
        stored = int.from_bytes(head[at + 8 : at + 10], "little") == 0
        size, name, extra = (int.from_bytes(head[at + i : at + i + n], "little") for i, n in ((18, 4), (26, 2), (28, 2)))
        begin = at + 30 + name + extra
        yield head[at + 30 : at + 30 + name].decode("utf-8", "replace"), head[begin : begin + size] if stored else b""
        at += 30


def zipped(head: bytes) -> str:
    found = "application/zip"
    for name, content in zip_members(head):
        if name == "mimetype" and content:
            return content.decode("ascii", "replace").strip()
        found = next((kind for prefix, kind in ZIP_MEMBERS.items() if name.startswith(prefix)), found) if found == "application/zip" else found
    return found


def texts(head: bytes) -> tuple[str, str] | None:
    """Type and encoding of bytes that are text."""
    for mark, encoding in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16le"), (b"\xfe\xff", "utf-16be")):
        if head.startswith(mark):
            text = head[len(mark) :].decode(encoding, "ignore")
            break
    else:
        if re.search(rb"[\x00-\x08\x0e-\x1a\x1c-\x1f\x7f]", head):
            return None
        encoding = "us-ascii" if head.isascii() else "utf-8"
        try:
            text = head.decode()
        except UnicodeDecodeError as e:
            if e.reason != "unexpected end of data" or len(head) < HEAD:
                return "text/plain", "unknown-8bit"
            text = head[: e.start].decode()  # the last character is cut off
    body = text.lstrip()
    if re.match(r"<!doctype html|<html|<head|<body", body, re.IGNORECASE):
        return "text/html", encoding
    if body.startswith("<?xml"):
        return ("image/svg+xml" if "<svg" in body else "text/xml"), encoding
    if re.match(r'\{\s*("|\}|$)|\[\s*(["\[{\d\]-]|true|false|null|$)', body):
        return "application/json", encoding
    return "text/plain", encoding


def sniff(head: bytes | None) -> dict | None:
    """Type, encoding (binary for what is no text)."""
    if head is None:
        return None
    head = bytes(head[:HEAD])
    if not head:
        return {"mime_type": "inode/x-empty", "mime_encoding": "binary"}
    kind = signed(head)
    if kind == "application/zip":
        kind = zipped(head)
    elif kind == "video/mp4":
        kind = next((k for brand, k in BRANDS.items() if head[8:12].decode("ascii", "replace").startswith(brand)), kind)
    elif kind == "application/x-ole-storage":
        names = {"W\0o\0r\0d\0D\0o\0c": "application/msword", "W\0o\0r\0k\0b\0o\0o\0k": "application/vnd.ms-excel", "P\0o\0w\0e\0r\0P\0o\0i\0n\0t": "application/vnd.ms-powerpoint", "H\0w\0p\0S\0u\0m\0m\0a\0r\0y": "application/x-hwp"}
        kind = next((k for name, k in names.items() if name.encode() in head), kind)
    elif kind == "image/bmp" and (len(head) < 18 or head[6:10] != b"\0\0\0\0"):
        kind = None  # two letters alone are text as well
    if kind is None and len(head) > 262 and head[257:262] == b"ustar":
        kind = "application/x-tar"
    if kind and not kind.startswith("text/"):
        return {"mime_type": kind, "mime_encoding": "binary"}
    found = texts(head)
    return {"mime_type": kind or (found[0] if found else OTHER), "mime_encoding": found[1] if found else "binary"}


KIND = "mime_type string, mime_encoding string"
_TYPE = pa.struct([("mime_type", pa.string()), ("mime_encoding", pa.string())])


def content_type(head: Column) -> Column:
    """struct<mime_type, mime_encoding> of the first bytes of files, null for null."""
    ship()
    return F.arrow_udf(lambda heads: pa.array([sniff(h) for h in heads.to_pylist()], _TYPE), KIND)(F.substring(head.cast("binary"), 1, HEAD))


def content_types(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds mime_type and mime_encoding to rows of paths. Each task reads the first ``HEAD`` bytes of its files, through Arrow's file systems;
    files that cannot be read get nulls."""
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(files.schema.jsonValue()).add("mime_type", "string").add("mime_encoding", "string")

    def step(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for part in parts:
            out = []
            for name in part.column(part.schema.get_field_index(path)).to_pylist():
                try:
                    store, inner = fs.FileSystem.from_uri(name) if ":" in name else (fs.LocalFileSystem(), name)
                    with store.open_input_file(inner) as source:
                        out.append(sniff(source.read(HEAD)))
                except (OSError, ValueError, TypeError):
                    out.append(None)
            kinds = [pa.array([k and k[c] for k in out], pa.string()) for c in ("mime_type", "mime_encoding")]
            yield pa.RecordBatch.from_arrays([*part.columns, *kinds], [*part.schema.names, "mime_type", "mime_encoding"])

    ship(files.sparkSession)
    return files.mapInArrow(step, schema)
