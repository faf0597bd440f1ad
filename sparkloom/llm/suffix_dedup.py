"""Removal of repeated substrings with suffix arrays built by two-stage sorting.

A window is a string of ``length`` bytes. A byte goes if a window covers it that also starts earlier: in a
document of smaller id, or earlier in the same document. Matches never cross documents.

Cutting the corpus into independent suffix arrays, without losing a match:

1. Texts are written once, without a shuffle, as bounded slices in the shared folder; all later work is
   keyed by slice and reads slice files, so text itself is never shuffled. Texts that are equal as a whole are one
   text from here on (the smallest id stands for them).
2. Every window has a minimizer: the smallest hash among its ``gram``-byte substrings. Equal windows have equal
   minimizers at equal places, so runs of windows that share a minimizer form a snippet, and snippets
   only have to meet others of the same minimizer. Snippets with a minimizer that occurs nowhere else are done.
   A Misra-Gries summary finds hot minimizers first; their snippets are cut into short ones keyed
   by the bytes all their windows share, so no key gathers more than a bounded variety of strings, and equal ones of a
   slice are one row before they are shuffled: their first and last places meet by a partial aggregation, and the verdict
   on all others goes back by a plain join. So a line that a third of all documents share meets in no task.
3. For each key, equal snippets (by two 64-bit hashes) are one string with its first place and one later place that stands
   for all later ones. All strings of a range of keys are concatenated and sorted: suffixes smaller than their
   successors directly, all others induced by bucket scans. Adjacent common prefixes of ``length`` or more
   join windows into classes; all but the first place of a class repeat it.
4. Verdicts return to their slices, where the removed bytes are marked.

Defined edge cases: null text is empty; texts shorter than ``length`` lose nothing; rows that repeat an id and text are
copies of one of them; rows with equal id and other text are ordered by digest; a null id comes first; a long text is hashed
in pieces of ``PIECE_BYTES`` that overlap by a window, and held whole only as bytes; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, map_arrow, slices
from sparkloom.llm.warc import open_store

LENGTH = 100
GRAM = 32
SLICE_BYTES = 2 << 20
#: Bytes of a text that are hashed at once.
PIECE_BYTES = 2 << 20
#: Records of a bucket (about 26 bytes each), and bytes of the strings of one suffix array.
BUCKET_RECORDS = 250_000
ARRAY_BYTES = 3 << 20
#: Buckets, and suffix arrays, of one task.
OF_TASK = 4
#: Counters of the summary, the least count of a hot minimizer, and the windows of its cut snippets. A task's summary misses at most
#: 1/COUNTERS of the task's records (one for about 35 bytes) of a minimizer, and leaves counts of one out; the sum over tasks has to reach
#: 1/COUNTERS of all. So a minimizer that is not hot has at most 2/COUNTERS of all records and one for each task, or HOT of them.
COUNTERS = 1 << 20
HOT = 4096
HOT_WINDOWS = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
U64 = np.uint64


# ---------------------------------------------------------------- two-stage suffix sorting


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor. The end counts as smallest, so the last suffix is not."""
    n = len(text)
    if not n:
        return np.zeros(0, bool)
    # positions up to and with a change compare as the change does
    change = np.where(text[1:] != text[:-1], np.arange(n - 1), n - 1)
    change = np.minimum.accumulate(change[::-1])[::-1]
    rises = np.zeros(n, bool)
    inside = change < n - 1
    at = change[inside]
    rises[:-1][inside] = text[at] < text[at + 1]
    return rises


def words_of(text: np.ndarray, room: int) -> np.ndarray:
    """Eight bytes from each position as big-endian numbers, whose order is that of the bytes; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(room + 16, np.uint8)])
    return np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,)).astype(np.uint64)


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most ``most``."""
    out = np.full(len(a), most, np.int64)
    live = np.arange(len(a))
    for depth in range(0, most, 8):
        x = words[a[live] + depth] ^ words[b[live] + depth]
        apart = x != 0
        if apart.any():
            bits = np.frexp((x[apart] >> U64(11)).astype(np.float64))[1].astype(np.int64) + 11
            small = (x[apart] >> U64(11)) == 0
            bits[small] = np.frexp(x[apart][small].astype(np.float64))[1]
            out[live[apart]] = np.minimum(most, depth + (64 - bits) // 8)
            live = live[~apart]
        if not len(live):
            break
    return out


def sort_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions by their first ``depth`` bytes. Rounds of eight bytes; groups of equal strings leave early."""
    if not len(at):
        return at
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    done = 8
    head = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(head) - 1
    size = np.bincount(group)
    tied = np.flatnonzero(size[group] > 1)
    while done < depth and len(tied):
        if done >= 24:  # most groups left are equal strings: those are finished
            same = np.ones(len(tied), bool)
            mates = np.flatnonzero(group[tied[1:]] == group[tied[:-1]])
            equal = common_prefix(words, at[tied[mates]] + done, at[tied[mates + 1]] + done, depth - done) >= depth - done
            open_groups = np.unique(group[tied[mates[~equal]]])
            same = ~np.isin(group[tied], open_groups)
            tied = tied[~same]
            if not len(tied):
                break
        key = words[at[tied] + done]
        order = np.lexsort((key, group[tied]))
        at[tied] = at[tied[order]]
        key, own = key[order], group[tied]
        head = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        fresh = np.cumsum(head) - 1 + len(group) * (done // 8)  # new names that no other group has
        group[tied] = fresh
        _, back, size = np.unique(fresh, return_inverse=True, return_counts=True)
        tied = tied[size[back] > 1]
        done += 8
    return at


def two_stage(text: np.ndarray, needed: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """The needed suffixes in the order of their first ``depth`` bytes.

    Suffixes smaller than their successors are sorted directly. The others are induced: buckets (first
    bytes) are scanned in ascending order, and the predecessor of each scanned suffix, if it is larger than it, is the
    next of its own bucket. A run of one byte induces itself in waves. Only needed suffixes and
    those that induce them take part.
    """
    n = len(text)
    rises = smaller_than_next(text)
    wanted = needed.copy()
    # a larger suffix needs its successor, up to the first smaller one
    falls = np.flatnonzero(wanted & ~rises)
    while len(falls):
        following = falls[falls + 1 < n] + 1
        following = following[~wanted[following]]
        wanted[following] = True
        falls = following[~rises[following]]
    words = words_of(text, depth) if words is None else words
    direct = sort_directly(words, np.flatnonzero(wanted & rises), depth)
    bytes_of = text[direct]
    larger = wanted & ~rises
    inducing = np.zeros(n + 1, bool)
    inducing[1:] = larger  # position p + 1 induces p
    bounds = np.searchsorted(bytes_of, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and larger[n - 1]:  # the end induces the last suffix
        waiting[text[n - 1]].append(np.asarray([n - 1]))
    out: list[np.ndarray] = []
    for c in range(256):
        def induce(scanned: np.ndarray) -> np.ndarray:
            """Sends predecessors to later buckets; returns those of this bucket."""
            before = scanned[inducing[scanned]] - 1
            before = before[before >= 0]
            of = text[before]
            later = before[of > c]
            if len(later):
                keys = text[later]
                order = np.argsort(keys, kind="stable")
                later, keys = later[order], keys[order]
                edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                for first, last in zip(edges, [*edges[1:], len(keys)], strict=True):
                    waiting[keys[first]].append(later[first:last])
            return before[of == c]

        wave = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        waiting[c] = []
        while len(wave):
            out.append(wave)
            wave = induce(wave)
        own = direct[bounds[c] : bounds[c + 1]]
        if len(own):
            out.append(own)
            induce(own)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[needed[order]]


def window_classes(strings: list[bytes], windows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the first ``windows[i]`` windows of every string: string, offset and class, in suffix order.

    Windows are of one class if the suffixes that start there share a prefix of ``length`` bytes.
    """
    text = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), windows)
    at = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows))
    needed = np.zeros(len(text), bool)
    needed[at] = True
    words = words_of(text, length)
    order = two_stage(text, needed, length, words)
    prefix = common_prefix(words, order[:-1], order[1:], length)
    classes = np.cumsum(np.concatenate([[True], prefix < length])) - 1 if len(order) else np.empty(0, np.int64)
    string = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)[order]
    return string, order - starts[string], classes


# ---------------------------------------------------------------- slices, minimizers


def write_slices(docs: DataFrame, folder: str, scratch: Scratch, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """slice, path, row, doc_id, n_bytes, digest of every document; texts go to files of about ``slice_bytes``. Slices are numbered by task,
    so that what is shuffled later names a slice in eight bytes."""

    def make():
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text", slice_bytes):
                texts = [t or b"" for t in part.column(1).to_pylist()]
                path = f"{folder}/{uuid.uuid4().hex}.arrow"
                store, inner = open_store(path)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                table = pa.table({"text": pa.array(texts, pa.large_binary())})
                sink = io.BytesIO()
                with pa.ipc.new_file(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(table)
                with store.open_output_stream(inner, compression=None) as out:
                    out.write(sink.getbuffer())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([next(numbers)] * len(texts), pa.int64()),
                        pa.array([path] * len(texts)),
                        pa.array(range(len(texts)), pa.int32()),
                        part.column(0),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    ],
                    ["slice", "path", "row", "doc_id", "n_bytes", "digest"],
                )

        return step

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return scratch.table(map_arrow(source, "slice long, path string, row int, doc_id long, n_bytes long, digest binary", make), "rows")


def read_slice(path: str) -> list[bytes]:
    store, inner = open_store(path)
    with store.open_input_file(inner) as source:
        return pa.ipc.open_file(pa.BufferReader(source.read())).read_all()["text"].to_pylist()


@lru_cache(maxsize=4)
def _powers(n: int, odd: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, odd, np.uint64), np.full(n, pow(odd, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class RollingHash:
    """Polynomial hashes of any substring of a buffer."""

    def __init__(self, text: np.ndarray, odd: np.uint64):
        n = len(text) + 1
        room = (n >> 20) + 1 << 20
        self.up, down = _powers(room, int(odd))
        self.sums = np.concatenate([[U64(0)], np.cumsum((text.astype(np.uint64) + U64(1)) * down[: len(text)], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = (self.sums[stop] - self.sums[start]) * self.up[start]
        return mixed(h ^ (stop - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        h = (self.sums[k:] - self.sums[:-k]) * self.up[: len(self.sums) - k]
        return mixed(h)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def minimizer_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """buffer, its document bounds, and of each run of windows with one minimizer: its hash, place, first window, number of windows."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    none = np.empty(0, np.int64)
    if len(text) < length:
        return text, ends, none.view(np.uint64), none, none, none
    hashes = RollingHash(text, _ODD).grams(gram)
    bits = U64(max(24, len(text).bit_length()))
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, grown = length - gram + 1, 1
    while grown * 2 <= width:
        least = np.minimum(least[:-grown], least[grown:])
        grown *= 2
    if grown < width:
        least = np.minimum(least[: -(width - grown)], least[width - grown :])
    place = (least & U64((1 << int(bits)) - 1)).astype(np.int64)
    valid = np.ones(len(place), bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - length + 1) : end] = False
    first = np.flatnonzero(valid)
    q = place[first]
    edge = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (first[1:] != first[:-1] + 1)])) if len(q) else none
    count = np.diff(np.concatenate([edge, [len(q)]])) if len(q) else none
    return text, ends, hashes[q[edge]], q[edge], first[edge], count


def batched_pieces(texts: list[bytes], length: int, most: int = PIECE_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Text number, first byte and bytes of pieces that together hold every window once, in batches of about ``most`` bytes."""
    batch: list[tuple[int, int, bytes]] = []
    total = 0
    for number, text in enumerate(texts):
        for first in range(0, len(text) - length + 1, most):
            piece = text[first : first + most + length - 1]
            batch.append((number, first, piece))
            total += len(piece)
            if total >= most:
                yield batch
                batch, total = [], 0
    if batch:
        yield batch


def cut_hot(hashes: np.ndarray, place: np.ndarray, first: np.ndarray, count: np.ndarray, hot: np.ndarray, content: RollingHash, length: int, most: int = HOT_WINDOWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, first window, windows: runs of hot minimizers in pieces of at most ``most`` windows at fixed
    offsets from the minimizer, keyed by the bytes that all windows of such a piece share."""
    is_hot = np.isin(hashes, hot)
    h, q, a, n = hashes[is_hot], place[is_hot], first[is_hot], count[is_hot]
    if not len(h):
        return h, a, n
    run = np.repeat(np.arange(len(h)), n)
    window = a[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    part = (q[run] - window) // most  # offsets most * part .. most * part + most - 1
    edge = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (part[1:] != part[:-1])]))
    size = np.diff(np.concatenate([edge, [len(run)]]))
    run, window, part = run[edge], window[edge], part[edge]
    # windows of the piece start at q - (most * part + most - 1) at the earliest and q - most * part at the latest
    core = content.of(q[run] - most * part, q[run] - (most * part + most - 1) + length)
    key = mixed(h[run] * U64(3) ^ core * _ODD2 ^ part.astype(np.uint64))
    return key, window, size


#: One record of a run of windows: key, content, document in the blob's table, first window in the document, windows.
RUN = np.dtype([("key", "<u8"), ("content", "<u8"), ("doc", "<u4"), ("first", "<u4"), ("count", "u1")])
DOC = np.dtype([("id", "<i8"), ("tie", "<i8"), ("row", "<i4"), ("null", "u1")])
#: Windows of a text that repeat: row in the slice, first window, windows.
PLACE = np.dtype([("row", "<i4"), ("first", "<u4"), ("count", "u1")])


def hot_minimizers(work: DataFrame, scratch: Scratch, length: int, gram: int, counters: int, least: int) -> np.ndarray:
    """Hashes of at least ``least`` places and 1/counters of all: at most ``counters`` of them, by a Misra-Gries summary."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        fresh: list[np.ndarray] = []
        total = 0

        def merged() -> None:
            nonlocal keys, counts
            own, n = np.unique(np.concatenate(fresh), return_counts=True) if fresh else (keys[:0], counts[:0])
            fresh.clear()
            both, back = np.unique(np.concatenate([keys, own]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(both)).astype(np.int64)
            keys = both
            if len(keys) > counters:  # Misra-Gries: subtract what the first counter too many has
                counts = counts - np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]

        for batch in batches:
            for path, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts = read_slice(path)
                for pieces in batched_pieces([texts[r["row"]] for r in rows], length):
                    fresh.append(minimizer_runs([p for _, _, p in pieces], length, gram)[2])
                    total += len(fresh[-1])
                    if sum(map(len, fresh)) > counters:
                        merged()
        merged()
        some = counts > 1
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some]), pa.array(np.zeros(some.sum(), np.int64))], ["h", "n", "total"])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.array([total], pa.int64())], ["h", "n", "total"])

    counted = scratch.table(work.mapInArrow(summarise, "h long, n long, total long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "counted")
    all_ = counted.agg(F.sum("total")).first()[0] or 0
    # no counter says more than was counted, so at most ``counters`` rows have a share of 1/counters
    return counted.filter(F.col("n") >= max(least, -(-all_ // counters))).select("h").toArrow()["h"].to_numpy().view(np.uint64)


def doc_table(rows: list[dict]) -> np.ndarray:
    table = np.empty(len(rows), DOC)
    table["id"] = [r["doc_id"] or 0 for r in rows]
    table["null"] = [r["doc_id"] is None for r in rows]
    table["tie"] = [r["tie"] for r in rows]
    table["row"] = [r["row"] for r in rows]
    return table


def slice_records(texts: list[bytes], hot: np.ndarray, length: int, gram: int, want_hot: bool) -> np.ndarray:
    """Records of the runs of windows of a slice: those with a hot minimizer, cut, or all others."""
    out = [np.empty(0, RUN)]
    for pieces in batched_pieces(texts, length):
        text, ends, hashes, place, first, count = minimizer_runs([p for _, _, p in pieces], length, gram)
        content = RollingHash(text, _ODD2)
        if want_hot:
            key, first, count = cut_hot(hashes, place, first, count, hot, content, length)
        else:
            cold = ~np.isin(hashes, hot)
            key, first, count = hashes[cold], first[cold], count[cold]
        piece = np.searchsorted(ends, first, "right")
        begin = np.concatenate([[0], ends[:-1]])
        record = np.empty(len(key), RUN)
        record["key"], record["count"] = key, count
        record["content"] = content.of(first, first + count + length - 1)
        record["doc"] = np.fromiter((n for n, _, _ in pieces), np.int64, len(pieces))[piece]
        record["first"] = first - begin[piece] + np.fromiter((a for _, a, _ in pieces), np.int64, len(pieces))[piece]
        out.append(record)
    return np.concatenate(out)


def runs_by_bucket(work: DataFrame, hot: np.ndarray, buckets: int, length: int, gram: int) -> DataFrame:
    """bucket, slice, docs, runs: packed records of a slice for each bucket of keys, but for hot minimizers."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, rows, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                texts = read_slice(path)
                record = slice_records([texts[r["row"]] for r in rows], hot, length, gram, False)
                if not len(record):
                    continue
                table = doc_table(rows)
                bucket = ((record["key"] >> U64(20)) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                record, bucket = record[order], bucket[order]
                edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                blobs, docs = [], []
                for a, b in zip(edge, [*edge[1:], len(bucket)], strict=True):
                    part = record[a:b].copy()
                    used, part["doc"] = np.unique(part["doc"], return_inverse=True)
                    blobs.append(part.tobytes())
                    docs.append(table[used].tobytes())
                for i in range(0, len(edge), 256):
                    j = slice(i, i + 256)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[edge][j].astype(np.int32)), pa.array([number] * len(edge[j]), pa.int64()), pa.array(docs[j], pa.binary()), pa.array(blobs[j], pa.binary())],
                        ["bucket", "slice", "docs", "runs"],
                    )

        return step

    return map_arrow(work, "bucket int, slice long, docs binary, runs binary", make)


#: Place of a string in document order, as Spark compares it.
ORDERED = "struct<has:boolean,id:long,tie:long,slice:long,row:int,first:long>"


def hot_strings(work: DataFrame, hot: np.ndarray, length: int, gram: int) -> DataFrame:
    """key, content, windows, slice, lo and hi (first and last place in the slice), n, places: a row for each distinct string of a
    slice whose minimizer is hot."""
    place = pa.struct([("has", pa.bool_()), ("id", pa.int64()), ("tie", pa.int64()), ("slice", pa.int64()), ("row", pa.int32()), ("first", pa.int64())])

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, rows, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                texts = read_slice(path)
                record, table = slice_records([texts[r["row"]] for r in rows], hot, length, gram, True), doc_table(rows)
                if not len(record):
                    continue
                record = record[by_first_place(record, table, record["key"], record["content"])]
                new = np.concatenate([[True], (record["key"][1:] != record["key"][:-1]) | (record["content"][1:] != record["content"][:-1])])
                edge = np.flatnonzero(new)
                last = np.concatenate([edge[1:], [len(record)]]) - 1
                own = np.empty(len(record), PLACE)
                own["row"], own["first"], own["count"] = table["row"][record["doc"]], record["first"], record["count"]

                def at(i: np.ndarray) -> pa.Array:
                    d = table[record["doc"][i]]
                    columns = [pa.array(d["null"] == 0), pa.array(d["id"]), pa.array(d["tie"]), pa.array([number] * len(i), pa.int64()), pa.array(d["row"]), pa.array(record["first"][i].astype(np.int64))]
                    return pa.StructArray.from_arrays(columns, fields=list(place))

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(record["key"][edge].view(np.int64)),
                        pa.array(record["content"][edge].view(np.int64)),
                        pa.array(record["count"][edge].astype(np.int32)),
                        pa.array([number] * len(edge), pa.int64()),
                        at(edge),
                        at(last),
                        pa.array(last - edge + 1),
                        pa.array([own[a : b + 1].tobytes() for a, b in zip(edge, last, strict=True)], pa.binary()),
                    ],
                    ["key", "content", "windows", "slice", "lo", "hi", "n", "places"],
                )

        return step

    return map_arrow(work, f"key long, content long, windows int, slice long, lo {ORDERED}, hi {ORDERED}, n long, places binary", make)


def resolve_hot(strings: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """slice, member, repeat, n as ``resolve_bucket`` gives them, for strings with hot minimizers.

    First and last places of a string are algebraic, so they are combined before the shuffle; repeats return by
    a plain join on (key, content), which can split a hot string.
    """
    whole = scratch.table(strings.groupBy("key", "content").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.first("windows").alias("windows")), "strings")
    shared = whole.groupBy("key").agg(F.sum("n").alias("_all")).filter("_all > 1").select("key")
    ends = F.when(F.col("n") > 1, F.array("lo", "hi")).otherwise(F.array("lo"))
    members = whole.join(shared, "key").select("key", "windows", F.explode(ends).alias("p")).select("p.slice", "p.row", "p.first", "windows", "key")
    others = strings.select("key", "content", "slice", "places").join(whole.filter("n > 2").select("key", "content", "lo", "hi"), ["key", "content"]).select(
        "slice", "places", "lo.slice", "lo.row", "lo.first", "hi.slice", "hi.row", "hi.first"
    )
    names, types = ["slice", "member", "repeat", "n"], [pa.int64(), pa.binary(), pa.binary(), pa.int64()]

    def pack():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            place = np.empty(batch.num_rows, PLACE)
            place["row"], place["first"], place["count"] = (batch.column(i).to_numpy() for i in (1, 2, 3))
            key = batch.column(4).to_numpy().view(np.uint64)
            blobs = [place[i : i + 1].tobytes() + key[i : i + 1].tobytes() for i in range(len(place))]
            size = batch.column(3).to_numpy().astype(np.int64) + length - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, types[1]), pa.array([b""] * len(blobs), types[2]), pa.array(size, types[3])], names)

        return step

    def rest():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            out = []
            for number, places, *ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(places, PLACE)
                for p, row, first in (ends[:3], ends[3:]):
                    if p == number:
                        own = own[(own["row"] != row) | (own["first"] != first)]
                if len(own):
                    out.append((number, b"", own.tobytes(), 0))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        return step

    schema = "slice long, member binary, repeat binary, n long"
    others = others.toDF("slice", "places", "p1", "r1", "f1", "p2", "r2", "f2")
    return map_arrow(members, schema, pack).unionByName(map_arrow(others, schema, rest))


def by_first_place(record: np.ndarray, docs: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Order by keys, then by place: document order, then first window."""
    rank = np.empty(len(docs), np.int64)
    rank[np.lexsort((docs["row"], docs["tie"], docs["id"], 1 - docs["null"].astype(np.int8)))] = np.arange(len(docs))
    return np.lexsort((rank[record["doc"]] << 32 | record["first"], *reversed(keys)))


def resolve_bucket(numbers: list[int], docs: list[bytes], runs: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, bytes, bytes, int]]:
    """For each slice: the members of suffix arrays with their keys, the repeats, and the members' bytes.

    Of every string of a key with more than one place, the first place and one later place are members;
    further places repeat whatever that later place repeats, which is all of the string.
    """
    tables = [np.frombuffer(d, DOC) for d in docs]
    parts = [np.frombuffer(r, RUN).copy() for r in runs]
    shift = np.cumsum([0] + [len(t) for t in tables])
    for part, s in zip(parts, shift, strict=False):
        part["doc"] += np.uint32(s)
    record, table = np.concatenate(parts), np.concatenate(tables)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    _, back, n = np.unique(record["key"], return_inverse=True, return_counts=True)
    some = n[back] > 1
    record, source = record[some], source[some]
    order = by_first_place(record, table, record["key"], record["content"])
    record, source = record[order], source[order]
    if not len(record):
        return
    new = np.concatenate([[True], (record["key"][1:] != record["key"][:-1]) | (record["content"][1:] != record["content"][:-1])])
    rank = np.arange(len(record)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    place = np.empty(len(record), PLACE)
    place["row"], place["first"], place["count"] = table["row"][record["doc"]], record["first"], record["count"]
    by_source = np.argsort(source, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], source[by_source][1:] != source[by_source][:-1]]))
    for first, last in zip(edge, [*edge[1:], len(source)], strict=True):
        own = by_source[first:last]
        member, repeat = own[rank[own] < 2], own[rank[own] >= 2]
        yield numbers[source[own[0]]], place[member].tobytes() + record["key"][member].tobytes(), place[repeat].tobytes(), int(place["count"][member].sum() + len(member) * (length - 1))


#: One string of a suffix array: document in the table, first window, windows, bytes.
STRING = np.dtype([("doc", "<u4"), ("first", "<u4"), ("count", "u1"), ("size", "<u2")])


def strings_by_array(work: DataFrame, arrays: int, length: int) -> DataFrame:
    """array, slice, docs, strings, text: the members of a slice for each suffix array."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, rows, number, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not members:
                    continue
                texts = read_slice(path)
                table = doc_table(rows)
                table.sort(order="row")
                counts = [len(m) // (PLACE.itemsize + 8) for m in members]
                place = np.concatenate([np.frombuffer(m, PLACE, n) for m, n in zip(members, counts, strict=True)])
                key = np.concatenate([np.frombuffer(m, "<u8", n, n * PLACE.itemsize) for m, n in zip(members, counts, strict=True)])
                array = ((key >> U64(8)) % U64(arrays)).astype(np.int64)
                order = np.lexsort((place["first"], place["row"], array))
                place, array = place[order], array[order]
                edge = np.flatnonzero(np.concatenate([[True], array[1:] != array[:-1]]))
                out = []
                for a, b in zip(edge, [*edge[1:], len(array)], strict=True):
                    own = place[a:b]
                    strings = [texts[r][f : f + c + length - 1] for r, f, c in zip(own["row"].tolist(), own["first"].tolist(), own["count"].tolist(), strict=True)]
                    used, doc = np.unique(np.searchsorted(table["row"], own["row"]), return_inverse=True)
                    record = np.empty(len(own), STRING)
                    record["doc"], record["first"], record["count"] = doc, own["first"], own["count"]
                    record["size"] = list(map(len, strings))
                    out.append((int(array[a]), number, table[used].tobytes(), record.tobytes(), b"".join(strings)))
                for i in range(0, len(out), 256):
                    columns = list(zip(*out[i : i + 256], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])], ["array", "slice", "docs", "strings", "text"]
                    )

        return step

    return map_arrow(work, "array int, slice long, docs binary, strings binary, text binary", make)


def judge_array(numbers: list[int], docs: list[bytes], strings: list[bytes], texts: list[bytes], length: int) -> Iterator[tuple[int, bytes]]:
    """For each slice the windows that repeat an earlier one, by one suffix array."""
    tables = [np.frombuffer(d, DOC) for d in docs]
    parts = [np.frombuffer(x, STRING).copy() for x in strings]
    shift = np.cumsum([0] + [len(t) for t in tables])
    for part, s in zip(parts, shift, strict=False):
        part["doc"] += np.uint32(s)
    record, table = np.concatenate(parts), np.concatenate(tables)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    ends = np.cumsum(record["size"].astype(np.int64)).tolist()
    whole = b"".join(texts)
    own = [whole[e - n : e] for e, n in zip(ends, record["size"].tolist(), strict=True)]
    string, offset, classes = window_classes(own, record["count"].astype(np.int64), length)
    # place of every string in document order; a class keeps its first window
    d = table[record["doc"]]
    order = np.lexsort((d["row"], d["tie"], d["id"], 1 - d["null"].astype(np.int8)))
    same = np.concatenate([[True], (d["id"][order][1:] != d["id"][order][:-1]) | (d["tie"][order][1:] != d["tie"][order][:-1]) | (d["null"][order][1:] != d["null"][order][:-1])])
    doc_rank = np.empty(len(record), np.int64)
    doc_rank[order] = np.cumsum(same) - 1
    window = record["first"][string].astype(np.int64) + offset
    place = (doc_rank[string] << 32) | window
    earliest = np.full(int(classes[-1]) + 1 if len(classes) else 0, np.iinfo(np.int64).max)
    np.minimum.at(earliest, classes, place)
    repeats = place > earliest[classes]
    string, window = string[repeats], window[repeats]
    row, src = d["row"][string].astype(np.int64), source[string]
    order = np.lexsort((window, row, src))
    row, src, window = row[order], src[order], window[order]
    if not len(row):
        return
    edge = np.flatnonzero(np.concatenate([[True], (src[1:] != src[:-1]) | (row[1:] != row[:-1]) | (window[1:] > window[:-1] + 1) | (np.arange(1, len(row)) % 200 == 0)]))
    out = np.empty(len(edge), PLACE)
    last = np.concatenate([edge[1:], [len(row)]]) - 1
    out["row"], out["first"], out["count"] = row[edge], window[edge], window[last] - window[edge] + 1
    first_of = np.flatnonzero(np.concatenate([[True], src[edge][1:] != src[edge][:-1]]))
    for a, b in zip(first_of, [*first_of[1:], len(edge)], strict=True):
        yield numbers[src[edge[a]]], out[a:b].tobytes()


def mark(work: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of the texts in the slices, given their repeats."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, rows, repeats in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                texts = read_slice(path)
                place = np.concatenate([np.frombuffer(r, PLACE) for r in repeats]) if repeats else np.empty(0, PLACE)
                place = place[np.argsort(place["row"], kind="stable")]
                out = []
                for r in rows:
                    text = texts[r["row"]]
                    a, b = np.searchsorted(place["row"], [r["row"], r["row"] + 1])
                    spans, kept = 0, text
                    if b > a:
                        own = np.sort(place[a:b], order="first")
                        first = own["first"].astype(np.int64)
                        reach = np.maximum.accumulate(first + own["count"] + (length - 1))
                        edge = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
                        begin, stop = first[edge], reach[np.concatenate([edge[1:], [len(first)]]) - 1]
                        spans = len(edge)
                        kept = b"".join(text[x:y] for x, y in zip([0, *stop.tolist()], [*begin.tolist(), len(text)], strict=True))
                    out.append((r["doc_id"], len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        return step

    return map_arrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", make)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, slice_bytes: int = SLICE_BYTES, bucket_records: int = BUCKET_RECORDS, array_bytes: int = ARRAY_BYTES, hot: int = HOT, counters: int = COUNTERS, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes: one row for each input row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    rows = write_slices(docs, scratch.folder("slices"), scratch, slice_bytes).withColumn("tie", F.xxhash64("digest"))
    place = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "slice", "row")
    # only texts that occur more than once are joined, from a written table: a plain join, which can split hot digests
    best = scratch.table(rows.filter(F.col("n_bytes") >= length).groupBy("digest").agg(F.min(place).alias("best"), F.count("*").alias("n")).filter("n > 1").select("digest", "best.slice", "best.row").toDF("digest", "b_slice", "b_row"), "best")
    stands = F.col("b_slice").isNull() | ((F.col("b_slice") == F.col("slice")) & (F.col("b_row") == F.col("row")))
    told = scratch.table(rows.join(best, "digest", "left").select("slice", "path", "row", "doc_id", "n_bytes", "tie", stands.alias("stands")), "told")
    work = scratch.table(told.filter("stands").groupBy("slice").agg(F.first("path").alias("path"), F.collect_list(F.struct("row", "doc_id", "tie")).alias("rows"), F.sum("n_bytes").alias("n_bytes")), "work")
    sizes = work.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).first()
    copies = told.filter("NOT stands").select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"), F.lit(b"").alias("kept")
    )
    tasks = max(1, -(-sizes["n"] // max(2, sizes["n"] // 50_000)))
    dealt = work.select("path", "rows", "slice").repartition(tasks, "slice")
    found = hot_minimizers(dealt, scratch, length, gram, counters, hot)
    records = (sizes["b"] or 0) // ((length - gram + 2) // 2) + 1
    buckets = max(1, -(-records // bucket_records))

    def resolve(frame):
        import pandas as pd

        got = list(resolve_bucket(frame["slice"].tolist(), frame["docs"].tolist(), frame["runs"].tolist(), length))
        return pd.DataFrame(got, columns=["slice", "member", "repeat", "n"])

    # tasks of a fixed number of buckets, so that they grow in number with the data; by a hash of the bucket some would get many
    packed = runs_by_bucket(dealt, found, buckets, length, gram).repartitionById(-(-buckets // OF_TASK), F.col("bucket"))
    resolved = packed.groupBy("bucket").applyInPandas(resolve, "slice long, member binary, repeat binary, n long")
    if len(found):
        strings = scratch.table(hot_strings(dealt, found, length, gram), "hot")
        resolved = resolved.unionByName(resolve_hot(strings, scratch, length))
    resolved = scratch.table(resolved, "resolved")
    members = resolved.filter("n > 0").groupBy("slice").agg(F.collect_list("member").alias("members"), F.sum("n").alias("n"))
    arrays = max(1, -(-(resolved.agg(F.sum("n")).first()[0] or 0) // array_bytes))

    def judge(frame):
        import pandas as pd

        got = list(judge_array(frame["slice"].tolist(), frame["docs"].tolist(), frame["strings"].tolist(), frame["text"].tolist(), length))
        return pd.DataFrame(got, columns=["slice", "repeat"])

    asked = work.join(members.select("slice", "members"), "slice").select("path", "rows", "slice", "members").repartition(tasks, "slice")
    sorted_by = strings_by_array(asked, arrays, length).repartitionById(-(-arrays // OF_TASK), F.col("array"))
    judged = scratch.table(sorted_by.groupBy("array").applyInPandas(judge, "slice long, repeat binary"), "judged")
    repeats = resolved.filter(F.octet_length("repeat") > 0).select("slice", "repeat").unionByName(judged).groupBy("slice").agg(F.collect_list("repeat").alias("repeats"))
    final = work.join(repeats, "slice", "left").select("path", "rows", F.coalesce("repeats", F.array().cast("array<binary>")).alias("repeats"), "slice").repartition(tasks, "slice").drop("slice")
    out = mark(final, length).unionByName(copies)
    return scratch.own(out if with_text else out.drop("kept"))
