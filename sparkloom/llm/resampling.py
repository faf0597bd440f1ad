"""Importance resampling towards a target distribution over hashed word n-grams.

Features are all runs of 1 to ``most`` consecutive words joined by one space; the bucket of a feature is the CRC-32 of its bytes modulo
``buckets``. A document's weight is the floored mean of its features' gains, the log ratio of their buckets' shares in the target
and in all documents. A seeded Gumbel number is added to it, and the highest scores are drawn: sampling without replacement.

No n-gram is ever made. The CRC of a word is computed once, for all words of a batch together. A CRC is linear over GF(2):
crc(AB) = shift(crc(A), bytes of B) xor crc(B), where the shift by a length is a product of the matrices of its powers of two. So the CRC of
an n-gram follows from that of the run without its last word.

Scale: two narrow passes over the texts. The first returns at most ``buckets`` counts a task, which are summed before they are
shuffled; the second reads the table of gains, ``buckets`` numbers, and scores. Scores are whole thousandths, so their histogram has
at most some 100,000 values whatever the corpus (gains and Gumbel numbers are logarithms); the cut comes from it. Only drawn rows
are ordered, by ranges of score, id and a row number fixed in the written scores, so repeated or null ids meet in no task.

Defined edge cases: null and empty text has no words, no features and weight 0; a null id is hashed as an empty one and ordered before all
others; texts of any length are read whole; repeated rows are scored and ranked each; ties in score go to the smaller id, then weight and
number of features; an empty target gives gains of an empty table; other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, bounded_batches, map_arrow, slices
from sparkloom.ship import ship

MOST = 1
BUCKETS = 10_000
#: Documents with fewer words are scored but never drawn, and the share of the others that is drawn.
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Words of at most so many bytes are hashed together, byte by byte; longer ones one at a time.
TOGETHER = 48

#: Bytes of words: digits, lower-case letters and all bytes of characters beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: The CRC-32 of zlib, reflected.
_POLYNOMIAL = 0xEDB88320


# ---------------------------------------------------------------- the algebra of CRCs


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """The CRC register after one byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), out >> np.uint32(1)).astype(np.uint32)
    return out


def times(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Product over GF(2) of a 32 x 32 matrix, given as the images of all values of each of the four bytes, and CRCs."""
    v = vectors.astype(np.uint32)
    return matrix[0][v & 255] ^ matrix[1][v >> 8 & 255] ^ matrix[2][v >> 16 & 255] ^ matrix[3][v >> 24]


@lru_cache(maxsize=1)
def powers() -> list[np.ndarray]:
    """Matrices that shift a CRC by 1, 2, 4, ... zero bytes; each is the square of the one before."""
    values = np.arange(256, dtype=np.uint32)
    each = [values << np.uint32(8 * i) for i in range(4)]
    step = byte_table()
    out = [np.stack([(v >> np.uint32(8)) ^ step[v & 255] for v in each])]
    while len(out) < 31:
        out.append(np.stack([times(out[-1], row) for row in out[-1]]))
    return out


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs as if ``lengths`` bytes followed, before those bytes' own CRC is added."""
    out = crcs.astype(np.uint32)
    for bit in range(int(lengths.max(initial=0)).bit_length()):
        on = (lengths >> bit & 1).astype(bool)
        out[on] = times(powers()[bit], out[on])
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of words of a buffer. Short words advance together, a byte at a time, longest first so that the live ones lead."""
    out = np.zeros(len(start), np.uint32)
    for i in np.flatnonzero(length > TOGETHER).tolist():
        out[i] = zlib.crc32(data[start[i] : start[i] + length[i]])
    short = np.flatnonzero(length <= TOGETHER)
    short = short[np.argsort(-length[short], kind="stable")]
    at, size, table = start[short], length[short], byte_table()
    register = np.full(len(short), 0xFFFFFFFF, np.uint32)
    live = len(short)
    for depth in range(int(size[0]) if live else 0):
        live = int(np.searchsorted(-size, -depth, "left"))  # words longer than depth
        now = register[:live]
        register[:live] = table[(now ^ data[at[:live] + depth]) & 255] ^ (now >> np.uint32(8))
    out[short] = ~register
    return out


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts (binary, no nulls), where words begin, their lengths, and each text's first word (one more for the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[raw]
    inside = _IN_WORD[data]
    fresh = np.zeros(len(data) + 1, bool)  # a word never goes on into the next text
    fresh[offsets] = True
    begins = np.flatnonzero(inside & (fresh[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (fresh[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return data, begins, ends - begins, np.searchsorted(begins, offsets)


def feature_crcs(texts: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``most`` words: CRCs of all runs of all texts, and each text's first run (one more for the end)."""
    data, start, length, edges = words_of(texts)
    words = word_crcs(data, start, length)
    yield words, edges
    last = np.repeat(edges[1:], np.diff(edges))  # the end of the words of each word's text
    spaced = shifted(np.full(len(words), zlib.crc32(b" "), np.uint32), length) ^ words  # a space and the word
    runs, first = words, np.arange(len(words))
    for n in range(2, most + 1):
        goes_on = first + n - 1 < last[first]
        first, runs = first[goes_on], runs[goes_on]
        final = first + n - 1
        runs = shifted(runs, length[final] + 1) ^ spaced[final]
        yield runs, np.searchsorted(first, edges)


# ---------------------------------------------------------------- Spark


def bucket_counts(texts: DataFrame, most: int, buckets: int) -> DataFrame:
    """bucket, n of column ``text`` (binary): features of all rows."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in parts:
            for part in slices(batch, "text"):
                for crcs, _ in feature_crcs(pc.fill_null(part.column(0), b""), most):
                    total += np.bincount(crcs.astype(np.int64) % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    ship(texts.sparkSession)
    bounded_batches(texts.sparkSession)
    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Floored thousandths of the log ratio of every bucket's share, with one more feature in each."""
    s_all, t_all = sum(documents.values()) + buckets, sum(target.values()) + buckets
    return np.asarray([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * s_all / (float(documents.get(b, 0) + 1) * t_all))) for b in range(buckets)], np.int64)


def scores(docs: DataFrame, gain: np.ndarray, most: int, seed: str) -> DataFrame:
    """doc_id, n_words, n_features, weight, score: one row for each document."""
    buckets = len(gain)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text"):
                n = np.zeros(part.num_rows, np.int64)
                total, words = n.copy(), n
                for k, (crcs, edges) in enumerate(feature_crcs(pc.fill_null(part.column(1), b""), most)):
                    sums = np.concatenate([[0], np.cumsum(gain[crcs.astype(np.int64) % buckets])])
                    total += sums[edges[1:]] - sums[edges[:-1]]
                    n = n + np.diff(edges)
                    words = n if k == 0 else words
                weight = total // np.maximum(n, 1)
                noise = [math.floor(-1000 * math.log(-math.log((int(h, 16) + 0.5) / 4294967296))) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (words, n, weight, weight + np.asarray(noise, np.int64)))], ["doc_id", "n_words", "n_features", "weight", "score"])

        return step

    h = F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), F.lit(8))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), h.alias("h"))
    return map_arrow(source, "doc_id long, n_words long, n_features long, weight long, score long", make)


def ranked(rows: DataFrame, least: int, drawn: int, scratch: Scratch) -> DataFrame:
    """Rows of at least the score ``least`` with ``rank`` from 1, null beyond ``drawn``; ordered by ranges, without a window over all rows."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.desc("weight"), F.desc("n_features"), F.asc("row")]
    ranged = scratch.table(rows.filter(F.col("score") >= least).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    place = F.col("before") + within
    joined = ranged.join(sizes.select("part", before.alias("before")), "part").withColumn("rank", place)
    return joined.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))


def resample(docs: DataFrame, target: DataFrame, most: int = MOST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row for each document; those with a rank are drawn."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    binary = F.col("text").cast("binary").alias("text")
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(df.select(binary), most, buckets).collect()} for df in (docs, target)]
    scored = scores(docs, gains(*counts, buckets), most, seed).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.table(scored, "scores")
    open_ = F.col("n_words") >= least_words
    histogram = sorted(((r["score"], r["n"]) for r in rows.filter(open_).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in histogram) // 100
    least, so_far = None, 0
    for score, n in histogram if drawn else ():
        least, so_far = score, so_far + n
        if so_far >= drawn:
            break
    result = ["doc_id", "n_features", "weight", "score", "rank"]
    if least is None:
        return scratch.own(rows.withColumn("rank", F.lit(None).cast("long")).select(*result))
    chosen = ranked(rows.filter(open_), least, drawn, scratch)
    rest = rows.filter(~(open_ & (F.col("score") >= least))).withColumn("rank", F.lit(None).cast("long"))
    return scratch.own(chosen.select(*result).unionByName(rest.select(*result)))
