"""Patterns that are rows of a table, searched in the texts of another, for any number of them.

Up to ``LISTED`` characters they are a list that every worker searches with one automaton. Beyond that no list exists: a filter of bounded size
names the candidates of each text, and an equi-join with the patterns decides. Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import patterns as A

#: Characters of the patterns of a list; an automaton takes some 40 bytes for each.
LISTED = 1 << 20


def _candidates(text: str, patterns: DataFrame, n: int, lengths: list[int]) -> Column:
    """The candidates of a text for ``n`` patterns. The filter is put together by Spark in parts of 4 KB."""
    log_bits = min(max((n * A.FILTER_BITS).bit_length(), A.LEAST_BITS), A.MOST_BITS)
    places = F.explode(A.filter_bits(F.col("pattern"), log_bits)).alias("place")
    parts = patterns.select(places).withColumn("place", F.col("place") + 1).groupBy(F.bitmap_bucket_number("place").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bits = bytearray((1 << log_bits) // 8)
    for k, part in parts.collect():  # parts count from 1
        bits[(k - 1) * len(part) : k * len(part)] = part
    return A.candidates(F.col(text), lengths, bytes(bits))


def _extent(patterns: DataFrame) -> tuple[int, int, list[int]]:
    """The number of patterns, their characters and their different lengths."""
    n = F.length("pattern")
    return tuple(patterns.agg(F.count("*"), F.coalesce(F.sum(n), F.lit(0)), F.collect_set(n)).first())


def first_stop(rows: DataFrame, text: str, stops: DataFrame, listed: int = LISTED) -> DataFrame:
    """The rows without their text, with ``stop``, the stop string of least rank that occurs in the text, and ``at``, the characters before it; both
    null where none occurs. ``stops`` are rows (pattern, rank): a pattern has its least rank, of equal ranks the lesser pattern stands, empty patterns
    and those without rank do not count. Rows are told apart by their place, so they are to be read in a fixed order, as from files.
    """
    others = [c for c in rows.columns if c != text]
    ranked = stops.filter("length(pattern) > 0 AND rank IS NOT NULL").groupBy("pattern").agg(F.min("rank").alias("rank"))
    n, characters, lengths = _extent(ranked)
    if characters <= listed:
        found = A.stop_at_any(F.col(text), [r["pattern"] for r in ranked.orderBy("rank", "pattern").collect()])
        out = rows.select(*others, found.alias("_r"))
        return out.select(*others, "_r.stop", F.when(F.col("_r.stop").isNotNull(), F.length("_r.text")).alias("at"))
    placed = rows.select(*others, F.monotonically_increasing_id().alias("_row"), _candidates(text, ranked, n, lengths).alias("_all"))
    flat = placed.select(*others, "_row", F.explode_outer("_all").alias("_c"))
    # rows without candidates meet no stop string, and their own number spreads them over the tasks
    keyed = flat.withColumn("_key", F.when(F.col("_c").isNull(), F.col("_row")).otherwise(F.xxhash64("_c.pattern")))
    known = ranked.select(F.xxhash64("pattern").alias("_hash"), F.col("pattern").alias("_stop"), F.col("rank").alias("_rank"))
    joined = keyed.join(known, (F.col("_key") == F.col("_hash")) & (F.col("_c.pattern") == F.col("_stop")), "left")
    best = F.min(F.when(F.col("_stop").isNotNull(), F.struct("_rank", "_stop", "_c.at"))).alias("_best")
    out = joined.groupBy("_row").agg(*[F.first(c).alias(c) for c in others], best)
    return out.select(*others, F.col("_best._stop").alias("stop"), F.col("_best.at").alias("at"))


def texts_with(rows: DataFrame, text: str, patterns: DataFrame, listed: int = LISTED) -> DataFrame:
    """pattern, texts: the patterns that occur, each with the number of rows whose text holds it. ``patterns`` are rows (pattern); empty ones do not count."""
    distinct = patterns.select("pattern").filter("length(pattern) > 0").distinct()
    n, characters, lengths = _extent(distinct)
    if characters <= listed:
        found = F.map_keys(A.occurrences(F.col(text), [r["pattern"] for r in distinct.collect()]))
        return rows.select(F.explode(found).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("texts"))
    found = rows.select(F.explode(_candidates(text, distinct, n, lengths)).alias("_c"))
    return found.groupBy(F.col("_c.pattern").alias("pattern")).agg(F.count("*").alias("texts")).join(distinct, "pattern", "left_semi")
