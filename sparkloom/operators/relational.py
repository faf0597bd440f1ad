"""Relational operators that compositions of built-ins do not name: as-of joins, range joins, salted aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str]) -> DataFrame:
    """Left rows with the latest right values at or before their time, per key: a union and one window, no theta join."""
    a = left.select("*", F.lit(1).alias("_side"), *[F.lit(None).cast(right.schema[v].dataType).alias(f"_{v}") for v in values])
    b = right.select(key, time, F.lit(0).alias("_side"), *[F.col(v).alias(f"_{v}") for v in values])
    w = Window.partitionBy(key).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True)
    for v in values:
        both = both.withColumn(v, F.last(f"_{v}", ignorenulls=True).over(w))
    return both.filter("_side = 1").select(*left.columns, *values)


def bucketed_asof_join(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str], bucket_rows: int = 100_000) -> DataFrame:
    """As ``asof_join``, but a key is as many tasks as it has rows for: the time between a key's first and last row is cut into buckets of
    equal width, about one for each ``bucket_rows`` rows. Within a bucket a window gives the latest right values; the values at a bucket's
    beginning are carried from bucket to bucket by a window over one row for each of them. Times are numbers, dates or timestamps; rows
    without a key or time match nothing. Many rows of one instant stay in one bucket.
    """
    instant = left.schema[time].dataType.simpleString()
    as_number = (lambda c: F.unix_micros(c.cast("timestamp"))) if instant.startswith(("timestamp", "date")) else (lambda c: c)
    kinds = {v: right.schema[v].dataType for v in values}
    a = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_v"))
    b = right.select(key, time, F.lit(0).alias("_side"), F.struct(*values).alias("_v"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_t", as_number(F.col(time)).cast("double"))
    spans = both.groupBy(key).agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"), F.ceil(F.count("*") / bucket_rows).alias("_n"))
    place = F.floor((F.col("_t") - F.col("_low")) * F.col("_n") / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)))
    # a plain join, so that Spark broadcasts the spans where they are few and splits a hot key where they are not
    placed = both.join(spans, key, "left").withColumn("_b", F.coalesce(F.least(place, F.col("_n") - 1), F.lit(0))).drop("_low", "_high", "_n")
    within = Window.partitionBy(key, "_b").orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    # as in one window over the key, each value is the last that is not null
    last = [F.max_by(F.col(f"_v.{v}"), F.when(F.col(f"_v.{v}").isNotNull(), F.struct(time))).alias(f"_c{i}") for i, v in enumerate(values)]
    ends = placed.groupBy(key, "_b").agg(*last)
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col(key).alias("_k"), F.col("_b").alias("_kb"), *[F.last(f"_c{i}", ignorenulls=True).over(before).alias(f"_c{i}") for i in range(len(values))])
    out = placed.withColumns({f"_w{i}": F.last(F.col(f"_v.{v}"), ignorenulls=True).over(within) for i, v in enumerate(values)}).filter("_side = 1")
    joined = out.join(carried, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_kb")), "left")
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    found = [F.when(known, F.coalesce(f"_w{i}", f"_c{i}")).cast(kinds[v]).alias(v) for i, v in enumerate(values)]
    return joined.select(*left.columns, *found)


def range_join(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: int) -> DataFrame:
    """Points with the ranges [low, high) that hold them: an equi-join on cells of ``width`` and a residual predicate."""
    cells = ranges.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))))
    return points.withColumn("_cell", F.floor(F.col(value) / width)).join(cells, "_cell").filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_cell")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, width: float, right_prefix: str = "right_") -> DataFrame:
    """Pairs of rows of equal keys whose intervals [start, end) share an instant: an equi-join on keys and cells of ``width``.

    Both sides name their columns alike; those of the right but the keys get a prefix. An interval lies in every cell that it
    touches, and a pair is made in the first cell that both touch, so no pair comes twice. Long intervals want wide cells. Empty intervals
    and nulls match nothing.
    """

    def celled(rows: DataFrame, name: str) -> DataFrame:
        some = rows.filter(F.col(start) < F.col(end))
        first, last = F.floor(F.col(start) / width), F.ceil(F.col(end) / width) - 1
        return some.withColumn(f"_first_{name}", first).withColumn("_cell", F.explode(F.sequence(first, last)))

    named = {c: f"{right_prefix}{c}" for c in right.columns if c not in keys}
    a, b = celled(left, "a"), celled(right, "b").withColumnsRenamed(named)
    pairs = a.join(b, [*keys, "_cell"]).filter(F.col("_cell") == F.greatest("_first_a", "_first_b"))
    meet = (F.col(start) < F.col(named[end])) & (F.col(named[start]) < F.col(end))
    return pairs.filter(meet).select(*left.columns, *named.values())


def salted_sum(rows: DataFrame, key: str, value: Column, salts: int = 16) -> DataFrame:
    """Sum and count by key in two steps, so that a hot key's rows are spread first."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts))
    part = rows.groupBy(key, salt.alias("_s")).agg(F.sum(value).alias("s"), F.count("*").alias("n"))
    return part.groupBy(key).agg(F.sum("s").alias("total"), F.sum("n").alias("n"))
