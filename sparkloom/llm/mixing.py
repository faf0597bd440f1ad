"""Mixing sources to target weights by subset-sum budget fitting.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the sum of all sizes. A target
stops at ``most`` times its source's size; the excess is shared again by weight until none is above.
Within a source every document is taken ``target // source size`` times; the rest of the budget is
a subset sum over exact lengths: an even share of each length first, then the largest lengths
that fit, then bounded-knapsack dynamic programming (bit sets) over what is left of the budget. Where no subset
comes to the target, further copies may, up to ``most``. The chosen count of each length is filled
with documents by seeded hash.

Scale: the text is read once into a narrow table. Rows equal in id, source and text are counted before the shuffle and are one row
until the result, so neither repeated rows nor rows without an id meet in a task. Sources are weighed and filled in Spark. Each
source's histogram is bounded by its distinct lengths, never by documents. Picking k documents of one length works on ``BUCKETS`` hash
buckets per (source, length): only whole buckets, and one boundary bucket that is ranked, are needed, so
a source or a length with a third of all rows never meets in one task. The dynamic programme holds
at most ``DP_BUDGET`` bits for each step that extends its sums, and at most ``DP_BUDGET`` such steps (8 KB each).

Defined edge cases: null text and empty text have size 0 and are taken 0 times; a null source is a
source of its own; repeated rows count each, and of rows equal in id and text any may be the one taken once more; ties in
length are broken by a seeded hash of id and text; a text is counted whole; extra columns are ignored by ``mix`` and preserved by
``materialised_mix``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, map_arrow, placed, private, slices, text_of

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20240607
BUCKETS = 1024
#: Repeats of one row that a task writes at once.
BLOCK = 4096
#: Cells of the dynamic programme: the part of a budget that it fits exactly.
DP_BUDGET = 1 << 16


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Target words of each source, by water filling."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def fit_budget(sizes: list[int], counts: list[int], budget: int, cells: int = DP_BUDGET) -> list[int]:
    """How many documents of each size to take, so that their sum comes as near below ``budget`` as can be found.

    An even share of every size is taken first (so the choice is not biased to long documents), less
    a margin that leaves the last ``cells`` words to the dynamic programme.
    """
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    if budget <= 0 or total <= 0:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    share = max(0.0, (budget - cells / 2) / total)
    take = [min(c, math.floor(c * share)) for c in counts]
    left = budget - sum(s * t for s, t in zip(sizes, take, strict=True))
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if left <= cells:
            break
        more = min(counts[i] - take[i], max(0, (left - cells // 2) // max(1, sizes[i])))
        take[i] += more
        left -= more * sizes[i]
    # only documents too large for what is above the cells are left to take now: the largest that fits, until none does
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        while left > cells and take[i] < counts[i] and 0 < sizes[i] <= left:
            take[i] += 1
            left -= sizes[i]
    left = min(left, cells, sum(s * (c - t) for s, c, t in zip(sizes, counts, take, strict=True)))
    mask = (1 << (left + 1)) - 1
    reach, steps = 1, []
    for i, s in enumerate(sizes):  # bounded knapsack: each count as powers of two and a rest
        spare, chunk = (min(counts[i] - take[i], left // s) if s else 0), 1
        while spare > 0 and not reach >> left & 1:
            n = min(chunk, spare)
            grown = (reach | reach << (n * s)) & mask
            if grown != reach:
                steps.append((i, n, reach))
                reach = grown
            spare, chunk = spare - n, chunk * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * sizes[i]
    return take


def fit_copies(sizes: list[int], counts: list[int], target: float, most: int = MOST, cells: int = DP_BUDGET) -> list[int]:
    """How many copies of each size to take in all, at most ``most`` of every document.

    Every document as often as the target holds the source, then a subset once more; further copies only where no
    subset comes to the target, and one document beyond it only if that is nearer.
    """
    words = sum(s * c for s, c in zip(sizes, counts, strict=True))
    if not words:
        return [0] * len(sizes)
    base = min(most, int(target // words))
    total, left = [c * base for c in counts], round(target) - base * words
    for spare in (1, most - base - 1):
        if base < most and spare > 0 and left > 0:
            more = fit_budget(sizes, [c * spare for c in counts], left, cells)
            total = [t + m for t, m in zip(total, more, strict=True)]
            left -= sum(s * m for s, m in zip(sizes, more, strict=True))
    over = [i for i, s in enumerate(sizes) if left < s < 2 * left and total[i] < most * counts[i]]
    if over:
        total[min(over, key=lambda i: sizes[i])] += 1
    return total


def sized(docs: DataFrame, seed: int = SEED, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, key (of the source, never null), size, mark (hash of the text), bucket, rank hash h (of id and text), and
    ``carried`` columns (long); the text is read once."""
    import pyarrow as pa

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text"):
                words = [len(x.split()) if x else 0 for x in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(words, pa.int64()), *part.columns[4:]], ["doc_id", "source", "mark", "size", *carried])

        return step

    source = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64(text_of()).alias("mark"), F.col("text").cast("binary").alias("text"), *carried)
    counted = map_arrow(source, "doc_id long, source string, mark long, size long" + "".join(f", {c} long" for c in carried), make)
    h = F.xxhash64(F.lit(seed), "doc_id", "mark")
    return counted.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"),
        "size",
        "mark",
        F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"),
        h.alias("h"),
        *carried,
    )


def numbered(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``place`` from 0 in code-point order, null last, without a window over all sources."""
    order = [F.col("key") == "n", F.col("key")]
    ranged = scratch.table(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.join(sizes.select("part", before.alias("before")), "part").withColumn("place", F.col("before") + within - 1).drop("part", "before")


def source_targets(words: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """key, source_size, target of rows key, words: the water filling of ``targets``, a pass over the sources each round.

    Sources may be as many as there are web domains, so none of this is collected but the sums of a round.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    all_ = scratch.table(numbered(words, scratch).select("key", "words", weight.cast("long").alias("weight")), "weights")
    everything = all_.agg(F.sum("words")).first()[0] or 0
    full_at: list[Column] = []  # a source is full if a round has found it so; each round is a level of words a weight

    def is_full() -> Column:
        out = F.lit(False)
        for level in full_at:
            out = out | level
        return out

    while True:
        sums = all_.agg(F.sum(F.when(is_full(), F.col("words") * most)).alias("gone"), F.sum(F.when(~is_full(), F.col("weight"))).alias("weight"), F.count_if(is_full()).alias("n")).first()
        left, total = float(everything - (sums["gone"] or 0)), sums["weight"]
        if not total:
            break
        own = F.lit(left) * F.col("weight") / F.lit(total)
        above = own > F.col("words") * most
        if not all_.filter(~is_full() & above).limit(1).count():
            break
        full_at.append(above)
    share = (F.col("words") * most).cast("double")
    if total:
        share = F.when(is_full(), share).otherwise(own)
    return scratch.table(all_.select("key", F.col("words").alias("source_size"), share.alias("target")), "targets")


def chosen(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...], most: int, seed: int, cells: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, n (rows), base (copies of each row), extra (rows that have one copy more), and
    ``carried`` columns of one of the rows: a row for all rows of one id, source and text."""
    rows = sized(docs, seed, carried)
    # equal rows are one from here on, so that they never meet
    equal = rows.groupBy("doc_id", "source", "key", "size", "mark", "bucket", "h").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in carried])
    equal = scratch.table(equal, "sizes")
    cells_of = scratch.table(equal.groupBy("key", "size", "bucket").agg(F.sum("n").alias("count")), "cells")
    goals = source_targets(cells_of.groupBy("key").agg(F.sum(F.col("size") * F.col("count")).alias("words")), scratch, weights, most)

    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for key, hist, words, target in zip(part["key"], part["hist"], part["source_size"], part["target"], strict=True):
                pairs = sorted((int(h["size"]), int(h["n"])) for h in hist)
                sizes, counts = [p[0] for p in pairs], [p[1] for p in pairs]
                total = fit_copies(sizes, counts, float(target), most, cells)
                yield pd.DataFrame(
                    {"key": key, "size": sizes, "source_size": words, "target": target, "base": [t // c for t, c in zip(total, counts, strict=True)], "extra": [t % c for t, c in zip(total, counts, strict=True)]}
                )

    hist = cells_of.groupBy("key", "size").agg(F.sum("count").alias("n")).groupBy("key").agg(F.collect_list(F.struct("size", "n")).alias("hist"))
    fitted = hist.join(goals, "key").mapInPandas(fit, "key string, size long, source_size long, target double, base long, extra long")
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = scratch.table(
        cells_of.join(fitted, ["key", "size"])
        .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select("key", "size", "bucket", "source_size", "target", "base", "count", F.greatest(F.lit(0), F.least("count", F.col("extra") - F.col("before"))).alias("more")),
        "plan",
    )
    # whole and empty buckets need no rank; at most one bucket of a source and size is cut
    joined = equal.join(plan, ["key", "size", "bucket"])
    cut = (F.col("more") > 0) & (F.col("more") < F.col("count")) & (F.col("size") > 0)
    above = F.coalesce(F.sum("n").over(Window.partitionBy("key", "size", "bucket").orderBy("h", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = joined.filter(~cut).withColumn("extra", F.when(F.col("more") > 0, F.col("n")).otherwise(0))
    some = joined.filter(cut).withColumn("extra", F.greatest(F.lit(0), F.least("n", F.col("more") - above)))
    out = whole.unionByName(some)
    none = F.col("size") == 0
    return out.select("doc_id", "source", "size", "source_size", "target", "n", F.when(none, 0).otherwise(F.col("base")).alias("base"), F.when(none, 0).otherwise(F.col("extra")).alias("extra"), *carried)


def repeated(rows: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times (not at all for 0). Many repeats of a row are dealt out in blocks of ``BLOCK``."""
    *plain, times_, block, nth = [*rows.columns, *private(rows.columns, "_t", "_b", "_j")]
    own = rows.withColumn(times_, times.cast("long")).filter(F.col(times_) > 0)
    blocks = own.filter(F.col(times_) > BLOCK).withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times_) - 1, F.lit(BLOCK).cast("long"))))
    blocks = blocks.withColumn(times_, F.least(F.lit(BLOCK).cast("long"), F.col(times_) - F.col(block))).drop(block).repartition(F.rand(1))
    both = own.filter(F.col(times_) <= BLOCK).unionByName(blocks)
    return both.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times_)))).select(*[F.col(f"`{c}`") for c in plain])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, cells: int = DP_BUDGET) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words), copies: one row for each input row."""
    scratch = Scratch(docs.sparkSession, "mix")
    picked = chosen(docs, scratch, weights, most, seed, cells)
    own = picked.withColumn("copies", F.explode(F.array(F.struct(F.col("extra").alias("n"), (F.col("base") + 1).alias("c")), F.struct((F.col("n") - F.col("extra")).alias("n"), F.col("base").alias("c")))))
    own = own.select("doc_id", "source", "size", "source_size", "target", (F.col("copies.c") * F.col("size")).alias("taken"), F.col("copies.c").cast("int").alias("copies"), F.col("copies.n").alias("n"))
    return scratch.own(repeated(own, F.col("n")).drop("n"))


def materialised_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, cells: int = DP_BUDGET) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it. Of rows equal in id, source and text one stands for the copies of
    all, with its other columns. It is told by its place in the input, so no id, source or size gathers rows."""
    scratch = Scratch(docs.sparkSession, "mixed")
    file, index, copies = private(docs.columns, "_f", "_i", "_n")
    own = placed(docs, scratch, file, index)
    picked = chosen(own, scratch, weights, most, seed, cells, (file, index))
    total = (F.col("base") * F.col("n") + F.col("extra")).alias(copies)
    joined = own.join(picked.select(file, index, total).filter(F.col(copies) > 0), [file, index])
    return scratch.own(repeated(joined, F.col(copies)).select(*[F.col(f"`{c}`") for c in docs.columns]))
