"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

1. Every text is normalised (ASCII white space removed) and digested with SHA-256 into a narrow table.
2. A Misra-Gries summary (Spark's ``approx_top_k``: mergeable, ``tracked`` counters per task) proposes
   frequent digests. Its guarantee: a digest with more than 2/tracked of the rows is among them.
3. One exact count verifies the proposals. Winners are at most ``tracked`` rows, so broadcasting
   them is bounded by a parameter, and their rows never meet in one task: the survivor and size of a
   winning group come from a partial aggregate, and its members are resolved by a map-side join.
4. All other digests use one ordinary shuffle and a window; those groups are small by construction.

Defined edge cases: a null text is an empty text (all empty texts are equal); a null ``doc_id``
sorts before others; of fully equal rows (same id, same text) exactly one is kept; an empty table
gives an empty result; extra columns of any name are ignored by ``duplicates`` and preserved by ``deduplicate``; texts of
any length are digested whole, one row at a time; of copies with equally many code points the smallest ``doc_id`` stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import WS, Scratch, placed, private, text_of

TRACKED = 8192
HEAVY_ROWS = 64
#: Groups of tasks whose sketches are combined first.
COMBINED = 256


def digest_columns(column: str = "text"):
    text = text_of(column)
    return F.sha2(F.regexp_replace(text, WS, ""), 256), F.length(text).cast("long")


def heavy_groups(rows: DataFrame, key: str, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Digests that hold at least ``heavy_rows`` rows and 2/tracked of all, with exact counts. At most ``tracked`` rows."""
    # one sketch a task (grouped, since the sketch functions have no answer for no rows); groups of tasks are combined before all are, so that no task takes in every sketch
    parts = rows.select(key, F.pmod(F.spark_partition_id(), F.lit(COMBINED)).alias("_part"))
    sketches = parts.groupBy("_part").agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("s"), F.count("*").alias("n"))
    whole = sketches.groupBy(F.lit(0).alias("_whole")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {tracked // 2})").alias("top"), F.sum("n").alias("all_rows"))
    proposed = whole.select("all_rows", F.explode("top").alias("t")).select(F.col("t.item").alias(key), "all_rows")
    return (
        rows.join(F.broadcast(proposed), key)
        .groupBy(key)
        .agg(
            F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").alias("d"), F.col("rid").alias("r"))).alias("best"),
            F.count("*").alias("group_size"),
            F.first("all_rows").alias("all_rows"),
        )
        .filter((F.col("group_size") >= heavy_rows) & (F.col("group_size") * (tracked // 2) > F.col("all_rows")))
        .select(key, "best", "group_size")
    )


def _digests(docs: DataFrame, scratch: Scratch, *more) -> DataFrame:
    """doc_id, text_sha256, n_points, rid and more columns, written: rids tell rows apart from here on."""
    digest, points = digest_columns()
    return scratch.table(docs.select("doc_id", digest.alias("text_sha256"), points.alias("n_points"), F.monotonically_increasing_id().alias("rid"), *more), "digests")


def _resolved(rows: DataFrame, scratch: Scratch, tracked: int, heavy_rows: int, *more: str) -> DataFrame:
    heavy = scratch.table(heavy_groups(rows, "text_sha256", tracked, heavy_rows).coalesce(1), "heavy")
    marked = rows.join(F.broadcast(heavy), "text_sha256", "left")
    light = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    order = Window.partitionBy("text_sha256").orderBy(F.col("n_points").desc(), F.col("doc_id").asc_nulls_first(), "rid")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_heavy = marked.filter(F.col("group_size").isNotNull()).select(
        "doc_id", F.col("best.d").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.r")).alias("kept"), "text_sha256", "n_points", *more
    )
    of_light = light.select(
        "doc_id",
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
        "text_sha256",
        "n_points",
        *more,
    )
    return of_light.unionByName(of_heavy)


def duplicates(docs: DataFrame, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_points: one row for each input row."""
    scratch = Scratch(docs.sparkSession, "exact")
    return scratch.own(_resolved(_digests(docs, scratch), scratch, tracked, heavy_rows))


def deduplicate(docs: DataFrame, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The rows that stay, with all their columns: one of each group of equal normalised texts.

    Rows are told apart by their place in the input, which no two share, so repeated or null ids meet in no task."""
    scratch = Scratch(docs.sparkSession, "exact-rows")
    file, index = private(docs.columns, "_f", "_i")
    own = placed(docs, scratch, file, index)
    rows = _digests(own, scratch, file, index)
    kept = _resolved(rows, scratch, tracked, heavy_rows, file, index).filter("kept").select(file, index)
    return scratch.own(own.join(kept, [file, index]).select(*[F.col(f"`{c}`") for c in docs.columns]))
