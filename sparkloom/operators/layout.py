"""Layout boxes of pages: filters, reading order, captions, numbering.

A box row has doc, page, pos (its place in the input), label, text and coordinate [x0, y0, x1, y1].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.geometry import box_distance, box_height, box_width
from sparkloom.functions.text import starts_numbered, strip

# Labels of a layout model, and which are read by default.
TEXT_LABELS = ("paragraph_title", "text", "content", "doc_title", "reference", "reference_content", "aside_text", "footer")
TARGET_LABELS = ("image", "chart")
TITLE_LABELS = ("figure_title",)
SAME_BLOCK = (("paragraph_title", "text"),)
X_NEAR, Y_NEAR, GAP = 100.0, 250.0, 50.0
CAPTION_REACH = 50.0

BOX = "array<struct<label:string,text:string,coordinate:array<double>>>"


def normalised_pages(pages: DataFrame) -> DataFrame:
    """Pages with either ``boxes`` or ``shapes`` (points) to one row per box, with pos."""
    shapes = F.transform("shapes", lambda s: F.struct(s["label"].alias("label"), s["text"].alias("text"), s["points"].alias("coordinate")))
    boxes = F.coalesce(F.col("boxes").cast(BOX), shapes.cast(BOX))
    return pages.select("input_path", "page_index", F.posexplode(boxes).alias("pos", "b")).select("input_path", "page_index", "pos", "b.label", "b.text", "b.coordinate")


def label_filter(boxes: DataFrame, include: tuple[str, ...] = TEXT_LABELS, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Boxes whose label is included (an empty list includes all) and not excluded."""
    keep = F.lit(True) if not include else F.col("label").isin(*include)
    return boxes.filter(keep & ~F.col("label").isin(*exclude)) if exclude else boxes.filter(keep)


def target_filter(boxes: DataFrame, targets: tuple[str, ...] = TARGET_LABELS) -> DataFrame:
    return boxes.filter(F.col("label").isin(*targets))


def min_size_filter(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """Drops a box only if both sides are too small."""
    c = F.col("coordinate")
    return boxes.filter(~((box_width(c) < width) & (box_height(c) < height)))


def max_size_filter(boxes: DataFrame, width: float = 800, height: float = 850) -> DataFrame:
    """Drops a box if either side is too large."""
    c = F.col("coordinate")
    return boxes.filter((box_width(c) <= width) & (box_height(c) <= height))


def with_thresholds(detections: DataFrame, classes: DataFrame) -> DataFrame:
    """Detections at or above the threshold of their class, with its name. Spark broadcasts the class list where it is small."""
    return detections.join(classes, "class_id").filter(F.col("score") >= F.col("threshold"))


def column_leaders(x: Column, near: float = X_NEAR) -> Column:
    """Leader clustering of an array: a value joins the first cluster whose first value is nearer than ``near``. Cluster of each value."""
    state = "struct<leaders:array<double>,out:array<int>>"

    def join(acc: Column, value: Column) -> Column:
        # numbers of the leaders in reach; null for the others, which array_min skips
        hit = F.array_min(F.transform(acc["leaders"], lambda first, i: F.when(F.abs(value - first) < near, i)))
        leaders = F.when(hit.isNull(), F.concat(acc["leaders"], F.array(value))).otherwise(acc["leaders"])
        return F.struct(leaders.alias("leaders"), F.concat(acc["out"], F.array(F.coalesce(hit, F.size(acc["leaders"])))).alias("out")).cast(state)

    start = F.struct(F.array().cast("array<double>").alias("leaders"), F.array().cast("array<int>").alias("out")).cast(state)
    return F.aggregate(x, start, join)["out"]


def with_columns_of_page(boxes: DataFrame) -> DataFrame:
    """Adds ``x_group``. The clusters depend on input order, so a page is folded as one array (bounded by its boxes)."""
    rest = [c for c in boxes.columns if c not in ("doc", "page", "pos")]
    pages = boxes.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("_b"))
    groups = column_leaders(F.transform("_b", lambda b: b["coordinate"][0].cast("double")))
    rows = pages.select("doc", "page", F.explode(F.arrays_zip(F.col("_b").alias("b"), groups.alias("g"))).alias("_r"))
    return rows.select("doc", "page", "_r.b.*", F.col("_r.g").alias("x_group"))


def block_order(boxes: DataFrame) -> DataFrame:
    """Adds ``block_id`` and ``rank``: columns by x, blocks by gaps, labels and numbering, then block and y order."""
    clustered = with_columns_of_page(boxes)
    c = F.col("coordinate")
    down = Window.partitionBy("doc", "page", "x_group").orderBy(c[1], "pos")
    above, label_above = F.lag(c).over(down), F.lag("label").over(down)
    far = F.abs(c[1] - above[1]) >= Y_NEAR
    special = F.lit(False)
    for first, second in SAME_BLOCK:
        special = special | ((label_above == first) & (F.col("label") == second))
    gap = c[1] - above[3] > GAP
    changed = ~F.col("label").eqNullSafe(label_above) & ~F.coalesce(special, F.lit(False))
    fresh = above.isNotNull() & far & (gap | changed | starts_numbered(F.coalesce("text", F.lit(""))))
    marked = clustered.withColumn("_new", fresh.cast("int")).withColumn("_n", F.row_number().over(down))
    # a new column starts a block as well; columns follow in order of their first box
    starts = F.sum(F.when(F.col("_n") == 1, 1).otherwise(F.col("_new"))).over(Window.partitionBy("doc", "page").orderBy("x_group", c[1], "pos").rowsBetween(Window.unboundedPreceding, 0))
    out = marked.withColumn("block_id", (starts - 1).cast("int"))
    rank = F.row_number().over(Window.partitionBy("doc", "page").orderBy("block_id", c[1], "pos"))
    return out.withColumn("rank", rank).drop("_new", "_n", "x_group")


def first_per_block(boxes: DataFrame) -> DataFrame:
    """The first of equal stripped texts of a block stays; empty texts and footers go."""
    clean = boxes.withColumn("text", strip(F.coalesce("text", F.lit("")))).filter("text <> '' AND label <> 'footer'")
    first = F.row_number().over(Window.partitionBy("doc", "page", "block_id", "text").orderBy("pos"))
    return clean.withColumn("_r", first).filter("_r = 1").drop("_r")


def long_pages(boxes: DataFrame, least: int = 50) -> DataFrame:
    """Boxes of pages whose non-empty texts, one space each, come to ``least`` characters; footers and repeats count."""
    text = strip(F.coalesce("text", F.lit("")))
    total = F.sum(F.when(text != "", F.length(text) + 1).otherwise(0)).over(Window.partitionBy("doc", "page"))
    return boxes.withColumn("_t", total).filter(F.col("_t") >= least).drop("_t")


def footer_text(boxes: DataFrame) -> DataFrame:
    """doc, page, footer: the first footer's text."""
    return boxes.filter("label = 'footer'").groupBy("doc", "page").agg(F.min_by("text", "pos").alias("footer"))


def nearest_title(boxes: DataFrame, targets: tuple[str, ...] = TARGET_LABELS, titles: tuple[str, ...] = TITLE_LABELS, reach: float = CAPTION_REACH) -> DataFrame:
    """Every target box with the text of the nearest title on its page within ``reach``; the later of equals; null if none.

    An equi-join on the page with a residual predicate, so it is a hash or merge join, never a product.
    """
    figure = boxes.filter(F.col("label").isin(*targets)).select("doc", "page", "pos", "label", "coordinate")
    title = boxes.filter(F.col("label").isin(*titles)).select("doc", "page", F.col("pos").alias("t_pos"), F.col("text").alias("t_text"), F.col("coordinate").alias("t_box"))
    pairs = figure.join(title, ["doc", "page"], "left").withColumn("d", box_distance(F.col("coordinate"), F.col("t_box")))
    within = F.col("t_pos").isNotNull() & (F.col("d") <= reach)  # greatest() skips nulls, so a missing title has distance 0
    near = F.when(within, F.struct(F.col("d"), (-F.col("t_pos")).alias("p")))
    return pairs.groupBy("doc", "page", "pos", "label").agg(F.min_by("t_text", near).alias("subtitle"), F.min(F.when(within, F.col("d"))).alias("distance"))


def has_title(boxes: DataFrame, **options) -> DataFrame:
    """``found`` or ``none`` for every target box."""
    return nearest_title(boxes, **options).withColumn("flag", F.when(F.col("distance").isNotNull(), "found").otherwise("none")).select("doc", "page", "pos", "label", "flag")


def running_index(boxes: DataFrame, *keys: str, order: str = "pos") -> DataFrame:
    """``index`` from 1 within the keys of a page."""
    return boxes.withColumn("index", F.row_number().over(Window.partitionBy("doc", "page", *keys).orderBy(order)))


def global_number(rows: DataFrame, order: list[str], partition: str, wide: int = 4096) -> DataFrame:
    """``number`` from 1 over all rows in order, without a window that holds them all: sizes of the partitions first, then
    their running offsets in two levels, then numbers within. ``partition`` is a whole number that grows with the leading
    key; ``order`` continues after it. The window without keys sees one row for ``wide`` partitions."""
    sizes = rows.groupBy(partition).count().withColumn("_w", F.floor(F.col(partition) / wide))
    wides = sizes.groupBy("_w").agg(F.sum("count").alias("_c"))
    wides = wides.select("_w", F.coalesce(F.sum("_c").over(Window.orderBy("_w").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inner = F.coalesce(F.sum("count").over(Window.partitionBy("_w").orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("_in", inner).join(wides, "_w").select(partition, (F.col("_off") + F.col("_in")).alias("_off"))
    within = F.row_number().over(Window.partitionBy(partition).orderBy(*order))
    return rows.join(offsets, partition).withColumn("number", F.col("_off") + within).drop("_off")


def last_write_wins(rows: DataFrame, name: str, order: str) -> DataFrame:
    """The row of largest ``order`` for every name."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(name).agg(F.max_by(whole, order).alias("w")).select("w.*")


def complete_documents(expected: DataFrame, present: DataFrame) -> DataFrame:
    """doc, complete: whether every label of a document has at least its expected number of files."""
    joined = expected.groupBy("doc", "label").agg(F.count("*").alias("need")).join(present.groupBy("doc", "label").agg(F.count("*").alias("have")), ["doc", "label"], "left")
    return joined.groupBy("doc").agg(F.every(F.coalesce("have", F.lit(0)) >= F.col("need")).alias("complete"))


def label_counts(boxes: DataFrame, targets: tuple[str, ...] = TARGET_LABELS) -> DataFrame:
    """doc and one zero-filled count per target label."""
    return boxes.groupBy("doc").agg(*[F.count_if(F.col("label") == t).alias(f"n_{t}") for t in targets])


def size_of(coordinate: Column) -> Column:
    return F.struct(box_width(coordinate).alias("width"), box_height(coordinate).alias("height"))
