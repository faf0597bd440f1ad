"""Documents and pages: grouping, page filters, markdown, chunks, metadata, routing, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions.repetition import collapsed_if_long
from sparkloom.operators import layout

# Suffixes and media types of the router.
PDF = (".pdf",)
IMAGE = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".webp")
AUDIO = (".mp3", ".wav", ".flac", ".aac", ".ogg", ".m4a", ".wma", ".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".webm")


def route(extension: Column, mime: Column) -> Column:
    """pdf, image, audio or unsupported: by suffix first, then by media type."""
    ext, mime = F.lower(extension), F.coalesce(mime, F.lit(""))
    return (
        F.when(ext.isin(*PDF) | (mime == "application/pdf"), "pdf")
        .when(ext.isin(*IMAGE) | mime.startswith("image/"), "image")
        .when(ext.isin(*AUDIO) | mime.startswith("audio/") | mime.startswith("video/"), "audio")
        .otherwise("unsupported")
    )


def run_statistics(rows: DataFrame, kind: str = "kind", failed: str = "failed") -> DataFrame:
    """total, pdf, image, audio, other, failed in one row."""
    k = F.col(kind)
    return rows.agg(
        F.count("*").alias("total"), *[F.count_if(k == x).alias(x) for x in ("pdf", "image", "audio")], F.count_if(~k.isin("pdf", "image", "audio")).alias("other"), F.count_if(failed).alias("failed")
    )


def collected(rows: DataFrame, key: str | list[str], order: list[str], value: str, name: str = "values") -> DataFrame:
    """key, values in order."""
    keys = [key] if isinstance(key, str) else key
    pairs = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    return rows.groupBy(*keys).agg(F.transform(pairs, lambda p: p["_value"]).alias(name))


def joined_text(rows: DataFrame, key: str | list[str], order: list[str], value: str, separator: str, name: str = "text") -> DataFrame:
    """key, text: the values in order with a separator between."""
    out = collected(rows, key, order, value, "_values")
    return out.withColumn(name, F.array_join("_values", separator)).drop("_values")


def valid_pages(rows: DataFrame, page: str = "page_num") -> DataFrame:
    """Rows whose page is a positive number written in digits."""
    return rows.filter(F.col(page).rlike(r"^\d+$") & (F.col(page).try_cast("bigint") > 0))


def page_order(page: str = "page_num") -> Column:
    """Sort key: the page number, 0 where it is none."""
    return F.coalesce(F.col(page).try_cast("int"), F.lit(0))


def page_range(rows: DataFrame, key: str, page: str) -> DataFrame:
    """key, page_range: one page or first-last in three digits, 000 without pages."""
    low, high = F.min(page), F.max(page)
    text = F.when(low.isNull(), "000").when(low == high, T.zero_padded(low)).otherwise(F.concat(T.zero_padded(low), F.lit("-"), T.zero_padded(high)))
    return rows.groupBy(key).agg(text.alias("page_range"))


def toc_pages(pages: DataFrame, toc: DataFrame) -> DataFrame:
    """Pages (doc, page) that stay: where some entry has level 2 or more, those whose forward-filled level is not 1.

    Pages before the first entry have no level and stay.
    """
    by_page = toc.groupBy("doc", "page").agg(F.min("level").alias("level"))
    deep = toc.groupBy("doc").agg((F.max("level") >= 2).alias("deep"))
    filled = F.last("level", ignorenulls=True).over(Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, 0))
    level = pages.join(by_page, ["doc", "page"], "left").withColumn("level", filled).join(deep, "doc", "left")
    return level.filter(~F.coalesce("deep", F.lit(False)) | F.coalesce(F.col("level") != 1, F.lit(True))).select("doc", "page")


def level_histogram(toc: DataFrame) -> DataFrame:
    return toc.groupBy("level").agg(F.count("*").alias("n")).orderBy("level")


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the checkpoint table."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def beyond_high_water(pages: DataFrame, outputs: DataFrame) -> DataFrame:
    """Pages after the largest processed page of their document; names that are no numbers do not count."""
    mark = outputs.groupBy("doc").agg(F.max(F.col("name").try_cast("int")).alias("_mark"))
    return pages.join(mark, "doc", "left").filter(F.col("page") > F.coalesce("_mark", F.lit(0))).drop("_mark")


def page_slice(markdown: Column, page: Column, observed: bool = False) -> Column:
    """The text of a page: from its heading to the next. Null without a heading.

    ``observed`` ends only at the heading of the very next number, else at the end of the document;
    the intended form ends at whatever page heading follows and drops a trailing page rule.
    """
    head = F.concat(F.lit("## 페이지 "), page.cast("string"))
    at = F.regexp_instr(markdown, F.concat(head, F.lit(r"\s*\n")))
    rest = F.regexp_replace(F.substr(markdown, at), F.concat(F.lit("^"), head, F.lit(r"\s*\n")), F.lit(""))
    until = F.concat(F.lit("## 페이지 "), (page + 1).cast("string"), F.lit(r"\s*\n")) if observed else F.lit(r"## 페이지 \d+\s*\n")
    end = F.regexp_instr(rest, until)
    body = T.strip(F.when(end > 0, F.left(rest, end - 1)).otherwise(rest))
    return F.when(at > 0, body if observed else T.strip(F.regexp_replace(body, r"\n?---$", "")))


def ocr_pages(ocr: DataFrame) -> DataFrame:
    """doc, page, text: a combined text split at its ###NNN.png markers; null text where a page is empty."""
    parts = F.regexp_extract_all("text", F.lit(r"(?s)###([^\n]*?\.png)\s*\n?(.*?)(?=###[^\n]*?\.png|$)"), F.lit(1))
    bodies = F.regexp_extract_all("text", F.lit(r"(?s)###([^\n]*?\.png)\s*\n?(.*?)(?=###[^\n]*?\.png|$)"), F.lit(2))
    rows = ocr.select("doc", F.explode(F.arrays_zip(parts.alias("name"), bodies.alias("body"))).alias("p"))
    body = T.strip(F.col("p.body"))
    return rows.select("doc", T.file_stem(F.col("p.name")).alias("page"), F.when(body != "", body).alias("text"))


def markdown_documents(boxes: DataFrame, least: int = 50, repeats: int = 4, mode: str = "intended") -> DataFrame:
    """doc, markdown of ordered boxes (doc, page, pos, block_id, label, text)."""
    last = boxes.groupBy("doc").agg(F.max("page").alias("_last"))
    lines = layout.first_per_block(layout.long_pages(boxes, least)).withColumn("text", collapsed_if_long(F.col("text"), least=repeats, mode=mode))
    body = lines.select("doc", "page", F.lit(1).alias("part"), "block_id", "pos", T.markdown_block(F.col("label"), F.col("text")).alias("md"))
    pages = layout.long_pages(boxes, least).select("doc", "page").distinct()
    zero = [F.lit(0).alias("block_id"), F.lit(0).alias("pos")]
    heads = pages.select("doc", "page", F.lit(0).alias("part"), *zero, F.concat(F.lit("## 페이지 "), F.col("page").cast("string"), F.lit("\n\n")).alias("md"))
    rules = pages.join(last, "doc").filter("page < _last").select("doc", "page", F.lit(2).alias("part"), *zero, F.lit("---\n\n").alias("md"))
    text = joined_text(body.unionByName(heads).unionByName(rules), "doc", ["page", "part", "block_id", "pos"], "md", "", "markdown")
    docs = last.select("doc").join(text, "doc", "left")
    return docs.select("doc", F.concat(F.lit("# "), F.col("doc"), F.lit("\n\n"), F.coalesce("markdown", F.lit(""))).alias("markdown"))


def combined_ocr(pages: DataFrame) -> DataFrame:
    """doc, text: every page's text under a line with its image name, empty lines between."""
    line = F.concat(F.lit("###"), F.col("image_name"), F.lit("\n"), F.coalesce("markdown_text", F.lit("")))
    return joined_text(pages.withColumn("_line", line), "doc", ["pos"], "_line", "\n\n")


def chunk_records(docs: DataFrame, most: int = 2000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, chunk number from 1, chunk: sentences deduplicated, then chunked. A narrow pass."""
    return docs.select(key, F.posexplode(T.gated_chunks(T.dedup_sentences(F.col(text)), most)).alias("n", "chunk")).withColumn("n", F.col("n") + 1)


def merged_metadata(records: DataFrame) -> DataFrame:
    """parent, title, n, file_names: metadata grouped by folder; the first title names the group, else the folder."""
    first = F.min_by("title", F.when(F.col("title").isNotNull(), F.col("pos")))
    out = records.groupBy("parent").agg(first.alias("title"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "file_name"))).alias("f"))
    return out.select("parent", F.coalesce("title", "parent").alias("title"), "n", F.transform("f", lambda x: x["file_name"]).alias("file_names"))


def markdown_candidates(records: DataFrame, files: DataFrame) -> DataFrame:
    """id, markdown: the first existing of title, folder, stem without numbers, and that without ``layout_``."""
    stem = F.regexp_replace("file_name", r"_\d+(?:_\d+)?$", "")
    names = F.array(F.col("title"), T.folder_of(F.col("file_path")), stem, F.when(stem.startswith("layout_"), F.replace(stem, F.lit("layout_"), F.lit(""))))
    options = records.select("id", F.posexplode(names).alias("priority", "name")).filter("name <> ''")
    hit = options.join(files.select("name").distinct(), "name").groupBy("id").agg(F.min_by("name", "priority").alias("markdown"))
    return records.select("id").join(hit, "id", "left")


def expired_backups(files: DataFrame, now: Column, months: int = 3) -> DataFrame:
    """Backups (``.yyyyMMddHHmmss.bak``) older than 30 days a month."""
    stamp = F.try_to_timestamp(F.regexp_extract("name", r"\.(\d{14})\.bak$", 1), F.lit("yyyyMMddHHmmss"))
    return files.filter(stamp < now - F.make_dt_interval(F.lit(30 * months)))


def last_word_wins_union(parts: list[DataFrame]) -> DataFrame:
    """Union by name of the parts of all folders, without the source path."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.drop("_source_path")


def consecutive_groups(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``island``: numbers runs of equal values in order."""
    w = Window.partitionBy(*key).orderBy(*order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | F.lag(F.lit(1)).over(w).isNull()).cast("int")
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
