"""File sources: inventories, page files, markdown, images, JSON with bad files set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.sources.content import content_type

# Image suffixes that are collected; layout page schema.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".tif", ".webp")
LAYOUT_SCHEMA = (
    "input_path string, page_index int, boxes array<struct<label:string,text:string,coordinate:array<double>>>, shapes array<struct<label:string,text:string,points:array<double>>>, _corrupt_record string"
)
MIME = {".pdf": "application/pdf", ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".json": "application/json", ".md": "text/markdown", ".txt": "text/plain", ".mp3": "audio/mpeg", ".wav": "audio/x-wav"}


def scan_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, length, modificationTime, content of all files below a folder, without folders called metadata."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).filter(~F.col("path").rlike("/metadata/"))


def inventory(files: DataFrame) -> DataFrame:
    """One metadata row a file. ``mime_type`` and its encoding are told by the content, ``mime_type_guess`` by the suffix. Only the hash
    and the type read the content; without those columns it is pruned from the scan."""
    kind = content_type(F.col("content"))
    guess = F.lit(None).cast("string")
    suffix = T.extension(F.col("path"))
    for ext, mime in MIME.items():
        guess = F.when(suffix == ext, mime).otherwise(guess)
    return files.select(
        F.col("path").alias("file_path"),
        T.file_name(F.col("path")).alias("file_name"),
        F.col("length").alias("file_size"),
        suffix.alias("file_extension"),
        F.md5("content").alias("file_hash_md5"),
        kind["mime_type"].alias("mime_type"),
        kind["mime_encoding"].alias("mime_encoding"),
        guess.alias("mime_type_guess"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("modified_time"),
    )


def layout_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc, page, path of layout pages: documents are folders, pages are numbers in names; in order."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*layout_*.json").load(folder).select("path")
    return names.select(T.folder_of(F.col("path")).alias("doc"), T.layout_page(T.file_name(F.col("path"))).alias("page"), "path").orderBy("doc", "page", "path")


def read_layout(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Good pages and bad ones (path, record): files that are no JSON are set aside, not raised."""
    whole = read_whole_texts(spark, folder, "*layout_*.json")
    parsed = whole.withColumn("p", F.from_json("text", LAYOUT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.col("p").isNull() | F.col("p._corrupt_record").isNotNull()
    return parsed.filter(~bad).select("p.*", "path").drop("_corrupt_record"), parsed.filter(bad).select("path", F.col("text").alias("record"))


def read_whole_texts(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """path, text of every file; unreadable files are skipped."""
    out = spark.read.option("pathGlobFilter", glob).option("ignoreCorruptFiles", True).text(folder, wholetext=True, recursiveFileLookup=True)
    return out.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def image_files(files: DataFrame) -> DataFrame:
    """Distinct image paths, whatever the case of the suffix, in order."""
    return files.filter(T.extension(F.col("path")).isin(*IMAGE_SUFFIXES)).select("path").distinct().orderBy("path")


def with_folder_type(records: DataFrame, path: str = "path") -> DataFrame:
    """Adds folder_type: the PDF or IMG folder a file lies below."""
    p = F.col(path)
    return records.withColumn("folder_type", F.when(p.contains("/PDF/"), "PDF").when(p.contains("/IMG/"), "IMG"))


def benchmark_results(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Result files name-qps_rate.json of several runs in one table with their name."""
    raw = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).select("*", F.col("_metadata.file_path").alias("_path"))
    return raw.withColumn("name", F.regexp_extract("_path", r"([^/]+)-qps", 1)).filter(F.col("name").isin(*names)).drop("_path")


def data_url(url: Column) -> Column:
    """struct<mime, data> of a base64 data url; null for others."""
    head = F.substring_index(F.substring_index(url, ",", 1), "data:", -1)
    good = url.startswith("data:") & url.contains(";base64,")
    return F.when(good, F.struct(F.substring_index(head, ";", 1).alias("mime"), F.unbase64(F.substring_index(url, ",", -1)).alias("data")))


def media_source(url: Column, allowed_root: str | None = None) -> Column:
    """http, data, file (below the allowed root and without ..), refused or unknown."""
    path = F.regexp_replace(url, "^file://", "")
    inside = F.lit(False) if allowed_root is None else path.startswith(allowed_root.rstrip("/") + "/") & ~path.contains("/../")
    return F.when(url.rlike("^https?://"), "http").when(url.startswith("data:"), "data").when(url.startswith("file://"), F.when(inside, "file").otherwise("refused")).otherwise("unknown")


# ---------------------------------------------------------------- JSON lines


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Batch requests, one JSON a line; blank lines are skipped; the body stays text."""
    return parsed_requests(spark.read.text(path))


def parsed_requests(lines: DataFrame) -> DataFrame:
    """The same from rows of lines (value)."""
    return lines.filter(F.trim("value") != "").select(F.from_json("value", "custom_id string, method string, url string, body string").alias("r")).select("r.*")


def responses(rows: DataFrame) -> DataFrame:
    """Response lines of custom_id, status, body, error."""
    failed = F.col("status") != 200
    return rows.select(
        F.concat(F.lit("batch-"), F.sha2(F.col("custom_id"), 256).substr(1, 32)).alias("id"),
        "custom_id",
        F.struct(F.col("status").alias("status_code"), F.concat(F.lit("request-"), F.col("custom_id")).alias("request_id"), F.when(~failed, F.col("body")).alias("body")).alias("response"),
        F.when(failed, F.col("error")).alias("error"),
    )


def write_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def upload_parts(rows: DataFrame, put, tries: int = 5, part_rows: int = 10_000, markers: str | None = None) -> None:
    """Sends JSON lines with ``put(part, text)`` in parts of at most ``part_rows`` rows; a failed part is tried again.

    Parts are numbered within a partition (``partition-number``). With ``markers``, a shared folder, a part that was sent leaves a marker
    file, and a task that is run again skips parts that have one; then ``rows`` must come in the same order each time, as
    those of a written table do. Between sending and marking a task may still die, so ``put`` should replace by part.
    """
    names = rows.columns

    def store_of(path: str):
        import pyarrow.fs

        local = path.startswith("file:") and not path.startswith("file://")
        return pyarrow.fs.FileSystem.from_uri(path.removeprefix("file:") if local else path)

    def send(part: str, lines: list[str]) -> None:
        if markers is not None:
            store, inner = store_of(f"{markers.rstrip('/')}/{part}.sent")
            if store.get_file_info(inner).is_file:
                return
        for attempt in range(tries):
            try:
                put(part, "".join(lines))
                break
            except OSError:
                if attempt == tries - 1:
                    raise
        if markers is not None:
            store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            store.open_output_stream(inner).close()

    def run(batches):
        import json

        from pyspark import TaskContext

        partition, number, lines = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for r in batch.to_pylist():
                lines.append(json.dumps({n: r[n] for n in names}, ensure_ascii=False, default=str) + "\n")
                if len(lines) == part_rows:
                    send(f"{partition}-{number}", lines)
                    number, lines = number + 1, []
        if lines:
            send(f"{partition}-{number}", lines)
        yield from ()

    rows.mapInArrow(run, rows.schema).write.format("noop").mode("overwrite").save()
