"""Sinks: inventories with backups, markdown, metadata, transcripts, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fs(df: DataFrame, path: str):
    jvm = df.sparkSession.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), hadoop, jvm


def save_with_backup(df: DataFrame, path: str, stamp: str) -> str | None:
    """Writes JSON; what was there is renamed to ``path.stamp.bak`` first. Returns the backup's path."""
    fs, target, jvm = _fs(df, path)
    backup = None
    if fs.exists(target):
        backup = f"{path}.{stamp}.bak"
        fs.rename(target, jvm.org.apache.hadoop.fs.Path(backup))
    df.write.mode("errorifexists").json(path)
    return backup


def remove_expired_backups(df: DataFrame, folder: str, before: str) -> list[str]:
    """Deletes backups in a folder whose stamp (yyyyMMddHHmmss) is before the given one. The listing is one folder's."""
    import re

    fs, target, _ = _fs(df, folder)
    gone = []
    for status in fs.listStatus(target) if fs.exists(target) else []:
        name = status.getPath().getName()
        found = re.search(r"\.(\d{14})\.bak$", name)
        if found and found[1] < before:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def envelope(files: DataFrame, version: str, source: str, clock: Column, most: int = 1_000_000) -> DataFrame:
    """The inventory as one record, an error beyond ``most`` files: larger inventories are written as rows.

    Each task hands on at most one file beyond the bound, so the record never gathers more than tasks times it.
    """
    mark = "_n"
    some = files.withColumn(mark, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).filter(F.col(mark) <= most).drop(mark)
    listed = F.array_sort(F.collect_list(F.struct(*files.columns)))
    rows = F.when(F.count("*") <= most, listed).otherwise(F.raise_error(F.lit(f"more than {most} files for one record")).cast(files.select(listed.alias("x")).schema["x"].dataType))
    return some.agg(rows.alias("metadata"), F.count("*").alias("total_files")).select("metadata", "total_files", F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"), F.lit(version).alias("version"), F.lit(source).alias("source_directory"))


def write_text_per_document(df: DataFrame, path: str, key: str = "doc", text: str = "markdown") -> None:
    """One folder ``key=...`` a document with its text."""
    df.select(key, F.col(text).alias("value")).write.mode("overwrite").partitionBy(key).option("lineSep", "\n").text(path)


def write_chunked(df: DataFrame, folder: str, source: str = "_source_path") -> DataFrame:
    """One JSON file for each source file, without the source path: ``<its folder>/<its name>_chunked_metadata.json`` below
    ``folder``. Returns the paths written. Rows without a source path are left out; a repeated task writes the same file."""
    names = [c for c in df.columns if c != source]
    base = F.regexp_replace(F.element_at(F.split(source, "/"), -1), r"_metadata\.json$|\.json$", "")
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.coalesce(F.get(F.reverse(F.split(source, "/")), F.lit(1)), F.lit("")), F.lit("/"), base, F.lit("_chunked_metadata.json"))
    files = df.filter(F.col(source).isNotNull()).select(path.alias("path"), F.to_json(F.struct(*names), {"pretty": "true", "ignoreNullFields": "false"}).alias("body"))

    def run(batches):
        import pyarrow.fs

        for batch in batches:
            for target, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                local = target.startswith("file:") and not target.startswith("file://")
                store, inner = pyarrow.fs.FileSystem.from_uri(target.removeprefix("file:") if local else target)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(inner) as out:
                    out.write(body.encode())
            yield batch.select(["path"])

    return files.mapInArrow(run, "path string")


def write_metadata(df: DataFrame, path: str, key: str = "doc") -> None:
    """Per-document metadata files, without the source path."""
    df.drop("_source_path").write.mode("overwrite").partitionBy(key).json(path)


def write_combined(parts: list[DataFrame], path: str) -> None:
    from sparkloom.operators.documents import last_word_wins_union

    last_word_wins_union(parts).write.mode("overwrite").json(path)


def transcript_header(fields: dict[str, Column]) -> Column:
    from sparkloom.functions.records import embedded_metadata

    return F.concat(embedded_metadata(**fields), F.lit("\n\n"))


def write_transcripts(segments: DataFrame, header: Column, timeline_path: str, text_path: str) -> None:
    """Timelines with speakers, and texts without them under a metadata comment."""
    from sparkloom.operators.speech import full_text, timeline

    write_text_per_document(timeline(segments), timeline_path, "audio", "markdown")
    write_text_per_document(full_text(segments).withColumn("text", F.concat(header, F.col("text"))), text_path, "audio", "text")


def block_report(boxes: DataFrame) -> DataFrame:
    """doc, page, report: numbered lines, a rule before each block."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc", "page").orderBy("rank")
    new = ~F.col("block_id").eqNullSafe(F.lag("block_id").over(w))
    line = F.concat(F.when(new, F.concat(F.lit("--- block "), F.col("block_id").cast("string"), F.lit(" ---\n"))).otherwise(""), F.col("rank").cast("string"), F.lit(". ["), F.col("label"), F.lit("] "), F.col("text"))
    lines = boxes.withColumn("_l", line)
    return lines.groupBy("doc", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "_l"))), lambda x: x["_l"]), "\n").alias("report"))


def write_excel(sheets: dict[str, DataFrame], path: str, rows: int = 100_000) -> None:
    """A driver-side report of small tables; needs an Excel writer, and refuses tables above ``rows``."""
    import pandas as pd

    try:
        writer = pd.ExcelWriter(path)
    except ImportError as e:
        raise RuntimeError("an Excel writer is not installed") from e
    with writer:
        for name, df in sheets.items():
            some = df.limit(rows + 1).toPandas()
            if len(some) > rows:
                raise ValueError(f"{name} has more than {rows} rows")
            some.to_excel(writer, sheet_name=name, index=False)
