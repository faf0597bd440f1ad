"""Shared pieces of the training-data operators: scratch tables, Arrow iteration, text helpers.

Scratch tables cut lineage and are shared by all executors: they are Parquet folders under the
folder that ``spark.checkpoint.dir`` names (Spark's own reliable checkpoints live there too).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.ship import BATCH_BYTES, bounded_batches, ship  # noqa: F401

#: ASCII white space, as a Java character class.
WS = r"[\x20\x09-\x0D]"
#: A word: a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: The largest number of bytes a signed 32-bit Arrow offset or a JVM array can hold, with a margin.
MAX_BLOB = 1 << 30


def text_of(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def private(columns: list[str], *names: str) -> list[str]:
    """The names, longer where a column has them already, so that helper columns never clash with the caller's."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the setting is unset, an own folder on a local master (tests); an
    error on a cluster, whose executors would each see another folder."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        configured = getattr(spark, "_loom_shared", None) or tempfile.mkdtemp(prefix="loom-shared-")
        spark._loom_shared = configured
    # with its scheme, so that Spark and the Python workers mean the same store
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(configured.rstrip("/"))
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/loom/{label}-{uuid.uuid4().hex}"


def placed(docs: DataFrame, scratch: Scratch, file: str, index: str) -> DataFrame:
    """The rows with their place (two longs: a hash of the file's path, and the row in the file), which tells any two of them apart and
    is the same at every reading. Rows that come from no Parquet scan are written first, with a running number."""
    try:
        at = docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(index))
        at.schema  # noqa: B018  resolves the plan
        return at
    except AnalysisException:
        return scratch.table(docs.select("*", F.lit(0).cast("long").alias(file), F.monotonically_increasing_id().alias(index)), "placed")


class Scratch:
    """Paths of one run. Spark keeps no owner for a written table, so the run's frames own it: when the
    last frame is garbage, the folder goes."""

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark, self.label = spark, label
        self._live: dict[str, object] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self._live[path] = weakref.finalize(self, _quiet_delete, self.spark, path)
        return self.spark.read.parquet(path)

    def folder(self, name: str) -> str:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        self._live[path] = weakref.finalize(self, _quiet_delete, self.spark, path)
        return path

    def drop(self) -> None:
        for done in self._live.values():
            done()

    def own(self, df: DataFrame) -> DataFrame:
        """The result frame keeps the run's tables alive."""
        df._loom_scratch = self
        _RECENT.append(self)
        del _RECENT[:-_KEEP]
        return df


def carry(owner: DataFrame, derived: DataFrame) -> DataFrame:
    """The derived frame keeps the operator's scratch tables alive."""
    derived._loom_scratch = getattr(owner, "_loom_scratch", None)
    return derived


#: Results may be re-derived (``df.select(...)``) after the frame that owns a run is gone, so the last runs stay.
_KEEP = 64
_RECENT: list[Scratch] = []


@atexit.register
def _release() -> None:
    _RECENT.clear()


def _quiet_delete(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session has ended or the folder is gone: nothing is left to free
        pass


def rows_of(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def map_arrow(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]) -> DataFrame:
    """``mapInArrow`` whose per-task state is built by ``make`` on the executor."""

    ship(df.sparkSession)
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return df.mapInArrow(run, schema)


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that are at most ``most`` together, or one alone."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most ``most`` bytes of ``column`` (one row at least), so that long texts do not pile up."""
    at = batch.schema.get_field_index(column)
    sizes = [0 if x is None else x for x in pa.compute.binary_length(batch.column(at)).to_pylist()]
    for first, last in runs(sizes, most):
        yield batch.slice(first, last - first)
