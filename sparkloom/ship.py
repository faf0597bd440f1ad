"""Makes this package importable in the Python workers of a session, and bounds what a task of it holds.

Workers see installed packages and, on one machine, the driver's PYTHONPATH and working folder. Anywhere else
the package goes with the session as a zip file, once, before a function that needs it is built.
"""

from __future__ import annotations

import os
import re
import sysconfig
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]


def _visible() -> bool:
    """Whether workers that inherit this process's environment find the package."""
    installed = {Path(p).resolve() for p in sysconfig.get_paths().values()}
    inherited = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    return ROOT in installed | inherited | {Path.cwd().resolve()}


#: Bytes of an Arrow batch: the JVM, the worker and its copy each hold one.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` in this session, whatever the texts' length; smaller settings stay."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


#: Shuffled bytes up to which Spark joins partitions: grouped, they take some 15 times as much of a task's memory.
PARTITION_BYTES = 16 << 20

_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def bounded_partitions(spark: SparkSession) -> None:
    """Partitions are joined up to ``PARTITION_BYTES`` in this session; smaller settings stay."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    found = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", spark.conf.get(name).strip().lower())
    if not found or not 0 < int(found[1]) << _UNITS[found[2]] <= PARTITION_BYTES:
        spark.conf.set(name, str(PARTITION_BYTES))


def ship(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    bounded_batches(spark)
    bounded_partitions(spark)
    context = spark.sparkContext
    if getattr(context, "_loom_shipped", False):
        return
    context._loom_shipped = True
    if _visible():
        return
    target = Path(tempfile.mkdtemp(prefix="loom-package-")) / "sparkloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted((ROOT / "sparkloom").rglob("*.py")):
            out.write(path, path.relative_to(ROOT))
    context.addPyFile(str(target))
