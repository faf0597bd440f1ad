"""Window panes with revisions: in-band punctuation on a stateful stream.

Rows of a stream of batches fall into panes, a kind and an hour of event time. The watermark of a batch is the largest event time of
all earlier batches. A pane is emitted once it is due, revised (retracted and replaced) when rows come after that, and forgotten once
it is closed; rows of closed panes are written as late, one by one.

1. ``batched`` cleans the rows and gives each its batch: one aggregation by id, so a repeated id meets no window.
2. Each batch, empty ones too, is a set of Parquet files below ``spark.checkpoint.dir``: its rows, and in the same band one control
   row (batch, watermark, last) for every state shard.
3. A streaming query, started anew for every batch on one checkpoint, combines the rows of a pane within each task before the shuffle
   and sends them to the shard of their pane. A row knows the watermark of its batch, so late rows are told apart there; they need no
   state and are spread over all shards by id. A shard puts what it gets into its panes, a ``MapState``; the control row then settles
   their lifecycle: emit, retract and replace, forget, and at last final.

Scale: the driver gets one watermark for each batch. A pane that holds a third of all rows is one row a task after the combination; a
shard holds the live panes of its hash only. State is checkpointed in the shared folder, the sink commits by batch, so lost executors
cost a retried task. Every call takes a new folder.

Defined edge cases: rows without a time are dropped; of rows with one id (no id counts as one) the least by arrival, time, kind and value
stays; a null arrival is the row's own time; a null kind is ``none``; a value that is null or no finite number counts 0, sums are
64-bit integers; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkloom.llm.common import Scratch
from sparkloom.ship import ship

BATCHES = 10
HOUR = 3_600_000_000
DAY = 24 * HOUR
#: After a pane's end: hours until it is due, and until it is closed.
DUE_HOURS = 12
CLOSED_HOURS = 48
#: State shards. A control row goes to each of them with each batch.
SHARDS = 128
#: Panes that a task gathers before it hands them on.
TASK_PANES = 50_000

RESULT = "batch long, hour long, click_id long, n_rows long, cents long, record string, kind string"


# the driver's own worker for stateful functions does not see packages that are shipped to executors, so this module goes by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Lifecycle:
    """When a pane is due and when it is closed, in microseconds after the start of its hour."""

    due: int = HOUR * (1 + DUE_HOURS)
    closed: int = HOUR * (1 + CLOSED_HOURS)


def micros(time: Column) -> Column:
    """Microseconds since 1970 as the clock shows them: the fields of a time without a zone, whatever the session's zone."""
    seconds = F.unix_date(F.to_date(time)) * F.lit(86_400).cast("long") + F.hour(time) * 3600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long")


def batched(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """batch, click_id, kind, hour, event (microseconds), cents: a row for each id."""
    kept = F.struct(
        F.coalesce(micros(F.col("arrived_at")), micros(F.col("ts"))).alias("arrived"), micros(F.col("ts")).alias("ts"), F.coalesce(F.col("kind").cast("string"), F.lit("none")).alias("kind"), F.col("value").cast("double").alias("value")
    )
    rows = clicks.filter(F.col("ts").isNotNull()).select(F.col("click_id").cast("long").alias("click_id"), kept.alias("r"))
    once = rows.groupBy("click_id").agg(F.min("r").alias("r")).select("click_id", "r.*")
    day = F.floor(F.col("arrived") / DAY)
    q = F.pmod(day, F.lit(batches))
    delay = F.greatest(F.lit(0), F.crc32(F.coalesce(F.col("click_id").cast("string"), F.lit(""))) % 30 - 23)
    event = F.col("ts") - (day - q) * DAY
    value = F.floor(F.col("value") * 100 + 0.5)
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf")))
    return once.select(F.least(F.lit(batches - 1), q + delay).cast("int").alias("batch"), "click_id", "kind", F.floor(event / HOUR).alias("hour"), event.alias("event"), F.when(finite, value).otherwise(0).cast("long").alias("cents"))


def watermarks(rows: DataFrame, batches: int = BATCHES) -> list[int | None]:
    """The largest event time of all batches before each batch."""
    most = {r["batch"]: r["most"] for r in rows.groupBy("batch").agg(F.max("event").alias("most")).collect()}
    out: list[int | None] = [None]
    for b in range(batches - 1):
        known = [w for w in (out[-1], most.get(b)) if w is not None]
        out.append(max(known) if known else None)
    return out


def shard_of(kind: str, hour: int, shards: int) -> int:
    return zlib.crc32(f"{hour}:{kind}".encode()) % shards


def combined(stream: DataFrame, life: Lifecycle, shards: int) -> DataFrame:
    """shard, role (pane, late or control), batch, w, last, click_id, kind, hour, n_rows, cents: rows of a pane are combined within a task."""
    schema = "shard int, role string, batch int, w long, last boolean, click_id long, kind string, hour long, n_rows long, cents long"
    names = [field.split()[0] for field in schema.split(", ")]
    numbers = {"shard": pa.int32(), "role": pa.string(), "batch": pa.int32(), "w": pa.int64(), "last": pa.bool_(), "click_id": pa.int64(), "kind": pa.string(), "hour": pa.int64(), "n_rows": pa.int64(), "cents": pa.int64()}

    def rows(**columns) -> pa.RecordBatch:
        n = len(columns["shard"])
        full = [pa.array(columns[c], numbers[c]) if c in columns else pa.nulls(n, numbers[c]) for c in names]
        return pa.RecordBatch.from_arrays(full, names)

    def step(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        panes: dict[tuple[int, str, int], list[int]] = {}

        def held() -> pa.RecordBatch:
            keys, sums = list(panes), list(panes.values())
            out = rows(
                shard=[shard_of(k, h, shards) for _, k, h in keys], role=["pane"] * len(keys), batch=[b for b, _, _ in keys], kind=[k for _, k, _ in keys], hour=[h for _, _, h in keys], n_rows=[s[0] for s in sums], cents=[s[1] for s in sums]
            )
            panes.clear()
            return out

        for part in parts:
            control = part.filter(part.column("control"))
            if control.num_rows:
                own = {c: control.column(c) for c in ("shard", "batch", "w", "last")}
                yield rows(role=["control"] * control.num_rows, **own)
            data = part.filter(pc.invert(part.column("control")))
            if not data.num_rows:
                continue
            hour = data.column("hour").to_numpy()
            w = data.column("w").fill_null(np.iinfo(np.int64).min).to_numpy()
            late = w >= hour * HOUR + life.closed
            if late.any():
                own = data.filter(pa.array(late))
                ids = own.column("click_id").fill_null(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                spread = (ids >> np.uint64(33)) % np.uint64(shards)
                yield rows(shard=spread.astype(np.int32), role=["late"] * own.num_rows, n_rows=[1] * own.num_rows, **{c: own.column(c) for c in ("batch", "click_id", "kind", "hour", "cents")})
            table = pa.Table.from_batches([data.filter(pa.array(~late))]).select(["batch", "kind", "hour", "cents"])
            sums = table.group_by(["batch", "kind", "hour"]).aggregate([("cents", "count"), ("cents", "sum")])
            for b, k, h, n, cents in zip(*(sums.column(c).to_pylist() for c in ("batch", "kind", "hour", "cents_count", "cents_sum")), strict=True):
                pane = panes.setdefault((b, k, h), [0, 0])
                pane[0] += n
                pane[1] += cents
            if len(panes) > TASK_PANES:
                yield held()
        if panes:
            yield held()

    ship(stream.sparkSession)
    return stream.mapInArrow(step, schema)


class PaneShard(StatefulProcessor):
    """The live panes of a shard. Rows come first, then the control row settles what they have changed."""

    def __init__(self, life: Lifecycle):
        self.life = life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.panes = handle.getMapState("panes", "kind string, hour long", "n_rows long, cents long, emitted boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        fresh: dict[tuple[str, int], list[int]] = {}
        batch, w, last = 0, None, False
        for part in rows:
            late = part[part["role"] == "late"]
            if len(late):
                yield _records(late["batch"], late["hour"], late["click_id"], late["n_rows"], late["cents"], "late", late["kind"])
            for r in part[part["role"] == "control"].itertuples(index=False):
                batch, w, last = int(r.batch), None if pd.isna(r.w) else int(r.w), bool(r.last)
            for r in part[part["role"] == "pane"].itertuples(index=False):
                pane = fresh.setdefault((r.kind, int(r.hour)), [0, 0])
                pane[0] += int(r.n_rows)
                pane[1] += int(r.cents)
        yield from self._settle(fresh, batch, w, last)

    def _settle(self, fresh: dict[tuple[str, int], list[int]], batch: int, w: int | None, last: bool) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        held = {tuple(k): tuple(v) for k, v in self.panes.iterator()}
        for pane, (n, cents) in fresh.items():
            before = held.get(pane, (0, 0, False))
            held[pane] = (before[0] + n, before[1] + cents, before[2])
            if before[2]:
                out += [(pane, before, "retract"), (pane, held[pane], "replace")]
        for pane, now in held.items():
            due = w is not None and w >= pane[1] * HOUR + self.life.due
            emit = (due or last) and not now[2]
            if emit:
                out.append((pane, now, "emit" if due else "final"))
            if w is not None and w >= pane[1] * HOUR + self.life.closed:
                self.panes.removeKey(pane)
            elif emit or pane in fresh:
                self.panes.updateValue(pane, (now[0], now[1], now[2] or emit))
        if out:
            yield _records([batch] * len(out), [p[1] for p, _, _ in out], [-1] * len(out), [v[0] for _, v, _ in out], [v[1] for _, v, _ in out], [r for _, _, r in out], [p[0] for p, _, _ in out])


def _records(batch, hour, click_id, n_rows, cents, record, kind) -> pd.DataFrame:
    numbers = {"batch": batch, "hour": hour, "click_id": click_id, "n_rows": n_rows, "cents": cents}
    out = pd.DataFrame({name: pd.array(list(values), "Int64") for name, values in numbers.items()})
    return out.assign(record=record, kind=list(kind))


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same context whose streams keep their state in RocksDB, which ``MapState`` needs. A start runs one batch, so
    executors close their stores with it and hold no space ahead."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own


def panes(clicks: DataFrame, batches: int = BATCHES, life: Lifecycle = Lifecycle(), shards: int = SHARDS) -> DataFrame:
    """batch, hour, click_id, n_rows, cents, record, kind: what the stream writes over all batches."""
    spark = clicks.sparkSession
    ship(spark)
    scratch = Scratch(spark, "panes")
    staged = scratch.folder("rows")
    batched(clicks, batches).write.partitionBy("batch").parquet(staged)
    rows = spark.read.schema("click_id long, kind string, hour long, event long, cents long, batch int").parquet(staged)
    marks = watermarks(rows, batches)
    inbox, out, checkpoint = scratch.folder("inbox"), scratch.folder("out"), scratch.folder("state")
    band = "batch int, w long, last boolean, control boolean, shard int, click_id long, kind string, hour long, cents long"
    own = streaming_session(spark)
    for b, w in enumerate(marks):
        tag = [F.lit(b).cast("int").alias("batch"), F.lit(w).cast("long").alias("w"), F.lit(b == batches - 1).alias("last")]
        none = [F.lit(None).cast("long").alias("click_id"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("long").alias("hour"), F.lit(None).cast("long").alias("cents")]
        data = rows.filter(F.col("batch") == b).select(*tag, F.lit(False).alias("control"), F.lit(None).cast("int").alias("shard"), "click_id", "kind", "hour", "cents")
        control = spark.range(0, shards, 1, 1).select(*tag, F.lit(True).alias("control"), F.col("id").cast("int").alias("shard"), *none)
        data.unionByName(control).write.mode("append").parquet(inbox)
        stream = combined(own.readStream.schema(band).parquet(inbox), life, shards)
        settled = stream.groupBy("shard").transformWithStateInPandas(PaneShard(life), RESULT, "Append", "None")
        query = settled.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    return scratch.own(spark.read.schema(RESULT).parquet(out))
