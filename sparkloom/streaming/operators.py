"""Streams: incremental directories, dead letters, replay, windows, sessions, joins, stateful caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def incremental(spark: SparkSession, folder: str, schema: str, checkpoint: str, process: Callable[[DataFrame, int], None], fmt: str = "parquet", **options) -> None:
    """Processes files that are new since the last call, in batches; progress lies in the checkpoint folder."""
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(folder)
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def with_dead_letters(raw: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and rows that are no such JSON with the reason. Works on batches and streams."""
    parsed = raw.withColumn("_p", F.from_json(column, schema + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.col("_p").isNull() | F.col("_p._corrupt_record").isNotNull()
    good = parsed.filter(~bad).select("_p.*").drop("_corrupt_record")
    return good, parsed.filter(bad).select(F.col(column).alias("record"), F.lit("not valid JSON").alias("reason"))


def watermarked(events: DataFrame, time: str, late: str) -> DataFrame:
    """Watermarks need an instant; times without a zone are read in the session's zone."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def replay(events: DataFrame, first_seq: int, late: str | None = None, time: str = "ts") -> DataFrame:
    """Events from a sequence number on, each number once. On a stream ``late`` bounds the state."""
    rows = events.filter(F.col("seq") >= first_seq)
    return watermarked(rows, time, late).dropDuplicatesWithinWatermark(["seq"]) if late else rows.dropDuplicates(["seq"])


def tumbling(events: DataFrame, time: str, width: str, keys: list[str], *aggregates, late: str | None = None) -> DataFrame:
    """start, end, keys and aggregates by fixed windows; counters start anew in every window."""
    rows = watermarked(events, time, late) if late else events
    out = rows.groupBy(F.window(time, width).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *[c for c in out.columns if c not in ("w", *keys)])


def sliding(events: DataFrame, time: str, width: str, step: str, keys: list[str], *aggregates, late: str | None = None) -> DataFrame:
    rows = watermarked(events, time, late) if late else events
    out = rows.groupBy(F.window(time, width, step).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *[c for c in out.columns if c not in ("w", *keys)])


def sessions(events: DataFrame, time: str, gap: str, keys: list[str], *aggregates, late: str | None = None) -> DataFrame:
    """start, end (last event plus gap), keys and aggregates by sessions."""
    rows = watermarked(events, time, late) if late else events
    out = rows.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *[c for c in out.columns if c not in ("w", *keys)])


def interval_join(left: DataFrame, right: DataFrame, key: str, within: str, late: str) -> DataFrame:
    """Pairs of one key whose right time lies within an interval after the left; both sides forget late rows."""
    a = watermarked(left, "ts", late).alias("a")
    b = watermarked(right, "ts", late).alias("b")
    return a.join(b, F.expr(f"a.{key} = b.{key} AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL {within}"))


def token_outputs(tokens: DataFrame, mode: str) -> DataFrame:
    """delta: every token as it comes; cumulative: text so far at every token; final: whole text of finished requests."""
    from pyspark.sql import Window

    if mode == "delta":
        return tokens.select("req", "pos", "text")
    w = Window.partitionBy("req").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    so_far = tokens.withColumn("text", F.array_join(F.collect_list("text").over(w), ""))
    return so_far.select("req", "pos", "text") if mode == "cumulative" else so_far.filter("finished").select("req", "pos", "text")


def rolling_hit_rate(stats: DataFrame, most: int) -> DataFrame:
    """cache, seq, hit_rate of a stream: state is the rows of the last ``most`` requests of each cache."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = list(zip(*state.get, strict=True)) if state.exists else []
        out = []
        rows = pd.concat(list(parts)).sort_values("seq")
        for r in rows.itertuples(index=False):
            kept.append((int(r.requests), int(r.queries), int(r.hits)))
            while len(kept) > 1 and sum(k[0] for k in kept) > most:
                kept.pop(0)
            queries = sum(k[1] for k in kept)
            out.append((key[0], r.seq, sum(k[2] for k in kept) / queries if queries else 0.0))
        state.update(tuple(map(list, zip(*kept, strict=True))))
        yield pd.DataFrame(out, columns=["cache", "seq", "hit_rate"])

    return stats.groupBy("cache").applyInPandasWithState(
        update, "cache long, seq long, hit_rate double", "requests array<long>, queries array<long>, hits array<long>", "append", GroupStateTimeout.NoTimeout
    )


def lru_cache(accesses: DataFrame, capacity: int) -> DataFrame:
    """cache, seq, hash, hit of a stream: state is the held hashes in order of use with their pins, at most ``capacity`` of them.
    A pinned hash stays until it is unpinned; if all are pinned, a new one is not held."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        out = []
        for r in pd.concat(list(parts)).sort_values("seq").itertuples(index=False):
            hit = r.hash in held
            pins = held.pop(r.hash, 0) + int(r.pin)
            if not hit and len(held) >= capacity:
                free = next((h for h, n in held.items() if n <= 0), None)
                if free is not None:
                    del held[free]
            if hit or len(held) < capacity:
                held[r.hash] = pins
            out.append((key[0], r.seq, r.hash, hit))
        state.update((list(held), list(held.values())))
        yield pd.DataFrame(out, columns=["cache", "seq", "hash", "hit"])

    return accesses.groupBy("cache").applyInPandasWithState(update, "cache long, seq long, hash string, hit boolean", "held array<string>, pins array<int>", "append", GroupStateTimeout.NoTimeout)


class QueryStats(StreamingQueryListener):
    """Collects input rows and duration of every batch of every stream: a statistics logger to attach to a session."""

    def __init__(self) -> None:
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches.append({"name": p.name, "batch": p.batchId, "rows": p.numInputRows, "ms": p.durationMs.get("triggerExecution", 0)})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def run_to_memory(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and returns its rows: for tests and small results."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
