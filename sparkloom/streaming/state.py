"""Stateful operators whose state ends: list state that is trimmed, and that goes when its key falls quiet."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkloom.ship import ship

# the driver's own worker for stateful functions does not see packages that are shipped to executors, so this module goes by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_list_state(spark: SparkSession) -> None:
    """Streams of this session keep their state in RocksDB, which list state needs. Old checkpoints of another kind stay unreadable."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class RecentHits(StatefulProcessor):
    """The last requests of a key, oldest first, of which at most ``most`` count; none after ``quiet`` milliseconds without one."""

    def __init__(self, most: int, quiet: int, by_event: bool):
        self.most, self.quiet, self.by_event = most, quiet, by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # without event time the store itself drops what is older
        self.recent = handle.getListState("recent", "requests long, queries long, hits long, at long", None if self.by_event else self.quiet)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kept = [tuple(r) for r in self.recent.get()]
        fresh = pd.concat(list(rows)).sort_values("seq")
        requests = sum(k[0] for k in kept)
        out = []
        for r in fresh.itertuples(index=False):
            at = int(r.ts.timestamp() * 1000)
            if self.by_event and kept and at - kept[-1][3] > self.quiet:  # the timer may not have come yet
                kept, requests = [], 0
            kept.append((int(r.requests), int(r.queries), int(r.hits), at))
            requests += kept[-1][0]
            while len(kept) > 1 and requests > self.most:
                requests -= kept.pop(0)[0]
            queries = sum(k[1] for k in kept)
            out.append((key[0], int(r.seq), sum(k[2] for k in kept) / queries if queries else 0.0))
        self.recent.put(kept)
        if self.by_event:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(max(k[3] for k in kept) + self.quiet)
        yield pd.DataFrame(out, columns=["cache", "seq", "hit_rate"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.recent.clear()
        yield pd.DataFrame({"cache": pd.Series(dtype="int64"), "seq": pd.Series(dtype="int64"), "hit_rate": pd.Series(dtype="float64")})


def expiring_hit_rate(stats: DataFrame, most: int, quiet: int, late: str | None = None) -> DataFrame:
    """cache, seq, hit_rate of a stream of cache, seq, requests, queries, hits and ts: as ``operators.rolling_hit_rate``, but a cache that
    is quiet for ``quiet`` milliseconds leaves no state. With ``late`` these are of event time, behind a watermark, and a timer clears the
    state; without, they are of the clock, and the state has that time to live. The rows of a cache in one batch are held at once.
    """
    ship(stats.sparkSession)
    rows = stats.withWatermark("ts", late) if late else stats
    return rows.groupBy("cache").transformWithStateInPandas(RecentHits(most, quiet, late is not None), "cache long, seq long, hit_rate double", "Append", "EventTime" if late else "ProcessingTime")
