"""An event log as a replayable stream source, and a sink that publishes each part once.

A log is a folder of segments, files of JSON lines named by the first and last sequence number that they hold. The source's offsets are
sequence numbers: a stream that starts again goes on behind the last number that it has committed, and one that starts new may
replay from any number. Where numbers are missing the stream waits before the gap, or passes it and says so in a row of its own.

The sink stages the rows of each task in a file of its own attempt and publishes them all at once with one manifest, so an attempt that
dies, or runs twice, leaves nothing that is read.
"""

from __future__ import annotations

import io
import json
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from sparkloom.ship import ship

# the driver's own workers for sources do not see packages that are shipped to executors, so this module goes by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SEGMENT = re.compile(r"events-(\d{20})-(\d{20})\.jsonl$")
#: A name that no segment has.
MANIFEST = "_parts.json"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9+]+:", path) else (fs.LocalFileSystem(), path)


def _names(path: str) -> list[str]:
    from pyarrow import fs

    store, inner = _store(path)
    return sorted(f.path for f in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if f.is_file)


def append_events(folder: str, first: int, payloads: list[str]) -> str:
    """A segment of events with numbers from ``first`` on. It is written under another name first, so a reader sees it whole or not."""
    store, inner = _store(folder)
    store.create_dir(inner, recursive=True)
    name = f"{inner}/events-{first:020d}-{first + len(payloads) - 1:020d}.jsonl"
    hidden = f"{inner}/_{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write("".join(json.dumps({"seq": first + i, "payload": p}, ensure_ascii=False) + "\n" for i, p in enumerate(payloads)).encode())
    store.move(hidden, name)
    return name


@dataclass
class _Numbers(InputPartition):
    """Events of a segment with numbers above ``after`` up to ``last``; without a segment, the row of a gap."""

    name: str | None
    after: int
    last: int


class _Log(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.first = int(options.get("from", 0))
        self.passes = options.get("gaps", "wait") == "pass"

    def initialOffset(self) -> dict:  # noqa: N802
        return {"seq": self.first - 1}

    def _segments(self, after: int) -> list[tuple[int, int, str]]:
        found = [(int(m[1]), int(m[2]), name) for name in _names(self.folder) if (m := _SEGMENT.search(name))]
        return sorted(s for s in found if s[1] > after)

    def latestOffset(self) -> dict:  # noqa: N802
        """The last number before the first gap, or of all. Segments may overlap, as a writer that died leaves them."""
        seq = self.first - 1
        for first, last, _ in self._segments(seq):
            if first > seq + 1 and not self.passes:
                break
            seq = max(seq, last)
        return {"seq": seq}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        seq = start["seq"]
        for first, last, name in self._segments(seq):
            if first > end["seq"] or last <= seq:
                continue
            if first > seq + 1:
                out.append(_Numbers(None, seq, first - 1))
                seq = first - 1
            out.append(_Numbers(name, seq, min(last, end["seq"])))
            seq = min(last, end["seq"])
        return out

    def read(self, partition: _Numbers) -> Iterator[tuple]:
        if partition.name is None:
            yield partition.after + 1, None, partition.last - partition.after
            return
        store, _ = _store(self.folder)
        with io.TextIOWrapper(store.open_input_file(partition.name), encoding="utf-8", newline="\n") as lines:
            for line in lines:
                event = json.loads(line)
                if partition.after < event["seq"] <= partition.last:
                    yield event["seq"], event["payload"], None

    def commit(self, end: dict) -> None:
        """The log keeps its segments, so that others can replay them."""


class _Whole(DataSourceReader):
    """The log as it stands, for batches."""

    def __init__(self, options: dict):
        self.log = _Log(options)

    def partitions(self) -> list[InputPartition]:
        return self.log.partitions(self.log.initialOffset(), self.log.latestOffset())

    def read(self, partition: _Numbers) -> Iterator[tuple]:
        return self.log.read(partition)


@dataclass
class _Part(WriterCommitMessage):
    name: str
    rows: int
    digest: str


class _Parts(DataSourceWriter):
    """``path``: rows as JSON lines in one file a task, and a manifest that names those that count. ``overwrite`` replaces the manifest,
    otherwise parts are added to it. Two writers at once are not told apart: the later manifest stands."""

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.overwrite, self.run = options["path"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> _Part:
        import hashlib

        store, inner = _store(self.folder)
        store.create_dir(inner, recursive=True)
        # a name for every attempt: what an attempt leaves that is never committed is not in the manifest
        name, rows, digest = f"part-{self.run}-{uuid.uuid4().hex}.jsonl", 0, hashlib.sha256()
        with store.open_output_stream(f"{inner}/{name}") as out:
            for row in iterator:
                line = (json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str) + "\n").encode()
                out.write(line)
                digest.update(line)
                rows += 1
        return _Part(name, rows, digest.hexdigest())

    def commit(self, messages: list[_Part | None]) -> None:
        store, inner = _store(self.folder)
        kept = [] if self.overwrite else published(self.folder)
        parts = kept + [{"name": m.name, "rows": m.rows, "sha256": m.digest} for m in messages if m is not None and m.rows]
        hidden = f"{inner}/_{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as out:
            out.write(json.dumps(parts).encode())
        store.move(hidden, f"{inner}/{MANIFEST}")
        self._sweep({p["name"] for p in parts})

    def abort(self, messages: list[_Part | None]) -> None:
        self._sweep({p["name"] for p in published(self.folder)})

    def _sweep(self, kept: set[str]) -> None:
        """Files of this run that no manifest names."""
        store, _ = _store(self.folder)
        for path in _names(self.folder):
            name = path.rsplit("/", 1)[-1]
            if name.startswith(f"part-{self.run}-") and name not in kept:
                store.delete_file(path)


def published(folder: str) -> list[dict]:
    """name, rows, sha256 of the parts that count."""
    store, inner = _store(folder)
    if f"{inner}/{MANIFEST}" not in _names(folder):
        return []
    with store.open_input_stream(f"{inner}/{MANIFEST}") as source:
        return json.loads(source.read())


class EventLog(DataSource):
    """``format("event_log")`` with ``path``, ``from`` (a number) and ``gaps`` (wait or pass): seq, payload, missing. A row of a gap has the
    first missing number and how many there are. Writes publish parts of JSON lines."""

    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return "seq long, payload string, missing long"

    def reader(self, schema) -> DataSourceReader:
        return _Whole(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Log(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Parts(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    ship(spark)
    spark.dataSource.register(EventLog)


def publish(rows: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Rows as parts of which each counts once, whatever tasks die or run twice."""
    register(rows.sparkSession)
    rows.write.format("event_log").option("path", folder).mode("overwrite" if overwrite else "append").save()


def read_published(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of the parts that count."""
    inner = folder.rstrip("/")
    names = [f"{inner}/{p['name']}" for p in published(folder)]
    return spark.read.schema(schema).json(names) if names else spark.createDataFrame([], schema)
