"""Loader, processor and adapter registries, and a Python data source for generated rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Loader = Callable[..., DataFrame]
LOADERS: dict[str, Loader] = {}


def register_loader(name: str) -> Callable[[Loader], Loader]:
    """Decorator: makes ``load(spark, name, ...)`` find a loader."""

    def add(loader: Loader) -> Loader:
        if name in LOADERS:
            raise ValueError(f"loader {name} exists")
        LOADERS[name] = loader
        return loader

    return add


def load(spark: SparkSession, name: str, *args, **options) -> DataFrame:
    if name not in LOADERS:
        raise ValueError(f"unknown loader {name}; known: {', '.join(sorted(LOADERS))}")
    return LOADERS[name](spark, *args, **options)


for _format in ("parquet", "orc", "json", "csv", "text"):
    register_loader(_format)(lambda spark, path, _f=_format, **options: spark.read.format(_f).options(**options).load(path))


class Plugins:
    """Functions by group and name; an allow-list limits which are active."""

    def __init__(self, allowed: list[str] | None = None):
        self.allowed, self.found = allowed, {}

    def register(self, group: str, name: str, function: Callable) -> None:
        self.found[group, name] = function

    def discover(self, group: str) -> list[str]:
        """Registers the installed entry points of a group that the allow-list names; others are not even loaded."""
        from importlib.metadata import entry_points

        found = [e for e in entry_points(group=group) if self.allowed is None or e.name in self.allowed]
        for e in found:
            self.register(group, e.name, e.load())
        return sorted(e.name for e in found)

    def active(self, group: str) -> dict[str, Callable]:
        return {n: f for (g, n), f in self.found.items() if g == group and (self.allowed is None or n in self.allowed)}

    def register_sql(self, spark: SparkSession, group: str, returns: str) -> list[str]:
        """Makes the group's functions callable from SQL."""
        for name, function in self.active(group).items():
            spark.udf.register(name, function, returns)
        return sorted(self.active(group))


class _Slice(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.rows, self.parts, self.seed = int(options.get("rows", 100)), int(options.get("partitions", 2)), int(options.get("seed", 0))

    def partitions(self) -> list[InputPartition]:
        edges = [self.rows * i // self.parts for i in range(self.parts + 1)]
        return [_Slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        import hashlib

        for i in range(partition.first, partition.last):
            yield i, int.from_bytes(hashlib.sha256(f"{self.seed}:{i}".encode()).digest()[:4], "big") / 2**32


class SeededRows(DataSource):
    """``spark.read.format("seeded_rows")``: id, u (uniform, the same for a seed whatever the partitions)."""

    @classmethod
    def name(cls) -> str:
        return "seeded_rows"

    def schema(self) -> str:
        return "id long, u double"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register_sources(spark: SparkSession) -> None:
    spark.dataSource.register(SeededRows)
