"""Synthetic columns from seeded hashes: the same row gets the same value in every run and partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def uniform01(key: Column, seed: int) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def uniform(key: Column, low: int, high: int, seed: int) -> Column:
    """Integers from low to high, both included."""
    return (low + F.floor(uniform01(key, seed) * (high - low + 1))).cast("int")


def constant(value: float) -> Column:
    return F.lit(value)


def lognormal(key: Column, mean: float, sigma: float, seed: int, most: float | None = None) -> Column:
    """exp(N(mean, sigma)) by Box-Muller, at most ``most``."""
    z = F.sqrt(-2 * F.log(uniform01(key, seed))) * F.cos(2 * np.pi * uniform01(key, seed + 1))
    out = F.exp(mean + sigma * z)
    return out if most is None else F.least(out, F.lit(most))


def _by_uniform(function):
    @F.pandas_udf("long")
    def run(u: pd.Series) -> pd.Series:
        return pd.Series(function(u.to_numpy()))

    return run


def zipf(key: Column, alpha: float, most: int, seed: int) -> Column:
    """Zipf numbers from 1 to ``most`` by the inverse of their distribution (a table of ``most`` entries)."""
    weights = np.arange(1, most + 1, dtype=float) ** -alpha
    steps = np.cumsum(weights) / weights.sum()
    return _by_uniform(lambda u: np.searchsorted(steps, u) + 1)(uniform01(key, seed))


def poisson(key: Column, mean: float, most: int, seed: int) -> Column:
    """Poisson numbers from 0 to ``most`` by inversion."""
    n = np.arange(most + 1)
    logs = n * np.log(mean) - mean - np.cumsum(np.log(np.maximum(n, 1)))
    steps = np.cumsum(np.exp(logs))
    return _by_uniform(lambda u: np.minimum(np.searchsorted(steps, u * steps[-1]), most))(uniform01(key, seed))


def gamma_gaps(rows: DataFrame, rate: float, burstiness: float, seed: int, key: str = "req") -> DataFrame:
    """Adds ``gap``: gamma gaps of mean 1/rate; burstiness 1 is a Poisson process."""
    schema = T.StructType([*rows.schema.fields, T.StructField("gap", T.DoubleType())])

    def draw(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(gap=[np.random.default_rng([seed, int(k)]).gamma(burstiness, 1 / (rate * burstiness)) for k in part[key]])

    return rows.mapInPandas(draw, schema)


def arrivals(rows: DataFrame, total: float | None = None, key: str = "req") -> DataFrame:
    """Adds ``arrival``: the running sum of gaps, rescaled so that the last arrives at ``total``. One stream is one order."""
    w = Window.partitionBy("stream").orderBy(key)
    out = rows.withColumn("arrival", F.sum("gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if total is not None:
        out = out.withColumn("arrival", F.col("arrival") * total / F.max("arrival").over(Window.partitionBy("stream")))
    return out


def ramped_rate(progress: Column, first: float, last: float, strategy: str) -> Column:
    """Request rate at a progress of 0 to 1, linear or exponential."""
    if strategy == "linear":
        return first + (last - first) * progress
    return first * F.pow(F.lit(last / first), progress)
