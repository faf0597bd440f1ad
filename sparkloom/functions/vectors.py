"""Vectors as arrays of doubles: similarity, normalisation, pooling, activation."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.ship import ship

EPS = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; norms below 1e-8 count as 1e-8."""
    return dot(a, b) / (F.greatest(norm(a), F.lit(EPS)) * F.greatest(norm(b), F.lit(EPS)))


def normalised(a: Column) -> Column:
    """Unit length; a vector shorter than 1e-12 is divided by that."""
    length = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(F.arrays_zip(a.alias("v"), F.array_repeat(length, F.size(a)).alias("n")), lambda x: x["v"].cast("double") / x["n"])


def truncated(a: Column, dimensions: int, unit: bool = True) -> Column:
    """The first dimensions, then unit length."""
    out = F.slice(a, 1, dimensions)
    return normalised(out) if unit else out


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax(a: Column) -> Column:
    top = F.array_max(a)
    total = F.aggregate(F.transform(a, lambda x: F.exp(x.cast("double") - top)), F.lit(0.0), lambda s, x: s + x)
    return F.transform(a, lambda x: F.exp(x.cast("double") - top) / total)


def classified(logits: Column, labels: int) -> Column:
    """Sigmoid for fewer than two labels, softmax otherwise."""
    return F.transform(logits, lambda x: sigmoid(x.cast("double"))) if labels < 2 else softmax(logits)


def first_token(states: Column) -> Column:
    return F.element_at(states, 1)


def last_token(states: Column) -> Column:
    return F.element_at(states, -1)


def mean_pooled(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key, vector: the mean of a group's vectors, dimension by dimension."""
    parts = rows.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias(vector))


#: Zero crossings of the windowed sinc on each side, and the share of the smaller Nyquist rate that it passes.
CROSSINGS = 6
ROLLOFF = 0.99


def sinc_bank(rate: int, target: int, crossings: int = CROSSINGS, rolloff: float = ROLLOFF) -> tuple[np.ndarray, int]:
    """A polyphase bank for coprime rates: row r weighs the samples from ``reach`` before a block of ``rate`` samples on for the r-th of
    its ``target`` outputs. The weights are a sinc that cuts off below the smaller Nyquist rate, under a squared cosine."""
    cut = min(rate, target) * rolloff
    reach = math.ceil(crossings * rate / cut)
    place = np.arange(-reach, reach + rate) / rate - np.arange(target)[:, None] / target
    t = np.clip(place * cut, -crossings, crossings)
    return np.sinc(t) * np.cos(t * np.pi / crossings / 2) ** 2 * cut / rate, reach


def band_limited(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Samples at another rate without what the new rate cannot hold; silence lies around them."""
    common = math.gcd(rate, target)
    rate, target = rate // common, target // common
    bank, reach = sinc_bank(rate, target)
    blocks = len(samples) // rate + 1
    padded = np.concatenate([np.zeros(reach), samples, np.zeros(reach + 2 * rate)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, bank.shape[1])[::rate][:blocks]
    return (windows @ bank.T).ravel()[: -(-len(samples) * target // rate)]


def _filtered(rate: int, target: int, mixed: bool):
    """Each row's channels at another rate, as their mean if ``mixed``. Null samples are silence."""

    def one(channels: list | None) -> list | None:
        if channels is None:
            return None
        arrays = [np.asarray([0.0 if x is None else x for x in c or ()]) for c in channels]
        out = [a if rate == target else band_limited(a, rate, target) for a in arrays]
        return np.mean(out, axis=0) if out else np.zeros(0)

    def each(rows: pa.Array) -> pa.Array:
        return pa.array([one(r if mixed or r is None else [r]) for r in rows.to_pylist()], pa.list_(pa.float64()))

    ship()
    return F.arrow_udf(each, "array<double>")


def band_limited_samples(samples: Column, rate: int, target: int = 16_000) -> Column:
    """Samples at another rate by a polyphase windowed-sinc filter: what the new rate cannot hold is gone instead of folded."""
    return _filtered(rate, target, False)(samples.cast("array<double>"))


def waveform(channels: Column, rate: int, target: int = 16_000) -> Column:
    """Channels of equal length, band-limited to another rate and mixed to one."""
    return _filtered(rate, target, True)(channels.cast("array<array<double>>"))


def resampled(samples: Column, rate: int, target: int = 16_000) -> Column:
    """Samples at another rate, linear between neighbours; the last one holds to the end. A column expression, for previews: it folds
    what lies above the new rate's limit, which ``band_limited_samples`` does not."""
    n = F.size(samples)

    def at(i: Column) -> Column:
        place = i * rate / target
        j = F.floor(place).cast("int")
        left, right = F.get(samples, F.least(j, n - 1)).cast("double"), F.get(samples, F.least(j + 1, n - 1)).cast("double")
        return left + (right - left) * (place - j)

    if rate == target:
        return samples.cast("array<double>")
    count = F.ceil(n * target / rate).cast("int")
    return F.when(n == 0, F.array().cast("array<double>")).otherwise(F.transform(F.sequence(F.lit(0), count - 1), at))


def mono(channels: Column) -> Column:
    """The mean of channels of equal length."""
    n = F.size(channels)
    total = F.aggregate(F.slice(channels, 2, F.greatest(n - 1, F.lit(0))), channels[0].cast("array<double>"), lambda acc, c: F.zip_with(acc, c, lambda x, y: x + y.cast("double")))
    return F.transform(total, lambda x: x / n)
