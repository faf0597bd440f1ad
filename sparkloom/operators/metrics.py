"""Request, latency and throughput statistics."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.layout import global_number
from sparkloom.ship import ship

DESCRIBE = (0.25, 0.5, 0.75, 0.9, 0.99, 0.999, 0.9999)


def described(rows: DataFrame, value: str, keys: tuple[str, ...] = (), quantiles: tuple[float, ...] = DESCRIBE) -> DataFrame:
    """count, mean, sample deviation, min, interpolated percentiles, max."""
    v = F.col(value)
    q = [F.percentile(v, F.lit(p)).alias("p" + str(p)[2:]) for p in quantiles]
    return rows.groupBy(*keys).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *q, F.max(v).alias("max"))


def latency_summary(rows: DataFrame, seconds: str, keys: tuple[str, ...] = (), quantiles: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """Mean, population deviation, median and percentiles in milliseconds; 0 where there is nothing."""
    v, zero = F.col(seconds) * 1000, F.lit(0.0)
    q = [F.coalesce(F.percentile(v, F.lit(p)), zero).alias("p" + str(p)[2:] + "_ms") for p in quantiles]
    return rows.groupBy(*keys).agg(F.coalesce(F.avg(v), zero).alias("mean_ms"), F.coalesce(F.stddev_pop(v), zero).alias("std_ms"), F.coalesce(F.percentile(v, F.lit(0.5)), zero).alias("median_ms"), *q)


def tpot(latency: Column, ttft: Column, tokens: Column) -> Column:
    """Time per output token after the first; null for one token."""
    return F.when(tokens > 1, (latency - ttft) / (tokens - 1))


def throughput(rows: DataFrame, duration: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Requests, output tokens and all tokens a second of req, prompt_len, output_tokens."""
    return rows.groupBy(*keys).agg(
        (F.count("*") / duration).alias("requests_s"), (F.sum("output_tokens") / duration).alias("output_s"), (F.sum(F.col("output_tokens") + F.col("prompt_len")) / duration).alias("total_s")
    )


def goodput(rows: DataFrame, limits: dict[str, float], duration: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Requests a second that meet every limit (seconds); a missing measure counts as 0."""
    good = F.lit(True)
    for name, limit in limits.items():
        good = good & (F.coalesce(F.col(name), F.lit(0.0)) <= limit)
    return rows.groupBy(*keys).agg(F.count_if(good).alias("good"), (F.count_if(good) / duration).alias("goodput_s"))


def token_times(rows: DataFrame) -> DataFrame:
    """req, t: arrival of every token from start_time, ttft and the gaps itl."""
    first = F.col("start_time") + F.col("ttft")
    state = "struct<t:double,out:array<double>>"
    ahead = F.aggregate(
        "itl",
        F.struct(first.alias("t"), F.array(first).alias("out")).cast(state),
        lambda a, g: F.struct((a["t"] + g).alias("t"), F.concat(a["out"], F.array(a["t"] + g)).alias("out")).cast(state),
    )["out"]
    return rows.select("req", F.explode(ahead).alias("t"))


def per_second(times: DataFrame, origin: Column) -> DataFrame:
    """second, n: events in each second after the origin."""
    return times.groupBy(F.floor(F.col("t") - origin).cast("long").alias("second")).agg(F.count("*").alias("n"))


def concurrency(rows: DataFrame, origin: Column, start: str = "start", end: str = "end") -> DataFrame:
    """second, n: requests that run in each second, first and last second included."""
    first, last = F.floor(F.col(start) - origin).cast("long"), F.floor(F.col(end) - origin).cast("long")
    return rows.select(F.explode(F.sequence(first, F.greatest(first, last))).alias("second")).groupBy("second").agg(F.count("*").alias("n"))


def bucket_histogram(rows: DataFrame, value: str, bounds: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, le, n: cumulative counts at fixed bounds and infinity, by one aggregate without a join."""
    v = F.col(value)
    counts = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.count_if(v <= b).alias("n")) for b in bounds], F.struct(F.lit(float("inf")).alias("le"), F.count(v).alias("n")))
    return rows.groupBy(*keys).agg(counts.alias("_b")).select(*keys, F.explode("_b").alias("b")).select(*keys, "b.le", "b.n")


def histogram_maps(samples: DataFrame, labels: list[str]) -> DataFrame:
    """labels, buckets map<le, n>, count, sum from rows of labels, le, n and one sum a label set."""
    buckets = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("le").cast("string").alias("k"), F.col("n").alias("v")))))
    return samples.groupBy(*labels).agg(buckets.alias("buckets"), F.max("n").alias("count"))


def positions_vector(rows: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """keys, values: an array by position from 0, missing ones 0."""
    m = F.map_from_entries(F.collect_list(F.struct(position, value)))
    return rows.groupBy(*keys).agg(m.alias("m"), F.max(position).alias("top")).select(*keys, F.transform(F.sequence(F.lit(0), F.col("top").cast("int")), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("values"))


def lifecycle(events: DataFrame) -> DataFrame:
    """Intervals of req, event, ts: queued, prefill, decode, inference and end-to-end seconds."""
    at = {e: F.min(F.when(F.col("event") == e, F.col("ts"))) for e in ("arrived", "queued", "scheduled", "first_token")}
    last = F.max(F.when(F.col("event").isin("first_token", "token", "finished"), F.col("ts")))
    t = events.groupBy("req").agg(*[c.alias(n) for n, c in at.items()], last.alias("last"))
    c = F.col
    return t.select(
        "req",
        (c("scheduled") - c("queued")).alias("queued_s"),
        (c("first_token") - c("scheduled")).alias("prefill_s"),
        (c("last") - c("first_token")).alias("decode_s"),
        (c("last") - c("scheduled")).alias("inference_s"),
        (c("last") - c("arrived")).alias("e2e_s"),
    )


def moving_average(rows: DataFrame, value: str, width: int, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Adds ``moving``: the mean of the last ``width`` values, of fewer at the head."""
    return rows.withColumn("moving", F.avg(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(width - 1), 0)))


def gaps(rows: DataFrame, time: str, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Adds ``gap`` since the previous row; null for the first."""
    return rows.withColumn("gap", F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(*order)))


def running_requests(intervals: DataFrame, keys: tuple[str, ...], bucket_rows: int = 100_000) -> DataFrame:
    """ts, running: requests under way after each start and end; ends come before starts of the same time.

    The time between a key's first and last change is cut into buckets of equal width, about one for each ``bucket_rows`` changes; a window
    sums within a bucket, and one over a row for each bucket what lies before it. Changes crowded into a small part of a key's time share
    a bucket.
    """
    starts = intervals.select(*keys, F.col("start").alias("ts"), F.lit(1).alias("d"))
    both = starts.unionByName(intervals.select(*keys, F.col("end").alias("ts"), F.lit(-1).alias("d"))).groupBy(*keys, "ts").agg(F.sum("d").alias("d"))
    kind = both.schema["ts"].dataType.simpleString()
    t = (F.unix_micros(F.col("ts").cast("timestamp")) if kind.startswith(("timestamp", "date")) else F.col("ts")).cast("double")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    spans = both.groupBy(*named).agg(F.min(t).alias("_low"), F.max(t).alias("_high"), F.ceil(F.count("d") / bucket_rows).alias("_n"))  # of d, so that Spark reads one shuffle twice
    place = F.floor((t - F.col("_low")) * F.col("_n") / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)))
    bucket = F.when(F.col("ts").isNull(), -1).otherwise(F.coalesce(F.least(place, F.col("_n") - 1), F.lit(0)))  # nulls come first
    placed = both.join(spans, same).select(*both.columns, bucket.alias("_b"))
    before = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(*named, F.col("_b").alias("_kb")).agg(F.sum("d").alias("_d")).withColumn("_before", F.coalesce(F.sum("_d").over(before), F.lit(0)))
    within = F.sum("d").over(Window.partitionBy(*keys, "_b").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("_within", within).join(carried, same & (F.col("_b") == F.col("_kb")))
    return out.select(*keys, "ts", (F.col("_within") + F.col("_before")).alias("running"))


def recent_hit_rate(stats: DataFrame, most: int, keys: tuple[str, ...]) -> DataFrame:
    """keys, seq, hit_rate over the latest rows whose requests sum to at most ``most``; the newest row always counts; 0 without queries.

    Rows in order of seq. What lies before the suffix of a row is a running sum over the rows' starts (sums of
    requests) and the points where suffixes begin, merged in one order: a window over twice the rows, no self-join.
    """
    w = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    run = stats.select(*keys, "seq", "requests", "queries", "hits", *[F.sum(c).over(w).alias(f"_{c}") for c in ("requests", "queries", "hits")])
    start, begin = F.col("_requests") - F.col("requests"), F.col("_requests") - most
    place = F.explode(F.array(F.struct(start.alias("x"), F.lit(1).alias("row")), F.struct(begin.alias("x"), F.lit(0).alias("row"))))
    merged = run.select("*", start.alias("_start"), place.alias("_p")).select("*", "_p.x", "_p.row")
    before = Window.partitionBy(*keys).orderBy("x", "row").rowsBetween(Window.unboundedPreceding, 0)
    gone = {c: F.coalesce(F.sum(F.when(F.col("row") == 1, F.col(c))).over(before), F.lit(0)) for c in ("queries", "hits")}
    asked = merged.select("*", *[g.alias(f"_gone_{c}") for c, g in gone.items()]).filter("row = 0")
    alone = F.col("_start") < F.col("x")
    queries, hits = [F.when(alone, F.col(c)).otherwise(F.col(f"_{c}") - F.col(f"_gone_{c}")) for c in ("queries", "hits")]
    return asked.select(*keys, "seq", F.when(queries > 0, hits / queries).otherwise(0.0).alias("hit_rate"))


def warmup_cutoffs(rows: DataFrame, percentages: list[float], span: float = 1000.0) -> DataFrame:
    """pct, n, runtime_s, mean latency of the rows left after the first share of them (in order of start_ms).

    Rows are numbered by spans of start time, so that no window holds them all.
    """
    spans = rows.withColumn("_span", F.floor(F.col("start_ms") / span))
    numbered = global_number(spans, ["start_ms", "req"], "_span").withColumnRenamed("number", "_n")
    total = rows.agg(F.count("*").alias("_all"))
    cut = numbered.crossJoin(F.broadcast(total)).withColumn("pct", F.explode(F.array(*[F.lit(float(p)) for p in percentages]))).filter(F.col("_n") > F.floor(F.col("pct") * F.col("_all")))
    return cut.groupBy("pct").agg(
        F.count("*").alias("n"), ((F.max_by(F.col("start_ms") + F.col("latency_ms"), "_n") - F.min_by("start_ms", "_n")) / 1000).alias("runtime_s"), F.avg("latency_ms").alias("mean_ms")
    )


def acceptance(rows: DataFrame, positions: int) -> DataFrame:
    """Speculation statistics of rows drafts, draft_tokens, accepted: rate in percent, mean length, rate at each position."""
    return rows.agg(
        (F.sum("accepted") * 100 / F.nullif(F.sum("draft_tokens"), F.lit(0))).alias("rate"),
        (1 + F.sum("accepted") / F.nullif(F.count("*"), F.lit(0))).alias("mean_length"),
        F.array(*[F.count_if(F.col("accepted") > p) / F.nullif(F.count("*"), F.lit(0)) for p in range(positions)]).alias("by_position"),
    )


def accuracy(rows: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Share of equal answers and of missing ones."""
    p, e = F.col(predicted), F.col(expected)
    return rows.agg(F.avg(F.coalesce(p == e, F.lit(False)).cast("double")).alias("accuracy"), F.avg(p.isNull().cast("double")).alias("invalid"))


def character_errors(rows: DataFrame, text: str, truth: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean edit distance and character error rate; samples without truth have no rate."""
    d = F.levenshtein(text, truth)
    return rows.groupBy(*keys).agg(F.avg(d.cast("double")).alias("edit_distance"), F.avg(d / F.nullif(F.length(truth), F.lit(0))).alias("cer"))


def line_straightness(points: DataFrame) -> DataFrame:
    """sample, direction, deviation: mean over lines of the deviation across the line."""
    by_line = points.groupBy("sample", "direction", "line").agg(F.stddev_pop("across").alias("d"))
    return by_line.groupBy("sample", "direction").agg(F.avg("d").alias("deviation"))


#: Weights of five levels of structural similarity.
SSIM_WEIGHTS = (0.0448, 0.2856, 0.3001, 0.2363, 0.1333)


def multi_scale_similarity(levels: DataFrame) -> DataFrame:
    """sample, ms_ssim: weighted sum of per-level similarities (level 1 to 5)."""
    weight = F.element_at(F.array(*[F.lit(w) for w in SSIM_WEIGHTS]), F.col("level"))
    return levels.groupBy("sample").agg(F.sum(F.col("ssim") * weight).alias("ms_ssim"))


def local_distortion(flow: DataFrame) -> DataFrame:
    """sample, ld: mean length of flow vectors."""
    return flow.groupBy("sample").agg(F.avg(F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy"))).alias("ld"))


#: The Gaussian window of local moments (deviation, reach), the constants, and the kernel that halves an image.
SSIM_DEVIATION, SSIM_REACH, SSIM_CONSTANTS = 1.5, 5, (0.01, 0.03)
HALVING = (0.0625, 0.25, 0.375, 0.25, 0.0625)


def _along_both(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """An image weighed by a kernel along its rows and then its columns; its edges go on outside."""
    reach = len(kernel) // 2
    for axis in (0, 1):
        padded = np.pad(image, [(reach, reach) if i == axis else (0, 0) for i in (0, 1)], mode="edge")
        image = np.lib.stride_tricks.sliding_window_view(padded, len(kernel), axis=axis) @ kernel
    return image


def structural_similarity(a: np.ndarray, b: np.ndarray, span: float) -> float:
    """The mean over pixels of the similarity of local means, variances and covariance."""
    at = np.arange(-SSIM_REACH, SSIM_REACH + 1)
    window = np.exp(-(at**2) / (2 * SSIM_DEVIATION**2))
    window /= window.sum()
    c1, c2 = ((k * span) ** 2 for k in SSIM_CONSTANTS)
    ma, mb = _along_both(a, window), _along_both(b, window)
    va, vb, cab = _along_both(a * a, window) - ma * ma, _along_both(b * b, window) - mb * mb, _along_both(a * b, window) - ma * mb
    return float(np.mean((2 * ma * mb + c1) * (2 * cab + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))))


def halved(image: np.ndarray) -> np.ndarray:
    """Every second pixel of every second row of a smoothed image."""
    return _along_both(image, np.asarray(HALVING))[::2, ::2]


def pixel_similarity(image: Column, reference: Column, span: float = 1.0) -> Column:
    """struct<ms_ssim, levels>: similarity of two images of equal size (rows of grey values) on each level of a pyramid that halves them, and
    their weighted sum. Null for null, for images of no or unequal size, and for values that are null."""

    def compare(images: pa.Array, references: pa.Array) -> pa.Array:
        out = []
        for pair in zip(images.to_pylist(), references.to_pylist(), strict=True):
            same = all(pair) and [len(r or ()) for r in pair[0]] == [len(r or ()) for r in pair[1]] and len({len(r or ()) for r in pair[0]}) == 1 and pair[0][0]
            if not same or any(x is None for image in pair for row in image for x in row):
                out.append(None)
                continue
            a, b = (np.asarray(image, float) for image in pair)
            levels = []
            for _ in SSIM_WEIGHTS:
                levels.append(structural_similarity(a, b, span))
                a, b = halved(a), halved(b)
            out.append({"ms_ssim": sum(w * x for w, x in zip(SSIM_WEIGHTS, levels, strict=True)), "levels": levels})
        return pa.array(out, pa.struct([("ms_ssim", pa.float64()), ("levels", pa.list_(pa.float64()))]))

    ship()
    kind = "array<array<double>>"
    return F.arrow_udf(compare, "ms_ssim double, levels array<double>")(image.cast(kind), reference.cast(kind))


#: A quantile sketch's size: its ranks are within about 1.65 / k^0.9 of the truth, so within 0.3 % for 800.
SKETCH_K = 800
#: Bits of the address of a distinct-count sketch: a relative error of about 1.04 / 2^7, 0.8 %.
SKETCH_BITS = 14


def sketched(rows: DataFrame, value: str, keys: tuple[str, ...] = (), member: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """keys, n, total, quantiles and, with ``member``, members: a row of mergeable sketches for each key, of bounded size whatever the
    rows. Write it by run or hour, and merge what is asked for. Null values and members are not counted."""
    kept = F.col(value).cast("double")
    out = [F.count(kept).alias("n"), F.sum(kept).alias("total"), F.kll_sketch_agg_double(kept, k).alias("quantiles")]
    return rows.groupBy(*keys).agg(*out, *([F.hll_sketch_agg(member, SKETCH_BITS).alias("members")] if member else []))


def merged_sketches(sketches: DataFrame, keys: tuple[str, ...] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches of many rows as one row for each key: of runs, hours or finer keys."""
    out = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("quantiles", k).alias("quantiles")]
    return sketches.groupBy(*keys).agg(*out, *([F.hll_union_agg("members", False).alias("members")] if "members" in sketches.columns else []))


def described_sketches(sketches: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9, 0.99, 0.999)) -> DataFrame:
    """The sketches' keys, n, mean, one column for each rank (p5, p999, ...) and the number of members. No rows give null."""
    own = [c for c in sketches.columns if c not in ("n", "total", "quantiles", "members")]
    some = F.col("n") > 0
    quantiles = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(r))).alias("p" + str(r)[2:]) for r in ranks]
    more = [F.hll_sketch_estimate("members").alias("members")] if "members" in sketches.columns else []
    return sketches.select(*own, "n", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"), *quantiles, *more)
