"""Content types, the event log, published parts, state that ends, sketches, band-limited samples, images, bucketed as-of joins."""

from __future__ import annotations

import datetime as dt
import io
import json
import math
import os
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import vectors
from sparkloom.operators import metrics, relational
from sparkloom.sources import content, event_log
from sparkloom.streaming import state

# ---------------------------------------------------------------- content


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members:
            z.writestr(name, body, zipfile.ZIP_STORED)
    return out.getvalue()


FILES = {
    "application/pdf": b"%PDF-1.7\n",
    "image/png": b"\x89PNG\r\n\x1a\n\0\0",
    "image/jpeg": b"\xff\xd8\xff\xe0\0\x10JFIF",
    "image/gif": b"GIF89a\1\0",
    "image/bmp": b"BM\x46\0\0\0\0\0\0\0\x36\0\0\0\x28\0\0\0",
    "image/tiff": b"II*\0\x08\0\0\0",
    "image/webp": b"RIFF\x10\0\0\0WEBPVP8 ",
    "audio/x-wav": b"RIFF\x24\0\0\0WAVEfmt ",
    "video/x-msvideo": b"RIFF\x24\0\0\0AVI LIST",
    "audio/mpeg": b"ID3\4\0\0\0",
    "audio/flac": b"fLaC\0\0\0\x22",
    "video/mp4": b"\0\0\0\x20ftypisom\0\0\2\0",
    "audio/mp4": b"\0\0\0\x20ftypM4A \0\0\2\0",
    "application/zip": zipped(("a.txt", "x")),
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": zipped(("[Content_Types].xml", "<x/>"), ("word/document.xml", "<w/>")),
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": zipped(("[Content_Types].xml", "<x/>"), ("xl/workbook.xml", "<w/>")),
    "application/epub+zip": zipped(("mimetype", "application/epub+zip"), ("META-INF/container.xml", "<c/>")),
    "application/msword": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 600 + "WordDocument".encode("utf-16le"),
    "application/gzip": b"\x1f\x8b\x08\0",
    "application/x-tar": b"name".ljust(257, b"\0") + b"ustar\0",
    "application/json": b' {"a": 1}',
    "text/html": b"<!DOCTYPE html><html>",
    "text/xml": b'<?xml version="1.0"?><a/>',
    "text/plain": b"BMW and other words",
    "application/octet-stream": b"\0\1\2\3words",
    "inode/x-empty": b"",
}


def test_files_with_wrong_suffixes_are_told_apart(spark, tmp_path):
    for i, (kind, body) in enumerate(FILES.items()):
        (tmp_path / f"{i:02d}.{random.Random(i).choice(['pdf', 'txt', 'png'])}").write_bytes(body)
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content").orderBy("path")
    by_path = content.content_types(files.select("path")).orderBy("path").collect()
    assert [r.mime_type for r in by_path] == list(FILES)[:-1]  # Spark lists no empty files
    got = files.select(content.content_type(F.col("content")).alias("k")).collect()
    assert [r.k.mime_type for r in got] == list(FILES)[:-1] and content.sniff(b"")["mime_type"] == list(FILES)[-1]
    missing = content.content_types(spark.createDataFrame([("file:/no/such/file",), (None,)], "path string")).collect()
    assert [r.mime_type for r in missing] == [None, None]


@pytest.mark.parametrize(
    ("body", "kind", "encoding"),
    [
        ("é".encode(), "text/plain", "utf-8"),
        ("é".encode("latin-1"), "text/plain", "unknown-8bit"),
        (b"plain", "text/plain", "us-ascii"),
        ("﻿{}".encode("utf-16le"), "application/json", "utf-16le"),
        (("a" * (content.HEAD - 1) + "é").encode(), "text/plain", "utf-8"),
        (b"[link] to", "text/plain", "us-ascii"),
        (b"[1, 2]", "application/json", "us-ascii"),
    ],
)
def test_texts_and_encodings(body, kind, encoding):
    assert content.sniff(body) == {"mime_type": kind, "mime_encoding": encoding}


def test_only_the_head_is_read(tmp_path, spark, monkeypatch):
    (tmp_path / "big").write_bytes(b"%PDF-1.4" + os.urandom(3_000_000))
    assert content.content_types(spark.createDataFrame([(str(tmp_path / "big"),)], "path string")).first().mime_type == "application/pdf"
    assert content.sniff(b"x" * 10 * content.HEAD + b"\0") == {"mime_type": "text/plain", "mime_encoding": "us-ascii"}


# ---------------------------------------------------------------- the event log


def run(spark, log, out, checkpoint, **options):
    rows = spark.readStream.format("event_log").options(path=log, **options).load()
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted((r.seq, r.payload, r.missing) for r in spark.read.schema("seq long, payload string, missing long").parquet(out).collect())


def test_a_restarted_stream_reads_each_number_once(spark, tmp_path):
    event_log.register(spark)
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    event_log.append_events(log, 0, ["a", "b", "c"])
    assert [r[0] for r in run(spark, log, out, checkpoint)] == [0, 1, 2]
    event_log.append_events(log, 3, ["d"])
    event_log.append_events(log, 2, ["c", "d", "é"])  # a writer that died has sent two of them before
    event_log.append_events(log, 8, ["late"])
    assert [r[:2] for r in run(spark, log, out, checkpoint)] == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "é")]  # waits before the gap
    event_log.append_events(log, 5, ["f", "g", "h"])
    assert [r[0] for r in run(spark, log, out, checkpoint)] == list(range(9))
    assert [r[0] for r in run(spark, log, str(tmp_path / "replayed"), str(tmp_path / "c2"), **{"from": 6})] == [6, 7, 8]
    assert [r.seq for r in spark.read.format("event_log").options(path=log, **{"from": 7}).load().orderBy("seq").collect()] == [7, 8]


def test_gaps_that_are_passed_are_rows(spark, tmp_path):
    event_log.register(spark)
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    event_log.append_events(log, 0, ["a"])
    event_log.append_events(log, 4, ["e"])
    assert run(spark, log, out, checkpoint, gaps="pass") == [(0, "a", None), (1, None, 3), (4, "e", None)]


def test_parts_of_tasks_that_run_twice_count_once(spark, tmp_path):
    """Every task's first attempt dies after it has written its rows; local mode retries none, so the attempts are driven by hand."""
    folder = str(tmp_path / "sink")
    writer = event_log._Parts({"path": folder}, False)
    some = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "i long, t string").collect()

    def dies():
        yield from some[:2]
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    speculative = writer.write(iter(some[:3]))
    messages = [writer.write(iter(some[:3])), writer.write(iter(some[3:])), None]
    writer.commit(messages)
    got = event_log.read_published(spark, folder, "i long, t string")
    assert sorted(r.i for r in got.collect()) == list(range(6))
    left = {n for n in os.listdir(folder) if n.endswith(".jsonl") and not n.startswith(".")}
    assert left == {p["name"] for p in event_log.published(folder)} and speculative.name not in left


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    folder = str(tmp_path / "sink")
    good = spark.range(10).select(F.col("id").alias("i"), F.lit("x").alias("t")).repartition(3)
    event_log.publish(good, folder)
    before = event_log.published(folder)
    bad = good.withColumn("t", F.when(F.col("i") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="broken"):
        event_log.publish(bad, folder)
    assert event_log.published(folder) == before and sum(p["rows"] for p in before) == 10
    event_log.publish(good, folder)
    assert event_log.read_published(spark, folder, "i long, t string").count() == 20
    event_log.publish(good.filter("i < 2"), folder, overwrite=True)
    assert event_log.read_published(spark, folder, "i long, t string").count() == 2
    assert json.loads((tmp_path / "sink" / event_log.MANIFEST).read_text()) == event_log.published(folder)


# ---------------------------------------------------------------- state that ends


def test_state_goes_with_quiet_keys(spark, tmp_path):
    own = spark.newSession()
    state.use_list_state(own)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    schema = "cache long, seq long, requests long, queries long, hits long, ts timestamp"
    start = dt.datetime(2024, 1, 1)
    sizes, rates = [], {}

    def feed(rows):
        own.createDataFrame([(c, s, 1, q, h, start + dt.timedelta(minutes=m)) for c, s, q, h, m in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = state.expiring_hit_rate(own.readStream.schema(schema).parquet(str(tmp_path / "in")), 2, 60_000, "0 seconds")
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
        rates.update({(r.cache, r.seq): r.hit_rate for r in own.read.parquet(str(tmp_path / "out")).collect()})

    feed([(c, s, 10, c, s) for c in range(5) for s in range(3)])
    held = sizes[-1]
    feed([(9, 0, 4, 1, 100)])  # the watermark passes the others' quiet time in the batch after this
    feed([(9, 1, 4, 3, 200)])
    feed([(9, 2, 0, 0, 300)])
    assert held >= 5 and sizes[-1] <= 1, sizes  # a list counts as one row; the five quiet ones have none
    assert rates[3, 2] == pytest.approx(0.3) and rates[9, 0] == 0.25
    assert rates[9, 1] == 0.75  # what was before has gone


# ---------------------------------------------------------------- sketches


def test_merged_sketches_stay_near_the_truth(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("model"), (F.col("id") % 7).alias("run"), (F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 1000).alias("v"), (F.col("id") % 900).alias("who"))
    rows = rows.unionByName(spark.createDataFrame([(9, 0, None, None)], rows.schema))
    by_run = metrics.sketched(rows, "v", ("model", "run"), "who")
    told = {r.model: r for r in metrics.described_sketches(metrics.merged_sketches(by_run, ("model",))).collect()}
    for model in range(3):
        values = np.sort([r.v for r in rows.filter(F.col("model") == model).collect()])
        assert told[model].n == len(values) and told[model]["mean"] == pytest.approx(values.mean())
        for name, rank in (("p25", 0.25), ("p5", 0.5), ("p99", 0.99), ("p999", 0.999)):
            assert abs(np.searchsorted(values, told[model][name]) / len(values) - rank) < 0.006
        assert abs(told[model].members - 300) <= 9
    assert told[9].n == 0 and told[9].p5 is None and told[9]["mean"] is None
    assert by_run.agg(F.max(F.length("quantiles"))).first()[0] < 40_000


# ---------------------------------------------------------------- samples and images


def tone(hertz, rate, seconds=0.2):
    return np.sin(2 * np.pi * hertz * np.arange(int(rate * seconds)) / rate)


def test_band_limited_samples_keep_low_tones_and_drop_high_ones(spark):
    low, high = tone(1000, 44_100), tone(11_000, 44_100)
    rows = spark.createDataFrame([(0, low.tolist()), (1, high.tolist()), (2, []), (3, None)], "i int, x array<double>")
    got = {r.i: r.y for r in rows.select("i", vectors.band_limited_samples(F.col("x"), 44_100).alias("y")).collect()}
    want = tone(1000, 16_000)
    assert len(got[0]) == len(want) == 3200
    assert np.abs(np.asarray(got[0])[50:-50] - want[50:-50]).max() < 0.01
    assert np.abs(np.asarray(got[1])[50:-50]).max() < 0.01
    assert np.abs(np.asarray([r.y for r in rows.filter("i = 1").select(vectors.resampled(F.col("x"), 44_100).alias("y")).collect()][0])).max() > 0.5  # which aliases
    assert got[2] == [] and got[3] is None


def test_band_limited_equals_a_double_loop():
    rng = np.random.default_rng(1)
    for rate, target, n in ((3, 2, 50), (2, 3, 41), (441, 160, 900), (1, 2, 7)):
        x, cut = rng.normal(size=n), min(rate, target) * 0.99
        want = []
        for m in range(-(-n * target // rate)):
            total = 0.0
            for j in range(n):
                t = (j / rate - m / target) * cut
                if abs(t) < 6:
                    total += x[j] * (1.0 if t == 0 else math.sin(math.pi * t) / (math.pi * t)) * math.cos(t * math.pi / 12) ** 2 * cut / rate
            want.append(total)
        assert np.allclose(vectors.band_limited(x, rate * 100, target * 100), want, atol=1e-9)


def test_waveform_mixes_channels(spark):
    rows = spark.createDataFrame([([[1.0, 2.0, None], [3.0, 4.0, 0.0]],), (None,), ([],)], "c array<array<double>>")
    assert [r.y for r in rows.select(vectors.waveform(F.col("c"), 16_000).alias("y")).collect()] == [[2.0, 3.0, 0.0], None, []]


def plain_similarity(a, b, span):
    h, w = len(a), len(a[0])
    weight = [[math.exp(-(i * i + j * j) / 4.5) for j in range(-5, 6)] for i in range(-5, 6)]
    total = sum(map(sum, weight))
    c1, c2, out = (0.01 * span) ** 2, (0.03 * span) ** 2, 0.0
    for y in range(h):
        for x in range(w):
            s = [0.0] * 5
            for i in range(-5, 6):
                for j in range(-5, 6):
                    p, q = (m[min(max(y + i, 0), h - 1)][min(max(x + j, 0), w - 1)] for m in (a, b))
                    k = weight[i + 5][j + 5] / total
                    s = [o + k * v for o, v in zip(s, (p, q, p * p, q * q, p * q), strict=True)]
            ma, mb, va, vb, cab = s[0], s[1], s[2] - s[0] ** 2, s[3] - s[1] ** 2, s[4] - s[0] * s[1]
            out += (2 * ma * mb + c1) * (2 * cab + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return out / h / w


def plain_half(a):
    k, h, w = [0.0625, 0.25, 0.375, 0.25, 0.0625], len(a), len(a[0])
    return [[sum(k[i + 2] * k[j + 2] * a[min(max(y + i, 0), h - 1)][min(max(x + j, 0), w - 1)] for i in range(-2, 3) for j in range(-2, 3)) for x in range(0, w, 2)] for y in range(0, h, 2)]


def test_similarity_equals_a_double_loop(spark):
    rng = random.Random(3)
    pairs = []
    for h, w in ((9, 12), (6, 5), (1, 1)):
        a = [[rng.random() for _ in range(w)] for _ in range(h)]
        pairs.append((a, [[min(1.0, max(0.0, v + rng.uniform(-0.2, 0.2))) for v in row] for row in a]))
    odd = [(None, [[1.0]]), ([], []), ([[1.0]], [[1.0, 2.0]]), ([[None]], [[1.0]]), ([[1.0], [1.0, 2.0]], [[1.0], [1.0, 2.0]])]
    rows = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs + odd)], "a array<array<double>>, b array<array<double>>, i int").orderBy("i")
    got = [r.s for r in rows.select(metrics.pixel_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    for (a, b), s in zip(pairs, got, strict=False):
        levels = []
        for _ in range(5):
            levels.append(plain_similarity(a, b, 1.0))
            a, b = plain_half(a), plain_half(b)
        assert s.levels == pytest.approx(levels) and s.ms_ssim == pytest.approx(sum(x * y for x, y in zip(metrics.SSIM_WEIGHTS, levels, strict=True)))
    assert got[len(pairs) :] == [None] * len(odd)


# ---------------------------------------------------------------- as-of


@pytest.mark.parametrize("bucket_rows", [1, 7, 1000])
def test_bucketed_asof_join_equals_one_window(spark, bucket_rows):
    rng = random.Random(4)
    left = [(rng.choice([1, 1, 1, 2, None]), rng.choice([*range(60), None]), i) for i in range(200)]
    right = [(rng.choice([1, 1, 2, 3, None]), rng.choice(range(60)), rng.choice([None, *range(9)]), f"v{i}") for i in range(80)]
    seen = {}
    right = [r for r in right if not (r[:2] in seen or seen.update({r[:2]: 1}))]  # one value for an instant
    a = spark.createDataFrame(left, "k int, t int, id int")
    b = spark.createDataFrame(right, "k int, t int, x int, y string")
    got = {r.id: (r.x, r.y) for r in relational.bucketed_asof_join(a, b, "k", "t", ["x", "y"], bucket_rows).collect()}
    for k, t, i in left:
        own = sorted((r for r in right if k is not None and t is not None and r[0] == k and r[1] <= t), key=lambda r: r[1])
        assert got[i] == (next((r[2] for r in reversed(own) if r[2] is not None), None), own[-1][3] if own else None)
    stamped = [df.withColumn("t", F.timestamp_seconds("t")) for df in (a, b)]
    assert {r.id: (r.x, r.y) for r in relational.bucketed_asof_join(*stamped, "k", "t", ["x", "y"], bucket_rows).collect()} == got


def test_a_hot_key_is_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    joined = relational.bucketed_asof_join(rows, rows.select("k", "t", F.col("t").alias("v")), "k", "t", ["v"], 2000)
    assert joined.filter("v <> t").count() == 0 and joined.count() == 20_000


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_overlap_join_equals_all_pairs(spark, width):
    rng = random.Random(5)

    def made(n):
        return [(rng.choice([1, 2, None]), rng.choice([None, *range(-20, 20)]), rng.choice([None, *range(-20, 25)]), i) for i in range(n)]

    left, right = made(60), made(60)
    a, b = (spark.createDataFrame(r, "k int, s int, e int, id int") for r in (left, right))
    got = sorted((r.id, r.right_id) for r in relational.overlap_join(a, b, ["k"], "s", "e", width).collect())
    whole = lambda r: r[0] is not None and r[1] is not None and r[2] is not None and r[1] < r[2]
    assert got == sorted((x[3], y[3]) for x in left for y in right if whole(x) and whole(y) and x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
