from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import common, exact_dedup, mixing, packing, panes, registry, resampling, simhash, suffix_dedup, token_counts

from .conftest import SCHEMA, frame

# ---------------------------------------------------------------- importance resampling


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, most):
    w = plain_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def plain_resample(docs, target, most, buckets, least, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in plain_features(text, most):
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        own = [gain[bucket(f)] for f in plain_features(text, most)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= least])
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[2], -r[1]))
    n = percent * len(drawn) // 100
    return sorted(((*r[:4], None) for r in [*drawn[n:], *(r for r in rows if not r[4])]), key=repr), [(*r[:4], k + 1) for k, r in enumerate(drawn[:n])]


@pytest.mark.parametrize(("most", "percent"), [(1, 10), (3, 40)])
def test_resampling_equals_a_plain_version(spark, words, odd_rows, most, percent):
    rng = random.Random(5)
    docs = [(r[0], r[1]) for r in odd_rows] + [(2000 + i, "Ünïcode WORD-" + " ".join(rng.choices(words, k=30)) + "_x" * 60) for i in range(40)]
    docs += [(None, "no id " + " ".join(words[:25]))] * 3 + [(7777, " ".join(words[:25]))] * 4
    target = [" ".join(rng.choices(words[:50], k=40)) for _ in range(5)] + [None, ""]
    got = resampling.resample(frame(spark, [(i, t, "a") for i, t in docs]), spark.createDataFrame([(t,) for t in target], "text string"), most, 997, 20, percent).collect()
    rest, drawn = plain_resample(docs, target, most, 997, 20, percent)
    assert sorted((tuple(r) for r in got if r.rank is None), key=repr) == rest
    assert sorted((tuple(r) for r in got if r.rank is not None), key=lambda r: r[4]) == drawn


def test_crcs_of_joined_runs(words):
    texts = pa.array([b"", " ".join(words[:40]).encode(), ("é" * 50 + " Z9 " + "q" * 300).encode(), b"ab", b"ab cd"], pa.binary())
    for n, (crcs, edges) in enumerate(resampling.feature_crcs(texts, 4), 1):
        want = [[zlib.crc32(" ".join(w[i : i + n]).encode()) for i in range(len(w) - n + 1)] for w in (plain_words(t.decode()) for t in texts.to_pylist())]
        assert [crcs[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == want


def test_resampling_of_no_rows(spark):
    none = frame(spark, [])
    assert resampling.resample(none, none).collect() == []
    assert [tuple(r) for r in resampling.resample(frame(spark, [(1, None, "a")]), none).select("n_features", "weight", "rank").collect()] == [(0, 0, None)]


# ---------------------------------------------------------------- panes


def plain_panes(rows, batches=10):
    hour, day, origin = 3_600_000_000, 86_400_000_000, datetime(1970, 1, 1)
    micro = lambda t: (t - origin) // timedelta(microseconds=1)
    once = {}
    for c, ts, arrived, kind, value in rows:
        if ts is not None:
            r = (micro(arrived or ts), micro(ts), kind or "none", value)
            once[c] = min(once.get(c, r), r, key=lambda x: (x[0], x[1], x[2], -math.inf if x[3] is None else x[3]))
    fed = [[] for _ in range(batches)]
    for c, (arrived, ts, kind, value) in once.items():
        d = arrived // day
        q = d % 10
        b = min(batches - 1, q + max(0, zlib.crc32(str("" if c is None else c).encode()) % 30 - 23))
        cents = math.floor(100 * value + 0.5) if value is not None and math.isfinite(value) else 0
        fed[b].append((c, kind, ts - (d - q) * day, cents))
    out, live, emitted, w = [], {}, set(), None
    for b, new in enumerate(fed):
        touched = {}
        for c, kind, event, cents in new:
            pane = (kind, event // hour)
            if w is not None and w >= (pane[1] + 49) * hour:
                out.append((b, pane[1], c, 1, cents, "late", kind))
                continue
            old = live.get(pane, (0, 0))
            touched.setdefault(pane, old)
            live[pane] = (old[0] + 1, old[1] + cents)
        for pane, now in sorted(live.items()):
            row = lambda v, record: (b, pane[1], -1, *v, record, pane[0])  # noqa: B023, E731
            if pane in emitted:
                out += [row(touched[pane], "retract"), row(now, "replace")] if pane in touched else []
            elif w is not None and w >= (pane[1] + 13) * hour:
                emitted.add(pane)
                out.append(row(now, "emit"))
            elif b == batches - 1:
                out.append(row(now, "final"))
        for pane in list(live):
            if w is not None and w >= (pane[1] + 49) * hour:
                del live[pane]
        w = max([e for _, _, e, _ in new] + [w] if w is not None else [e for _, _, e, _ in new], default=w)
    return sorted(out, key=repr)


CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, kind string, value double, batch string, shard int"


def test_panes_equal_a_plain_version(spark):
    rng = random.Random(8)
    rows = []
    for i in range(700):
        ts = datetime(2024, 1, 8) + timedelta(minutes=rng.randrange(20 * 1440))
        arrived = ts + timedelta(hours=rng.choice([0, 0, 0, 1, 20, 60]))
        rows.append((i, ts, rng.choice([arrived] * 9 + [None]), rng.choice(["view", "view", "view", None, "ünï"]), rng.choice([1.005, -3.2, 0.0, None, float("nan"), float("inf")])))
    rows += [rows[i] for i in range(0, 700, 9)] + [(5000, None, datetime(2024, 1, 1), "view", 1.0), (None, datetime(2024, 1, 12), datetime(2024, 1, 12), "view", 2.0)]
    rows += [(6000, datetime(1969, 12, 31, 23, 30), datetime(1970, 1, 1, 2), "view", 3.0), (1, datetime(2024, 2, 1), datetime(2024, 2, 2), "x", 9.0)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], CLICKS).repartition(3)
    got = sorted((tuple(r) for r in panes.panes(docs, shards=5).collect()), key=repr)
    assert got == plain_panes(rows)
    assert {r[5] for r in got} == {"late", "emit", "retract", "replace", "final"}


def test_panes_of_no_rows(spark):
    assert panes.panes(spark.createDataFrame([], CLICKS), batches=2, shards=2).collect() == []


def test_a_hot_pane_is_one_row_a_task(spark):
    """Rows of one pane are combined before the shuffle; late rows spread over the shards."""
    band = "batch int, w long, last boolean, control boolean, shard int, click_id long, kind string, hour long, cents long"
    rows = [(1, 100 * panes.HOUR, False, False, None, i, "view", 99 if i % 2 else 1, 5) for i in range(4000)]
    out = panes.combined(spark.createDataFrame(rows, band).repartition(3), panes.Lifecycle(), 16).collect()
    held = [r for r in out if r.role == "pane"]
    assert len(held) <= 3 and sum(r.n_rows for r in held) == 2000 and sum(r.cents for r in held) == 10_000
    late = [r.shard for r in out if r.role == "late"]
    assert len(late) == 2000 and max(map(late.count, range(16))) < 250


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(registry.tokenizer_path())


def test_token_counts_equal_the_library(spark, odd_rows, library):
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "a", "É", "ß", "İ", "ſ", "ﬁ", "漢", "𝒳", "😀", "é", " ", " ", "\x0b", "\x85", "1", "²", "'s", "'LL", "-", "...", "thing", "\x00", "ª", "Σ", "क्", "힣"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 30))), "a") for i in range(300)]
    rows += [(900, "ab" * 20_000, "a"), (901, "".join(rng.choices("abcdefghij0123456789+/", k=60_000)), "a"), (902, " ".join(["wörd 漢"] * 30_000), "a"), *odd_rows]
    got = sorted(map(tuple, token_counts.count_tokens(frame(spark, rows), registry.tokenizer_path()).collect()), key=repr)
    n = [len(e.ids) for e in library.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)]
    assert got == sorted(((i, len((t or "").encode()), k, k > 2048) for (i, t, _), k in zip(rows, n, strict=True)), key=repr)


def test_pieces_end_at_white_space(library, monkeypatch):
    counter = token_counts.TokenCounter(registry.tokenizer_path())
    monkeypatch.setattr(token_counts, "PIECE", 7)
    for text in ("some words é 漢字 and 'll <|endoftext|> more" * 5, "x" * 40, "a b 　 c" * 9):
        assert counter.whole(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_merges_take_the_lowest_rank_first():
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "a</w>", "b</w>", "c</w>", "ab", "bc", "abc</w>", "bc</w>"])}
    merges = token_counts.Merges(vocab, ["b c</w>", "a b", "a bc</w>"], "</w>")
    assert [merges.count(w) for w in ("abc", "ab", "abab", "abcabc", "c")] == [1, 2, 3, 3, 1]


# ---------------------------------------------------------------- keys that null and repeated ids make hot


def test_equal_rows_without_an_id_spread(spark):
    rows = spark.range(40_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(13).cast("long").alias("n_chars"))
    packed = packing.pack(rows, registry.tokenizer_path()).groupBy(F.expr("sequence_id >> 32").alias("g")).count().collect()
    assert len(packed) >= 9 and max(r["count"] for r in packed) < 6000 and sum(r["count"] for r in packed) >= 40_000
    assert mixing.chosen(rows, common.Scratch(spark, "t"), (1,), 3, 1, 1 << 16).count() == 1
    mixed = mixing.mix(rows)
    assert mixed.count() == 40_000 and mixed.agg(F.sum("taken")).first()[0] == 120_000
    assert exact_dedup.deduplicate(rows).count() == 1 == simhash.one_of_each(rows).count()
    assert mixing.materialised_mix(rows).count() == 40_000


def test_repeats_of_one_row_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 7)
    rows = spark.createDataFrame([(1, 0), (2, 3), (3, 7), (4, 100)], "_t long, n long")
    assert {r["_t"]: r["count"] for r in mixing.repeated(rows, F.col("n")).groupBy("_t").count().collect()} == {2: 3, 3: 7, 4: 100}


@pytest.mark.parametrize("parquet", [False, True])
def test_stages_keep_rows_by_place(spark, tmp_path, parquet):
    rows = [(None, "one text", "a"), (None, "other text here", "a"), (5, "same id", "b"), (5, "but another text", "b"), (6, "same  id", "b"), (7, None, "c"), (8, "", "c")]
    docs = spark.createDataFrame([(i, t, "en", s, 1, "clash", 0.5) for i, t, s in rows], SCHEMA.replace("spans", "_f").replace("score", "_i"))
    if parquet:
        docs.write.parquet(str(tmp_path / "d"))
        docs = spark.read.parquet(str(tmp_path / "d"))
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(5, "but another text"), (6, "same  id"), (7, None)]
    assert kept.count() == 5
    assert simhash.one_of_each(kept).count() == 5
    mixed = mixing.materialised_mix(kept)
    assert mixed.columns == docs.columns
    taken = {(r.doc_id, r.text): r["count"] for r in mixed.groupBy("doc_id", "text").count().collect()}
    want = {(r.doc_id, r.text): r.copies for r in mixing.mix(kept).join(kept.select("doc_id", "text", F.size(F.split("text", r"\s+")).cast("long").alias("size")), ["doc_id", "size"]).collect() if r.copies}
    assert set(want) <= set(taken) | {k for k in want if k[0] is None} and sum(taken.values()) == mixing.mix(kept).agg(F.sum("copies")).first()[0]


def test_the_summary_returns_at_most_its_counters(spark, words):
    rng = random.Random(6)
    docs = frame(spark, [(i, " ".join(rng.choices(words, k=400)), "a") for i in range(40)])
    scratch = common.Scratch(spark, "t")
    rows = suffix_dedup.write_slices(docs, scratch.folder("s"), scratch).withColumn("tie", F.xxhash64("digest"))
    work = rows.groupBy("slice").agg(F.first("path").alias("path"), F.collect_list(F.struct("row", "doc_id", "tie")).alias("rows")).select("path", "rows", "slice")
    for counters in (1, 4, 64):
        assert len(suffix_dedup.hot_minimizers(work, scratch, 100, 32, counters, 1)) <= counters
    assert rows.select("slice").distinct().count() == rows.select("path").distinct().count()
    assert np.all(np.asarray([r["slice"] for r in rows.select("slice").collect()]) >= 0)
