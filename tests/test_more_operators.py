"""Operators against plain versions and hand-derived cases: schedulers, detokenising, audio, unwarping, sampling, sinks."""

from __future__ import annotations

import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions import vectors as V
from sparkloom.operators import adapters, conversations, detokenising, layout, scheduling
from sparkloom.operators import sampling as Z
from sparkloom.plans import registry
from sparkloom.sources import files, sinks
from sparkloom.sources.registry import Plugins
from sparkloom.streaming import operators as S

REQUESTS = "queue long, req long, arrival long, priority int, prompt int, output int"


# ---------------------------------------------------------------- scheduling


def batches(spark, rows, *args, **options):
    out = scheduling.batching_simulation(spark.createDataFrame(rows, REQUESTS), *args, **options).orderBy("tick", "req").collect()
    return [(r["tick"], r["req"], r["tokens"], r["preempted"]) for r in out]


def test_batching_without_blocks(spark):
    rows = [(0, 1, 0, 0, 5, 1), (0, 2, 1, 0, 3, 2)]
    # budget 6: request 1 prefills 5, request 2 one token; then decode and the rest of the prompt
    assert batches(spark, rows, 6, 8) == [(0, 1, 5, False), (0, 2, 1, False), (1, 1, 1, False), (1, 2, 2, False), (2, 2, 1, False), (3, 2, 1, False)]


def test_batching_preempts_the_last(spark):
    rows = [(0, 1, 0, 0, 2, 3), (0, 2, 1, 0, 2, 1)]
    # five blocks of one token: both prefill, request 1 takes the fifth, so request 2 loses its blocks and starts again
    assert batches(spark, rows, 10, 8, blocks=5, block_size=1) == [
        (0, 1, 2, False), (0, 2, 2, False), (1, 1, 1, False), (1, 2, 0, True), (2, 1, 1, False), (3, 1, 1, False), (4, 2, 2, False), (5, 2, 1, False),
    ]


def test_batching_preempts_by_priority(spark):
    rows = [(0, 1, 0, 9, 2, 2), (0, 2, 1, 1, 2, 2)]
    # request 2 comes first; its decode takes the blocks of request 1, whose priority is larger
    got = batches(spark, rows, 10, 8, blocks=4, block_size=1, policy="priority")
    assert got[:4] == [(0, 1, 2, False), (0, 2, 2, False), (1, 1, 0, True), (1, 2, 1, False)]
    assert sum(n for _, req, n, _ in got if req == 2) == 4
    with pytest.raises(Exception, match="needs more than 2 blocks"):
        batches(spark, rows, 10, 8, blocks=2, block_size=1)


def test_batching_keeps_every_request(spark):
    rng = random.Random(4)
    rows = [(i % 3, i, i // 5, rng.randrange(3), rng.randint(1, 40), rng.randint(0, 9)) for i in range(60)]
    for options in ({}, {"blocks": 14, "block_size": 4}, {"blocks": 14, "block_size": 4, "policy": "priority"}):
        got = scheduling.batching_simulation(spark.createDataFrame(rows, REQUESTS), 32, 6, **options).collect()
        done = Counter()
        for r in got:
            done[r["req"]] += r["tokens"]
        again = {r["req"] for r in got if r["preempted"]}
        assert bool(again) == bool(options)
        for _, i, _, _, prompt, output in rows:
            assert done[i] == prompt + output if i not in again else done[i] >= prompt + output
        assert max(Counter((r["queue"], r["tick"]) for r in got if r["tokens"]).values()) <= 6


def test_zipped_checks_lengths(spark):
    prompts, params = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, text string"), spark.createDataFrame([(0, 1.0), (1, 2.0)], "pos int, t double")
    assert {(r["text"], r["t"]) for r in scheduling.zipped(prompts, params).collect()} == {("a", 1.0), ("b", 2.0)}
    assert {r["t"] for r in scheduling.zipped(prompts, params.filter("pos = 1"), shared=True).collect()} == {2.0}
    for bad, shared in ((params.filter("pos = 0"), False), (params, True)):
        with pytest.raises(Exception, match="differ in length|have one row"):
            scheduling.zipped(prompts, bad, shared=shared).collect()


def test_even_bins_match_plain(spark):
    rng = random.Random(6)
    items = [(g, i, float(rng.randrange(100))) for g in range(4) for i in range(12)]
    got = {(r["group"], r["item"]): r["bin"] for r in scheduling.packed_evenly(spark.createDataFrame(items, "group long, item long, size double"), 3).collect()}
    for g in range(4):
        load, n = [0.0] * 3, [0] * 3
        for _, i, size in sorted((x for x in items if x[0] == g), key=lambda x: (-x[2], x[1])):
            b = min((b for b in range(3) if n[b] < 4), key=lambda b: (load[b], b))
            load[b], n[b] = load[b] + size, n[b] + 1
            assert got[g, i] == b


def test_stream_cache_honours_pins(spark, tmp_path):
    rows = [(0, i, h, p) for i, (h, p) in enumerate([("a", 1), ("b", 0), ("c", 0), ("a", 0), ("d", 1), ("e", 0), ("a", -1), ("f", 0), ("a", 0)])]
    df = spark.createDataFrame(rows, "cache long, seq long, hash string, pin int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    hits = {r["seq"]: r["hit"] for r in S.run_to_memory(S.lru_cache(live, 2), "t_pins").collect()}
    assert hits == {r["seq"]: r["hit"] for r in scheduling.lru_simulation(df, 2).collect()}
    assert hits[3] and not hits[5]


# ---------------------------------------------------------------- detokenising


def whole(pieces, **options):
    out = list(detokenising.deltas(pieces, **options))
    return "".join(d for d, _ in out), out[-1][1] if out else None, len(out)


def test_detokenised_text_is_the_whole_text():
    text = "héllo 中文 😀 end"
    raw = text.encode()
    for n in (1, 2, 3, 5):
        assert whole([raw[i : i + n] for i in range(0, len(raw), n)])[0] == text
    # no piece of a character is given out
    assert [d for d, _ in detokenising.deltas([b"\xe4", b"\xb8", b"\xadx"])] == ["", "", "中x"]
    assert whole([])[0] == ""


def test_detokenised_stops():
    pieces = [b"ab", b"cS", b"TO", b"Pq", b"z"]
    assert whole(pieces, stop=("STOP",)) == ("abc", "STOP", 4)
    assert whole(pieces, stop=("STOP",), include=True) == ("abcSTOP", "STOP", 4)
    assert whole(pieces, stop=("STOP",), least=4) == ("abcSTOPqz", None, 5)
    assert whole(pieces, stop=("zz", "c")) == ("ab", "c", 2)
    # three characters are held back, as they may be the head of the stop string
    assert [d for d, _ in detokenising.deltas([b"abcd", b"ef"], stop=("STOP",))] == ["a", "bcdef"]


# ---------------------------------------------------------------- audio and images


def test_resampling(spark):
    row = spark.createDataFrame([([0.0, 2.0, 4.0, 6.0], [[1.0, 3.0], [3.0, 5.0]], [])], "x array<double>, c array<array<double>>, e array<double>")
    got = row.select(V.resampled(F.col("x"), 8000).alias("up"), V.resampled(F.col("x"), 32_000).alias("down"), V.resampled(F.col("x"), 16_000).alias("same"), V.mono(F.col("c")).alias("m"), V.resampled(F.col("e"), 8000).alias("e")).first()
    assert got["up"] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 6.0]
    assert (got["down"], got["same"], got["m"], got["e"]) == ([0.0, 4.0], [0.0, 2.0, 4.0, 6.0], [2.0, 4.0], [])


def plain_sample(image, px, py):
    total = 0.0
    for y, row in enumerate(image):
        for x, v in enumerate(row):
            total += v * max(0.0, 1 - abs(px - x)) * max(0.0, 1 - abs(py - y))
    return total


def test_grid_unwarp_matches_plain(spark):
    rng = np.random.default_rng(2)
    image, grid = rng.random((5, 7)), rng.uniform(-1.3, 1.3, (3, 4, 2))
    df = spark.createDataFrame([(1, image.tolist(), grid.tolist()), (2, None, grid.tolist())], "id int, image array<array<double>>, grid array<array<array<double>>>")
    got = {r["id"]: r["image"] for r in adapters.grid_unwarped(df, 6, 9).collect()}
    assert got[2] is None
    for y in range(9):
        for x in range(6):
            gy, gx = y * 2 / 8, x * 3 / 5
            p = [sum(grid[j, i, k] * max(0, 1 - abs(gy - j)) * max(0, 1 - abs(gx - i)) for j in range(3) for i in range(4)) for k in (0, 1)]
            assert got[1][y][x] == pytest.approx(plain_sample(image, (p[0] + 1) / 2 * 6, (p[1] + 1) / 2 * 4))
    corners = [[[-1.0, -1.0], [1.0, -1.0]], [[-1.0, 1.0], [1.0, 1.0]]]
    assert np.allclose(adapters.sampled_at(image, adapters.enlarged_grid(np.array(corners), 5, 7)), image)


def test_stubs_of_media_models(spark):
    pages = spark.createDataFrame([("d", "001.png"), ("d", "none.png")], "doc string, image_name string")
    assert adapters.detected(pages).count() == 2
    boxes = adapters.detected(pages, lambda n: [("a", 0.5, [0.0, 0.0, 1.0, 1.0]), ("b", 0.6, [1.0, 1.0, 2.0, 2.0])] if n[0] == "0" else [])
    assert [(r["image_name"], r["pos"], r["label"]) for r in boxes.orderBy("pos").collect()] == [("001.png", 0, "a"), ("001.png", 1, "b")]
    turns = adapters.diarised(spark.createDataFrame([("x", 25.0)], "audio string, seconds double")).orderBy("start").collect()
    assert [(r["start"], r["end"], r["speaker"]) for r in turns] == [(0.0, 10.0, "SPEAKER_00"), (10.0, 20.0, "SPEAKER_01"), (20.0, 25.0, "SPEAKER_00")]
    images = spark.createDataFrame([(1, b"abc")], "id int, content binary")
    assert bytes(adapters.unwarped(images).first()["content"]) == b"abc"
    assert bytes(adapters.unwarped(images, lambda c: bytes(c)[::-1]).first()["content"]) == b"cba"


def test_models_of_one_name_are_told_apart(spark):
    rows = spark.createDataFrame([("x",)], "text string").coalesce(1)

    class One:
        def __init__(self, answer):
            self.answer = answer

        def generate(self, text):
            return self.answer

    for answer in "ab":
        assert adapters.infer(rows, "generate", load=lambda answer=answer: One(answer)).first()["output"] == answer
    for k in range(20):
        segments = spark.createDataFrame([("x", 0.0, 1.0)], "audio string, start double, end double")
        assert adapters.transcribed(segments, lambda a, s, e, k=k: str(k)).first()["text"] == str(k)
    assert adapters.name_of(adapters.HashModel) and not adapters.name_of(lambda: 1)


def test_stateful_processor(spark):
    logits = spark.createDataFrame([(r, t, float(t)) for r in (1, 2) for t in range(4)], "req int, token_id int, logit double")
    once = adapters.LogitsProcessor(lambda ids, x, outputs: np.where(np.isin(ids, outputs), -9.0, x), stateful=True)
    tokens = spark.createDataFrame([(1, 0, 3), (2, 0, 2)], "req int, pos int, token int")
    best = lambda df: {r["req"]: r["t"] for r in df.groupBy("req").agg(F.max_by("token_id", "logit").alias("t")).collect()}
    assert best(adapters.processed(logits, [once])) == {1: 3, 2: 3}
    assert best(adapters.processed(logits, [once], added=tokens)) == {1: 2, 2: 3}
    assert best(adapters.processed(logits, [once], added=tokens.selectExpr("req", "1 AS pos", "IF(req = 1, 2, 3) AS token"))) == {1: 1, 2: 1}
    once.update_state(None, gone=tokens.filter("req = 1"))
    assert best(once(logits)) == {1: 3, 2: 1}


# ---------------------------------------------------------------- sampling


def test_random_tokens_follow_the_softmax(spark):
    x = [0.0, 1.0, 2.0, -1.0]
    rows = spark.range(20_000).select(F.col("id").alias("req"), F.posexplode(F.array(*[F.lit(v) for v in x])).alias("token_id", "logit"))
    got = Counter(r["token_id"] for r in Z.random_tokens(rows, 5).collect())
    total = sum(map(math.exp, x))
    for i, v in enumerate(x):
        assert got[i] / 20_000 == pytest.approx(math.exp(v) / total, abs=0.015)
    first = {r["req"]: r["token_id"] for r in Z.random_tokens(rows, 5).collect()}
    assert first == {r["req"]: r["token_id"] for r in Z.random_tokens(rows.repartition(7), 5).collect()}
    assert first != {r["req"]: r["token_id"] for r in Z.random_tokens(rows, 6).collect()}


def test_seeded_sample(spark):
    rows = spark.range(1000)
    one = {r["id"] for r in conversations.seeded_sample(rows, "id", 100, 3).collect()}
    assert len(one) == 100
    assert one == {r["id"] for r in conversations.seeded_sample(rows.repartition(5), "id", 100, 3).collect()}
    other = {r["id"] for r in conversations.seeded_sample(rows, "id", 100, 4).collect()}
    assert len(one & other) < 40


def test_approximate_aggregates_are_near(spark, sf_dir):
    got = {r["l_returnflag"]: r for r in registry.queries()["rel_approximate"](spark, sf_dir).collect()}
    exact = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("n"), F.expr("percentile(l_quantity, 0.5)").alias("m")).collect()
    for r in exact:
        assert got[r["l_returnflag"]]["orders"] == pytest.approx(r["n"], rel=0.08)
        assert float(got[r["l_returnflag"]]["median"]) == pytest.approx(float(r["m"]), abs=1)


def test_global_number_over_many_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 100_000).alias("x")).withColumn("span", F.floor(F.col("x") / 10))
    got = {r["x"]: r["number"] for r in layout.global_number(rows, ["x"], "span", wide=16).collect()}
    assert got == {x: n for n, x in enumerate(sorted(i * 7919 % 100_000 for i in range(5000)), 1)}


def test_many_chunks_in_blocks(spark):
    text = " ".join(f"Sentence number {i}." for i in range(4000))
    got = spark.createDataFrame([(text,)], "t string").select(T.split_chunks(F.col("t"), 60)).first()[0]
    assert len(got) > 1000
    assert " ".join(got) == text


# ---------------------------------------------------------------- sinks and plugins


def test_parts_are_bounded_and_sent_once(spark, tmp_path):
    rows = spark.range(25).coalesce(1)

    def put(part, text):
        with open(tmp_path / f"part-{part}", "a") as out:
            out.write(text)

    for _ in range(2):  # the second run finds markers
        files.upload_parts(rows, put, part_rows=10, markers=f"file://{tmp_path}/sent")
    assert {p.name: len(p.read_text().splitlines()) for p in tmp_path.glob("part-*")} == {"part-0-0": 10, "part-0-1": 10, "part-0-2": 5}


def test_chunked_metadata_files(spark, tmp_path):
    rows = spark.createDataFrame([("/in/doc1/a_metadata.json", "x"), ("/in/doc2/b.json", None), (None, "lost")], "_source_path string, chunk string")
    sinks.write_chunked(rows, f"file://{tmp_path}/out").collect()
    assert json.loads((tmp_path / "out/doc1/a_chunked_metadata.json").read_text()) == {"chunk": "x"}
    assert json.loads((tmp_path / "out/doc2/b_chunked_metadata.json").read_text()) == {"chunk": None}
    assert len(list(tmp_path.glob("out/*/*.json"))) == 2


def test_envelope_has_a_bound(spark):
    rows = spark.range(5).withColumnRenamed("id", "file")
    clock = F.lit("2024-01-02").cast("timestamp")
    assert sinks.envelope(rows, "1", "/", clock, most=5).first()["total_files"] == 5
    with pytest.raises(Exception, match="more than 4 files"):
        sinks.envelope(rows, "1", "/", clock, most=4).collect()


def test_plugins_are_discovered_by_entry_point(monkeypatch):
    from importlib import metadata

    points = [metadata.EntryPoint("one", "json:dumps", "loom.test"), metadata.EntryPoint("two", "no_such_module:x", "loom.test")]
    monkeypatch.setattr(metadata, "entry_points", lambda group: points if group == "loom.test" else [])
    plugins = Plugins(allowed=["one"])
    assert plugins.discover("loom.test") == ["one"]  # the other is not even loaded
    assert plugins.active("loom.test")["one"]([1]) == "[1]"
