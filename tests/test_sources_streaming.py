"""Sources and sinks on files, and streams against their batch form."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import adapters, metrics, scheduling
from sparkloom.sources import files, generators, registry, sinks
from sparkloom.streaming import operators as S


def test_inventory_and_pages(spark, tmp_path):
    doc = tmp_path / "PDF" / "docA"
    (doc / "metadata").mkdir(parents=True)
    for n in (10, 2):
        (doc / f"layout_{n:03d}.json").write_text(json.dumps({"input_path": "x", "page_index": n, "boxes": [{"label": "text", "text": "t", "coordinate": [0, 0, 1, 1]}]}))
    (doc / "layout_099.json").write_text('{"broken')
    (doc / "metadata" / "skip.json").write_text("{}")
    (doc / "a.MD").write_text("hello")
    rows = files.inventory(files.scan_files(spark, str(tmp_path))).collect()
    assert len(rows) == 4
    md = next(r for r in rows if r["file_name"] == "a.MD")
    assert (md["file_extension"], md["file_size"], md["file_hash_md5"]) == (".md", 5, "5d41402abc4b2a76b9719d911017c592")
    assert [(r["doc"], r["page"]) for r in files.layout_files(spark, str(tmp_path)).collect()] == [("docA", 2), ("docA", 10), ("docA", 99)]
    good, bad = files.read_layout(spark, str(tmp_path))
    assert sorted(r["page_index"] for r in good.collect()) == [2, 10]
    assert bad.count() == 1
    assert files.with_folder_type(files.layout_files(spark, str(tmp_path))).first()["folder_type"] == "PDF"


def test_backups_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([("d1", "# a\n\nb"), ("d2", "c")], "doc string, markdown string")
    path = str(tmp_path / "meta.json")
    assert sinks.save_with_backup(df, path, "20240101000000") is None
    assert sinks.save_with_backup(df, path, "20240601000000") == path + ".20240601000000.bak"
    assert sinks.remove_expired_backups(df, str(tmp_path), "20250101000000") == ["meta.json.20240601000000.bak"]
    sinks.write_text_per_document(df, str(tmp_path / "md"))
    back = files.read_whole_texts(spark, str(tmp_path / "md"), "*.txt")
    assert sorted(r["text"].rstrip("\n") for r in back.collect()) == ["# a\n\nb", "c"]


def test_media(spark):
    urls = ["https://x/y.png", "data:image/png;base64,aGk=", "file:///ok/a.png", "file:///ok/../b.png", "ftp://x"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    got = rows.select(files.media_source(F.col("url"), "/ok").alias("s"), files.data_url(F.col("url")).alias("d")).collect()
    assert [r["s"] for r in got] == ["http", "data", "file", "refused", "unknown"]
    assert (got[1]["d"]["mime"], bytes(got[1]["d"]["data"])) == ("image/png", b"hi")


def test_registry(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert registry.load(spark, "parquet", str(tmp_path / "p")).count() == 5
    with pytest.raises(ValueError, match="unknown loader"):
        registry.load(spark, "nothing")
    registry.register_sources(spark)
    one = spark.read.format("seeded_rows").option("rows", 20).option("partitions", 1).load().orderBy("id").collect()
    three = spark.read.format("seeded_rows").option("rows", 20).option("partitions", 3).load().orderBy("id").collect()
    assert one == three
    plugins = registry.Plugins(allowed=["double"])
    plugins.register("text", "double", lambda s: s + s)
    plugins.register("text", "hidden", lambda s: s)
    assert plugins.register_sql(spark, "text", "string") == ["double"]
    assert spark.sql("SELECT double('ab') AS v").first()["v"] == "abab"


def test_generators(spark):
    rows = spark.range(4000).withColumnRenamed("id", "req").withColumn("stream", F.lit(1))
    s = rows.select(generators.poisson(F.col("req"), 4.0, 60, 1).alias("p"), generators.zipf(F.col("req"), 1.5, 100, 2).alias("z"), generators.uniform(F.col("req"), 1, 6, 3).alias("u")).agg(F.avg("p"), F.min("z"), F.max("u"), F.min("u")).first()
    assert abs(s[0] - 4) < 0.2 and s[1] == 1 and (s[2], s[3]) == (6, 1)
    gaps = generators.arrivals(generators.gamma_gaps(rows, 10.0, 1.0, 5), 100.0)
    assert abs(gaps.agg(F.max("arrival")).first()[0] - 100) < 1e-6


def test_upload_tries_again(spark, tmp_path):
    marker = str(tmp_path / "tried")

    def put(part, text):
        import os

        if not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("busy")
        with open(f"{marker}-{part}", "a") as out:
            out.write(text)

    files.upload_parts(spark.range(3).coalesce(1), put)
    assert sum(len(p.read_text().splitlines()) for p in tmp_path.glob("tried-*")) == 3


def test_adapters(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    assert adapters.infer(rows, "generate").filter("output LIKE 'answer %'").count() == 2
    scores = adapters.score(rows.withColumn("other", F.col("text")), "text", "other").collect()
    assert all(abs(r["score"] - 1) < 1e-9 for r in scores)
    assert adapters.quietest_split([1.0] * 50 + [0.0] * 10 + [1.0] * 40, 20, 3.0, 5)[0] == (0, 50)
    audio = spark.createDataFrame([("a", [1.0] * 50 + [0.0] * 10 + [1.0] * 40)], "audio string, samples array<double>")
    assert adapters.split_audio(audio, 20, 3.0, 5).count() == 2
    logits = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0)], "req int, token_id int, logit double")
    halved = adapters.LogitsProcessor(lambda ids, x: x / 2, rank_preserving=True)
    assert sorted(r["logit"] for r in adapters.processed(logits, [halved]).collect()) == [0.5, 1.5]
    assert sorted(r["logit"] for r in adapters.processed(logits, [halved], greedy=True).collect()) == [1.0, 3.0]
    ok = rows.select(adapters.meets(F.col("text"), "choice", ["a"]).alias("c"), adapters.meets(F.col("text"), "regex", "[ab]").alias("r"), adapters.meets(F.col("text"), "json", "x int").alias("j")).collect()
    assert [tuple(r) for r in ok] == [(True, True, False), (False, True, False)]
    pages = adapters.recognised(adapters.rasterised(spark.createDataFrame([("d", 3)], "doc string, n_pages int")))
    assert pages.count() == 3
    spoken = adapters.transcribed(spark.createDataFrame([("x", 0.0, 1.5)], "audio string, start double, end double"))
    assert spoken.first()["text"] == "x 0-1.5"


def test_incremental_files(spark, tmp_path):
    seen: list[int] = []
    schema = "id long"
    spark.range(3).write.parquet(str(tmp_path / "in"))
    run = lambda: S.incremental(spark, str(tmp_path / "in"), schema, str(tmp_path / "ck"), lambda df, n: seen.append(df.count()))
    run()
    run()
    spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sum(seen) == 8


@pytest.fixture
def stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    return events, spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))


def test_windows_stream_like_batch(stream):
    batch, live = stream
    agg = (F.count("*").alias("n"),)
    for name, f in (("tumbling", lambda d: S.tumbling(d, "ts", "1 hour", ["event_type"], *agg)), ("sliding", lambda d: S.sliding(d, "ts", "2 hours", "1 hour", [], *agg))):
        assert sorted(map(repr, S.run_to_memory(f(live), f"t_{name}", "complete").collect())) == sorted(map(repr, f(batch).collect()))


def test_sessions_stream_like_batch(stream):
    batch, live = stream
    whole = S.sessions(batch, "ts", "6 hours", ["user_id"], F.count("*").alias("n"))
    done = S.run_to_memory(S.sessions(live, "ts", "6 hours", ["user_id"], F.count("*").alias("n"), late="1 hour"), "t_sessions")
    assert 0 < done.count() <= whole.count()  # the last sessions stay open
    assert done.exceptAll(whole).count() == 0


def test_stateful_streams_like_batch(stream):
    batch, live = stream

    def stats(d):
        return d.select((F.col("user_id") % 5).alias("cache"), F.col("event_id").alias("seq"), (F.col("event_id") % 3 + 1).cast("int").alias("requests"), (F.col("event_id") % 50).cast("int").alias("queries"), (F.col("event_id") % 20).cast("int").alias("hits"))

    got = {(r["cache"], r["seq"]): round(r["hit_rate"], 9) for r in S.run_to_memory(S.rolling_hit_rate(stats(live), 10), "t_rate").collect()}
    expected = {(r["cache"], r["seq"]): round(r["hit_rate"], 9) for r in metrics.recent_hit_rate(stats(batch), 10, ("cache",)).collect()}
    assert got == expected

    def accesses(d):
        return d.select((F.col("user_id") % 3).alias("cache"), F.col("event_id").alias("seq"), F.concat("event_type", (F.col("user_id") % 7).cast("string")).alias("hash"), F.lit(0).alias("pin"))

    hits = {(r["cache"], r["seq"]): r["hit"] for r in S.run_to_memory(S.lru_cache(accesses(live), 6), "t_lru").collect()}
    replayed = {(r["cache"], r["seq"]): r["hit"] for r in scheduling.lru_simulation(accesses(batch), 6).collect()}
    assert hits == replayed


def test_interval_join_stream(stream):
    batch, live = stream
    right = live.select("user_id", "ts", F.col("event_id").alias("other"))
    joined = S.interval_join(live.select("user_id", "ts", "event_id"), right, "user_id", "10 MINUTES", "1 hour")
    got = S.run_to_memory(joined.select("event_id", "other"), "t_join").count()
    a, b = batch.alias("a"), batch.alias("b")
    assert got == a.join(b, F.expr("a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 10 MINUTES")).count()


def test_stream_statistics(spark, stream):
    _, live = stream
    stats = S.QueryStats()
    spark.streams.addListener(stats)
    S.run_to_memory(live.select("event_id"), "t_stats")
    spark.streams.removeListener(stats)
    import time

    for _ in range(50):
        if stats.batches:
            break
        time.sleep(0.1)
    assert sum(b["rows"] for b in stats.batches) == live.sparkSession.table("t_stats").count()


def test_sql_functions(spark):
    from sparkloom.functions.sql import register

    assert "collapse_repetition" in register(spark)
    text = "alpha beta alpha beta alpha beta alpha beta omega"
    assert spark.sql(f"SELECT collapse_repetition('{text}') AS v").first()["v"] == "alpha beta omega"
    assert spark.sql("SELECT table_matrix_to_html('<table><tr><td>a</td><td><l></l></td></tr></table>') AS v").first()["v"] == '<table><tr><td colspan="2">a</td></tr></table>'


def test_metadata_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("d1", "t1", "/a"), ("d2", "t2", "/b")], "doc string, title string, _source_path string")
    sinks.write_metadata(rows, str(tmp_path / "per_doc"))
    back = spark.read.json(str(tmp_path / "per_doc"))
    assert sorted(back.columns) == ["doc", "title"] and back.count() == 2
    sinks.write_combined([rows, rows.withColumn("extra", F.lit(1))], str(tmp_path / "all"))
    assert spark.read.json(str(tmp_path / "all")).count() == 4
    one = sinks.envelope(rows.drop("_source_path"), "1.0", "/src", F.lit("2024-01-02").cast("timestamp")).first()
    assert (one["total_files"], len(one["metadata"]), one["generated_at"], one["version"]) == (2, 2, "2024-01-02T00:00:00", "1.0")


def test_benchmark_results(spark, tmp_path):
    for name, qps in (("chunked", 2), ("chunked", 4), ("disagg", 2), ("other", 2)):
        (tmp_path / f"{name}-qps-{qps}.json").write_text(json.dumps({"qps": qps, "mean_ttft_ms": 1.5 * qps}))
    got = files.benchmark_results(spark, str(tmp_path), ["chunked", "disagg"])
    assert sorted((r["name"], r["qps"]) for r in got.collect()) == [("chunked", 2), ("chunked", 4), ("disagg", 2)]


def test_transcripts(spark, tmp_path):
    rows = spark.createDataFrame([("x", 0.0, 65.0, "A", "hello"), ("x", 65.0, 66.0, "UNKNOWN", "noise")], "audio string, start double, end double, speaker string, text string")
    header = sinks.transcript_header({"audio_filename": F.lit("x.wav"), "duration_seconds": F.lit(66.0)})
    sinks.write_transcripts(rows, header, str(tmp_path / "time"), str(tmp_path / "text"))
    timeline = files.read_whole_texts(spark, str(tmp_path / "time"), "*.txt").first()["text"]
    assert timeline.startswith("[00:00 - 01:05] **A**: hello")
    text = files.read_whole_texts(spark, str(tmp_path / "text"), "*.txt").first()["text"]
    assert text == '<!--METADATA:{"audio_filename": "x.wav", "duration_seconds": 66.0}-->\n\nhello\n'


def test_excel_report_refuses_large_tables(spark, tmp_path):
    with pytest.raises((RuntimeError, ValueError, ImportError, ModuleNotFoundError)):
        sinks.write_excel({"s": spark.range(5)}, str(tmp_path / "r.xlsx"), rows=2)


def test_package_goes_with_the_session(tmp_path):
    """A driver elsewhere, with no path to the package for its workers."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from sparkloom.operators import adapters
print(adapters.infer(spark.createDataFrame([(1, "a")], "id int, text string"), "generate").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("1"), done.stderr[-2000:]
