"""Cases that ordinary tables seldom show: hot keys, very long texts, clashing names, repeated ids, odd values."""

from __future__ import annotations

import hashlib
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import ann, common, exact_dedup, mixing, packing, pii, registry, secrets, simhash, suffix_dedup, toxicity, warc
from tests.llm.conftest import frame

CLASH = "doc_id long, text string, lang string, source string, n_chars long, _z string, _k string, _h string, _n string, _r string, _s string, _w string, _all string, _rows string, _i string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, *"abcdefghij") for i, t, s in rows], CLASH).repartition(3)


# ---------------------------------------------------------------- rows that share ids or names


def test_rows_without_or_under_one_id_stay(spark, words):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(5)]
    rows = [(None, texts[0], "a"), (None, texts[1], "a"), (None, texts[2], "a"), (7, texts[3], "a"), (7, texts[4], "a"), (9, texts[4], "a"), (None, texts[0], "a")]
    docs = clashing(spark, rows)
    for stage in (exact_dedup.deduplicate, simhash.one_of_each):
        out = stage(docs)
        assert out.columns == docs.columns
        assert sorted(r["text"] for r in out.collect()) == sorted(texts)
    assert {r["doc_id"] for r in simhash.one_of_each(docs).filter(F.col("text") == texts[4]).collect()} == {7}


def test_mix_tells_rows_of_one_id_apart_by_size(spark):
    docs = clashing(spark, [(1, "a", "s"), (1, "b c d e f g h i j k", "s"), (2, "x y z", "t"), (3, "u v w", "u")])
    taken = sum(r["taken"] for r in mixing.mix(docs).collect())
    out = mixing.materialised_mix(docs)
    assert out.columns == docs.columns
    assert sum(len(r["text"].split()) for r in out.collect()) == taken


def test_toxic_rows_keep_all_columns(spark):
    docs = clashing(spark, [(1, "badword here badword", "s"), (2, "good", "s"), (None, None, None)])
    field = toxicity.Field(np.zeros(1 << toxicity.HASH_BITS), np.zeros((2, 2)), -5.0, np.array([-5.0, 0, 0, 0]))
    assert toxicity.keep(docs, field).columns == docs.columns
    assert toxicity.keep(docs, field).count() == 3


def test_offsets_where_lower_case_is_longer():
    text = "İstanbul word badword"
    n = len(toxicity._WORDS.findall(toxicity.folded(text)))
    assert n == 3
    p = np.array([0.0, 0.0, 0.9])
    assert [text[s["start"] : s["end"]] for s in toxicity.offending(text, p)] == ["badword"]


def test_shared_folder_is_demanded_on_a_cluster(spark):
    conf = SimpleNamespace(get=lambda *_: None)
    fake = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"), conf=conf)
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.shared_dir(fake)
    assert common.private(["_z", "_Z_"], "_z", "_k", "_k") == ["_z__", "_k", "_k_"]


# ---------------------------------------------------------------- very long texts


@pytest.fixture(scope="module")
def long_rows(words):
    rng = random.Random(8)
    line = " ".join(rng.choices(words, k=40)) + " "
    long = " ".join(rng.choices(words, k=700_000)) + " a@b.example key token = abcdef0123 " + line
    assert len(long) > 4_000_000
    return long, line, [(1, long, "a"), (2, line, "b"), (3, long, "c")]


def test_long_texts_are_searched_whole(spark, long_rows):
    long, _, rows = long_rows
    spans = {r["doc_id"]: r["spans"] for r in pii.extract(frame(spark, rows)).collect()}
    assert [long[s["start"] : s["end"]] for s in spans[1]] == ["a@b.example"] and spans[2] == []
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(frame(spark, rows), np.zeros((len(secrets.ALPHABET) + 1,) * 2)).collect()}
    assert [long[s["start"] : s["end"]] for s in found[3]] == ["token = abcdef0123"]


def test_long_texts_are_deduplicated_whole(spark, long_rows):
    long, _, rows = long_rows
    docs = frame(spark, rows)
    assert {r["doc_id"]: r["kept"] for r in exact_dedup.duplicates(docs).collect()} == {1: True, 2: True, 3: False}
    one = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert one[1]["fingerprint"] == one[3]["fingerprint"] == f"{simhash.fingerprint(long.encode()):016x}"


def test_long_texts_are_cut_whole(spark, long_rows):
    long, line, rows = long_rows
    removed = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert removed[3]["n_removed"] == len(long.encode()) and bytes(removed[3]["kept"]) == b""
    assert removed[2]["n_removed"] == len(line.encode())


def test_long_texts_are_mixed_and_packed_whole(spark, long_rows):
    long, _, rows = long_rows
    assert {r["doc_id"]: r["size"] for r in mixing.mix(frame(spark, rows)).collect()}[1] == len(long.split())
    pieces = packing.pack(frame(spark, rows), registry.tokenizer_path()).filter("doc_id = 1").collect()
    assert sum(r["length"] for r in pieces) == pieces[0]["doc_tokens"] > 700_000


def test_long_payloads_are_archived_whole(spark, long_rows):
    long = long_rows[0]
    _, records = warc.archive(spark.createDataFrame([(1, "u", long), (2, "u", long)], "page_id long, url string, html string"))
    assert {(r["page_id"], r["record_type"], r["payload_bytes"]) for r in records.drop("payload").collect()} == {(1, "response", len(long.encode())), (2, "revisit", len(long.encode()))}


def test_pieces_hold_every_window_once():
    texts = [bytes(range(i % 200, i % 200 + 50)) * (i % 7) for i in range(30)] + [b"", b"x" * 99]
    windows = []
    for batch in suffix_dedup.batched_pieces(texts, 100, 64):
        windows += [(n, a + i) for n, a, piece in batch for i in range(len(piece) - 99)]
        assert all(texts[n][a : a + len(piece)] == piece for n, a, piece in batch)
    assert sorted(windows) == [(n, i) for n, t in enumerate(texts) for i in range(len(t) - 99)]


# ---------------------------------------------------------------- hot keys


def test_a_shared_line_meets_in_no_task(spark, words):
    """Rows of a hot string are one for each slice, and what leaves its aggregation does not grow with the documents."""
    line = " ".join(random.Random(1).choices(words, k=50))
    sizes = []
    for n in (200, 400):
        docs = frame(spark, [(i, f"{i * 7919} {line} {i * 104729}", "a") for i in range(n)])
        scratch = common.Scratch(spark, "t")
        rows = suffix_dedup.write_slices(docs, scratch.folder("s"), scratch).withColumn("tie", F.xxhash64("digest"))
        work = rows.groupBy("slice").agg(F.first("path").alias("path"), F.collect_list(F.struct("row", "doc_id", "tie")).alias("rows")).select("path", "rows", "slice")
        hot = suffix_dedup.hot_minimizers(work, scratch, 100, 32, 1 << 16, 50)
        assert len(hot)
        strings = suffix_dedup.hot_strings(work, hot, 100, 32)
        assert strings.groupBy("key", "content").count().agg(F.max("count")).first()[0] <= work.count()
        sizes.append(suffix_dedup.resolve_hot(strings, scratch, 100).filter(F.octet_length("member") > 0).count())
        cold = suffix_dedup.runs_by_bucket(work, hot, 4, 100, 32).collect()
        keys = np.concatenate([np.frombuffer(r["runs"], suffix_dedup.RUN)["key"] for r in cold])
        assert np.unique(keys, return_counts=True)[1].max() < 50
    assert sizes[1] < 3 * sizes[0]


def plain_components(fps, radius):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("small", [1, 4, 512])
def test_bucket_links_connect_what_pairs_connect(small):
    rng = random.Random(5)
    for width in (6, 12, 30):
        fps = sorted({rng.getrandbits(width) & rng.getrandbits(width) for _ in range(300)})
        links = simhash.bucket_links(np.asarray(fps, np.uint64), 3, small)
        assert len(links) < len(fps)
        assert all((fps[a] ^ fps[b]).bit_count() <= 3 for a, b in links)
        parent = list(range(len(fps)))
        for a, b in links:
            old, new = parent[a], parent[b]
            parent = [new if p == old else p for p in parent]
        plain = plain_components(fps, 3)
        assert len(set(parent)) == len(set(plain)) == len(set(zip(parent, plain, strict=True)))


def test_hot_buckets_are_split_without_a_lost_link(spark):
    rng = random.Random(6)
    places = rng.sample(range(62), 16)
    fps = sorted({sum((x >> i & 1) << p for i, p in enumerate(places)) for x in (rng.getrandbits(16) for _ in range(1200))})
    vertices = spark.createDataFrame([(x,) for x in fps], "fp long")
    scratch = common.Scratch(spark, "t")
    edges = simhash.links(vertices, scratch, most=60)
    sizes = [b.groupBy("mask", "key").count().agg(F.max("count")).first()[0] for b in (simhash.buckets(vertices, scratch, 3), simhash.buckets(vertices, scratch, 3, most=60))]
    assert sizes[0] > 60 >= sizes[1]
    named = {r["v"]: r["c"] for r in simhash.components(edges, scratch).collect()}
    plain = plain_components(fps, 3)
    own = [named.get(x, x) for x in fps]
    assert len(set(own)) == len(set(plain)) == len(set(zip(own, plain, strict=True)))


def test_targets_of_many_sources_match_plain(spark):
    rng = random.Random(2)
    sizes = {f"s{i:03}é"[: rng.randint(3, 5)] + str(i): rng.choice((0, 1, 5, 50, 1000, 100_000)) for i in range(90)}
    rows = spark.createDataFrame([("s" + k, v) for k, v in sizes.items()] + [("n", 400)], "key string, words long").repartition(5)
    scratch = common.Scratch(spark, "t")
    got = {r["key"]: r["target"] for r in mixing.source_targets(rows, scratch).collect()}
    expected = mixing.targets({**sizes, None: 400})
    assert {k: pytest.approx(v) for k, v in got.items()} == {"n" if k is None else "s" + k: v for k, v in expected.items()}


def test_budget_of_huge_sizes_is_bounded():
    take = mixing.fit_budget([10_000_000, 9_000_000, 3], [3, 2, 5], 21_000_000, cells=1000)
    assert take[0] * 10_000_000 + take[1] * 9_000_000 <= 21_000_000
    assert sum(t * s for t, s in zip(take, (10_000_000, 9_000_000, 3), strict=True)) >= 20_000_000


# ---------------------------------------------------------------- secrets, personal data


def test_ordinary_identifiers_are_no_secrets():
    model = secrets.train([(s, 1) for s in secrets.random_strings(20_000)] + [(s, 0) for s in secrets.ordinary_identifiers([], 20_000)])
    ordinary = ["getUserAccountById2", "aVeryLongCamelCaseIdentifier", "x86_64-linux-gnu-gcc-12", "https/www/example/com/Path2", "2024-01-01T00-00-00Z"]
    ordinary += ["MAX_RETRY_COUNT_DEFAULT_3", "windows-server-2019-datacenter", "org/apache/commons/lang3/StringUtils", "image_0001_thumbnail_large", "20240101T120000Z"]
    assert [t for t in ordinary if secrets.spans(t, model)] == []
    rng = random.Random(12)
    for alphabet, n in ((secrets.ALPHABET[:64], 24), (secrets.ALPHABET[:62], 20), (secrets.ALPHABET[26:62], 32)):
        found = [secrets.spans("see " + "".join(rng.choices(alphabet, k=n)) + " here", model) for _ in range(200)]
        assert sum(bool(f) for f in found) >= 194


def test_rounds_reach_further_instances(spark):
    """Mails teach the word alpha, alpha teaches tickets, tickets teach beta, and beta teaches a last kind of token."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=9))
    texts = [f"{word()} alpha user{i}@mail.example {word()}" for i in range(200)]
    texts += [f"{word()} alpha ticket-{1000 + i} {word()}" for i in range(18)] + [f"{word()} beta ticket-{1000 + i} {word()}" for i in range(18)]
    texts += [f"{word()} beta room#{77 + i} {word()}" for i in range(2)]
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    by_rounds = {}
    for rounds in (1, 3):
        out = pii.extract(docs, rounds=rounds).collect()
        by_rounds[rounds] = {texts[r["doc_id"]][s["start"] : s["end"]].split("-")[0].split("#")[0] for r in out for s in r["spans"] if s["kind"] == "found_email"}
    assert by_rounds == {1: {"ticket"}, 3: {"ticket", "room"}}


# ---------------------------------------------------------------- archives


def test_urls_are_read_back_as_they_were(spark):
    urls = ["http://a/é?q=1 2", "http://a/%C3%A9", "a\r\nWARC-Type: revisit", " padded ", "", None, "tab\there", "http://a/: b"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    index, records = warc.archive(pages.repartition(3), frame_bytes=100, bundle_bytes=200)
    assert {r["page_id"]: r["url"] for r in records.collect()} == dict(enumerate(urls))
    assert records.rdd.getNumPartitions() == index.select("bundle").distinct().count() > 2


# ---------------------------------------------------------------- nearest neighbours


def test_equal_vectors_tie_by_id_wherever_they_lie(spark):
    rng = np.random.default_rng(5)
    some = rng.standard_normal((30, 24))
    rows = [(i, some[i % 30].tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in ann.search(df, F.col("vec_id") % 20 == 0, block_rows=200).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("v")).collect():
        own = [(-x["score"], x["vec_id"]) for x in r["v"]]
        assert own == sorted(own)
        same = [x for x in r["v"] if x["vec_id"] % 30 == r["query_id"] % 30]
        assert len({x["score"] for x in same}) == 1


def test_huge_and_tiny_components_end(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.choice([-300, 0, 200])).tolist()) for i in range(120)] + [(500, [0.0, 1.0]), (520, [1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.search(df, F.col("vec_id") % 20 == 0, k=5).collect()
    assert {r["query_id"] for r in out} == {*range(0, 120, 20), 500, 520}


def test_repeated_ids_do_not_depend_on_order(spark):
    rng = np.random.default_rng(7)
    rows = [(i % 50, rng.standard_normal(6).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    results = [sorted(map(tuple, ann.search(d, F.col("vec_id") % 10 == 0, k=4).collect())) for d in (df, df.orderBy(F.rand(1)).repartition(7))]
    assert results[0] == results[1] and len(results[0]) == 20


def test_a_small_share_is_verified():
    rng = np.random.default_rng(8)
    vectors = ann.unit(rng.standard_normal((8192, 64)))
    built = ann.CollisionIndex(vectors)
    queries = vectors[:60]
    least = ann.PER_NEIGHBOUR * (ann.K + 1) + int(ann.SHARE * len(vectors))
    hits = built.candidates(queries, least)
    assert np.mean([len(h) for h in hits]) < 0.1 * len(vectors)
    # of the nearest of all a block holds a few
    recall = np.mean([len(np.intersect1d(h, np.argsort(-(vectors @ q))[:6])) / 6 for h, q in zip(hits, queries, strict=True)])
    assert recall >= 0.9


# ---------------------------------------------------------------- pipeline


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_digest_of_kept_bytes(spark):
    docs = frame(spark, [(1, "x" * 150, "a"), (2, "y" * 99 + "é", "a"), (None, "x" * 120, "a")])
    for r in suffix_dedup.remove_repeats(docs).collect():
        assert r["kept_sha256"] == hashlib.sha256(bytes(r["kept"])).hexdigest()
        assert r["n_bytes"] - r["n_removed"] == len(r["kept"])
