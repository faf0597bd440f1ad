"""Hand-derived cases of the fixture notes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import geometry as G
from sparkloom.functions import records as R
from sparkloom.functions import repetition as P
from sparkloom.functions import tables as H
from sparkloom.functions import text as T
from sparkloom.functions import tokens as K
from sparkloom.operators import documents as D
from sparkloom.operators import layout as L
from sparkloom.operators import metrics as M
from sparkloom.operators import sampling as Z
from sparkloom.operators import scheduling as Q
from sparkloom.operators import speech as S

BOX = "doc string, page int, pos int, label string, text string, coordinate array<double>"
PAGE = [
    ("doc1", 7, 0, "paragraph_title", "1. Intro", [100.0, 100.0, 400.0, 130.0]),
    ("doc1", 7, 1, "text", "body", [100.0, 140.0, 400.0, 300.0]),
    ("doc1", 7, 2, "text", "far", [100.0, 600.0, 400.0, 700.0]),
    ("doc1", 7, 3, "text", "right col", [600.0, 120.0, 900.0, 200.0]),
    ("doc1", 7, 4, "footer", "12", [110.0, 950.0, 400.0, 980.0]),
]


def value(spark, column, **columns):
    rows = spark.createDataFrame([tuple(columns.values())], list(columns)) if columns else spark.range(1)
    return rows.select(column.alias("v")).first()["v"]


def test_block_ordering(spark):
    rows = L.block_order(spark.createDataFrame(PAGE, BOX)).orderBy("rank").collect()
    assert [(r["text"], r["block_id"]) for r in rows] == [("1. Intro", 0), ("body", 0), ("far", 1), ("12", 2), ("right col", 3)]


def test_leaders_compare_with_the_first_member(spark):
    x = F.array(*[F.lit(float(v)) for v in (0, 90, 150, 95, 260)])
    assert value(spark, L.column_leaders(x)) == [0, 0, 1, 0, 2]
    assert value(spark, L.column_leaders(F.array().cast("array<double>"))) == []


def test_page_markdown(spark):
    boxes = L.block_order(spark.createDataFrame(PAGE, BOX))
    assert D.markdown_documents(boxes, least=50).first()["markdown"] == "# doc1\n\n"
    assert D.markdown_documents(boxes, least=30).first()["markdown"] == "# doc1\n\n## 페이지 7\n\n**1. Intro**\n\nbody\n\nfar\n\nright col\n\n"


@pytest.mark.parametrize(
    ("text", "observed", "intended"),
    [
        ("aaaa.bbbb.cccc.dddd.eeee?ffff.", "aaaa.bbbb?ffff.", "aaaa.bbbb.cccc.dddd.eeee?ffff."),
        ("Hi there. Hi there. Hi there. Hi there. End of it.", "Hi there. Hi there", "Hi there. Hi there. Hi there. Hi there. End of it."),
        ("alpha beta alpha beta alpha beta alpha beta omega", "alpha beta omega", "alpha beta omega"),
        ("short. short. s.", "short. short. s.", "short. short. s."),
    ],
)
def test_repetition_collapse(text, observed, intended):
    assert P.collapse_repetition(text, observed=True) == observed
    assert P.collapse_repetition(text) == intended


def test_sentences_and_chunks(spark):
    assert value(spark, T.dedup_sentences(F.lit("A. B! A. C"))) == "A. B! C"
    assert value(spark, T.split_chunks(F.lit("aaaa bbbb. cccc dddd. eeee"), 20)) == ["aaaa bbbb.", "cccc dddd. eeee"]
    assert value(spark, T.split_chunks(F.lit("aaaa\n\nbbbb\n\ncccccccccccc"), 14)) == ["aaaa\n\nbbbb", "cccccccccccc"]
    assert value(spark, T.split_chunks(F.lit("a" * 30), 20)) == ["a" * 30]
    assert value(spark, T.split_chunks(F.lit(""), 20)) == []
    assert value(spark, T.split_chunks(F.lit(None).cast("string"), 20)) == []


def test_page_ranges_and_ids(spark):
    rows = spark.createDataFrame([("a", 7), ("b", 3), ("b", 1), ("b", 2), ("c", None)], "doc string, page int")
    assert dict(D.page_range(rows, "doc", "page").collect()) == {"a": "007", "b": "001-003", "c": "000"}
    assert value(spark, T.chunk_ids(F.lit("007_text"), F.array(F.lit("x"), F.lit("y")))) == ["007_text_chunk1", "007_text_chunk2"]
    assert value(spark, T.chunk_ids(F.lit("007_text"), F.array(F.lit("x")))) == ["007_text"]


def test_page_slice_modes(spark):
    md = F.lit("## 페이지 1\n\none\n\n---\n\n## 페이지 3\n\nthree\n\n")
    assert value(spark, D.page_slice(md, F.lit(1), observed=True)) == "one\n\n---\n\n## 페이지 3\n\nthree"
    assert value(spark, D.page_slice(md, F.lit(1))) == "one"
    assert value(spark, D.page_slice(md, F.lit(2))) is None


def test_tables():
    across = "<table><tr><td>H</td><td><l></l></td></tr><tr><td>a</td><td>b</td></tr></table>"
    assert H.matrix_to_html(across) == '<table><tr><td colspan="2">H</td></tr><tr><td>a</td><td>b</td></tr></table>'
    down = "<table><tr><td>R</td><td>x</td></tr><tr><td><t></t></td><td>y</td></tr></table>"
    assert H.matrix_to_html(down) == '<table><tr><td rowspan="2">R</td><td>x</td></tr><tr><td>y</td></tr></table>'
    assert H.html_to_matrix(H.matrix_to_html(across)) == "<table><tr><td>H</td><td><l></td></tr><tr><td>a</td><td>b</td></tr></table>"
    with pytest.raises(H.TableShapeError):
        H.matrix_to_html("<table><tr><td>a</td></tr><tr><td>b</td><td>c</td></tr></table>")


def test_table_column(spark):
    text = "intro\n\n<table><tr><td>H</td><td><l></l></td></tr></table>\n\nend"
    assert value(spark, H.tables_to_html(F.lit(text))) == 'intro\n\n<table><tr><td colspan="2">H</td></tr></table>\n\nend'
    assert value(spark, H.tables_to_html(F.lit(None).cast("string"))) is None


SEGMENTS = [("x", 1.0, 4.0, "A"), ("x", 3.0, 3.5, "B"), ("x", 5.0, 40.0, "A")]


def test_speech(spark):
    rows = spark.createDataFrame(SEGMENTS, "audio string, start double, end double, speaker string")
    filled = S.fill_gaps(rows, spark.createDataFrame([("x", 45.0)], "audio string, duration double"))
    unknown = sorted((r["start"], r["end"]) for r in filled.filter("speaker = 'UNKNOWN'").collect())
    assert unknown == [(0.0, 1.0), (3.5, 5.0), (40.0, 45.0)]
    pieces = S.split_long(filled)
    assert pieces.count() == 8
    assert sorted(r["start"] for r in pieces.filter("speaker = 'A' AND start >= 5").collect()) == [5.0, 20.0, 35.0]
    texts = {1.0: "a1", 3.0: "b", 5.0: "a2", 20.0: "a3", 35.0: "a4"}
    known = [(r["audio"], r["start"], r["end"], r["speaker"], texts[r["start"]]) for r in pieces.filter("speaker <> 'UNKNOWN'").collect()]
    merged = S.merge_speakers(spark.createDataFrame(known, "audio string, start double, end double, speaker string, text string"))
    assert sorted((r["speaker"], r["text"], r["start"], r["end"]) for r in merged.collect()) == [("A", "a1", 1.0, 4.0), ("A", "a2 a3 a4", 5.0, 40.0), ("B", "b", 3.0, 3.5)]


def test_nearest_title(spark):
    def page(*titles):
        rows = [("d", 1, 0, "image", "", [100.0, 100.0, 200.0, 200.0])] + [("d", 1, i + 1, "figure_title", t, b) for i, (t, b) in enumerate(titles)]
        return L.nearest_title(spark.createDataFrame(rows, BOX)).first()["subtitle"]

    assert page(("t1", [100.0, 210.0, 200.0, 230.0]), ("t2", [100.0, 70.0, 200.0, 90.0])) == "t2"
    assert page(("at50", [100.0, 250.0, 200.0, 260.0])) == "at50"
    assert page(("at51", [100.0, 251.0, 200.0, 260.0])) is None
    assert page(("over", [150.0, 150.0, 250.0, 250.0]), ("near", [100.0, 201.0, 200.0, 230.0])) == "over"
    assert page() is None


def test_tolerant_json(spark):
    def parse(raw):
        return value(spark, R.tolerant_page(F.lit(raw)))

    good = parse('{"natural_text":"hi"}')
    assert (good["primary_language"], good["is_rotation_valid"], good["rotation_correction"], good["is_table"], good["natural_text"]) == ("ko", True, 0, False, "hi")
    cut = parse('{"primary_language":"en","natural_text":"abc')
    assert (cut["primary_language"], cut["natural_text"]) == ("en", R.FAILED)
    assert parse("garbage")["natural_text"] == R.FAILED


def test_toc_pages(spark):
    pages = spark.createDataFrame([("d", p) for p in range(1, 7)], "doc string, page int")

    def keep(entries):
        toc = spark.createDataFrame([("d", lv, p) for lv, p in entries], "doc string, level int, page int")
        return sorted(r["page"] for r in D.toc_pages(pages, toc).collect())

    assert keep([(1, 1), (2, 2), (1, 4), (2, 5)]) == [2, 3, 5, 6]
    assert keep([(1, 1), (1, 4)]) == [1, 2, 3, 4, 5, 6]
    assert keep([]) == [1, 2, 3, 4, 5, 6]
    assert keep([(1, 3), (2, 5)]) == [1, 2, 5, 6]


def test_masks(spark):
    rows = spark.createDataFrame([("r", 0, 2.0), ("r", 1, 2.0), ("r", 2, 1.0)], "req string, token_id int, logit double")

    def kept(df):
        return sorted(r["token_id"] for r in df.filter(F.col("logit") > Z.NEVER).collect())

    p = [round(r["p"], 4) for r in rows.select("token_id", Z.softmax(F.col("logit"), Z._req()).alias("p")).orderBy("token_id").collect()]
    assert p == [0.4223, 0.4223, 0.1554]
    assert kept(Z.top_k_mask(rows, 1)) == [0, 1]
    assert kept(Z.top_p_mask(rows, 0.5)) == [0, 1]
    assert kept(Z.min_p_mask(rows, 0.5)) == [0, 1]
    rank = Z.sampled_rank(rows, spark.createDataFrame([("r", 0)], "req string, token_id int")).first()["rank"]
    assert rank == 2
    signed = spark.createDataFrame([("r", 0, 2.0), ("r", 1, -2.0)], "req string, token_id int, logit double")
    counts = spark.createDataFrame([("r", 0, 1), ("r", 1, 1)], "req string, token_id int, n long")
    out = Z.penalised(signed, counts, None, 0.0, 0.0, 2.0).orderBy("token_id").collect()
    assert [r["logit"] for r in out] == [1.0, -4.0]


@pytest.mark.parametrize(
    ("tokens", "low", "high", "k", "expected"),
    [([1, 2, 3, 4, 1, 2, 3], 2, 2, 3, [4, 1, 2]), ([1, 2, 3, 4, 1, 2, 3, 5, 6], 2, 2, 3, None), ([1, 3, 6, 2, 3, 4, 1, 2, 3], 1, 1, 2, [6, 2])],
)
def test_ngram_lookup(spark, tokens, low, high, k, expected):
    assert value(spark, K.ngram_proposal(F.array(*[F.lit(t) for t in tokens]), low, high, k, 1000)) == expected


def test_metrics(spark):
    assert G.one_two_five(100) == [1, 2, 5, 10, 20, 50, 100]
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate((1.0, 3.0, 5.0))], "k string, i int, v double")
    assert [r["moving"] for r in M.moving_average(rows, "v", 2, ("k",), ("i",)).orderBy("i").collect()] == [1.0, 2.0, 4.0]
    stats = spark.createDataFrame([(1, 1, 5, 50, 10), (1, 2, 5, 50, 30), (1, 3, 4, 40, 40)], "cache long, seq long, requests int, queries int, hits int")
    last = M.recent_hit_rate(stats, 10, ("cache",)).filter("seq = 3").first()["hit_rate"]
    assert round(last, 4) == 0.7778


def test_reasoning(spark):
    def parse(output):
        return tuple(value(spark, T.split_reasoning(F.lit(output))))

    assert parse("This is a reasoning section</think>This is the rest") == ("This is a reasoning section", "This is the rest")
    assert parse("no end tag") == ("no end tag", None)
    assert parse("end tag last</think>") == ("end tag last", None)


def test_batch_lines(spark, tmp_path):
    from sparkloom.sources import files

    (tmp_path / "in.jsonl").write_text('{"custom_id":"a","method":"POST","url":"/v1/embeddings","body":{"x":1}}\n\n   \n{"custom_id":"b","method":"POST","url":"/bad_url","body":{}}\n')
    rows = Q.dispatch(files.read_requests(spark, str(tmp_path / "in.jsonl"))).orderBy("custom_id").collect()
    assert [(r["custom_id"], r["task"], r["status"]) for r in rows] == [("a", "embedding", 200), ("b", None, 400)]
    (tmp_path / "empty.jsonl").write_text("")
    assert files.read_requests(spark, str(tmp_path / "empty.jsonl")).count() == 0
    done = files.responses(Q.dispatch(files.read_requests(spark, str(tmp_path / "in.jsonl"))).withColumn("error", F.lit("unknown url")))
    files.write_lines(done, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).filter("error IS NOT NULL").count() == 1


def test_null_and_empty_text(spark):
    rows = spark.createDataFrame([(None,), ("",), ("   ",)], "t string")
    got = rows.select(T.dedup_sentences(F.col("t")).alias("d"), T.strip(F.col("t")).alias("s"), T.last_number(F.col("t")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(None, None, None), ("", "", None), ("", "", None)]


def test_balanced_bins(spark):
    rows = spark.createDataFrame([(0, i, float(s)) for i, s in enumerate((1000, 100, 200, 50))], "group long, item long, size double")
    got = {r["item"]: r["bin"] for r in Q.balanced(rows, 2).collect()}
    assert got == {0: 0, 2: 1, 1: 1, 3: 1}
    even = Q.packed_evenly(rows, 2).groupBy("bin").count().collect()
    assert {r["count"] for r in even} == {2}
