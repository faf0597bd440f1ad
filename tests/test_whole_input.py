"""Queries read every row and every word: plain versions on small tables that are larger than the old cuts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sparkloom.plans import registry
from tests.compare import connect, of_frame, of_sql

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    start = [rng.choice(["a", "bb", "ccc", "dddd"]) for _ in range(30)]
    return {i: " ".join(start + [rng.choice(["a", "bb", "ccc", "dddd"]) for _ in range(n)]) for i, n in enumerate((0, 15, 31, 47, 68, 90, 400))}


@pytest.fixture(scope="module")
def token_dir(spark, texts, tmp_path_factory):
    path = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(path / "documents.parquet"))
    return str(path)


def tokens_of(text: str) -> list[int]:
    return [len(w) % 4 for w in text.split(" ")]


def result(spark, name: str, sf_dir: str, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in QUERIES[name](spark, sf_dir).collect()}


def chained(tokens: list[int]) -> list[str]:
    parent, out = "root", []
    for i in range(0, len(tokens) // 4 * 4, 4):
        parent = hashlib.sha256(f"{parent}|{','.join(map(str, tokens[i : i + 4]))}|".encode()).hexdigest()
        out.append(parent)
    return out


def test_hashes_of_all_words(spark, texts, token_dir):
    hashes = {i: chained(tokens_of(t)) for i, t in texts.items()}
    assert result(spark, "jsn9_prefix_hashes", token_dir, "doc_id", "blocks") == {i: len(h) for i, h in hashes.items()}
    cache = {h for i, own in hashes.items() if i % 2 == 0 for h in own}
    expected = {}
    for i, own in hashes.items():
        run = next((k for k, h in enumerate(own) if h not in cache), len(own))
        expected[i] = min(run, (len(tokens_of(texts[i])) - 1) // 4)
    assert result(spark, "jn9_cached_prefix", token_dir, "req", "blocks") == expected
    assert expected[6] > 10


def test_token_queries_take_all_words(spark, texts, token_dir):
    tokens = {i: tokens_of(t) for i, t in texts.items()}
    assert result(spark, "ag21_token_counts", token_dir, "token_id", "n") == Counter(x for t in tokens.values() for x in t)
    assert result(spark, "jsn11_bad_words", token_dir, "doc_id", "bad") == {i: t[-2:] == [2, 3] for i, t in tokens.items()}
    joined = {i: "".join(map(str, t)) for i, t in tokens.items()}
    assert result(spark, "jsn16_token_replace", token_dir, "doc_id", "tokens") == {i: t.replace("12", "9") for i, t in joined.items()}
    assert result(spark, "jsn16_token_replace", token_dir, "doc_id", "found") == {i: t.count("12") for i, t in joined.items()}
    assert result(spark, "tk16_offset_order", token_dir, "doc_id", "reversed") == {i: t[::-1] for i, t in joined.items()}


def test_ngram_lookup_takes_all_words(spark, texts, token_dir):
    def proposal(t: list[int]) -> str | None:
        n = len(t)
        for width in (3, 2):
            for i in range(n - width):
                if t[i : i + width] == t[-width:]:
                    return ",".join(map(str, t[i + width : i + width + 3]))
        return None

    assert result(spark, "jsn10_ngram_lookup", token_dir, "doc_id", "proposal") == {i: proposal(tokens_of(t)) for i, t in texts.items()}


@pytest.fixture(scope="module")
def vector_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vectors")
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-0.4, 0.4) for _ in range(11)]) for i in [*range(3), *range(30, 34), *range(400, 423)]]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(path / "embeddings.parquet"))
    return str(path), dict(rows)


def brute_beams(row: list[float], width: int, steps: int, eos: int) -> list[tuple[str, float]]:
    """The same rule over every token of the vocabulary."""
    x = [round(v * 20, 1) for v in row]
    lp = [v - math.log(sum(map(math.exp, x))) for v in x]
    beams, ended = [((), 0.0)], []
    for _ in range(steps):
        grown = sorted(((s + p, b, i, toks) for b, (toks, s) in enumerate(beams) for i, p in enumerate(lp)), key=lambda g: (-g[0], g[1], g[2]))[: 2 * width]
        ended += [(toks, s) for s, _, i, toks in grown if i == eos]
        beams = [((*toks, i), s) for s, _, i, toks in grown if i != eos][:width]
    scored = sorted(((s / max(len(toks), 1), toks) for toks, s in ended + beams), key=lambda g: (-g[0], g[1]))[:width]
    return [(",".join(map(str, toks)), s) for s, toks in scored]


def test_beam_search_takes_all_requests_and_tokens(spark, vector_dir):
    path, rows = vector_dir
    got = {(r["req"], r["rank"]): r for r in QUERIES["tk8_beam_search"](spark, path).collect()}
    assert {k[0] for k in got} == set(rows)
    for i, row in rows.items():
        expected = brute_beams(row, 3, 4, 0)
        assert len([k for k in got if k[0] == i]) == len(expected)
        assert sorted(got[i, r + 1]["score"] for r in range(len(expected))) == pytest.approx(sorted(s for _, s in expected), abs=1e-5)
        assert got[i, 1]["tokens"].count(",") == expected[0][0].count(",")
    assert any(int(x) >= 8 for r in got.values() for x in r["tokens"].split(",") if x)


def test_even_packing_takes_all_rows(spark, vector_dir):
    path, rows = vector_dir
    counts = Counter()
    for r in QUERIES["tk15_even_packing"](spark, path).collect():
        counts[r["group"]] += r["n"]
        assert r["n"] <= -(-sum(i // 40 == r["group"] for i in rows) // 8)
    assert counts == Counter(i // 40 for i in rows)


def test_modality_runs_take_all_turns(spark, tmp_path):
    rows = [(1, k, role, "") for k, role in enumerate("abaab")] + [(2, k, role, "") for k, role in enumerate("aab")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert result(spark, "tk17_modality_runs", str(tmp_path), "conv_id", "runs") == {1: 4, 2: 2}


def test_level_aggregates_take_all_lines(spark, tmp_path):
    rows = [(order, line, order * line) for order in range(1, 11) for line in range(1, 4)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert result(spark, "ag3_level_histogram", str(tmp_path), "level", "n") == Counter(p % 3 + 1 for _, _, p in rows)
    assert result(spark, "ag4_min_level", str(tmp_path), "page", "docs") == {2: 10, 4: 10, 6: 10}


def test_chunk_response_gives_a_row_for_every_document(spark, tmp_path):
    texts = {1: "a\nb", 2: "a\n\nb\nc", 3: " a \n b", 4: "a\n", 5: " \n ", 6: "", 7: "\n\n\nb\n\n c\n\n\n\n", 8: "\nx"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = {}
    for i, text in texts.items():
        answer = "\n".join(f"청크 {k}:\n{s}" for k, s in enumerate(text.split("\n"), 1))
        found = [c.strip() for c in re.findall(r"청크 \d+:\s*\n([\s\S]*?)(?=\n\s*청크 \d+:|$)", answer)]
        chunks = [c for c in found if c]
        expected[i] = (len(chunks), chunks[0] if chunks else None)
    got = {r["doc_id"]: (r["n"], r["first_chunk"]) for r in QUERIES["str6_chunk_response"](spark, str(tmp_path)).collect()}
    assert got == expected
    names, rows = of_sql(connect(str(tmp_path)), registry.oracle_sql()["str6_chunk_response"])
    assert {r[0]: (r[2], r[1]) for r in rows} == expected


@pytest.mark.parametrize("width", [6, 12])
def test_passages_of_all_rows_are_searched(tmp_path, spark, width):
    """Of 120,000 passages, as a list and beyond one: the last alone, a later one before an earlier one, one beyond the basic plane, a short one, none, no text."""
    passage = [f"{i:0{width}d}" for i in range(120_000)]
    passage[119_998], passage[119_997] = "é😀" + "y" * (width - 2), "~"
    pa_table = {"item_id": [7 * i for i in range(120_000)], "text": [p + " more" * (len(p) == 12) for p in passage]}
    pq.write_table(pa.table(pa_table), tmp_path / "benchmark.parquet")
    head = [t[:12] for t in pa_table["text"]]
    texts = ["x " + head[119_999] + " end", f"é {head[110_005]} {head[100_003]} {head[110_005]}", "😀😀" + head[119_998], "z" * 70_000 + head[119_996], "a" + head[119_997], head[3], "none", "", None]
    pq.write_table(pa.table({"doc_id": range(len(texts)), "text": texts}), tmp_path / "documents.parquet")
    con = connect(str(tmp_path))
    for name in ("str16_many_stop_strings", "str16_pattern_counts"):
        assert of_frame(QUERIES[name](spark, str(tmp_path))) == of_sql(con, registry.oracle_sql()[name])
