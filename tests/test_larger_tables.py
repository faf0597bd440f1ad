"""Queries on tables beyond the limits that small ones never meet, and memory that does not grow with them."""

from __future__ import annotations

import contextlib
import sys
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkloom.functions import patterns, repetition
from sparkloom.functions.pieces import PIECE_BYTES, in_pieces, pieces
from sparkloom.operators import adapters, detokenising, metrics, scheduling
from sparkloom.plans import registry
from tests.compare import connect, of_frame, of_sql
from tests.conftest import SF


def same_as_sql(spark, name: str, sf_dir) -> None:
    assert of_frame(registry.queries()[name](spark, str(sf_dir))) == of_sql(connect(str(sf_dir)), registry.oracle_sql()[name])


def test_recursion_of_more_than_a_million_rows(spark, tmp_path):
    duckdb.sql("SELECT 1000000 + i AS c_custkey FROM range(60000) r(i)").write_parquet(str(tmp_path / "customer.parquet"))
    same_as_sql(spark, "rel_recursive_cte", tmp_path)


@pytest.mark.parametrize("stateful", [True, False])
def test_logits_of_a_batch_are_no_python_objects(spark, stateful):
    rows = spark.range(10_000 * 256).select(F.floor(F.col("id") / 256).alias("req"), (F.col("id") % 256).alias("token_id"), F.lit(1.5).alias("logit"))
    processor = adapters.LogitsProcessor(lambda ids, x, *more: x * 0 + sys.getallocatedblocks(), stateful=stateful)
    added = spark.range(10_000).selectExpr("id AS req", "0 AS pos", "1 AS token") if stateful else None
    got = adapters.processed(rows, [processor], added=added).agg(F.count("*").alias("n"), F.max("logit").alias("most")).first()
    assert got["n"] == 10_000 * 256
    assert got["most"] < 1_500_000


def _udf_of(monkeypatch, make):
    """The function of columns that a column function gives to Spark."""
    seen = []
    monkeypatch.setattr(F, "arrow_udf", lambda f, kind: seen.append(f) or (lambda *columns: columns[0]))
    with contextlib.suppress(AnalysisException):  # what builds on the result's type
        make()
    monkeypatch.undo()
    return seen[0]


def _peak(function, *columns) -> tuple[pa.Array, int]:
    """The result, and the most bytes of Python objects on the way."""
    tracemalloc.start()
    try:
        return function(*columns), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_pieces_are_bounded_and_whole():
    texts = pa.array(["x" * 1000] * 500 + ["y" * 600_000, None, ""])
    got = [p[0] for p in pieces((texts,))]
    assert pa.concat_arrays(got).equals(texts)
    assert all(p.nbytes <= PIECE_BYTES or len(p) == 1 for p in got)
    assert in_pieces(lambda a: a.slice(0))(pa.array([], pa.string())).to_pylist() == []


def test_texts_of_a_batch_are_collapsed_in_pieces(spark, monkeypatch):
    run = _udf_of(monkeypatch, lambda: repetition.collapsed(F.lit("")))
    out, most = _peak(run, pa.array(["word " * 400 + "end."] * 5_000))
    assert out.to_pylist() == [repetition.collapse_repetition("word " * 400 + "end.")] * 5_000
    assert most < 4 << 20


def test_detokenising_holds_pieces(spark, monkeypatch):
    frame = spark.createDataFrame([(1, 0, b"a")], "req int, pos int, piece binary")
    run = _udf_of(monkeypatch, lambda: detokenising.detokenised(frame, stop=("x",)))
    out, most = _peak(run, pa.array([[b"ab"] * 100] * 3_000))
    assert len(out) == 3_000 and "".join(o["delta"] for o in out[2_999].as_py()) == "ab" * 100
    assert most < 16 << 20


def test_stop_strings_give_places_not_texts(spark, monkeypatch):
    run = _udf_of(monkeypatch, lambda: patterns.stop_at_any(F.lit(""), ["stop"]))
    out, most = _peak(run, pa.array(["é" * 1000 + "stop" + "x" * 1000] * 5_000))
    assert out.nbytes < 1 << 20 and most < 4 << 20
    rows = spark.createDataFrame([("éé stop x",), ("none",), (None,), ("stop",)], "t string")
    got = [tuple(r) for r in rows.select(patterns.stop_at_any(F.col("t"), ["stop"]).alias("r")).select("r.*").collect()]
    assert got == [("éé ", "stop"), ("none", None), (None, None), ("", "stop")]


def test_candidates_are_few_and_hold_no_texts(spark, monkeypatch):
    bits, given = bytearray(1 << 17), [f"{i:012d}" for i in range(1000)]
    for bit in _udf_of(monkeypatch, lambda: patterns.filter_bits(F.lit(""), 20))(pa.array(given)).flatten().to_pylist():
        bits[bit // 8] |= 1 << bit % 8
    run = _udf_of(monkeypatch, lambda: patterns.candidates(F.lit(""), [12], bytes(bits)))
    out, most = _peak(run, pa.array(["".join(map(chr, range(97, 123))) * 80 + "000000000007"] * 3_000 + [None, ""]))
    assert out.to_pylist() == [out[0].as_py()] * 3_000 + [[], []]
    assert {"pattern": "000000000007", "at": 2_080} in out[0].as_py() and len(out[0]) < 4
    assert out.nbytes < 1 << 20 and most < 8 << 20


def test_running_requests_of_a_hot_key_are_cut_into_buckets(spark):
    rows = spark.range(4_000).selectExpr("IF(id % 10 = 0, NULL, 1) AS k", "CAST(id * id % 977 AS DOUBLE) AS start", "CAST(id * id % 977 + id % 13 AS DOUBLE) AS `end`")
    plain, cut = [sorted(map(tuple, metrics.running_requests(rows, ("k",), n).collect()), key=repr) for n in (10**9, 50)]
    assert cut == plain and len(plain) > 500
    plan = metrics.running_requests(rows, ("k",))._jdf.queryExecution().optimizedPlan().toString()
    assert "[k" in plan and "_b#" in plan.split("Window [sum(d#", 1)[1].split("\n", 1)[0]


def test_cached_prefix_shuffles_no_hash_texts(spark):
    requests = spark.createDataFrame([(1, 9, ["p", "q"]), (2, 8, ["p", "q"]), (3, 9, ["x", "q"]), (4, 2, []), (5, 20, ["p", None, "q"]), (6, None, None)], "req int, n int, hashes array<string>")
    cache = spark.createDataFrame([("p",), ("q",), (None,), ("p",)], "hash string")
    out = scheduling.cached_prefix(requests, cache, 4)
    assert {r["req"]: r["blocks"] for r in out.collect()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0}
    exchanges = [n for n in out._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in n]
    assert exchanges and not any("hash#" in n for n in exchanges)


@pytest.mark.parametrize(("given", "kept"), [(None, 16 << 20), ("64MB", 16 << 20), ("1g", 16 << 20), ("16777217b", 16 << 20), ("8m", "8m"), ("4194304", "4194304")])
def test_joined_partitions_are_bounded_and_smaller_settings_stay(spark, given, kept):
    name, session = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.newSession()
    if given is not None:
        session.conf.set(name, given)
    registry.queries()["ag16_concurrency"](session, SF)
    assert session.conf.get(name) == str(kept)
