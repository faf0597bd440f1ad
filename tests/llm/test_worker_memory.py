"""Python objects of a task do not grow with the Arrow batch."""

from __future__ import annotations

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from sparkloom.llm import packing, toxicity
from sparkloom.llm.common import runs
from sparkloom.llm.registry import tokenizer_path


def test_runs_are_bounded_and_whole():
    sizes = [3, 0, 9, 2, 2, 2, 0, 7, 1]
    got = list(runs(sizes, 6))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 6 or sum(x > 0 for x in sizes[a:b]) == 1 for a, b in got)
    assert list(runs([], 6)) == [] and list(runs([0, 0], 6)) == [(0, 2)]


def new_words(rng: random.Random, n: int) -> str:
    return " ".join("%08x" % rng.getrandbits(32) for _ in range(n)).translate(str.maketrans("0123456789", "ghijklmnop"))


def test_toxicity_of_a_full_batch_is_no_list_of_all_its_words(spark, monkeypatch):
    rng = random.Random(5)
    texts = [new_words(rng, 700) for _ in range(700)] + [None, ""]
    weights = np.random.default_rng(5).normal(size=1 << toxicity.HASH_BITS)
    field = toxicity.Field(weights, np.array([[1.0, -1.0], [-1.0, 1.0]]), -1.0, np.array([-1.0, 1.0, 0.5, -2.0]))
    some = {i: toxicity.Scorer(field).score([texts[i] or ""])[0][0] for i in range(0, len(texts), 40)}
    threshold = float(np.median(list(some.values())))
    made = []
    monkeypatch.setattr(toxicity, "map_arrow", lambda docs, schema, make: made.append(make))
    toxicity.keep(spark.createDataFrame([(1, "a")], "doc_id long, text string"), field, threshold)
    step = made[0]()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    kept = [i for part in step(batch) for i in part.column(0).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 140 << 20
    assert [i for i in kept if i % 40 == 0] == [i for i, s in some.items() if s < threshold]
    assert 0 < len(kept) < len(texts)


def test_packing_gives_the_tokenizer_few_words_at_a_time():
    rng = random.Random(6)
    words = new_words(rng, 20_000).split(" ")
    own = packing.WordTokenizer(tokenizer_path())
    whole = own.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    merger, given = own.merger, []
    own.merger = SimpleNamespace(encode_batch_fast=lambda texts, **more: given.append(sum(map(len, texts))) or merger.encode_batch_fast(texts, **more))
    ids, edges = own.encode(pa.array([" ".join(words)]))
    assert ids.tolist() == whole and edges.tolist() == [0, len(whole)]
    assert max(given) <= 50_000
