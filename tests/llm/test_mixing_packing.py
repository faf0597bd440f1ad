from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import mixing, packing
from sparkloom.llm.registry import tokenizer_path
from tests.llm.conftest import frame

# ---------------------------------------------------------------- mixing


def test_targets_share_the_whole_and_stop_at_the_cap():
    got = mixing.targets({"b": 10, "a": 1000, None: 5, "c": 300})
    assert list(sorted(k for k in got if k)) == ["a", "b", "c"]
    assert abs(sum(got.values()) - 1315) < 1e-6
    assert got["b"] == 30 and got[None] == 15
    assert abs(got["c"] / got["a"] - 3) < 1e-9 or got["c"] == 900
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 30)), min_size=1, max_size=12, unique_by=lambda p: p[0]), st.integers(0, 6000), st.sampled_from([8, 64, 1 << 16]))
def test_budget_is_never_exceeded_and_exact_where_dp_reaches(pairs, budget, cells):
    sizes, counts = [p[0] for p in pairs], [p[1] for p in pairs]
    take = mixing.fit_budget(sizes, counts, budget, cells)
    assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
    got, total = sum(s * t for s, t in zip(sizes, take, strict=True)), sum(s * c for s, c in pairs)
    assert got <= max(budget, 0)
    if cells == 1 << 16 and budget <= total:
        sums = {0}
        for s, c in pairs:
            sums = {x + s * n for x in sums for n in range(c + 1) if x + s * n <= budget}
        assert got == max(sums)


def test_copies_come_near_the_target():
    assert mixing.fit_copies([3, 100], [5, 1], 40) == [13, 0]  # repeats of the small ones
    assert mixing.fit_copies([100], [1], 40) == [0]
    assert mixing.fit_copies([100], [1], 60) == [1]
    assert mixing.fit_copies([100], [2], 310) == [3]
    assert mixing.fit_copies([100], [2], 600) == [6]
    assert mixing.fit_copies([0], [4], 10) == [0]


def test_mix_matches_contract(spark, odd_rows):
    rows = [r for r in odd_rows if r[0] != 999] + [(5000 + i, "one two three", "a") for i in range(200)]
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    size = Counter(len((t or "").split()) for _, t, _ in rows)
    assert Counter(r["size"] for r in out) == size
    taken, by_source = defaultdict(int), {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        by_source[r["source"]] = (r["source_size"], r["target"])
    expected = mixing.targets({s: v[0] for s, v in by_source.items()})
    for s, (_, target) in by_source.items():
        assert abs(target - expected[s]) < 1e-6
        assert abs(taken[s] - target) <= 1
    again = mixing.mix(frame(spark, rows, parts=5)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in out)


def test_materialised_mix(spark, odd_rows):
    rows = [r for r in odd_rows if r[0] not in (8, None)]
    docs = frame(spark, rows)
    picks = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.materialised_mix(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({i: n for i, n in picks.items() if n})


def test_mix_empty(spark):
    assert mixing.mix(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def reference_ids(tokenizer, texts):
    return [np.asarray(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_cached_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(1)
    letters = [chr(c) for c in range(9, 256)] + ["'s", "'S", "'ll", "'VE", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " ", " "]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(rng.choices([chr(c) for c in range(0x2FF)] + ["Σ", "İ", "😀", "中", "é"], k=25)) for _ in range(500)]
    own = packing.WordTokenizer(tokenizer_path())
    got = []
    for i in range(0, len(texts), 700):
        ids, edges = own.encode(pa.array(texts[i : i + 700], pa.string()))
        got += [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
    assert got == reference_ids(tokenizer, texts)
    for some in ([], [""], ["", " \n"], ["Σ"]):
        ids, edges = own.encode(pa.array(some, pa.string()))
        assert len(edges) == len(some) + 1 and edges[-1] == len(ids)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_tournament_first_fit_is_plain_first_fit(sizes):
    bins, at = packing.first_fit_decreasing(sizes, 64)
    room, expected = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), None)
        if b is None:
            room.append(64)
            b = len(room) - 1
        room[b] -= sizes[i]
        expected[i] = b
    assert bins == expected
    for b in set(bins):
        spans = sorted((at[i], sizes[i]) for i in range(len(sizes)) if bins[i] == b)
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]


def test_pack_holds_every_id_once(spark, odd_rows, tokenizer):
    out = packing.pack(frame(spark, odd_rows), tokenizer_path(), length=256, group_docs=16).collect()
    texts = {(i, t): ids + (1).to_bytes(4, "little") for (i, t, _), ids in zip(odd_rows, reference_ids(tokenizer, [t or "" for _, t, _ in odd_rows]), strict=True)}
    by_id = {i: ids for (i, _), ids in texts.items()}
    pieces = defaultdict(Counter)
    for r in out:
        ids = by_id[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) // 4
        assert zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]
        pieces[r["doc_id"]][r["start"], r["length"]] += 1
    copies = Counter(i for i, _, _ in odd_rows)
    for i, found in pieces.items():
        assert set(found.values()) == {copies[i]}
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(by_id[i]) // 4
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        assert sum(n for _, n in spans) <= 256
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length


def test_little_padding(spark, words):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(words, k=int(rng.lognormvariate(4, 1)) + 1)), "a") for i in range(3000)]
    out = packing.pack(frame(spark, rows), tokenizer_path()).groupBy("sequence_id").sum("length").collect()
    fill = [r[1] for r in out]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in fill)
    assert padding <= 0.01 * sum(fill)


def test_pack_empty(spark):
    assert packing.pack(frame(spark, []), tokenizer_path()).count() == 0
