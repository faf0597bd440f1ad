from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import simhash, suffix_dedup
from sparkloom.llm.common import Scratch
from tests.llm.conftest import frame

# ---------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_every_set_of_positions_is_missed_by_some_mask():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for positions in itertools.combinations(range(64), radius):
            bits = sum(1 << p for p in positions)
            assert any(m & bits == 0 for m in masks)


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 60), st.integers(1, 9), st.integers(0, 1 << 30))
def test_bucket_links_give_all_components(n, spread, seed):
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    members = sorted({centre ^ sum(1 << rng.randrange(24) for _ in range(rng.randrange(spread + 1))) & (2**64 - 1) for _ in range(n)})
    values = np.asarray(members, np.uint64)
    expected = plain_components(members, 3)
    for small in (512, 0):  # all pairs, and leaders
        links = simhash.bucket_links(values, 3, small)
        assert len(links) < len(members)
        assert all((members[a] ^ members[b]).bit_count() <= 3 for a, b in links)
        parent = list(range(len(members)))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            parent[root(a)] = root(b)
        got = [root(i) for i in range(len(members))]
        assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def near_rows(words):
    rng = random.Random(6)
    rows = []
    for g in range(12):
        text = rng.choices(words, k=300)
        for v in range(8):
            own = list(text)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((g * 100 + v, " ".join(own), "a"))
    return rows


def test_near_duplicates_match_plain(spark, odd_rows, words):
    rows = odd_rows + [(i + 3000, t, s) for i, t, s in near_rows(words)]
    out = simhash.near_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    prints = {(i, t): plain_fingerprint(t) for i, t, _ in rows}
    assert sorted((r["doc_id"] or -1, r["fingerprint"]) for r in out) == sorted((i or -1, f"{prints[i, t]:016x}") for i, t, _ in rows)
    values = [prints[i, t] for i, t, _ in rows]
    groups = plain_components(values, 3)
    least = {g: min((rows[i][0] for i in range(len(rows)) if groups[i] == g and rows[i][0] is not None), default=None) for g in set(groups)}
    expected = sorted((rows[i][0] or -1, least[groups[i]] or -1) for i in range(len(rows)))
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == expected
    assert len(set(groups)) < len(set(values))


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1003), (1001, 1003)]
    random.Random(1).shuffle(chain)
    edges = spark.createDataFrame(chain, "a long, b long").repartition(4)
    scratch = Scratch(spark, "t")
    got = {r["v"]: r["c"] for r in simhash.components(edges, scratch).collect()}
    assert len([p for p in scratch._live if "-edges" in p]) <= 3  # rounds
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000, 1003: 1000}


def test_one_of_each(spark, words):
    rows = near_rows(words) + [(7, "x y z", "a"), (7, "x y z", "a")]
    docs = frame(spark, [r for r in rows if r[0] != 7 or r[1] == "x y z"])
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert out.count() == simhash.near_duplicates(docs).select("component_id").distinct().count()


def test_simhash_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- repeated substrings


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=60) | st.text("ab", max_size=80).map(str.encode) | st.integers(0, 70).map(lambda n: b"a" * n), max_size=12), st.integers(1, 16))
def test_two_stage_order_is_suffix_order(parts, depth):
    text = np.frombuffer(b"".join(parts), np.uint8)
    raw = text.tobytes()
    rng = np.random.default_rng(len(raw))
    needed = rng.random(len(text)) < 0.7
    order = suffix_dedup.two_stage(text, needed, depth)
    assert sorted(order.tolist()) == np.flatnonzero(needed).tolist()
    keys = [raw[i : i + depth] for i in order.tolist() if i + depth <= len(raw)]
    assert keys == sorted(keys)


def test_common_prefix():
    raw = b"abcdefghijXklmnop" + b"abcdefghijYklmnop" + bytes(64)
    words = suffix_dedup.words_of(np.frombuffer(raw, np.uint8), 0)
    assert suffix_dedup.common_prefix(words, np.array([0, 5, 0]), np.array([17, 22, 0]), 30).tolist() == [10, 5, 30]


def plain_removal(rows, length):
    """Row number -> removed positions. Rows in document order; equal rows are copies."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    seen, out = set(), {}
    for n in order:
        text, gone = (rows[n][1] or "").encode(), set()
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            if w in seen:
                gone.update(range(p, p + length))
            seen.add(w)
        out[n] = gone
    return out


def summary(rows, removal):
    out = []
    for n, gone in removal.items():
        text = (rows[n][1] or "").encode()
        spans = sum(1 for p in gone if p - 1 not in gone)
        kept = bytes(b for p, b in enumerate(text) if p not in gone)
        out.append((rows[n][0], len(text), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_rows(words):
    rng = random.Random(9)
    passage, other = " ".join(rng.choices(words, k=60)), " ".join(rng.choices(words, k=25))
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(5, 120))), "a") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choices(words, k=rng.randint(0, 20))) + passage + " ".join(rng.choices(words, k=10)), "a") for i in range(30)]
    rows += [(200 + i, other[rng.randrange(20) :] + "é" * rng.randint(0, 90) + other, "a") for i in range(12)]
    rows += [(300, "ab" * 400, "a"), (301, "a" * 500, "a"), (302, "a" * 130 + "b" * 130, "a"), (303, "ab" * 60, "a"), (304, passage, "a"), (305, passage, "a"), (1, rows[1][1], "a"), (306, None, "a"), (307, "", "a"), (308, "x" * 99, "a"), (309, "x" * 99, "a")]
    return rows


@pytest.mark.parametrize("options", [{}, {"hot": 2}, {"hot": 8, "slice_bytes": 2000, "bucket_records": 200, "array_bytes": 3000}, {"counters": 4, "hot": 2}])
def test_removal_matches_plain(spark, words, odd_rows, options):
    rows = substring_rows(words) + [r for r in odd_rows if r[0] != 1]
    out = suffix_dedup.remove_repeats(frame(spark, rows, parts=4), **options)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect()), key=repr)
    assert got == summary(rows, plain_removal(rows, 100))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in out.collect())


def test_removal_empty(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    assert suffix_dedup.remove_repeats(frame(spark, [(1, None, "a")])).collect()[0]["n_bytes"] == 0
