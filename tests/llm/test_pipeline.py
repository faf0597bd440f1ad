from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from sparkloom.llm import exact_dedup, mixing, simhash, toxicity
from sparkloom.llm.common import table
from sparkloom.llm.registry import tokenizer_path


def test_stages_on_small_tables(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs, seen = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen.append(docs.count())
        if name == "exact_dedup":
            assert seen[-1] == exact_dedup.duplicates(before).filter("kept").count()
        if name == "simhash_near_dedup":
            assert seen[-1] == simhash.near_duplicates(before).select("component_id").distinct().count()
        if name != "sequence_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert seen[0] < table(spark, sf_dir, "documents").count()
    assert seen[1] < seen[0]
    assert corpus_pipeline.run(spark, sf_dir).count() == seen[-1]


def plain_exact(rows):
    """The row that stays of each group of equal texts: most code points, then smallest id."""
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        order = (-len(r.text or ""), r.doc_id)
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    return sorted(r for _, r in best.values())


def plain_near(rows):
    """The smallest id of each component of fingerprints that differ in at most three bits."""
    marks = [int(simhash.fingerprint((r.text or "").encode(), simhash.SHINGLE, simhash.HASH_SEED)) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in zip(group, rows, strict=True):
        least[g] = min(least.get(g, r), r, key=lambda x: x.doc_id)
    return sorted(least.values())


def test_every_stage_equals_a_plain_version_row_by_row(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = table(spark, sf_dir, "documents").select(*corpus_pipeline.COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, table(spark, sf_dir, "labels")).collect()}
    kept = sorted(stages["toxicity"](spark, docs, sf_dir).collect())
    assert kept == sorted(r for r in docs.collect() if not scores[r.doc_id])
    exact = sorted(stages["exact_dedup"](spark, spark.createDataFrame(kept, docs.schema), sf_dir).collect())
    assert exact == plain_exact(kept)
    near = sorted(stages["simhash_near_dedup"](spark, spark.createDataFrame(exact, docs.schema), sf_dir).collect())
    assert near == plain_near(exact)
    mixed = stages["source_mixing"](spark, spark.createDataFrame(near, docs.schema), sf_dir).collect()
    copies, words = Counter(mixed), Counter()
    assert set(copies) <= set(near) and max(copies.values()) <= 3
    sizes = {s: sum(len(r.text.split()) for r in near if r.source == s) for s in {r.source for r in near}}
    for r in mixed:
        words[r.source] += len(r.text.split())
    for source, target in mixing.targets(sizes).items():
        # a source of a few documents has few sums; no document that may be taken once more comes nearer
        spare = [n for r in near if r.source == source and copies[r] < 3 and (n := len(r.text.split()))]
        assert abs(words[source] - target) <= 1 or all(abs(words[source] + n - target) >= abs(words[source] - target) for n in spare), source
    pieces = sorted(stages["sequence_packing"](spark, spark.createDataFrame(mixed, docs.schema), sf_dir).collect())
    encoder = Tokenizer.from_file(tokenizer_path())
    ids = {r.doc_id: [*encoder.encode(r.text, add_special_tokens=False).ids, 1] for r in near}
    used, covered = {}, Counter()
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.length == len(own)
        assert p.ids_crc32 == zlib.crc32(np.asarray(own, "<u4").tobytes())
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
        covered[p.doc_id] += p.length
    assert covered == {i: n * len(ids[i]) for i, n in Counter(r.doc_id for r in mixed).items()}
    for spans in used.values():
        ends = [0, *(a + n for a, n in sorted(spans))]
        assert [a for a, _ in sorted(spans)] == ends[:-1] and ends[-1] <= 2048


def test_stages_take_odd_rows(spark, sf_dir, odd_rows, words):
    rng = random.Random(1)
    rows = odd_rows + [(4000 + i, " ".join(rng.choices(words, k=20)), "b") for i in range(20)]
    full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_near_copies_keep_unrelated_rows_without_or_under_one_id(spark, words):
    rng = random.Random(3)
    own = [" ".join(rng.choices(words, k=60)) for _ in range(9)]
    rows = [(None, t) for t in own[:4]] + [(5, own[4]), (5, own[5])] + [(6, own[6]), (7, own[6]), (7, own[7]), (None, own[7]), (8, own[8]), (8, own[8]), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect()), key=repr)
    expected = [(None, t) for t in own[:4]] + [(5, own[4]), (5, own[5]), (6, own[6]), (7, own[7]), (8, own[8]), (9, "")]
    assert got == sorted(expected, key=repr)


def test_mix_of_rows_without_an_id_takes_what_it_chose(spark, words):
    rng = random.Random(4)
    rows = [(None if i % 3 == 0 else i // 2, " ".join(rng.choices(words, k=rng.randint(0, 12))), "en", "ab"[i % 2], 0) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    chosen, taken = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        chosen[r["doc_id"], r["source"], r["size"]] += r["copies"]
    for r in mixing.materialised_mix(docs).collect():
        taken[r["doc_id"], r["source"], len(r["text"].split())] += 1
    assert taken == +chosen
