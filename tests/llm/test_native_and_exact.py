from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import exact_dedup, pii, registry
from sparkloom.llm.common import table
from tests.compare import connect, of_frame, of_sql
from tests.llm.conftest import frame

# ---------------------------------------------------------------- exact dedup


def plain_exact(rows):
    out, groups = [], {}
    for n, (i, t, _) in enumerate(rows):
        t = t or ""
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), (i is not None, i or 0), n, i))
    for key, members in groups.items():
        best = min(members)
        out += [(m[3], best[3], len(members), hashlib.sha256(key.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy_rows", [2, 64])
def test_exact_dedup_matches_plain(spark, odd_rows, heavy_rows):
    rows = odd_rows + [(2000 + i, "a very common text", "a") for i in range(80)]
    marks = exact_dedup.duplicates(frame(spark, rows), heavy_rows=heavy_rows)
    got = [tuple(r) for r in marks.select("doc_id", "keep_id", "group_size", "text_sha256").collect()]
    assert sorted(got, key=repr) == plain_exact(rows)
    kept = marks.filter("kept")
    assert kept.count() == marks.select("text_sha256").distinct().count()
    assert kept.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).count() == 0


def test_heavy_groups_are_found(spark):
    rows = [(i, f"text {i % 300 if i % 3 else 'hot'}", "a") for i in range(900)]
    digest, points = exact_dedup.digest_columns()
    narrow = frame(spark, rows).select("doc_id", digest.alias("d"), points.alias("n_points"), F.monotonically_increasing_id().alias("rid"))
    heavy = exact_dedup.heavy_groups(narrow, "d", 64, 10).collect()
    assert [r["group_size"] for r in heavy] == [300]


def test_deduplicate_keeps_columns(spark, odd_rows):
    docs = frame(spark, odd_rows)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert out.count() == len({r[3] for r in plain_exact(odd_rows)})


def test_exact_dedup_empty(spark):
    assert exact_dedup.duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.deduplicate(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_sql(name, spark, sf_dir):
    assert of_frame(registry.queries()[name](spark, sf_dir)) == of_sql(connect(sf_dir), registry.oracle_sql()[name])


# ---------------------------------------------------------------- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    spans = [(m.start(), k, m.end(), kind) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "") if good(kind, m.group())]
    return [(a, b, kind) for a, _, b, kind in sorted(spans)]


def pii_texts():
    rng = random.Random(8)
    atoms = ["a.b@c.d", "x@y", "@", "a@b.c_d@e.f.g", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "0000255.1.1.1", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", "++49 30 1234567.", "é", "😀", " ", "-", ".", "0", "12", "word", "\n"]
    texts = ["".join(rng.choices(atoms, k=rng.randint(0, 25))) for _ in range(400)]
    return texts + ["1" * 5000, "7 " * 3000, "+" * 50 + "5" * 40, "a" * 3000 + "@", "1.2.3.4 " * 700]


def test_base_spans_match_plain(spark):
    rows = [(i, t, "a") for i, t in enumerate(pii_texts())] + [(9001, None, "a"), (9002, "", "a"), (None, "a@b.c", "a")]
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"] if not s["kind"].startswith("found")] for r in pii.extract(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i] == plain_base(t), t


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(i, f"lorem ipsum mail user{i}@host{i}.org today dolor", "a") for i in range(40)]
    rows += [(100 + i, f"some call +1 555 {rng.randint(200, 999)} {rng.randint(1000, 9999)} soon sit", "a") for i in range(40)]
    rows += [(300, "then mail bob99(at)example today amet", "a"), (301, "an order number X1234567 of amet", "a")]
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in pii.extract(frame(spark, rows)).collect()}
    assert got[300] == [(10, 26, "found_email")]
    assert got[301] == []


def test_pii_empty(spark):
    assert pii.extract(frame(spark, [])).count() == 0


def test_pii_query_has_no_python(spark, sf_dir):
    plan = registry.op1_pii(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert registry.op1_pii(spark, sf_dir).count() == table(spark, sf_dir, "documents").count()
