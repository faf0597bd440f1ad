from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, score double"


def frame(spark, rows, schema=SCHEMA, parts=3):
    """Documents with extra columns whose names clash with results."""
    full = [(i, t, "en", s, len(t) if t is not None else None, "x", 0.5) for i, t, s in rows]
    return spark.createDataFrame(full, schema).repartition(parts)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, empty and blank texts, repeated rows, ties, a long text, and ordinary ones."""
    rng = random.Random(4)
    rows = [(1, None, "a"), (2, "", None), (3, " \t\n", "b"), (4, "é😀 word", "a"), (None, "no id here", "a"), (5, "same text", "b"), (6, "same  text", "b"), (7, "sametext", "c"), (8, "dup row", "c"), (8, "dup row", "c")]
    rows += [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 60))), rng.choice("abc")) for i in range(60)]
    rows.append((999, " ".join(rng.choices(words, k=6000)), "a"))
    return rows
