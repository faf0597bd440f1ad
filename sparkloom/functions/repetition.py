"""Collapse of repeated sentences and word patterns: a greedy left-to-right scan, so an Arrow-batched function."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.pieces import in_pieces
from sparkloom.ship import ship

_MARKS = re.compile(r"([.!?\n])")
SHORT = 20
LONGEST = 15


def _run(items: list[str], at: int, width: int, stride: int) -> int:
    """How often items[at : at + width] occurs in a row, ``stride`` apart."""
    pattern, count, nxt = items[at : at + width], 1, at + stride
    while nxt + width <= len(items) and items[nxt : nxt + width] == pattern:
        count, nxt = count + 1, nxt + stride
    return count


def collapse_sentences(text: str, least: int, observed: bool) -> str:
    """Runs of ``least`` or more equal sentences keep one, with its mark.

    ``observed`` also takes marks themselves as sentences, so that equal marks in a row swallow what is
    between them; otherwise only sentences start a run.
    """
    parts, out, at = _MARKS.split(text), [], 0
    while at < len(parts):
        may = at + 2 * least <= len(parts) and (observed or at % 2 == 0) and parts[at] == parts[at + 2]
        count = _run(parts, at, 1, 2) if may else 1
        if count >= least:
            out += parts[at : at + 2]
            at += 2 * count
        else:
            out.append(parts[at])
            at += 1
    return "".join(out)


def collapse_words(sentence: str, least: int) -> str:
    """Word patterns (the longest of 15 to 2 words first) that repeat ``least`` times or more keep one."""
    words = sentence.split()
    if len(sentence) < SHORT or len(words) < 2 * least:
        return sentence
    out, at, widest = [], 0, min(LONGEST, len(words) // least)
    while at < len(words):
        step = 1
        for width in range(widest, 1, -1):
            if at + width * least > len(words) or words[at] != words[at + width]:
                continue
            count = _run(words, at, width, width)
            if count >= least:
                out += words[at : at + width]
                step = width * count
                break
        else:
            out.append(words[at])
        at += step
    return " ".join(out)


def collapse_repetition(text: str | None, least: int = 4, observed: bool = False) -> str | None:
    if not text or len(text) < SHORT:
        return text
    return "".join(collapse_words(part, least) for part in _MARKS.split(collapse_sentences(text, least, observed)))


def collapsed(text: Column, least: int = 4, mode: str = "intended") -> Column:
    """Column form. ``mode`` is ``intended`` or ``observed``."""
    ship()
    observed = mode == "observed"

    def run(values: pa.Array) -> pa.Array:
        return pa.array([collapse_repetition(t, least, observed) for t in values.to_pylist()], pa.string())

    return F.arrow_udf(in_pieces(run), "string")(text)


def collapsed_if_long(text: Column, longer_than: int = 100, least: int = 4, mode: str = "intended") -> Column:
    """Only texts of more than ``longer_than`` characters are scanned."""
    return F.when(F.length(text) > longer_than, collapsed(text, least, mode)).otherwise(text)
