"""Incremental detokenisation: token bytes become text as soon as they are whole characters, with stop strings.

Rows of req, pos, piece (the bytes of one token) are folded by request, in order of pos; a request is bounded by its output.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.pieces import in_pieces
from sparkloom.ship import ship

#: From so many stop strings on, one automaton looks for all of them.
MANY = 8


@lru_cache(maxsize=4)
def automaton(stop: tuple[str, ...]):
    """An Aho-Corasick automaton of stop strings with their places in the list, or none for a few."""
    if len(stop) < MANY:
        return None
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, s in enumerate(stop):
        if s and s not in out:
            out.add_word(s, i)
    out.make_automaton()
    return out


class Detokeniser:
    """The text of one request so far. Stop strings are looked for in new text once more than ``least`` tokens are there."""

    def __init__(self, stop: tuple[str, ...] = (), least: int = 0, include: bool = False):
        self.stop, self.least, self.include = stop, least, include
        self.held = 0 if include or not stop else max(map(len, stop)) - 1
        self.decode = codecs.getincrementaldecoder("utf-8")("replace").decode
        self.text, self.sent, self.tokens = "", 0, 0
        self.stopped: str | None = None
        self.machine = automaton(stop)

    def add(self, piece: bytes) -> None:
        self.tokens += 1
        before = len(self.text)
        self.text += self.decode(piece)
        if self.tokens <= self.least or len(self.text) == before:
            return
        at, s = self._first_listed(before)
        if at >= 0:
            self.text = self.text[: at + len(s) if self.include else at]
            self.stopped = s

    def _first_listed(self, before: int) -> tuple[int, str]:
        """The first listed stop string that ends in the text from ``before`` on, and where it first does; -1 if none."""
        if self.machine is None:
            found = ((self.text.find(s, max(0, before - len(s) + 1)), s) for s in self.stop)
            return next((f for f in found if f[0] >= 0), (-1, ""))
        tail = max(0, before - max(map(len, self.stop)) + 1)
        hits = ((i, tail + end) for end, i in self.machine.iter(self.text[tail:]) if tail + end >= before)
        i, end = min(hits, default=(-1, 0))
        return (end + 1 - len(self.stop[i]), self.stop[i]) if i >= 0 else (-1, "")

    def delta(self, last: bool) -> str:
        """Text not given out yet; what may be the head of a stop string is held back until the end."""
        end = len(self.text) if last or self.stopped is not None else len(self.text) - self.held
        out, self.sent = self.text[self.sent : max(self.sent, end)], max(self.sent, end)
        return out


def deltas(pieces: Iterable[bytes], **options) -> Iterator[tuple[str, str | None]]:
    """New text and the stop string met, for each token up to the stop; incomplete bytes at the end give nothing."""
    state, pieces = Detokeniser(**options), list(pieces)
    for i, piece in enumerate(pieces):
        state.add(piece)
        yield state.delta(i == len(pieces) - 1), state.stopped
        if state.stopped is not None:
            return


def detokenised(tokens: DataFrame, stop: tuple[str, ...] = (), least: int = 0, include: bool = False) -> DataFrame:
    """req, pos, delta, stopped for every token up to the stop string. A request's tokens are one row of arrays, and a batch of many
    requests is folded in pieces."""
    ship(tokens.sparkSession)
    kind = dict(tokens.dtypes)

    def fold(requests: pa.Array) -> pa.Array:
        out = []
        for pieces in requests.to_pylist():
            out.append([{"delta": d, "stopped": s} for d, s in deltas(pieces, stop=stop, least=least, include=include)])
        return pa.array(out, pa.list_(pa.struct([("delta", pa.string()), ("stopped", pa.string())])))

    folded = F.arrow_udf(in_pieces(fold), "array<struct<delta:string,stopped:string>>")
    whole = tokens.groupBy("req").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("t"))
    pieces = F.transform("t", lambda x: x["piece"].cast("binary"))
    rows = whole.select("req", F.transform("t", lambda x: x["pos"]).alias("at"), folded(pieces).alias("out")).select("req", "at", F.posexplode("out").alias("i", "o"))
    return rows.select("req", F.get("at", F.col("i")).cast(kind["pos"]).alias("pos"), "o.delta", "o.stopped")
