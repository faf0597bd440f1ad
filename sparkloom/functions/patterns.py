"""Many patterns at once: one automaton for all of them, so that the time of a text does not grow with their number.

Strings are searched with an Aho-Corasick automaton, bad words of tokens with a tree of their heads, read backwards. Both are built once in
each worker from a broadcast list, whose size is checked against ``MOST_BYTES``. Patterns beyond a list are rows of a table: ``candidates`` are
the places of a text that may hold one, told by a filter of bounded size, for a join that decides.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.pieces import in_pieces
from sparkloom.ship import ship

#: Characters or tokens of all patterns together, times their bytes in memory.
MOST_BYTES = 64 << 20
#: Bits of a filter for each pattern, of which it sets two, so that one of some 4,000 other places becomes a candidate; logarithms of the bits of
#: the smallest and largest filter (32 MB: 2 million patterns; beyond them more places become candidates).
FILTER_BITS, LEAST_BITS, MOST_BITS = 128, 20, 28
#: Places of a text that are hashed at a time.
BLOCK = 1 << 16


def _broadcast(patterns: list, bytes_each: int) -> tuple[str, Broadcast]:
    """A key and the patterns for all executors; an error beyond the bound."""
    size = sum(map(len, patterns)) * bytes_each
    if size > MOST_BYTES:
        raise ValueError(f"patterns of {size} bytes are more than {MOST_BYTES}")
    spark = SparkSession.getActiveSession()
    ship(spark)
    return uuid.uuid4().hex, spark.sparkContext.broadcast(patterns)


#: Lists that this worker holds, by key.
_VALUES: dict[str, list] = {}


@lru_cache(maxsize=4)
def _automaton(key: str):
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, pattern in enumerate(_VALUES[key]):
        if pattern and pattern not in out:  # of equal patterns the first listed stands
            out.add_word(pattern, i)
    out.make_automaton()
    return out if len(out) else None


@lru_cache(maxsize=4)
def _heads(key: str) -> dict:
    """Heads of bad words from their last token back; ``None`` holds the tokens that complete a word."""
    root: dict = {}
    for word in _VALUES[key]:
        if word:
            node = root
            for token in reversed(word[:-1]):
                node = node.setdefault(token, {})
            node.setdefault(None, set()).add(word[-1])
    return root


def _held(key: str, patterns: Broadcast) -> str:
    """The key of a list whose value this worker holds; it keeps the last few."""
    if key not in _VALUES:
        while len(_VALUES) >= 4:
            _VALUES.pop(next(iter(_VALUES)))
        _VALUES[key] = patterns.value
    return key


def stop_at_any(text: Column, stops: list[str], include: bool = False) -> Column:
    """struct<text, stop>: as ``text.stop_at``, the text up to the first *listed* stop string that occurs in it, for any number of them."""
    name, given = _broadcast(stops, 4)

    def cut(values: pa.Array) -> pa.Array:
        key = _held(name, given)
        machine, out = _automaton(key), []
        for value in values.to_pylist():
            best = None if value is None or machine is None else min(((i, end) for end, i in machine.iter(value)), default=None)
            if best is None:
                out.append({"end": None, "stop": None})
            else:
                stop = given.value[best[0]]
                out.append({"end": best[1] + 1 - (0 if include else len(stop)), "stop": stop})
        return pa.array(out, pa.struct([("end", pa.int32()), ("stop", pa.string())]))

    # Python gives places only, so no text comes back from it
    found = F.array(F.arrow_udf(in_pieces(cut), "end int, stop string")(text))
    return F.transform(found, lambda f: F.struct(F.when(f["end"].isNull(), text).otherwise(F.substring(text, 1, f["end"])).alias("text"), f["stop"].alias("stop")))[0]


def occurrences(text: Column, patterns: list[str]) -> Column:
    """map<pattern, times> of the patterns that occur, overlaps counted; null for null."""
    name, given = _broadcast(patterns, 4)

    def count(values: pa.Array) -> pa.Array:
        key = _held(name, given)
        machine, out = _automaton(key), []
        for value in values.to_pylist():
            found: dict[int, int] = {}
            for _, i in machine.iter(value) if value and machine is not None else ():
                found[i] = found.get(i, 0) + 1
            out.append(None if value is None else [(given.value[i], n) for i, n in sorted(found.items())])
        return pa.array(out, pa.map_(pa.string(), pa.int64()))

    return F.arrow_udf(in_pieces(count), "map<string,bigint>")(text)


_UP, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_DOWN = pow(_UP, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2**64."""
    out = np.empty((2, n), np.uint64)
    out[0], out[1], out[:, 0] = _UP, _DOWN, 1
    return tuple(np.cumprod(out, axis=1))


def _sums(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums over a text's beginnings, of which ``_hashes`` takes differences, and the powers that make these the same at any place."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    up, down = _powers(max(2 * BLOCK, 1 << len(codes).bit_length()))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return sums, down


def _hashes(first: np.ndarray, last: np.ndarray, down: np.ndarray) -> np.ndarray:
    """The hashes of the substrings between two places each, by the sums there and the powers of the first."""
    hashes = (last - first) * down
    return (hashes ^ (hashes >> np.uint64(32))) * _MIX


def _bits(hashes: np.ndarray, log_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a filter."""
    return hashes >> np.uint64(64 - log_bits), hashes >> np.uint64(64 - 2 * log_bits) & np.uint64((1 << log_bits) - 1)


def _is_set(held: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (held[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def filter_bits(pattern: Column, log_bits: int) -> Column:
    """The bits of a pattern in a filter of ``2 ** log_bits`` bits; null for null."""

    def bits(values: pa.Array) -> pa.Array:
        texts = values.to_pylist()
        sums, down = _sums("".join(v or "" for v in texts))
        edges = np.cumsum([0, *(len(v or "") for v in texts)])
        both = np.stack(_bits(_hashes(sums[edges[:-1]], sums[edges[1:]], down[edges[:-1]]), log_bits), axis=1).tolist()
        return pa.array([None if v is None else b for v, b in zip(texts, both, strict=True)], pa.list_(pa.int64()))

    return F.arrow_udf(in_pieces(bits), "array<bigint>")(pattern)


def candidates(text: Column, lengths: list[int], bits: bytes) -> Column:
    """array<struct<pattern, at>>: the different substrings of these lengths whose bits are set in the filter, each with the number of characters before
    its first place. All patterns of the filter that occur are among them. Empty for null. Each length is a pass over the text."""
    ship(SparkSession.getActiveSession())
    given = SparkSession.getActiveSession().sparkContext.broadcast(bits)
    lengths, log_bits = sorted(lengths), len(bits).bit_length() + 2

    def find(values: pa.Array) -> pa.Array:
        held, out = np.frombuffer(given.value, np.uint8), []
        for value in values.to_pylist():
            found: dict[str, int] = {}
            for first in range(0, len(value or ""), BLOCK):
                block = value[first : first + BLOCK + lengths[-1] - 1]
                sums, down = _sums(block)
                for length in lengths:
                    n = min(max(len(sums) - length, 0), BLOCK)
                    one, other = _bits(_hashes(sums[:n], sums[length : length + n], down[:n]), log_bits)
                    hits = np.flatnonzero(_is_set(held, one))
                    for at in hits[_is_set(held, other[hits])].tolist():
                        found.setdefault(block[at : at + length], first + at)
            out.append([{"pattern": p, "at": at} for p, at in found.items()])
        return pa.array(out, pa.list_(pa.struct([("pattern", pa.string()), ("at", pa.int32())])))

    return F.arrow_udf(in_pieces(find), "array<struct<pattern:string,at:int>>")(text)


def masked_tokens(tokens: Column, bad_words: list[list[int]]) -> Column:
    """The tokens that would complete a bad word, ascending: last tokens of the words whose other tokens end the row. Null for null."""
    name, given = _broadcast(bad_words, 32)

    def mask(values: pa.Array) -> pa.Array:
        key = _held(name, given)
        root, out = _heads(key), []
        for row in values.to_pylist():
            banned, node = set(root.get(None, ())), root
            for token in reversed(row or ()):
                node = node.get(token) if token is not None else None
                if node is None:
                    break
                banned |= node.get(None, set())
            out.append(None if row is None else sorted(banned))
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(in_pieces(mask), "array<int>")(tokens)
