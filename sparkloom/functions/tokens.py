"""Token sequences as arrays: prefix hashes, n-gram lookup, replacement, stop rules, slots."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.pieces import in_pieces
from sparkloom.ship import ship


def _blocks(tokens: pa.ListArray, size: int) -> tuple[list[str], list[int]]:
    """The texts of all full blocks, one row's after the other's, and each row's number of them. Null tokens have no text."""
    offsets = tokens.offsets.to_numpy().astype(np.int64)
    n = np.diff(offsets) // size
    first = np.repeat(offsets[:-1] - (np.cumsum(n) - n) * size, n) + np.arange(int(n.sum())) * size
    at = (first[:, None] + np.arange(size)).ravel()
    texts = tokens.values.take(pa.array(at)).cast(pa.string())
    edges = np.arange(0, len(at) + 1, size)
    if texts.null_count:
        edges = np.concatenate([[0], np.cumsum(texts.is_valid().to_numpy(zero_copy_only=False))])[edges]
        texts = texts.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), texts), ",").to_pylist(), n.tolist()


def prefix_block_hashes(tokens: Column, size: int, extra: Column | None = None) -> Column:
    """A chained hash for every full block: digest of the parent's hash, the block's tokens and extra keys."""

    def chain(rows: pa.Array, extras: pa.Array) -> pa.Array:
        blocks, counts = _blocks(rows, size)
        out, at = [], 0
        for n, key, valid in zip(counts, extras.to_pylist(), rows.is_valid().to_pylist(), strict=True):
            parent, tail, hashes = "root", f"|{key or ''}", []
            for block in blocks[at : at + n]:
                parent = hashlib.sha256(f"{parent}|{block}{tail}".encode()).hexdigest()
                hashes.append(parent)
            out.append(hashes if valid else None)
            at += n
        return pa.array(out, pa.list_(pa.string()))

    key = F.lit("") if extra is None else F.coalesce(extra.cast("string"), F.lit(""))
    ship()
    return F.arrow_udf(in_pieces(chain), "array<string>")(tokens, key)


def longest_repeat(tokens: list, shortest: int, longest: int) -> tuple[int, int]:
    """Width of the longest suffix, of ``shortest`` to ``longest`` tokens, that occurs earlier as well, and where it first does; (0, 0)
    if none. One pass: the suffix is searched backwards with its prefix function, so a place is never compared twice."""
    suffix = tokens[: -longest - 1 : -1]
    border = [0] * len(suffix)  # of the first i + 1 tokens of the reversed suffix
    for i in range(1, len(suffix)):
        k = border[i - 1]
        while k and suffix[i] != suffix[k]:
            k = border[k - 1]
        border[i] = k + (suffix[i] == suffix[k])
    width = matched = at = 0
    for i in range(len(tokens) - 2, -1, -1):
        token = tokens[i]
        if matched == len(suffix):
            matched = border[matched - 1]
        while matched and suffix[matched] != token:
            matched = border[matched - 1]
        matched += suffix[matched] == token
        if matched >= width and matched:
            width, at = matched, i  # the farther back, the earlier
    return (width, at) if width >= shortest else (0, 0)


def ngram_proposal(tokens: Column, shortest: int, longest: int, k: int, most: int) -> Column:
    """The next k tokens after the earliest earlier occurrence of the longest suffix n-gram; null if there is none.

    Proposals stop at ``most`` tokens in all. Texts of any length are searched in one pass.
    """

    def propose(rows: pa.Array) -> pa.Array:
        out = []
        for row in rows.to_pylist():
            take = 0 if row is None else min(k, most - len(row))
            width, at = longest_repeat(row, shortest, longest) if take > 0 else (0, 0)
            out.append(row[at + width : at + width + take] if width else None)
        return pa.array(out, rows.type)

    ship()
    return F.arrow_udf(propose, "array<int>")(tokens.cast("array<int>"))


def ends_with_bad_prefix(tokens: Column, bad: list[int]) -> Column:
    """Whether the tokens end with all but the last of a bad word, so that its last token must be masked."""
    head = bad[:-1]
    if not head:
        return F.lit(True)
    pattern = F.array(*[F.lit(t) for t in head])
    return F.when(F.size(tokens) < len(head), F.lit(False)).otherwise(F.slice(tokens, F.size(tokens) - len(head) + 1, F.lit(len(head))) == pattern)


def replaced(tokens: Column, pattern: list[int], with_: list[int]) -> Column:
    """Occurrences of a pattern replaced from the left, without overlap; an empty pattern changes nothing."""
    if not pattern:
        return tokens
    width, new = len(pattern), F.array(*[F.lit(t) for t in with_]).cast("array<int>")

    def joined(starts: Column) -> Column:
        after = F.concat(F.array(F.lit(0)), F.transform(starts, lambda s: s + width))
        pieces = F.transform(after, lambda e, i: F.slice(tokens, e + 1, F.coalesce(F.get(starts, i), F.size(tokens)) - e))
        return F.flatten(F.transform(pieces, lambda p, i: F.when(i < F.size(starts), F.concat(p, new)).otherwise(p)))

    # a lambda's argument, so that the starts are found once
    return F.transform(F.array(found_at(tokens, pattern)), joined)[0]


def found_at(tokens: Column, pattern: list[int]) -> Column:
    """Starts (from 0) of a pattern's occurrences from the left, without overlap."""
    if not pattern:
        return F.array().cast("array<int>")
    width, old = len(pattern), F.array(*[F.lit(t) for t in pattern]).cast("array<int>")
    state = "struct<next:int,out:array<int>>"

    def step(acc: Column, i: Column) -> Column:
        hit = (i >= acc["next"]) & (F.slice(tokens, i, F.lit(width)) == old)
        return F.when(hit, F.struct((i + width).alias("next"), F.concat(acc["out"], F.array(i - 1)).alias("out")).cast(state)).otherwise(acc)

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("out")).cast(state)
    return F.when(F.size(tokens) == 0, F.array().cast("array<int>")).otherwise(F.aggregate(F.sequence(F.lit(1), F.size(tokens)), start, step)["out"])


def first_one(flags: Column) -> Column:
    """Position from 0 of the first 1 in an array of zeros, then ones; its size if there is none; an error if it is no such array."""
    at = F.array_position(flags, 1).cast("int")
    place = F.when(at > 0, at - 1).otherwise(F.size(flags))
    good = F.forall(F.transform(flags, lambda f, i: f == F.when(i >= place, 1).otherwise(0)), lambda x: x)
    return F.when(good, place).otherwise(F.raise_error(F.lit("not zeros, then ones")).cast("int"))


def slot(position: Column, blocks: Column, size: int) -> Column:
    """Slot of a token position in a table of blocks."""
    return F.get(blocks, F.floor(position / size).cast("int")) * size + position % size


def finish_reason(n_output: Column, n_total: Column, last: Column, most_output: int, most_total: int, eos: int, stops: list[int], least_output: int = 0) -> Column:
    """Length first, then the end token, then stop tokens; none before the least output; null while running."""
    stop = F.lit(False) if not stops else last.isin(*stops)
    return F.when(n_output < least_output, None).when((n_total >= most_total) | (n_output >= most_output), "length").when((last == eos) | stop, "stop")


def masked_before_minimum(logit: Column, token: Column, n_output: Column, least: int, stops: list[int]) -> Column:
    """Stop tokens are impossible before the least output."""
    return F.when((n_output < least) & token.isin(*stops), F.lit(float("-inf"))).otherwise(logit)
