"""Packing documents into fixed-length training sequences: first-fit decreasing on a tournament tree.

A document is its token ids and an end id. Documents longer than a sequence are cut into whole sequences
and a remainder. Remainders of a seeded fraction of documents (``filler``) are cut further, into
powers of two, so that small pieces exist that close the gaps of first fit; the others stay whole.
Documents are dealt into randomised groups by hash; each group is packed on its own by first-fit decreasing. The
tournament tree holds the largest free capacity below each node, so finding the first bin that
fits takes one descent.

Scale: only piece lengths and checksums are shuffled, never text or ids, and a group holds about
``group_docs`` documents whatever the size of the corpus: rows are dealt by a number that is fixed in the written table of
pieces, so repeated or null ids spread as all others. Tokenising is one narrow pass.

Defined edge cases: null and empty text is the end id alone; a special token's spelling in a text gives that token's id, as the
tokenizer has it; texts of any length are tokenised whole, in batches of bounded bytes or one by one; repeated rows and ties in
length are packed each, in order of id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, map_arrow, slices

LENGTH = 2048
END_ID = 1
GROUP_DOCS = 4096
#: One in so many documents has its remainder cut into powers of two.
FILLER = 16
SEED = 77
#: Bytes of the texts that are tokenised together.
SLICE_BYTES = 4 << 20

#: A text without such a character (all but printable ASCII and Latin-1, and white space) is split in Arrow.
_ODD = r"[^\t-\r\x20-\x7e¡-¬®-ÿ]"
#: The pre-tokenizer's words in lower-cased text of those characters: letters, a number, a contraction, anything else.
_WORDS = re.compile(r"[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+").findall


def gathered(values: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces ``at`` of ``values`` (piece i has ``size[i]`` values), one after the other, and their sizes."""
    begin, length = (np.cumsum(size) - size)[at], size[at]
    ends = np.cumsum(length)
    return values[np.repeat(begin - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)], length


class WordTokenizer:
    """Token ids of texts.

    The vocabulary's pre-tokenizer splits a text at white space and then into words that are encoded
    independently. So a batch is split and dictionary-encoded in Arrow, each distinct run of non-space
    characters is encoded once, and ids are gathered by array operations. Words are encoded as texts of some hundred words and
    told apart by their last tokens, which alone carry the end-of-word mark. Texts outside Latin-1, where
    case folding and normalisation differ between libraries, and texts that hold an added (special) token go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # added tokens are found in the text before it is split, in any letter case if they are normalised
        added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.odd = "|".join([_ODD] + [f"(?i:{re.escape(t)})" for t in added])
        # the same merges without normaliser and pattern, for words that are lower-cased and split already
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.model._resize_cache(0)  # words come once only
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 3, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _merged(self, words: list[str], some: int = 200, together: int = 20) -> np.ndarray:
        """Short texts: the tokenizer's time per word grows with the text. Few at a time: an encoding has some 200 bytes a token."""
        parts = [np.empty(0, "<u4")]
        for first in range(0, len(words), some * together):
            group = words[first : first + some * together]
            texts = [" ".join(group[i : i + some]) for i in range(0, len(group), some)]
            parts += [np.asarray(e.ids, "<u4") for e in self.merger.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(parts)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-cased words, one after the other, and how many each has. Equal words are encoded once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids = self._merged(distinct)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(distinct):  # no vocabulary of this kind: one by one
            each = [self._merged([w]) for w in distinct]
            ids, ends = np.concatenate([np.empty(0, "<u4"), *each]), np.cumsum([len(e) for e in each], dtype=np.int64)
        size = np.diff(np.concatenate([[0], ends]))
        return gathered(ids, size, coded.indices.to_numpy())

    def _runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of non-space characters, which may hold several words or none."""
        lower = pc.utf8_lower(runs)
        alone = pc.utf8_is_alpha(lower)
        several = [_WORDS(run) for run in lower.filter(pc.invert(alone)).to_pylist()]
        is_alone = alone.to_numpy(zero_copy_only=False)
        counts = np.ones(len(lower), np.int64)
        counts[~is_alone] = [len(words) for words in several]
        # words of single-word runs first, then of the others
        ids, size = self._words(pa.concat_arrays([lower.filter(alone), pa.array(list(chain.from_iterable(several)), pa.string())]))
        order = np.empty(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        order[first[is_alone]] = np.arange(int(is_alone.sum()))
        rest = np.repeat(~is_alone, counts)
        order[rest] = np.arange(int(is_alone.sum()), len(order))
        flat, each = gathered(ids, size, order)
        stop = np.concatenate([[0], np.cumsum(each)])[np.cumsum(counts)]
        return flat, np.diff(np.concatenate([[0], stop]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls), one after the other, and where each text's begin; one more for the end."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd)) if odd.any() else texts
        lists = pc.ascii_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        flat, length = gathered(*self._runs(coded.dictionary), coded.indices.to_numpy())
        ends = np.cumsum(length)
        edges = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()] if len(plain) else np.zeros(1, np.int64)
        if not odd.any():
            return flat, edges
        parts, nth = [], 0
        for i, is_odd in enumerate(odd.tolist()):
            if is_odd:
                parts.append(self._whole(texts[i].as_py()))
            else:
                parts.append(flat[edges[nth] : edges[nth + 1]])
                nth += 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> WordTokenizer:
    """One per Python worker, kept from task to task."""
    return WordTokenizer(path)


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def cut(n: int, length: int, filler: bool) -> list[int]:
    """Piece lengths of a document of n ids."""
    rest = n % length
    return [length] * (n // length) + (powers(rest) if filler else [rest] if rest else [])


class TournamentTree:
    """Bins of equal capacity; ``place`` gives the first bin with room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        free, node = self.free, 1
        if free[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        leaf = node
        free[node] -= size
        node //= 2
        while node:
            a, b = free[2 * node], free[2 * node + 1]
            best = a if a > b else b
            if free[node] == best:
                break
            free[node] = best
            node //= 2
        return leaf - self.leaves


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item. Ties keep their order."""
    bins, at = [0] * len(sizes), [0] * len(sizes)
    # first fit never leaves two bins at most half full, so twice the volume is enough
    tree = TournamentTree(2 * (sum(sizes) // capacity) + 2, capacity)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bins[i] = tree.place(sizes[i])
    used: dict[int, int] = {}
    for i, b in enumerate(bins):
        at[i] = used.get(b, 0)
        used[b] = at[i] + sizes[i]
    return bins, at


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, filler: int = FILLER, seed: int = SEED) -> DataFrame:
    """doc_id, doc_tokens, starts, lengths, checksums: one row for each document."""
    end = np.asarray([end_id], "<u4").tobytes()

    def make():
        encoder = tokenizer_of(tokenizer)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, edges = encoder.encode(pc.fill_null(part.column(1), ""))
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                starts, lengths, sums = [], [], []
                total = np.diff(edges) + 1  # with the end id
                for first, n, number in zip((edges[:-1] * 4).tolist(), total.tolist(), part.column(2).to_pylist(), strict=True):
                    cuts = cut(n, length, number % filler == 0)
                    ends = list(accumulate(cuts))
                    begin = [0, *ends[:-1]]
                    own = [zlib.crc32(raw[first + 4 * b : first + 4 * min(e, n - 1)]) for b, e in zip(begin, ends, strict=True)]
                    own[-1] = zlib.crc32(end, own[-1])
                    starts.append(begin)
                    lengths.append(cuts)
                    sums.append(own)
                array = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(starts, array), pa.array(lengths, array), pa.array(sums, array)],
                    ["doc_id", "doc_tokens", "starts", "lengths", "sums"],
                )

        return step

    # fillers are chosen by id and place, so that rows without an id are chosen one by one
    mark = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id()), F.lit(1 << 40))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), mark.alias("mark"))
    return map_arrow(source, "doc_id long, doc_tokens long, starts array<long>, lengths array<long>, sums array<long>", make)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, group_docs: int = GROUP_DOCS, filler: int = FILLER, seed: int = SEED) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for each piece."""
    scratch = Scratch(docs.sparkSession, "pack")
    rows = scratch.table(pieces(docs, tokenizer, length, end_id, filler, seed).withColumn("number", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-rows.count() // group_docs))

    def pack_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "doc_tokens", "number"], kind="stable", na_position="first", ignore_index=True)
        n = group["lengths"].map(len).to_numpy()
        sizes = np.concatenate(group["lengths"].to_numpy()).astype(np.int64).tolist()
        bins, at = first_fit_decreasing(sizes, length)
        return pd.DataFrame(
            {
                "doc_id": group["doc_id"].astype("Int64").repeat(n).to_numpy(),
                "start": np.concatenate(group["starts"].to_numpy()),
                "length": sizes,
                "ids_crc32": np.concatenate(group["sums"].to_numpy()),
                "doc_tokens": group["doc_tokens"].repeat(n).to_numpy(),
                "sequence_id": (int(group["grp"].iloc[0]) << 32) + np.asarray(bins, np.int64),
                "offset": at,
            }
        )

    dealt = rows.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "number"), F.lit(groups)).cast("long"))
    out = dealt.groupBy("grp").applyInPandas(pack_group, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return scratch.own(out)
