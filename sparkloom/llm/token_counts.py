"""Token counts by byte-pair merging on a linked list with a heap of ranks.

A word starts as one symbol for each byte, the last with the end-of-word mark. The heap holds the adjacent pairs that the
vocabulary can merge, by rank and place; the lowest is popped and merged again and again, and its new neighbours are pushed. The
count of the word is its symbols less its merges: no identifier is made.

Texts are normalised and split as the vocabulary file says: special strings first, as the tokenizer takes them by default, then
normalisation, then words. Texts of Latin-1 are split in Arrow, and each distinct run of a batch is split into words once; other texts go
through the file's own normaliser and splitter, in pieces that end at white space, which no word crosses.

Scale: one narrow pass. A worker keeps the counts of at most ``CACHE`` distinct short words; batches and pieces are of bounded bytes.
A word is cut beforehand where no token of the vocabulary spans two adjacent symbols, so a long run of mixed characters is
many short words; only a run whose every pair occurs in a token is held as one list, some 150 bytes a byte.

Defined edge cases: null and empty text has no bytes and no tokens; texts of any length are counted whole; a special string is one
token; repeated rows and ids are counted each; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_arrow, slices
from sparkloom.llm.packing import _ODD, _WORDS

LIMIT = 2048
#: Distinct words, of at most ``CACHED`` characters each, whose counts a worker keeps.
CACHE = 1 << 18
CACHED = 64
#: Symbols of a word from which on it is cut where no token spans.
UNCUT = 64
#: Characters of a text that are split at once.
PIECE = 1 << 20


#: No symbol of a vocabulary, and the bits of a heap entry that hold a place.
NONE = (1 << 20) - 1
PLACES = (1 << 32) - 1


class Merges:
    """The merges of a vocabulary as numbers: the rank of a pair of symbols (20 bits each) and the symbol that it becomes."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        if len(vocab) >= NONE:
            raise ValueError("a vocabulary of more than a million symbols is not supported")
        self.end = end
        self.symbol = vocab
        # ranks count from 1 and leave 32 bits for a place, so that a rank and a place are one number of the heap
        self.rank: dict[int, int] = {}
        self.becomes = [NONE]
        for merge in merges:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault(vocab[a] << 20 | vocab[b], len(self.becomes) << 32)
            self.becomes.append(vocab[a + b])
        # adjacent characters that some token holds; the marked last character counts as one
        self.together = set(chain.from_iterable(self._adjacent(t) for t in vocab))

    def _characters(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            return [*token[: -len(self.end) - 1], token[-len(self.end) - 1 :]]
        return list(token)

    def _adjacent(self, token: str) -> Iterator[tuple[str, str]]:
        characters = self._characters(token)
        return zip(characters, characters[1:])

    def count(self, word: str) -> int:
        """Tokens of a word of byte symbols (one character a byte)."""
        characters = [*word[:-1], word[-1] + self.end]
        symbols = [self.symbol.get(c, NONE) for c in characters]
        if len(word) <= UNCUT:
            return len(word) - self.merges(symbols)
        cuts = [0, *(i for i, pair in enumerate(zip(characters, characters[1:]), 1) if pair not in self.together), len(characters)]
        return sum(b - a - self.merges(symbols[a:b]) for a, b in zip(cuts, cuts[1:]))

    def merges(self, symbols: list[int]) -> int:
        """How many merges a run of symbols takes. ``after`` and ``before`` link the live symbols; a dead symbol is ``NONE``."""
        n, rank_of, becomes = len(symbols), self.rank.get, self.becomes
        heap = [rank | i for i in range(n - 1) if (rank := rank_of(symbols[i] << 20 | symbols[i + 1]))]
        if not heap:
            return 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        done = 0
        while heap:
            entry = heapq.heappop(heap)
            i = entry & PLACES
            j = after[i]
            # a pair that has changed since it was pushed has another rank now
            if j >= n or rank_of(symbols[i] << 20 | symbols[j]) != entry - i:
                continue
            done += 1
            merged = symbols[i] = becomes[entry >> 32]
            symbols[j] = NONE
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if rank := rank_of(merged << 20 | symbols[k]):
                    heapq.heappush(heap, rank | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] << 20 | merged)):
                heapq.heappush(heap, rank | h)
        return done


def byte_symbols() -> list[str]:
    """The splitter's symbol of every byte: printable Latin-1 stands for itself, the others follow from U+0100 in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


class TokenCounter:
    """Counts tokens of texts as the tokenizer of a vocabulary file gives them, special tokens around a text left out."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        special = sorted({t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content}, key=len, reverse=True)
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that are normalised, strip or stand alone are not supported")
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.odd = "|".join([_ODD, *map(re.escape, special)])
        self.known: dict[str, int] = {}
        # the splitter's characters for bytes of lower-cased words
        self.bytes = byte_symbols()

    def word(self, word: str) -> int:
        """Tokens of a word in the splitter's symbols."""
        found = self.known.get(word)
        if found is None:
            found = self.merges.count(word)
            if len(word) <= CACHED:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[word] = found
        return found

    def _plain(self, word: str) -> int:
        """Tokens of a lower-cased word as it stands in the text."""
        if word.isascii():
            return self.word(word)
        return self.word("".join(map(self.bytes.__getitem__, word.encode())))

    def whole(self, text: str) -> int:
        """Tokens of any text."""
        total, at = 0, 0
        for special in self.special.finditer(text) if self.special else ():
            total += 1 + self._between(text, at, special.start())
            at = special.end()
        return total + self._between(text, at, len(text))

    def _between(self, text: str, start: int, stop: int) -> int:
        total = 0
        while start < stop:
            end = min(stop, start + PIECE)
            # a piece ends before white space; a run without any stays whole
            space = re.compile(r"\s").search(text, end, stop) if end < stop else None
            end = space.start() if space else stop
            total += sum(self.word(w) for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text[start:end])) if w)
            start = end
        return total

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of all texts (no nulls)."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        out[odd] = [self.whole(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        plain = pc.ascii_split_whitespace(texts.filter(pa.array(~odd)))
        runs = plain.flatten().dictionary_encode()
        each = np.asarray([sum(map(self._plain, _WORDS(run))) for run in pc.utf8_lower(runs.dictionary).to_pylist()], np.int64)
        sums = np.concatenate([[0], np.cumsum(each[runs.indices.to_numpy()])]) if len(runs) else np.zeros(1, np.int64)
        edges = plain.offsets.to_numpy() - plain.offsets[0].as_py() if len(plain) else np.zeros(1, np.int64)
        out[~odd] = np.diff(sums[edges])
        return out


@lru_cache(maxsize=1)
def counter_of(path: str) -> TokenCounter:
    """One per Python worker, kept from task to task."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each document."""

    def make():
        counter = counter_of(tokenizer)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text"):
                texts = pc.fill_null(part.column(1), "")
                n = counter.counts(texts)
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return step

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
