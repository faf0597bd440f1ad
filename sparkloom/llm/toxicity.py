"""Toxicity by a linear-chain conditional random field over words.

States: 0 ordinary, 1 toxic. A word's features are the word, its prefixes and a suffix, hashed; two weights per
pair of neighbouring states. Forward-backward gives each word's marginal of state 1; a document's
score is a logistic function of its largest marginal, its expected number of toxic words (of marginals above ``EVIDENT``) and that
number per word; runs of words with a marginal above one half are the offending offsets.

Training: labels mark documents, so words are labelled first. A feature (word or prefix) is toxic if the
likelihood ratio of its presence in toxic against other documents is above ``SIGNIFICANT`` nats and it hardly
occurs in others; words with such a feature in toxic documents get label 1, all other words label 0. The
field is fitted to these labelled words by gradient steps on the exact conditional likelihood; then the logistic
function is fitted to the same documents. The training sample is bounded by parameters: ``SAMPLE_TOXIC`` and ``SAMPLE_OTHER``
labelled documents with the smallest hashes, of at most ``SAMPLE_CHARS`` characters; of their segments of ``SEGMENT`` words the
field is fitted to ``SEGMENTS`` / 2 with a marked word and ``SEGMENTS`` without one, drawn with a seed. Only rows with
crc32(doc_id) mod 3 <> 1 are ever learned from. Scoring reads every text whole.

Scale: training data and model are bounded by parameters; scoring is one narrow pass without a shuffle.

Defined edge cases: null and empty text has no words and gets the score of no evidence; without labelled
rows of both classes every score is 0; repeated rows are scored each; of texts that share a labelled id the smallest is learned
from; an id that is labelled twice is toxic if either label says so; a text is held whole by one task, with about 60 bytes a word;
an empty table gives an empty result; extra columns are ignored by ``score`` and preserved by ``keep``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_arrow, runs, slices

SAMPLE_TOXIC = 1500
SAMPLE_OTHER = 3000
SAMPLE_CHARS = 20_000
SIGNIFICANT = 9.0
THRESHOLD = 0.7
HASH_BITS = 18
SEGMENT = 48
SEGMENTS = 6000
STEPS = 60
SEED = 9

_WORDS = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """Lower-cased without a change of length: characters whose lower case is longer stay, so that offsets hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


_PREFIXES = (4, 5, 6)
#: The least marginal of a word that counts towards a document's expected number of toxic words.
EVIDENT = 0.1
#: Bytes of the texts whose sequences advance side by side, with some 10 bytes of arrays a byte.
SIDE_BY_SIDE = 4 << 20
#: Characters of the texts that are words, as Python objects, at one time; a longer text alone.
AS_WORDS = 1 << 19


def is_held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def feature_names(word: str) -> list[str]:
    """The word, its prefixes, its suffix, and a feature that all words have."""
    return ["w" + word] + [f"p{word[:n]}" for n in _PREFIXES if len(word) >= n] + ["s" + word[-3:], "every"]


def feature_ids(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) & ((1 << HASH_BITS) - 1) for f in feature_names(word)]


@dataclass
class Field:
    """Emission weights (state 1 against 0), transitions[from, to] and start (all log), and the logistic weights."""

    emission: np.ndarray
    transition: np.ndarray
    start: float
    logistic: np.ndarray

    def potentials(self, words: list[str]) -> list[float]:
        """Of many words at once: the sums of the weights of their features."""
        if not words:
            return []
        ids = [feature_ids(w) for w in words]
        first = np.cumsum([0] + [len(i) for i in ids[:-1]])
        return np.add.reduceat(self.emission[list(chain.from_iterable(ids))], first).tolist()


def _carry(r: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log-odds of the next state before its emission, given those of this state."""
    return np.logaddexp(t[0, 1], t[1, 1] + r) - np.logaddexp(t[0, 0], t[1, 0] + r)


def marginals(potentials: list[np.ndarray], field: Field) -> list[np.ndarray]:
    """P(state 1) of every word of every sequence, exactly. Sequences advance side by side, longest first."""
    if not potentials:
        return []
    lengths = np.asarray([len(p) for p in potentials])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    total = int(lengths.sum())
    live = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), "left")  # sequences longer than t
    # time-major layout: step t holds the first live[t] sequences
    offset = np.concatenate([[0], np.cumsum(live)]).astype(np.int64)
    flat = np.empty(total)
    for rank, i in enumerate(order.tolist()):
        flat[offset[: lengths[rank]] + rank] = potentials[i]
    t, back = field.transition, field.transition.T
    ahead, behind = np.empty(total), np.empty(total)
    r = np.empty(0)
    for step in range(len(live)):
        a, b = offset[step], offset[step + 1]
        r = flat[a:b] + (np.full(b - a, field.start) if step == 0 else _carry(r[: b - a], t))
        ahead[a:b] = r
    r = np.empty(0)
    for step in range(len(live) - 1, -1, -1):
        a, b = offset[step], offset[step + 1]
        incoming = np.zeros(b - a)
        if len(r):
            incoming[: len(r)] = _carry(r, back)
        behind[a:b] = incoming
        r = incoming + flat[a:b]
    p = 1 / (1 + np.exp(-np.clip(ahead + behind, -500, 500)))
    out: list[np.ndarray] = [np.empty(0)] * len(potentials)
    for rank, i in enumerate(order.tolist()):
        out[i] = p[offset[: lengths[rank]] + rank]
    return out


def summary(p: np.ndarray) -> tuple[float, float, float]:
    """What the logistic function sees of a document. Words that are hardly toxic do not add up, so length alone is no evidence."""
    if not len(p):
        return 0.0, 0.0, 0.0
    expected = float(p[p > EVIDENT].sum())
    return float(p.max()), float(np.log1p(expected)), float(np.sqrt(expected / len(p)))


def without_copies(texts: list[list[str]], sketch: int = 8, shared: int = 3) -> list[int]:
    """Positions of texts that are no copies or near copies of an earlier one, by bottom-``sketch`` hashes of their
    words. Copies of one text would make all its rare words look like marks of its class."""
    owners: dict[int, list[int]] = {}
    kept = []
    for i, words in enumerate(texts):
        own = sorted({zlib.crc32(w.encode()) for w in words})[:sketch]
        counts = Counter(o for h in own for o in owners.get(h, ()))
        if counts and max(counts.values()) >= min(shared, len(own)):
            continue
        kept.append(i)
        for h in own:
            owners.setdefault(h, []).append(i)
    return kept


def toxic_features(toxic: list[list[str]], other: list[list[str]]) -> set[str]:
    """Words and prefixes that mark toxic documents. A prefix has to do so without its most frequent word."""
    words: Counter = Counter()
    for text in toxic:
        words.update(set(text))
    leading: dict[str, str] = {}
    for w in sorted(words, key=lambda w: (words[w], w)):
        for f in feature_names(w)[1:-2]:
            leading[f] = w

    def present(texts: list[list[str]]) -> Counter:
        counts: Counter = Counter()
        for text in texts:
            counts.update({f for w in set(text) for f in feature_names(w)[:-2] if leading.get(f) != w})
        return counts

    n1, n0 = len(toxic), len(other)
    c1, c0 = present(toxic), present(other)
    n_features = len(c1)
    # a passage that several documents share has the same neighbours everywhere: it counts once
    around: dict[str, tuple[set, set]] = {}
    for text in toxic:
        for before, w, after in zip(["", *text], text, [*text[1:], ""], strict=False):
            for f in feature_names(w)[:-2]:
                if leading.get(f) != w and c1[f] >= 3:
                    sides = around.setdefault(f, (set(), set()))
                    sides[0].add(before)
                    sides[1].add(after)
    c1 = Counter({f: min(c1[f], len(left), len(right)) for f, (left, right) in around.items()})
    prior = n1 / (n1 + n0)
    enough = max(SIGNIFICANT, float(np.log(max(1, n_features))))
    found = set()
    for f, a in c1.items():
        b = c0.get(f, 0)
        share = a / (a + b)
        if share <= prior or (a / n1) < 10 * (b / n0):
            continue
        gain = a * np.log(share / prior) + (b * np.log((1 - share) / (1 - prior)) if b else 0.0)
        if gain >= enough:
            found.add(f)
    return found


def narrow_prefixes(sequences: list[tuple[list[str], np.ndarray]], least: int = 3) -> set[int]:
    """Prefixes that only one or two toxic words have: they say no more than the words and would spread to others."""
    having: dict[str, set[str]] = {}
    for words, labels in sequences:
        for i in np.flatnonzero(labels).tolist():
            for f in feature_names(words[i])[1:-1]:
                having.setdefault(f, set()).add(words[i])
    return {zlib.crc32(f.encode()) & ((1 << HASH_BITS) - 1) for f, words in having.items() if len(words) < least}


def _fit_field(sequences: list[tuple[list[str], np.ndarray]], seed: int = SEED) -> tuple[np.ndarray, np.ndarray, float]:
    """Adaptive gradient steps on the mean conditional log-likelihood of labelled segments."""
    rng = np.random.default_rng(seed)
    with_one, without = [], []
    for words, labels in sequences:
        for first in range(0, len(words), SEGMENT):
            own = labels[first : first + SEGMENT]
            (with_one if own.any() else without).append((words[first : first + SEGMENT], own))
    for part in (with_one, without):
        rng.shuffle(part)  # type: ignore[arg-type]
    segments = with_one[: SEGMENTS // 2] + without[:SEGMENTS]
    width = 3 + len(_PREFIXES)
    n = len(segments)
    blocked = narrow_prefixes(sequences)
    ids = np.full((n, SEGMENT, width), 1 << HASH_BITS, np.int64)  # the last weight stays 0
    y = np.zeros((n, SEGMENT))
    mask = np.zeros((n, SEGMENT))
    for i, (words, labels) in enumerate(segments):
        for j, w in enumerate(words):
            f = [x for x in feature_ids(w) if x not in blocked]
            ids[i, j, : len(f)] = f
        y[i, : len(labels)] = labels
        mask[i, : len(labels)] = 1
    emission, transition, start = np.zeros((1 << HASH_BITS) + 1), np.zeros((2, 2)), 0.0
    squares, t_squares, s_square = np.full(len(emission), 1e-8), np.full((2, 2), 1e-8), 1e-8
    flat = ids.ravel()
    pairs = np.stack([((1 - y if a == 0 else y)[:, :-1] * (1 - y if b == 0 else y)[:, 1:] * mask[:, 1:]).sum() for a in (0, 1) for b in (0, 1)]).reshape(2, 2) if n else transition
    for _ in range(STEPS if n else 0):
        e = emission[ids].sum(2)
        ahead, behind = np.empty_like(e), np.zeros_like(e)
        r = e[:, 0] + start
        ahead[:, 0] = r
        for s in range(1, SEGMENT):
            r = e[:, s] + _carry(r, transition)
            ahead[:, s] = r
        for s in range(SEGMENT - 2, -1, -1):
            behind[:, s] = np.where(mask[:, s + 1] > 0, _carry(behind[:, s + 1] + e[:, s + 1], transition.T), 0.0)
        p = 1 / (1 + np.exp(-(ahead + behind))) * mask
        # pair marginals from forward odds, transition, emission and backward odds
        right = (behind + e)[:, 1:]
        logs = np.stack([(ahead[:, :-1] if a else 0.0) + transition[a, b] + (right if b else np.zeros_like(right)) for a in (0, 1) for b in (0, 1)])
        both = np.exp(logs - logs.max(0))
        both = (both / both.sum(0) * mask[None, :, 1:]).sum((1, 2)).reshape(2, 2)
        gradient = np.bincount(flat, np.repeat(((y - p) * mask).ravel(), width), len(emission)) / n - 1e-6 * emission
        gradient[-1] = 0
        squares += gradient**2
        emission += 0.4 * gradient / np.sqrt(squares)
        t_gradient = (pairs - both) / n
        t_squares += t_gradient**2
        transition += 0.2 * t_gradient / np.sqrt(t_squares)
        s_gradient = float((y[:, 0] - p[:, 0]).sum()) / n
        s_square += s_gradient**2
        start += 0.2 * s_gradient / np.sqrt(s_square)
    return emission[:-1], transition, start


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1, 0.1, 0.1])
        w += np.linalg.solve(h, x.T @ (y - p) - np.array([0, 0.1, 0.1, 0.1]) * w)
    return w


def train(texts: list[str], labels: list[int]) -> Field:
    empty = Field(np.zeros(1 << HASH_BITS), np.zeros((2, 2)), 0.0, np.array([-50.0, 0, 0, 0]))
    if len(set(labels)) < 2:
        return empty
    words = [_WORDS.findall(folded(t)) for t in texts]
    # by class: a toxic text may be a clean one with some words put in
    by_class = [[i for i, y in enumerate(labels) if bool(y) == toxic] for toxic in (True, False)]
    kept = [own[k] for own in by_class for k in without_copies([words[i] for i in own])]
    words, labels = [words[i] for i in kept], [labels[i] for i in kept]
    marks = toxic_features([w for w, y in zip(words, labels, strict=True) if y], [w for w, y in zip(words, labels, strict=True) if not y])
    known: dict[str, float] = {}

    def mark(word: str) -> float:
        if word not in known:
            known[word] = float(any(f in marks for f in feature_names(word)))
        return known[word]

    tagged = [(w, np.asarray([mark(x) for x in w]) if y else np.zeros(len(w))) for w, y in zip(words, labels, strict=True)]
    emission, transition, start = _fit_field(tagged)
    field = Field(emission, transition, start, empty.logistic)
    scored = marginals([np.asarray(field.potentials(w)) for w in words], field)
    field.logistic = _fit_logistic(np.asarray([summary(p) for p in scored]), np.asarray(labels, float))
    return field


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """A bounded sample of the labelled rows that may be learned from: ids first, then their texts by a bounded broadcast."""
    ids = labels.filter(F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    some = ids.filter("toxic = 1").orderBy(*by_hash).limit(toxic).unionByName(ids.filter("toxic = 0").orderBy(*by_hash).limit(other))
    some = some.toDF("_id", "_toxic")
    rows = (
        docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
        .filter(F.length("text") <= chars)
        .join(F.broadcast(some), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("_toxic").alias("_toxic"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [int(r["_toxic"]) for r in rows]


class Scorer:
    """Scores texts; potentials are cached by word."""

    def __init__(self, field: Field, most: int = 200_000):
        self.field, self.most = field, most
        self.cache: dict[str, float] = {}

    def potentials(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Of the words of many texts. New words of all of them are worked out together, once each."""
        if len(self.cache) > self.most:
            self.cache.clear()
        fresh = list(set(chain.from_iterable(texts)).difference(self.cache))
        self.cache.update(zip(fresh, self.field.potentials(fresh), strict=True))
        return [np.fromiter(map(self.cache.__getitem__, words), float, len(words)) for words in texts]

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores, and the marginals of every text's words. Words are objects for some texts at a time, numbers for all."""
        of_words: list[np.ndarray] = []
        for first, last in runs([len(t) for t in texts], AS_WORDS):
            of_words += self.potentials([_WORDS.findall(folded(t)) for t in texts[first:last]])
        probabilities = marginals(of_words, self.field)
        x = np.asarray([summary(p) for p in probabilities])
        w = self.field.logistic
        return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -500, 500))), probabilities


def score(docs: DataFrame, field: Field, spans: bool = True) -> DataFrame:
    """doc_id, score, spans array<struct<start, end, p>> in code points: one row for each input row."""
    weights = field.emission
    bounded = docs.sparkSession.sparkContext.broadcast(weights)  # 2^HASH_BITS numbers
    transition, start, logistic = field.transition, field.start, field.logistic
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def make():
        scorer = Scorer(Field(bounded.value, transition, start, logistic))

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text", SIDE_BY_SIDE):
                texts = [t or "" for t in part.column(1).to_pylist()]
                scores, probabilities = scorer.score(texts)
                found = [offending(t, p) if spans and len(p) and p.max() > 0.5 else [] for t, p in zip(texts, probabilities, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(found, kind)], ["doc_id", "score", "spans"])

        return step

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, "doc_id long, score double, spans array<struct<start:long,end:long,p:double>>", make)


def keep(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold. The text column must be named text."""
    text = docs.schema.names.index("text")
    bounded = docs.sparkSession.sparkContext.broadcast(field.emission)
    transition, start, logistic = field.transition, field.start, field.logistic

    def make():
        scorer = Scorer(Field(bounded.value, transition, start, logistic))

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text", SIDE_BY_SIDE):
                scores, _ = scorer.score([t or "" for t in part.column(text).to_pylist()])
                yield part.filter(pa.array(scores < threshold))

        return step

    return map_arrow(docs, docs.schema, make)


def offending(text: str, p: np.ndarray) -> list[dict]:
    """Runs of words with a marginal above one half. Offsets of the text as it is, not lower-cased."""
    words = list(_WORDS.finditer(folded(text)))
    out: list[dict] = []
    for i in np.flatnonzero(p > 0.5).tolist():
        m = words[i]
        if out and out[-1]["last"] == i - 1:
            out[-1] |= {"end": m.end(), "p": max(out[-1]["p"], float(p[i])), "last": i}
        else:
            out.append({"start": m.start(), "end": m.end(), "p": float(p[i]), "last": i})
    return [{k: s[k] for k in ("start", "end", "p")} for s in out]


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, spans."""
    out = score(docs, train(*labelled_sample(docs, labels)))
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
