"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Base spans follow fixed patterns (assignments to secret names, access key ids, long hexadecimal runs).
The models add spans: first-order character chains are trained on labelled samples, random strings (label 1)
and ordinary identifiers (label 0). A token whose log-likelihood ratio is above both a total and a
per-character threshold, and that overlaps no base span, is reported as ``markov``.

Training: random strings are drawn by rule (alphabets below) with a seed. Ordinary identifiers are words, and
words joined the way identifiers, paths, versions and dates are. The words are common ones of programs (fixed list) and those of
a bounded sample of documents: ``SAMPLE_DOCS`` of the smallest hashes, of at most ``SAMPLE_CHARS`` characters each, and of
their distinct words the ``SAMPLE_WORDS`` of the smallest seeded hashes. Everything else reads every text whole.

Scale: one narrow pass over the texts; the model is a table of alphabet x alphabet numbers.

Defined edge cases: null text is empty text and has no spans; offsets count code points, ends are
exclusive; repeated rows are scanned each; a text is scanned whole by one task; of texts that share a sampled id the smallest is
learned from; without any document the fixed words are the ordinary sample; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_arrow, slices

KINDS = ("assign", "access", "hex", "markov")
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 20_000
SAMPLE_WORDS = 60_000
SEED = 5
#: A candidate token, and the thresholds of the log-likelihood ratio (nats).
MIN_TOKEN = 16
PER_CHAR = 0.25
TOTAL = 8.0

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "api")

#: Ordinary samples that a corpus of prose may lack: common words of programs, paths and addresses.
PROGRAM_WORDS = (
    "account action add address admin all api app array async auth base block body bool buffer build by byte cache call char check child class clean "
    "client close code collection com commit common config connection content context control copy core count create current data database date debug "
    "default delete device dir disable display do docs document domain download edit element email enable encode end engine entry env error event example "
    "exception export factory false field file filter find first flag float folder for format from function gcc get git global gnu group handler has hash "
    "header height hidden home host html http https id image import in index info init input insert instance int interface internal invalid io is item "
    "java json key label last lib library line link linux list load local lock log login main make manager map max message method min mode model module "
    "name net new next node none null num object of on open option order org output package page panel param parse password path pixel play plugin port post "
    "prefix print private process project property provider proxy public push query queue random read record reference register remove render "
    "request reset resource response result return root row run save scale schema script search section select send server service session set shift size sort "
    "source spring sql src start state static status stop store stream string style system tab table tag target task temp test text thread time title to token top "
    "total tree true type unit update upload url user usr util utils valid value var vector version video view web width window with word work write www xml zip"
).split()

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
#: A word of letters that is no part of a longer token.
WHOLE_WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,}(?![A-Za-z0-9+/_=-])")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(256, len(ALPHABET), np.uint8)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET), dtype=np.uint8)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the fixed patterns."""
    spans = []
    low = text.lower()
    if any(name in low for name in NAMES):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def chain(samples: list[str]) -> np.ndarray:
    """Log transition probabilities with add-one smoothing."""
    n = len(ALPHABET) + 1
    counts = np.ones((n, n))
    for s in samples:
        codes = _CODE[np.frombuffer(s.encode("ascii", "replace"), np.uint8)]
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def train(labelled: list[tuple[str, int]]) -> np.ndarray:
    """Table of log-likelihood ratios of a character pair: label 1 (random) against label 0 (ordinary)."""
    return chain([s for s, y in labelled if y == 1]) - chain([s for s, y in labelled if y == 0])


def ratio(token: str, model: np.ndarray) -> float:
    codes = _CODE[np.frombuffer(token.encode("ascii", "replace"), np.uint8)]
    return float(model[codes[:-1], codes[1:]].sum())


def _joined(rng: random.Random, some: list[str]) -> str:
    """Words joined in one of the ways that names in programs are, some with a number."""
    numbered = [w + str(rng.choice((2, 3, 8, 16, 32, 64, 86, 100, rng.randrange(1000)))) if rng.random() < 0.15 else w for w in some]
    style = rng.randrange(8)
    if style == 0:
        return "_".join(numbered)
    if style == 1:
        return "-".join(numbered)
    if style == 2:
        return numbered[0] + "".join(w.capitalize() for w in numbered[1:])
    if style == 3:
        return "".join(w.capitalize() for w in numbered)
    if style == 4:
        return "/".join(w.capitalize() if rng.random() < 0.2 else w for w in numbered)
    if style == 5:
        return "_".join(numbered).upper()
    if style == 6:
        return "".join(numbered)
    return "/".join(rng.choice("_-").join(numbered[i : i + 2]) for i in range(0, len(numbered), 2))


def _dated(rng: random.Random) -> str:
    day = f"{rng.randint(1970, 2039)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    clock = [f"{rng.randrange(24):02}", f"{rng.randrange(60):02}", f"{rng.randrange(60):02}"]
    return rng.choice((day, day + "T" + "-".join(clock) + "Z", day.replace("-", "/"), day.replace("-", "") + "T" + "".join(clock) + "Z", day + "_" + "-".join(clock), day.replace("-", "") + "".join(clock)))


def random_strings(n: int, seed: int = SEED) -> list[str]:
    """Random strings over the alphabets that keys are written in."""
    rng = random.Random(seed)
    alphabets = [ALPHABET[:62] + "+/", ALPHABET[:62] + "-_", ALPHABET[:62], "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[26:62]]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))) for _ in range(n)]


def ordinary_identifiers(words: list[str], n: int, seed: int = SEED) -> list[str]:
    """Words as they are, and joined as identifiers, paths, numbered names and dates. Half of the joined ones have words of programs."""
    rng = random.Random(seed)
    words = sorted({w for w in words if w.isascii() and w.isalpha() and len(w) > 1}) or PROGRAM_WORDS
    out = [_joined(rng, rng.choices(words if i % 2 else PROGRAM_WORDS, k=rng.randint(2, 6))) for i in range(n)]
    return out + [_dated(rng) for _ in range(n // 20)] + words + PROGRAM_WORDS


def labelled_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, seed: int = SEED) -> list[tuple[str, int]]:
    """Labelled strings: 1 random, 0 ordinary. Reads a bounded sample of documents for words."""
    # ids first, without texts, so that this is a scan of one column; then their texts, by a broadcast of at most sample_docs ids
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample_docs).distinct()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    sample = texts.filter(F.length("text") <= sample_chars).groupBy("doc_id").agg(F.min("text").alias("text"))
    words: set[str] = set()
    for row in sample.collect():
        text = row["text"]
        for a, b, _ in base_spans(text):
            text = text[:a] + " " * (b - a) + text[b:]
        words.update(WHOLE_WORD.findall(text))
    some = sorted(words, key=lambda w: (zlib.crc32(f"{seed}:{w}".encode()), w))[:SAMPLE_WORDS]
    return [(s, 1) for s in random_strings(20_000, seed)] + [(s, 0) for s in ordinary_identifiers(some, 20_000, seed)]


def spans(text: str, model: np.ndarray, per_char: float = PER_CHAR, total: float = TOTAL) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed."""
    out = base_spans(text)
    base = sorted(out)
    for m in TOKEN.finditer(text):
        token = m.group()
        if token.isdigit() or not (any(c.isdigit() for c in token) or (token.lower() != token and token.upper() != token)):
            continue
        a, b = m.span()
        if any(x < b and a < y for x, y, _ in base):
            continue
        llr = ratio(token, model)
        if llr >= total and llr >= per_char * (b - a - 1):
            out.append((a, b, "markov"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, model: np.ndarray | None = None, per_char: float = PER_CHAR, total: float = TOTAL) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>>: one row for each input row."""
    table = train(labelled_sample(docs)) if model is None else model
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text"):
                found = [[{"kind": k, "start": a, "end": b} for a, b, k in spans(t or "", table, per_char, total)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])

        return step

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, "doc_id long, spans array<struct<kind:string,start:long,end:long>>", make)
