"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base entities follow fixed patterns (email, ip, card, phone) and are the seeds. Every mention, a seed or
an identifier-like token of unknown kind, has lexical patterns: the word before, the word after,
and both. The bipartite graph of patterns and instances is scored in rounds: a pattern's score for a
kind is the share of known instances of the kind among its distinct instances, if it has enough of them;
an unknown instance becomes known if its accepted patterns agree on a kind (noisy or). A mention
of an accepted instance in an accepted pattern is reported as ``found_<kind>``. Base spans always stay.

Offsets: a pattern's matches and the pieces between them come from ``regexp_extract_all`` and ``split``
with the same regular expression; starts are running sums of their lengths, summed in two levels so that
thousands of matches in a text do not copy a growing array each. Regular expressions use possessive
quantifiers and look-behinds that leave the matches as the plain patterns give them, but take time linear in the text.

Scale: texts are read once, in a narrow pass, into a table of mentions. The graph is aggregated by (pattern,
instance) before any join; joins are on pattern or instance with ordinary, splittable shuffles; nothing
is collected or broadcast by hint.

Parameters of the graph: a context is the ``CONTEXT`` characters on either side, so a longer neighbouring word counts by its
nearest part; a token of unknown kind has a digit or an at sign and ``MIN_TOKEN`` characters or more. Neither touches base spans.

Defined edge cases: null text is empty text; offsets count code points, ends are exclusive; repeated
rows are reported each, and count as one instance; a text is searched whole by one task; of kinds that tie the first counts; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, text_of

# Kinds in order, and their patterns (Java syntax, linear-time forms).
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be worth a pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A token with a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CONTEXT = 40
MIN_TOKEN = 5
BLOCK = 256

ROUNDS = 3
MIN_SUPPORT = 5
MIN_SCORE = 0.9

SPAN = "struct<start:bigint,end:bigint,text:string,before:string,after:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not wherever it occurs."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches with offsets and the text around them: array<struct<start, end, text, before, after>>."""

    def within(part: Column) -> Column:
        # offsets relative to the block
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["p"]).cast("long")
            end = start + F.length(x["m"]).cast("long")
            one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"), x["before"].alias("before"), x["after"].alias("after"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(part, zero, add)

    def joined(blocks: Column) -> Column:
        begin = F.aggregate(
            blocks,
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        )["out"]
        shifted = F.zip_with(
            blocks,
            begin,
            lambda b, at: F.transform(
                b["out"],
                lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["text"].alias("text"), s["before"].alias("before"), s["after"].alias("after")),
            ),
        )
        return F.flatten(shifted)

    def of_parts(z: Column) -> Column:
        matches = F.transform(
            z["m"],
            lambda m, i: F.struct(
                F.get(z["p"], i).alias("p"), m.alias("m"), F.right(F.get(z["p"], i), F.lit(CONTEXT)).alias("before"), F.left(F.get(z["p"], i + 1), F.lit(CONTEXT)).alias("after")
            ),
        )
        cut = let(matches, lambda ms: F.transform(F.sequence(F.lit(0), F.floor((F.size(ms) - 1) / BLOCK).cast("int")), lambda b: within(F.slice(ms, b * BLOCK + 1, F.lit(BLOCK)))))
        return F.when(F.size(z["m"]) == 0, F.array().cast(f"array<{SPAN}>")).otherwise(let(cut, joined))

    return let(F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), of_parts)


def luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(F.regexp_replace(match, "[^0-9]", ""), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def keep(kind: str) -> Callable[[Column], Column]:
    return lambda s: valid(kind, s["text"])


def word_before(before: Column) -> Column:
    """The last word before a mention, lower-cased, without marks; '#' if there is none."""
    word = F.lower(F.regexp_replace(F.regexp_extract(before, r"([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$", 1), r"[^\p{L}]++", ""))
    return F.when(word == "", "#").otherwise(word)


def word_after(after: Column) -> Column:
    word = F.lower(F.regexp_replace(F.regexp_extract(after, r"^[^\p{L}]*+(\p{L}++)", 1), r"[^\p{L}]++", ""))
    return F.when(word == "", "#").otherwise(word)


def mentions(docs: DataFrame) -> DataFrame:
    """rid, doc_id, base, unknown: spans of the base kinds, and identifier-like tokens outside of them."""
    text = F.col("_text")
    rows = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("rid"), text_of().alias("_text"))
    has_digit = text.rlike("[0-9]")
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for kind in KINDS:
        worth = has_digit if NEEDS[kind] is None else text.contains(NEEDS[kind])
        if kind in ("ip", "phone"):
            worth = worth & has_digit
        spans = F.filter(F.when(worth, located(text, PATTERNS[kind])).otherwise(none), keep(kind))
        found.append(spans.alias(f"_{kind}"))
    tokens = F.when(has_digit | text.contains("@"), located(text, TOKEN)).otherwise(none)
    wide = rows.select("doc_id", "rid", *found, tokens.alias("_token"))
    kind_id = {k: i for i, k in enumerate(KINDS)}

    def tagged(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(s["start"].alias("start"), F.lit(kind_id[kind]).alias("k"), s["end"].alias("end"), s["text"].alias("text"), word_before(s["before"]).alias("left"), word_after(s["after"]).alias("right")))

    base = wide.select("doc_id", "rid", F.array_sort(F.concat(*[tagged(k) for k in KINDS])).alias("base"), "_token")
    outside = F.filter("_token", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])) & (F.length(t["text"]) >= MIN_TOKEN))
    unknown = F.transform(outside, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), word_before(s["before"]).alias("left"), word_after(s["after"]).alias("right")))
    return base.select("doc_id", "rid", "base", unknown.alias("unknown"))


def patterns_of(left: Column, right: Column) -> Column:
    every = F.array(F.concat(F.lit("< "), left), F.concat(F.lit("> "), right), F.concat(F.lit("<> "), left, F.lit(" "), right))
    return F.filter(every, lambda p: ~p.contains("#"))


def bootstrap(rows: DataFrame, scratch: Scratch, rounds: int = ROUNDS, support: int = MIN_SUPPORT, score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, k, score) and instances (instance, k) after some rounds on the graph."""
    seeds = rows.select(F.explode("base").alias("s")).select(F.lower("s.text").alias("instance"), F.col("s.k").alias("k"), F.explode(patterns_of(F.col("s.left"), F.col("s.right"))).alias("pattern"))
    others = rows.select(F.explode("unknown").alias("s")).select(F.lower("s.text").alias("instance"), F.explode(patterns_of(F.col("s.left"), F.col("s.right"))).alias("pattern"))
    graph = scratch.table(seeds.select("pattern", "instance").unionByName(others.select("pattern", "instance")).distinct(), "graph")
    # a text that matches several kinds is of the kind it is mentioned as most often, of the first of equals
    votes = seeds.groupBy("instance", "k").count()
    kinds = scratch.table(votes.groupBy("instance").agg(F.max_by("k", F.struct("count", -F.col("k"))).alias("k")), "kinds")
    known, unknown = kinds, graph.join(kinds.select("instance"), "instance", "left_anti")
    accepted = None
    for number in range(rounds):
        # an instance known from elsewhere counts for its patterns as well
        labelled = graph.join(known, "instance", "left")
        by_kind = labelled.groupBy("pattern").agg(F.count("*").alias("n"), *[F.count_if(F.col("k") == i).alias(f"n{i}") for i in range(len(KINDS))])
        best = F.greatest(*[F.col(f"n{i}") for i in range(len(KINDS))])
        which = F.coalesce(*[F.when(F.col(f"n{i}") == best, F.lit(i)) for i in range(len(KINDS))])
        accepted = scratch.table(
            by_kind.select("pattern", "n", best.alias("hits"), which.alias("k")).filter((F.col("hits") >= support) & (F.col("hits") >= score * F.col("n"))).select("pattern", "k", (F.col("hits") / (F.col("n") + 1)).alias("score")),
            f"patterns{number}",
        )
        new = unknown.join(accepted.withColumnRenamed("k", "pk"), "pattern").groupBy("instance", "pk").agg((1 - F.product(1 - F.col("score"))).alias("belief"))
        top = new.groupBy("instance").agg(F.max(F.struct("belief", (-F.col("pk")).alias("minus_k"))).alias("m")).select("instance", (-F.col("m.minus_k")).alias("k"), "m.belief")
        found = scratch.table(top.filter(F.col("belief") >= score * support / (support + 1)).select("instance", "k"), f"found{number}")
        known = kinds.unionByName(found)
        if not found.limit(1).count():
            break
    return accepted, found


def extract(docs: DataFrame, **options) -> DataFrame:
    """doc_id, spans array<struct<start, k, end, kind>> by start, then kind; base kinds before found ones."""
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.table(mentions(docs), "mentions")
    patterns, instances = bootstrap(rows, scratch, **options)
    places = rows.select("rid", F.explode("unknown").alias("s")).select(
        "rid", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.lower("s.text").alias("instance"), F.explode(patterns_of(F.col("s.left"), F.col("s.right"))).alias("pattern")
    )
    hits = places.join(patterns.drop("score"), "pattern").join(instances, ["instance", "k"]).select("rid", "start", "end", "k").distinct()
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"found_{k}") for k in KINDS])
    extra = hits.groupBy("rid").agg(F.collect_list(F.struct("start", (F.col("k") + len(KINDS)).alias("k"), "end")).alias("extra"))
    own = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))
    merged = rows.select("doc_id", "rid", own.alias("base")).join(extra, "rid", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast("array<struct<start:bigint,k:int,end:bigint>>"))))
    out = merged.select("doc_id", F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), F.element_at(names, s["k"] + 1).alias("kind"))).alias("spans"))
    return scratch.own(out)
