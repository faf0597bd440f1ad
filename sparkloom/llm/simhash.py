"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: bit b is set if more than half of a text's shingles (repeats included) have it in their 64-bit hash.
Texts link at ``radius`` or fewer differing bits; components of the links are the classes.

Covering masks: every bit position gets a seeded non-zero vector of radius + 1 bits. Table v (non-zero,
2^(radius+1) - 1 of them) keeps the positions whose vector has odd inner product with v. Any
``radius`` positions span too little to be seen by all v, so some table keeps none of them: two
fingerprints within the radius always collide there. Nothing is missed, at any size of the data.

Scale: equal fingerprints are one vertex from the start, so exact copies and their groups cost nothing more. Only
(key, fingerprint) pairs are shuffled. Buckets are counted, and those of more than ``HOT_BUCKET`` fingerprints are split into
finer ones that still hold every near pair. In a bucket a spanning set of links is found, so a large group of near
copies yields fewer links than members and no pairs are spelt out. Components shrink by hooking every vertex to its
smallest neighbour, round by round, in Spark; nothing of this is collected.

Defined edge cases: null and empty text has fingerprint zero and links like any other; fewer words than a shingle make one
shingle; repeated rows and ties share their component; a null id takes part, and names a component only if all its ids are
null; a text is hashed whole by one task, with about 60 bytes a word; extra columns are ignored by ``near_duplicates`` and
preserved by ``one_of_each``; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, map_arrow, placed, private, slices, text_of

SHINGLE = 3
RADIUS = 3
HASH_SEED = 42
MASK_SEED = 11
#: Distinct fingerprints of a bucket beyond which it is split.
HOT_BUCKET = 50_000


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.asarray([digest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    return np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64, len(starts))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = HASH_SEED) -> int:
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[first : first + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = HASH_SEED, digest: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), the text's SHA-256 if ``digest``, and ``carried`` columns (long)."""
    names = ["doc_id", "fp", *["digest"] * digest, *carried]

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text"):
                values = np.asarray([fingerprint(t or b"", shingle, seed) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values), *part.columns[2:]], names)

        return step

    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")]
    more = [*[F.sha2(text_of(), 256).alias("digest")] * digest, *carried]
    return map_arrow(docs.select(*own, *more), ", ".join(f"{n} {'string' if n == 'digest' else 'long'}" for n in names), make)


def covering_masks(radius: int = RADIUS, bits: int = 64, seed: int = MASK_SEED) -> list[int]:
    """2^(radius+1) - 1 masks; for any ``radius`` positions some mask keeps none of them."""
    rng = np.random.default_rng(seed)
    # every non-zero vector about equally often, so that each mask keeps about half of the positions
    vectors = np.resize(np.arange(1, 1 << (radius + 1)), bits)
    rng.shuffle(vectors)
    return [sum(1 << i for i, a in enumerate(vectors.tolist()) if (a & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))]


def bits_of(mask: int) -> list[int]:
    return [i for i in range(64) if mask >> i & 1]


def finer(mask: int, radius: int) -> list[int]:
    """Masks that keep one of radius + 1 groups of the other positions as well. Two fingerprints of a bucket within the
    radius differ in at most ``radius`` of these groups, so some finer bucket holds both."""
    free = bits_of(~mask & (1 << 64) - 1)
    return [mask | sum(1 << i for i in free[g :: radius + 1]) for g in range(radius + 1)]


def bucket_links(members: np.ndarray, radius: int, small: int = 512) -> list[tuple[int, int]]:
    """Links (positions) that connect what the pairs of distinct members within the radius connect; fewer links than members.

    Up to ``small`` members are compared with each other; more are split by the groups of ``finer`` on the
    positions in which they differ, and parts that are connected already are left out.
    """
    parent = list(range(len(members)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []

    def link(a: int, b: int) -> None:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            links.append((a, b))

    def compare(at: np.ndarray) -> None:
        """Breadth first through the near pairs, so that only links of a spanning forest are spelt out."""
        near = np.bitwise_count(members[at][:, None] ^ members[at][None, :]) <= radius
        left = near.sum(axis=1) > 1
        while left.any():
            front = np.asarray([int(left.argmax())])
            left[front] = False
            while len(front):
                others = np.flatnonzero(left)
                reach = near[front][:, others]
                hit = reach.any(axis=0)
                fresh, by = others[hit], front[reach[:, hit].argmax(axis=0)]
                for a, b in zip(at[by].tolist(), at[fresh].tolist(), strict=True):
                    link(a, b)
                left[fresh] = False
                front = fresh

    todo = [np.arange(len(members))]
    while todo:
        at = todo.pop()
        one = root(int(at[0]))
        if all(root(x) == one for x in at.tolist()):
            continue
        if len(at) <= small:
            compare(at)
            continue
        own = members[at]
        differ = bits_of(int(np.bitwise_or.reduce(own ^ own[0])))
        if len(differ) <= radius:
            for x in at[1:].tolist():
                link(int(at[0]), x)
            continue
        for g in range(radius + 1):
            key = own & np.uint64(sum(1 << i for i in differ[g :: radius + 1]))
            order = np.argsort(key, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            todo += [at[order[x:y]] for x, y in zip(edge, [*edge[1:], len(at)], strict=True) if y - x > 1]
    return links


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def buckets(vertices: DataFrame, scratch: Scratch, radius: int, seed: int = MASK_SEED, most: int = HOT_BUCKET) -> DataFrame:
    """mask, key, fp: every fingerprint in its bucket of each table.

    Buckets of more than ``most`` distinct fingerprints are counted exactly and split by ``finer``, again until none is
    left: a bucket has at most 2^(positions it does not keep) members, so two or three splits suffice.
    """

    def placed(masks: Column) -> Column:
        return F.explode(F.transform(masks, lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("key")))).alias("k")

    masks = covering_masks(radius, seed=seed)
    keyed = vertices.select("fp", placed(F.array(*[F.lit(_signed(m)).cast("long") for m in masks]))).select("k.mask", "k.key", "fp")
    done: list[DataFrame] = []
    while True:
        hot = scratch.table(keyed.groupBy("mask", "key").count().filter(F.col("count") > most).select("mask", "key"), f"hot{len(done)}")
        if not hot.limit(1).count():
            break
        done.append(keyed.join(hot, ["mask", "key"], "left_anti"))
        parts = {m: finer(m, radius) for m in masks}
        into = F.create_map(*[x for m, some in parts.items() for x in (F.lit(_signed(m)).cast("long"), F.array(*[F.lit(_signed(y)).cast("long") for y in some]))])
        split = keyed.join(hot, ["mask", "key"]).select("fp", placed(into[F.col("mask")])).select("k.mask", "k.key", "fp")
        keyed, masks = scratch.table(split, f"split{len(done)}"), sorted({y for some in parts.values() for y in some})
    for part in done:
        keyed = keyed.unionByName(part)
    return keyed


def links(vertices: DataFrame, scratch: Scratch, radius: int = RADIUS, seed: int = MASK_SEED, most: int = HOT_BUCKET) -> DataFrame:
    """a, b: links among distinct fingerprints (column fp) that give all components of pairs within the radius."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets arrive sorted; the last bucket of a batch stays open."""

        def emit(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
            out: list[tuple[int, int]] = []
            pairs = np.flatnonzero(last - first == 2)
            x, y = values[first[pairs]], values[first[pairs] + 1]
            near = np.bitwise_count(x ^ y) <= radius
            for i in np.flatnonzero(last - first > 2).tolist():
                own = values[first[i] : last[i]]
                out += [(int(own[a]), int(own[b])) for a, b in bucket_links(own, radius)]
            a = np.concatenate([x[near], np.asarray([p[0] for p in out], np.uint64)]).view(np.int64)
            b = np.concatenate([y[near], np.asarray([p[1] for p in out], np.uint64)]).view(np.int64)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        keys, values = [], []
        for batch in batches:
            k = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            v = batch.column(2).to_numpy().view(np.uint64)
            change = np.flatnonzero(np.any(k[1:] != k[:-1], axis=1))
            fresh = not keys or bool(np.any(keys[-1][-1] != k[0])) if len(k) else False
            stop = int(change[-1]) + 1 if len(change) else 0
            if stop or fresh:
                keys.append(k[:stop])
                values.append(v[:stop])
                if sum(map(len, keys)):
                    yield from emit(np.concatenate(keys), np.concatenate(values))
                keys, values = [k[stop:]], [v[stop:]]
            else:
                keys.append(k)
                values.append(v)
        if sum(map(len, keys)):
            yield from emit(np.concatenate(keys), np.concatenate(values))

    dealt = buckets(vertices, scratch, radius, seed, most).repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return dealt.mapInArrow(find, "a long, b long").distinct()


def components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """v, c: for every vertex of an edge its component, named by the smallest vertex in it.

    Every round hooks each vertex to its smallest neighbour (or itself), follows the hooks to their roots by
    pointer jumping, which halves the longest path each time, and maps the edges to the roots of their
    ends. Only vertices that are smallest among their neighbours are left for the next round.
    """
    edges = scratch.table(edges.select("a", "b"), f"{label}-edges")
    steps: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = scratch.table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("p")), f"{label}-hook{len(steps)}")
        for jump in itertools.count():
            up = hook.join(hook.toDF("p", "q"), "p").select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved"))
            up = scratch.table(up, f"{label}-hook{len(steps)}-{jump}")
            hook = up.select("v", "p")
            if not up.filter("moved").limit(1).count():
                break
        steps.append(hook)
        ha, hb = hook.toDF("a", "pa"), hook.toDF("b", "pb")
        moved = edges.join(ha, "a").join(hb, "b").filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        edges = scratch.table(moved, f"{label}-edges{len(steps)}")
    if not steps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
    out = steps[0].select("v", F.col("p").alias("c"))
    for hook in steps[1:]:
        up = hook.toDF("c", "_p")
        out = out.join(up, "c", "left").select("v", F.coalesce("_p", "c").alias("c"))
    return out


def _components_of(rows: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """fp, low (smallest id), c: the component of every distinct fingerprint."""
    vertices = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "vertices")
    label = components(links(vertices.select("fp"), scratch, radius), scratch)
    named = vertices.join(label.toDF("fp", "c"), "fp", "left").select("fp", "low", F.coalesce("c", "fp").alias("c"))
    return scratch.table(named, "named")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, hash_seed: int = HASH_SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each input row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(fingerprints(docs, shingle, hash_seed), "fp")
    named = _components_of(rows, scratch, radius)
    least = named.groupBy("c").agg(F.min("low").alias("component_id"))
    by_fp = named.join(least, "c").select("fp", "component_id")
    out = rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return scratch.own(out)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, hash_seed: int = HASH_SEED) -> DataFrame:
    """One document of each component stays: the smallest id (null last), of rows with that id the smallest text digest, of equal rows
    the first of the input.

    Rows are told apart by their place in the input, so unrelated texts without an id, or under one id, stay each, and repeated ids
    meet in no task.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    file, index = private(docs.columns, "_f", "_i")
    own = placed(docs, scratch, file, index)
    rows = scratch.table(fingerprints(own, shingle, hash_seed, digest=True, carried=(file, index)), "fp")
    named = _components_of(rows, scratch, radius)
    # by fingerprint first, so that equal texts go into the join as one row
    first = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "digest", file, index)
    of_fp = rows.groupBy("fp").agg(F.min(first).alias("m"))
    stay = of_fp.join(named.select("fp", "c"), "fp").groupBy("c").agg(F.min("m").alias("m")).select(f"m.{file}", f"m.{index}")
    return scratch.own(own.join(stay, [file, index]).select(*[F.col(f"`{c}`") for c in docs.columns]))
