"""Approximate nearest neighbours by collision-counting hashing with query-aware windows.

Largest inner product is turned into smallest distance: a vector x gets one more component sqrt(M^2 - |x|^2), where M is the
largest norm of its block; a query is stretched to length M and gets 0 there. Every projection is one seeded Gaussian
direction whose values are kept sorted. A query opens a window around its own value in each projection; a vector whose place
in the sorted array lies in the window collides there. Virtual rehashing widens all windows by a factor without
rebuilding anything. A vector that collides in at least ``threshold`` of the projections is a candidate; windows widen until
``share`` of the block and ``PER_NEIGHBOUR`` vectors for each wanted neighbour are candidates, which are
verified by their exact inner product in double precision, summed in one fixed order for every row.

Every row is indexed, in blocks by hash of the id. Queries are written once as bounded files in the shared folder; the task of
a block builds its index once and streams all queries past it, and returns the ``k`` best of each, which a window function
merges. So vectors are shuffled once, whatever the number of queries, and a task holds one block and one batch of
queries. Nothing is broadcast. Parameters do not depend on the data; recall is measured in the tests. Work is that of a
stated query set against all rows: queries times blocks.

Defined edge cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id;
vectors of different length never meet; of rows that repeat an id the smallest vector counts; ties go to the smaller
id; components are scaled before they are projected, so that huge and tiny ones neither overflow nor vanish, and an
inner product that overflows to no number ranks last; with fewer than ``k`` candidates all are returned; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import Scratch, bounded_batches
from sparkloom.llm.warc import open_store

K = 20
#: Fewer than 256, since collisions are counted in bytes.
PROJECTIONS = 128
THRESHOLD = 0.9
SHARE = 0.04
#: Candidates asked for per wanted neighbour, besides the share of the block.
PER_NEIGHBOUR = 8
WIDEN = 1.04
SEED = 3
#: Rows of a block (places are counted in two bytes), rows that the first radius is taken from, and queries of a batch.
BLOCK_ROWS = 8192
PROBE_ROWS = 512
QUERY_ROWS = 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows stretched to length 1, without overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class CollisionIndex:
    """Sorted projections of one block of non-zero, finite vectors."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = SEED):
        n, d = vectors.shape
        if n >> 16 or projections >> 8:
            raise ValueError("a block has at most 65,535 rows and 255 projections")
        scaled = vectors / np.abs(vectors).max()
        square = (scaled * scaled).sum(axis=1)
        self.norm = float(np.sqrt(square.max()))
        self.axes = np.random.default_rng(seed).standard_normal((d + 1, projections))
        values = scaled @ self.axes[:d] + np.sqrt(np.maximum(0.0, square.max() - square))[:, None] * self.axes[d]
        order = np.argsort(values, axis=0, kind="stable")
        #: Values of each projection in order, and the place of every vector in that order.
        self.values = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)
        self.place = np.empty((projections, n), np.uint16)
        np.put_along_axis(self.place, order.T, np.arange(n, dtype=np.uint16)[None, :], axis=1)
        self.probe = values[:: max(1, n // PROBE_ROWS)]
        self.n, self.d = n, d

    def windows(self, at: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of places of every query's window in every projection."""
        low, high = at - radius[:, None], at + radius[:, None]
        first = np.stack([v.searchsorted(low[:, j]) for j, v in enumerate(self.values)], axis=1)
        last = np.stack([v.searchsorted(high[:, j], "right") for j, v in enumerate(self.values)], axis=1)
        return first.astype(np.uint16), (last - first).astype(np.uint16)

    def candidates(self, queries: np.ndarray, least: int, threshold: float = THRESHOLD, widen: float = WIDEN) -> list[np.ndarray]:
        """Candidates of every query (at least ``least``): the radius starts where a probe of the block has them, and widens."""
        need, least = int(np.ceil(threshold * len(self.place))), min(least, self.n)
        at = unit(queries) @ self.axes[: self.d] * self.norm
        rank = min(len(self.probe) - 1, least * len(self.probe) // self.n)
        reach = [np.partition(np.partition(np.abs(self.probe - one), need - 1, axis=1)[:, need - 1], rank)[rank] for one in at]
        radius = np.maximum(np.asarray(reach), 1e-9 * self.norm)
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        open_ = np.arange(len(queries))
        while len(open_):
            still = []
            for q, first, width in zip(open_.tolist(), *self.windows(at[open_], radius[open_]), strict=True):
                # places below the window wrap round to large numbers
                inside = self.place - first[:, None] < width[:, None]
                out[q] = np.flatnonzero(inside.view(np.uint8).sum(axis=0, dtype=np.uint8) >= need)
                if len(out[q]) < least:
                    still.append(q)
            open_ = np.asarray(still, np.int64)
            radius[open_] *= widen
        return out


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever its row lies; what is no number ranks last."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (vectors * query).sum(axis=1)
    return np.where(np.isnan(out), -np.inf, out)


def search_block(built: CollisionIndex, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K, share: float = SHARE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, vector, score: the best ``k`` of the block for every query, verified."""
    out_q, out_v, out_s = [], [], []
    least = PER_NEIGHBOUR * (k + 1) + int(share * len(ids))
    for first in range(0, len(queries), 256):
        some = queries[first : first + 256]
        for own, query, hits in zip(query_ids[first : first + 256].tolist(), some, built.candidates(some, least), strict=True):
            hits = hits[ids[hits] != own]
            score = inner(vectors[hits], query)
            if len(hits) > k:  # all that tie with the k-th stay until ids decide
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                hits, score = hits[keep], score[keep]
            best = np.lexsort((ids[hits], -score))[:k]
            out_q.append(np.full(len(best), own, np.int64))
            out_v.append(ids[hits][best])
            out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def usable(column: str) -> Column:
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)


def by_length(ids: np.ndarray, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and vectors (double) of each length that a list column holds."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, first = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    for d in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == d)
        yield ids[own], flat[first[own][:, None] + np.arange(d)]


def search(vectors: DataFrame, query_filter: Column, id_column: str = "vec_id", column: str = "embedding", k: int = K, share: float = SHARE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row that ``query_filter`` selects."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    bounded_batches(spark)
    rows = vectors.filter(usable(column)).filter(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("x"), query_filter.alias("is_query"))
    blocks = max(1, -(-rows.count() // block_rows))
    # one task a block, here and below
    single = rows.repartition(blocks, "id").groupBy("id").agg(F.min("x").alias("x"), F.max("is_query").alias("is_query"))
    asked = scratch.table(single.filter("is_query").select("id", "x"), "queries")
    paths = sorted(asked.inputFiles())

    def batches_of(paths: list[str]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for path in paths:
            store, inner_path = open_store(path)
            with store.open_input_file(inner_path) as source:
                yield from pq.ParquetFile(source).iter_batches(query_rows, columns=["id", "x"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def results(ids: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
            for first in range(0, len(ids), 4 * block_rows):  # a hash may give a block some more rows
                own, some = ids[first : first + 4 * block_rows], block[first : first + 4 * block_rows]
                built = CollisionIndex(some)
                for batch in batches_of(paths):
                    for q_ids, queries in by_length(batch.column(0).to_numpy(), batch.column(1)):
                        if queries.shape[1] == some.shape[1]:
                            found = search_block(built, own, some, q_ids, queries, k, share)
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

        for part in parts:
            for ids, block in by_length(part.column(0).to_numpy(), part.column(1)):
                held.setdefault(block.shape[1], []).append((ids, block))
        for d in sorted(held):
            yield from results(np.concatenate([i for i, _ in held[d]]), np.concatenate([v for _, v in held.pop(d)]))

    found = single.select("id", "x").mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    out = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return scratch.own(out)
