"""Nearest neighbours by a block matrix join with int8 products and exact error bounds.

Vectors are dealt by hash into blocks; a tile is one block of queries against one block of candidates. In
a tile, products of int8-quantised vectors give every inner product up to a known error: with x = x' + e
(x' quantised, e the rest), x.y - x'.y' = e.y + x'.f, so its size is at most |e||y| + |x'||f|. Pairs whose
upper bound reaches the k-th best lower bound of their query survive, as do all for which a bound is beyond
double precision; they are recomputed in double precision from the original numbers. A heap per query merges
what the parts of a tile leave, and tiles are merged by rank. No neighbour is lost: the result is that of
comparing everything.

Scale: queries are a stated share of all rows. Rows that repeat id and vector are one, with their number. A
tile holds a block of queries, ``QUERY_BYTES`` of vectors on average, and streams its candidates, which are
sorted behind them, part by part: n vectors and q queries are shipped
as n * q / query block + q * n / candidate block rows. A query sends ``k`` rows per tile to the merge, where
ranks are cut before the shuffle.

Defined results: a vector that is null, empty or zero, or holds a null or non-finite number, or whose id
is null, takes no part; rows that repeat an id are candidates each and pool their neighbours as queries, and
are not each other's neighbours; only vectors of one length are compared; equal scores go to the smaller id;
products beyond double precision are infinite, or NaN, which stands first; fewer candidates than k give
fewer rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import on_workers
from sheetloom.session import written

QUERY_BYTES, CANDIDATES = 32 << 20, 1 << 15  # of a block on average
PART_QUERIES, PART_CANDIDATES = 512, 4_096  # of a tile at a time
PAIRS_AT_A_TIME = 200_000


def quantised(x: np.ndarray):
    """int8 numbers as floats, scales, norms of what the scaled numbers stand for, and of the rest."""
    scale = np.abs(x).max(axis=1) / 127
    with np.errstate(all="ignore"):
        q = np.where(scale[:, None] > 0, np.rint(x / scale[:, None]), 0)
        back = q * scale[:, None]
        return q.astype(np.float32 if x.shape[1] <= 1_000 else np.float64), scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in the order of the components."""
    total = np.zeros(len(x))
    with np.errstate(all="ignore"):
        for d in range(x.shape[1]):
            total += x[:, d] * y[:, d]
    return total


class Asked:
    """Queries of one tile and their nearest candidates so far."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.copies, self.vectors, self.k = ids, copies, vectors, k
        self.q8, self.scale, self.norm, self.rest = quantised(vectors)
        self.heaps: list[list[tuple[bool, float, int, int]]] = [[] for _ in ids]

    def _survivors(self, q: slice, ids: np.ndarray, c8, scale, norm, rest) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of pairs that may be among the nearest."""
        with np.errstate(all="ignore"):
            near = (self.q8[q] @ c8.T).astype(np.float64) * self.scale[q, None] * scale[None, :]
            # a little more than the bound, for rounding in the bound itself
            off = (self.rest[q, None] * norm[None, :] + self.norm[q, None] * rest[None, :]) * (1 + 1e-9) + 1e-12 * (1 + np.abs(near))
            lower, upper = near - off, near + off
        lower[~np.isfinite(lower)] = -np.inf
        own = self.ids[q, None] == ids[None, :]
        lower[own] = -np.inf
        least = np.array([h[0][1] if len(h) == self.k and not h[0][0] else -np.inf for h in self.heaps[q]])
        if lower.shape[1] > self.k:
            least = np.maximum(least, np.partition(lower, -self.k, axis=1)[:, -self.k])
        return np.nonzero(~(upper < least[:, None]) & ~own)

    def meet(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> None:
        k = self.k
        for c0 in range(0, len(ids), PART_CANDIDATES):
            c = slice(c0, c0 + PART_CANDIDATES)
            c8, scale, _, rest = quantised(vectors[c])
            with np.errstate(over="ignore"):
                norm = np.linalg.norm(vectors[c], axis=1)
            for q0 in range(0, len(self.ids), PART_QUERIES):
                q = slice(q0, q0 + PART_QUERIES)
                rows, columns = self._survivors(q, ids[c], c8, scale, norm, rest)
                if not len(rows):
                    continue
                score = np.concatenate([inner(self.vectors[q][rows[i:i + PAIRS_AT_A_TIME]], vectors[c][columns[i:i + PAIRS_AT_A_TIME]])
                                        for i in range(0, len(rows), PAIRS_AT_A_TIME)])
                strange = np.isnan(score)
                best = np.lexsort((ids[c][columns], np.where(strange, 0, -score), ~strange, rows))
                rows, columns, score, strange = rows[best], columns[best], score[best], strange[best]
                start = np.searchsorted(rows, np.arange(len(self.ids[q]) + 1))
                for r in np.unique(rows).tolist():
                    heap = self.heaps[q0 + r]
                    for at in range(start[r], min(start[r] + k, start[r + 1])):
                        entry = (bool(strange[at]), 0.0 if strange[at] else float(score[at]), -int(ids[c][columns[at]]), int(copies[c][columns[at]]))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                        else:
                            break

    def found(self) -> pa.RecordBatch:
        out = [(int(own), -minus, float("nan") if strange else score, min(self.k, int(n) * times))
               for own, n, heap in zip(self.ids, self.copies, self.heaps, strict=True) for strange, score, minus, times in heap]
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64(), "times": pa.int32()}
        return pa.RecordBatch.from_pydict({c: pa.array([o[at] for o in out], kind) for at, (c, kind) in enumerate(kinds.items())})


def _by_length(rows: pa.Table | pa.RecordBatch):
    """(length, ids, copies, vectors) of rows."""
    sizes = pc.list_value_length(rows.column("vec")).to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, int)
    for d in np.unique(sizes).tolist():
        part = rows.filter(pa.array(sizes == d))
        flat = np.concatenate([np.zeros(0), *[chunk.flatten().to_numpy() for chunk in getattr(part.column("vec"), "chunks", [part.column("vec")])]])
        yield d, part.column("id").to_numpy(), part.column("copies").to_numpy(), flat.reshape(-1, d)


def _search(batches, k: int):
    """Tiles out of sorted record batches, the queries of each before its candidates."""
    tile, waiting, asked = None, [], None

    def close():
        return [a.found() for a in (asked or {}).values()]

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("q", "c", "asks")])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            if start == end:
                continue
            key, part = (keys[0, start], keys[1, start]), batch.slice(start, end - start)
            if key != tile:
                yield from close()
                tile, waiting, asked = key, [], None
            if keys[2, start]:
                waiting.append(part)
            elif waiting:
                if asked is None:
                    asked = {d: Asked(ids, copies, x, k) for d, ids, copies, x in _by_length(pa.Table.from_batches(waiting))}
                for d, ids, copies, x in _by_length(part):
                    if d in asked:
                        asked[d].meet(ids, copies, x)
    yield from close()


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec, copies) of the vectors that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return (vectors.where(F.col(id_col).isNotNull() & (F.size(v) > 0) & finite & some)
            .groupBy(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vec")).agg(F.count("*").alias("copies")))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", query_bytes: int = QUERY_BYTES,
            candidates: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest inner products of each query with all other vectors.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = written(usable(vectors, id_col, vector_col), "vectors")
    size = rows.agg(F.count("*").alias("all"), F.sum(F.when(is_query, F.size("vec") * 8).otherwise(0)).alias("asked")).first()
    # a query sends k rows out of each block of candidates, so their number follows the vectors, not the cluster
    n_q, n_c = max(1, -(-(size["asked"] or 0) // query_bytes)), max(1, -(-size["all"] // candidates))
    deal = F.xxhash64("id", "vec")
    each_c, each_q = (F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (n_c, n_q))
    queries = rows.where(is_query).select("id", "vec", "copies", F.pmod(deal, F.lit(n_q)).alias("q"), each_c.alias("c"), F.lit(True).alias("asks"))
    parts = rows.select("id", "vec", "copies", each_q.alias("q"), F.pmod(deal, F.lit(n_c)).alias("c"), F.lit(False).alias("asks"))
    tiles = on_workers(queries.unionAll(parts)).repartition("q", "c").sortWithinPartitions("q", "c", F.desc("asks"))
    best = tiles.mapInArrow(lambda batches: _search(batches, k), "query_id long, vec_id long, score double, times int")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    each = best.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), "times")))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
