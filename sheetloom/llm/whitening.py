"""Whitening of embeddings by a covariance weighted with multiplicities.

1. Every entry c becomes the integer x = floor(scale * c) + shift. Rows with equal x vectors are grouped, with
   the number of their copies; from here on a vector is handled once, however many rows have it.
2. Weights of the fit are these counts, or one each. Weighted sums per dimension are exact integers.
3. Vectors are centred, multiplied block by block (weighted GEMM in each task) and the products summed. The
   covariance's eigenvectors are worked out on the driver, which holds one matrix of the vectors' dimension.
4. Each distinct vector is whitened once and joined back to its rows. How far the result's covariance is from
   the identity is measured over all of it in one more pass.

Scale: two shuffles, of distinct vectors (counted before the shuffle) and of row ids with a 128-bit key of their
vector. A vector with more than ``HOT`` rows is joined in as many portions as it needs: rows are dealt to them
by their id, and the vector's result is repeated once for each. Vectors are written once and read by each pass.

Defined results: a vector that is null, empty or holds a null or non-finite entry takes no part; a row without
id takes part and keeps its null id; rows that repeat an id have a result each; vectors of different lengths are
whitened apart, each length with its own fit; entries beyond 2^62 / scale count as that bound; a deviation of
more than 38 digits is null; a component without variance (equal vectors, fewer vectors than components) has
null in ``whitened`` and no part in the error, and explains nothing; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import on_workers
from sheetloom.session import written

SCALE, SHIFT = 1_024, 100_000
COMPONENTS = 8
HOT = 2_048  # rows of one vector that are joined together
_BOUND = 2.0 ** 62
_FLAT = 1e-12  # share of the variance below which a component has none


@dataclass
class Fit:
    """What whitening needs of one length of vectors: weight, sums, components (rows) and their variances."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, the whole part of the mean taken off in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole).astype(np.float64) - np.array([s % self.n for s in self.sums], np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """Sum over dimensions of (n * x - sums)^2, exact."""
        largest = self.n * max(1, int(np.abs(x).max())) + max(map(abs, self.sums))
        if largest * largest * x.shape[1] < 1 << 63:
            found = ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        else:
            found = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [Decimal(d) if d < 10 ** 38 else None for d in found]

    @property
    def varies(self) -> np.ndarray:
        return self.variances > _FLAT * self.total

    @property
    def explained(self) -> np.ndarray:
        return np.maximum(self.variances, 0) / self.total if self.total > 0 else np.zeros(len(self.variances))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.centred(x) @ self.axes.T / np.sqrt(np.where(self.varies, self.variances, np.nan))


def in_integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(id, x, h1, h2) of the vectors that take part; h1 and h2 are their key."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-_BOUND)), F.lit(_BOUND))) + F.lit(shift).cast("long"))
    rows = vectors.where((F.size(v) > 0) & finite).select(F.col(id_col).alias("id"), x.alias("x"))
    return rows.withColumn("h1", F.xxhash64("x")).withColumn("h2", F.xxhash64(F.lit(1), "x"))


def _blocks(batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one length with their vectors as a matrix, batch by batch."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
        for d in np.unique(sizes):
            part = batch.filter(pa.array(sizes == d))
            yield part, part.column("x").flatten().to_numpy().reshape(-1, int(d))


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Weight and exact weighted sums, by length."""
    def run(batches):
        kept: dict[int, list] = {}
        for part, x in _blocks(batches):
            weights, largest = part.column("weight").to_numpy(), int(np.abs(x).max())
            small = largest * int(weights.sum()) < 1 << 62
            sums = (weights @ x).tolist() if small else [sum(w * v for w, v in zip(weights.tolist(), column, strict=True)) for column in x.T.tolist()]
            own = kept.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            for k, s in enumerate([int(weights.sum()), *sums]):
                own[k] += s
        for d, sums in kept.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d] * (d + 1), pa.int32()), "k": pa.array(range(d + 1), pa.int32()),
                                              "s": pa.array(map(Decimal, sums), pa.decimal128(38, 0))})

    rows = on_workers(distinct.select("x", "weight")).mapInArrow(run, "d int, k int, s decimal(38,0)").groupBy("d", "k").agg(F.sum("s").alias("s")).collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r["d"], [0] * (r["d"] + 1))[r["k"]] = int(r["s"])
    return {d: (s[0], s[1:]) for d, s in found.items()}


def _covariances(table: DataFrame, centred: Callable[[int, np.ndarray], np.ndarray], weights: dict[int, int], column: str) -> dict[int, np.ndarray]:
    """Weighted covariances of ``centred(length, vectors)``: a product in each task, summed over tasks."""
    def run(batches):
        kept: dict[int, np.ndarray] = {}
        for part, x in _blocks(batches):
            flat, d = x, x.shape[1]
            if column != "x":
                flat = part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            y = centred(d, flat)
            made = (y * part.column("weight").to_numpy()[:, None]).T @ y
            kept[d] = kept[d] + made if d in kept else made
        for d, made in kept.items():
            i, j = np.triu_indices(len(made))
            yield pa.RecordBatch.from_pydict({"d": pa.array(np.full(len(i), d, np.int32)), "i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)),
                                              "v": pa.array(made[i, j])})

    rows = on_workers(table).mapInArrow(run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toArrow()
    d, i, j, v = (rows.column(c).to_numpy() for c in ("d", "i", "j", "v"))
    found = {}
    for size in np.unique(d).tolist():
        own = d == size
        matrix = np.zeros((i[own].max() + 1,) * 2)
        matrix[i[own], j[own]] = matrix[j[own], i[own]] = v[own] / weights[size]
        found[size] = matrix
    return found


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Fits by length of the vectors of ``distinct`` (x, weight)."""
    sums = _sums(distinct)
    start = {d: Fit(n, s, np.zeros((0, d)), np.zeros(0), 0.0) for d, (n, s) in sums.items()}
    made = _covariances(distinct.select("x", "weight"), lambda d, x: start[d].centred(x), {d: n for d, (n, _) in sums.items()}, "x")
    fits = {}
    for d, matrix in made.items():
        variances, axes = np.linalg.eigh(matrix)
        fits[d] = Fit(*sums[d], axes.T[::-1][:components].copy(), variances[::-1][:components].copy(), float(np.trace(matrix)))
    return fits


def whiten(vectors: DataFrame, components: int = COMPONENTS, by_count: bool = True, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE, shift: int = SHIFT, hot: int = HOT) -> DataFrame:
    """(id, n, deviation, component, whitened, explained, identity_error): a row per row that takes part and component.

    With ``by_count`` a vector weighs as many as its rows in the fit, else one.
    """
    rows = in_integers(vectors, id_col, vector_col, scale, shift)
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    distinct = written(rows.groupBy("h1", "h2", "x").agg(F.count("*").alias("copies"), weight.alias("weight")), "distinct")
    fits = fit(distinct, components)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)  # as large as the dimension says

    def run(batches):
        for part, x in _blocks(batches):
            own = shared.value[x.shape[1]]
            made = own.whitened(x)
            y = pa.array(made.ravel(), mask=np.isnan(made.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * made.shape[1], pa.int32()), y)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.deviations(x), pa.decimal128(38, 0)), lists], names=[*part.schema.names, "deviation", "y"])

    done = written(on_workers(distinct).mapInArrow(run, "h1 long, h2 long, x array<long>, copies long, weight long, deviation decimal(38,0), y array<double>"), "whitened")

    def plain(d, y):
        return y[:, shared.value[d].varies]

    weights = {d: f.n for d, f in fits.items()}
    means = _means(done, plain, weights)
    products = _covariances(done.select("x", "y", "weight"), lambda d, y: plain(d, y) - means[d], weights, "y") if fits else {}
    errors = {d: float(np.abs(m - np.eye(len(m))).max(initial=0.0)) for d, m in products.items()}

    told = [(d, f.n, k + 1, float(e), errors.get(d, 0.0)) for d, f in fits.items() for k, e in enumerate(f.explained)]
    about = vectors.sparkSession.createDataFrame(told, "d int, n long, component int, explained double, identity_error double")
    # rows of one vector meet its result in portions
    portions = F.ceil(F.col("copies") / hot).cast("int")
    many = distinct.where(F.col("copies") > hot).select("h1", "h2", portions.alias("portions"))
    dealt = F.pmod(F.xxhash64("id"), F.coalesce("portions", F.lit(1))).cast("int")
    asked = rows.select("id", "h1", "h2").join(many, ["h1", "h2"], "left").select("id", "h1", "h2", dealt.alias("portion"))
    given = done.select("h1", "h2", F.size("x").alias("d"), "deviation", "y", F.explode(F.sequence(F.lit(0), portions - 1)).alias("portion"))
    whole = asked.join(given, ["h1", "h2", "portion"]).select("id", "d", "deviation", F.posexplode("y").alias("k", "whitened"))
    return (whole.withColumn("component", F.col("k") + 1).join(F.broadcast(about), ["d", "component"])
            .select("id", "n", "deviation", "component", "whitened", "explained", "identity_error"))


def _means(done: DataFrame, plain: Callable[[int, np.ndarray], np.ndarray], weights: dict[int, int]) -> dict[int, np.ndarray]:
    """Weighted means of whitened vectors, by length."""
    sums = (done.select(F.size("x").alias("d"), "weight", F.posexplode("y").alias("k", "v")).groupBy("d", "k")
            .agg(F.sum(F.coalesce(F.col("v"), F.lit(0.0)) * F.col("weight")).alias("s")).collect())
    found: dict[int, dict[int, float]] = {}
    for r in sums:
        found.setdefault(r["d"], {})[r["k"]] = r["s"] / weights[r["d"]]
    return {d: plain(d, np.array([[own[k] for k in sorted(own)]]))[0] for d, own in found.items()}
