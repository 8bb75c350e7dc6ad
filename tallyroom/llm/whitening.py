"""Whitening of integer vectors with a covariance weighted by multiplicity.

Every component c of a vector becomes the whole number x = floor(scale * c). Equal x vectors are grouped
once, with their number of copies; the covariance is fitted on the distinct ones, each with weight
one or, on request, with its number of copies. The mean is exact: sums of whole numbers. Tasks
centre their vectors and multiply them as matrices (weighted GEMM), and the small products are
summed; the eigenvectors of their sum come from the driver. Each distinct vector is whitened
once, and the rows get their result back in a join.

Distinct vectors are told apart by 128 bits of hashes, so the join moves 24 bytes a row; a vector that a
third of all rows hold is one row on the whitened side, was counted in the map tasks
before it was shuffled, and adaptive execution splits its rows in the join.

What passes through the driver is of the size of the covariance, dims x dims, and a task holds one
Arrow batch and one such matrix.

Defined results: a vector that is null, empty, holds null or non-finite components, or a
component whose x does not fit 64 bits takes no part; a null id stays a null id; repeated rows get
their result each; vectors of different lengths are fitted each length for itself; a component
without variance (its eigenvalue is not above ``FLAT`` of the trace, as with a single vector)
has a null ``whitened``; without any variance ``explained`` is null; a deviation beyond 64 bits is null;
an empty table gives no rows. Only the two named columns are read, so clashing names cannot matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, written

SCALE = 256
COMPONENTS = 4
#: Share of the trace at or below which an eigenvalue counts as zero.
FLAT = 1e-12

_RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
           "explained double, identity_error double")


@dataclass
class Whitening:
    """Mean, directions and eigenvalues of the vectors of one length."""

    #: Sum of the weights: the number of distinct vectors, or that of all rows.
    n: int
    sums: np.ndarray
    #: Unit eigenvectors as columns, by falling eigenvalue.
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(s) for s in self.sums]) / self.n

    @property
    def directions(self) -> np.ndarray:
        """The columns that whiten a centred vector; NaN for a component without variance."""
        live = self.values > FLAT * self.trace
        return self.vectors / np.where(live, np.sqrt(np.where(live, self.values, 1)), np.nan)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """The x vector of a column, null where the vector takes no part."""
    c = vector.cast("array<double>")
    # Adding zero, as -0.0 is no whole number of its own.
    x = F.transform(c, lambda v: F.floor(v * float(scale)))
    limit = float(1 << 62)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * float(scale)) >= limit))
    return F.when((F.size(c) > 0) & ~bad, x)


def _keyed(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
                          whole_numbers(F.col(f"`{vector_col}`"), scale).alias("x"))
    return rows.where(F.col("x").isNotNull()).select(
        "vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"))


def distinct_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     scale: int = SCALE) -> DataFrame:
    """(h1, h2, dims, x, copies): every x vector once."""
    return (_keyed(vectors, id_col, vector_col, scale).groupBy("h1", "h2")
            .agg(F.any_value("x").alias("x"), F.count(F.lit(1)).alias("copies"))
            .select("h1", "h2", F.size("x").alias("dims"), "x", "copies"))


def _matrix(batch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _sums(distinct: DataFrame, dims: int, by_copies: bool) -> tuple[int, np.ndarray]:
    """The sum of weights and the weighted sums, exact."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if len(batch):
                x = _matrix(batch, dims)
                weight = batch.column("copies").to_numpy() if by_copies else np.ones(len(x), np.int64)
                # Python numbers: exact however large the entries are.
                exact = np.abs(x).max() < (1 << 62) // max(1, int(weight.sum()))
                total = (weight @ x if exact else weight.astype(object) @ x.astype(object))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(weight.sum())]), pa.array([[str(s) for s in total.tolist()]])],
                    names=["n", "sums"])

    parts = bounded(distinct).select("x", "copies").mapInArrow(run, "n bigint, sums array<string>")
    rows = (parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return int(rows[0].n), np.array([int(r.s) for r in sorted(rows, key=lambda r: r.i)], object)


def _covariance(distinct: DataFrame, mean: np.ndarray, n: int, by_copies: bool) -> np.ndarray:
    """Centre first, then multiply; the divisor is the sum of weights."""
    dims = len(mean)
    shared = distinct.sparkSession.sparkContext.broadcast(mean)

    def run(batches):
        import pyarrow as pa

        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch, dims) - shared.value
            left = x * batch.column("copies").to_numpy()[:, None] if by_copies else x
            total += left.T @ x
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array(list(total))], names=["i", "row"])

    rows = (bounded(distinct).select("x", "copies").mapInArrow(run, "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "v"))
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((dims, dims))
    for r in rows:
        out[r.i, r.j] = r.v / n
    return (out + out.T) / 2


def fit(distinct: DataFrame, dims: int, by_copies: bool = False) -> Whitening:
    """Fit on the distinct vectors, with weight one or with their copies."""
    n, sums = _sums(distinct, dims, by_copies)
    mean = np.array([float(s) for s in sums]) / n
    values, vectors = np.linalg.eigh(_covariance(distinct, mean, n, by_copies))
    values, vectors = values[::-1], vectors[:, ::-1]
    # One sign of the two: the largest entry is positive.
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(dims)])
    return Whitening(n, sums, vectors * sign, values.clip(0), float(values.clip(0).sum()))


def whiten(distinct: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """(h1, h2, copies, deviation, w): each distinct vector once; w has ``components`` entries."""
    dims = len(model.sums)
    shared = distinct.sparkSession.sparkContext.broadcast(
        (model.n, model.sums, model.mean, model.directions[:, :components]))

    def run(batches):
        import pyarrow as pa

        n, sums, mean, directions = shared.value
        for batch in batches:
            x = _matrix(batch, dims)
            w = (x - mean) @ directions
            most = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
            if dims * most * most < 1 << 63:
                away = n * x - sums.astype(np.int64)
                deviation = (away * away).sum(1).tolist()
            else:
                away = x.astype(object) * n - sums
                deviation = [d if d < 1 << 63 else None for d in (away * away).sum(1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1"), batch.column("h2"), batch.column("copies"),
                 pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))],
                names=["h1", "h2", "copies", "deviation", "w"])

    return bounded(distinct).select("h1", "h2", "x", "copies").mapInArrow(
        run, "h1 bigint, h2 bigint, copies bigint, deviation bigint, w array<double>")


def identity_error(white: DataFrame, live: int, by_copies: bool = False) -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    if not live:
        return None
    weight = F.col("copies").cast("double") if by_copies else F.lit(1.0)
    at = [F.col("w")[i] for i in range(live)]
    sums = [F.sum(weight).alias("n"), *[F.sum(weight * a).alias(f"s{i}") for i, a in enumerate(at)],
            *[F.sum(weight * at[i] * at[j]).alias(f"p{i}_{j}")
              for i in range(live) for j in range(i, live)]]
    r = white.agg(*sums).first()
    return max(abs(r[f"p{i}_{j}"] / r.n - r[f"s{i}"] / r.n * r[f"s{j}"] / r.n - (i == j))
               for i in range(live) for j in range(i, live))


def whiten_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = SCALE, components: int = COMPONENTS,
                by_copies: bool = False) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    distinct = written(distinct_vectors(vectors, id_col, vector_col, scale), "x-vectors")
    rows = _keyed(vectors, id_col, vector_col, scale).select(
        "vec_id", "h1", "h2", F.size("x").alias("dims"))
    lengths = sorted(r.dims for r in distinct.select("dims").distinct().collect())
    out = spark.createDataFrame([], _RESULT)
    for dims in lengths:
        own = distinct.where(F.col("dims") == dims)
        model = fit(own, dims, by_copies)
        shown = min(components, dims)
        live = int((model.values[:shown] > FLAT * model.trace).sum())
        white = written(whiten(own, model, shown), "x-whitened")
        error = identity_error(white, live, by_copies)
        explained = [float(v / model.trace) if model.trace > 0 else None
                     for v in model.values[:shown]]
        each = F.array(*[F.struct(F.lit(i + 1).alias("component"),
                                  F.nanvl(F.col("w")[i], F.lit(None).cast("double")).alias("whitened"),
                                  F.lit(explained[i]).cast("double").alias("explained"))
                         for i in range(shown)])
        joined = (rows.where(F.col("dims") == dims)
                  .join(white.select("h1", "h2", "deviation", "w"), ["h1", "h2"])
                  .select("vec_id", "deviation", F.inline(each)))
        out = out.unionByName(joined.select(
            "vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation",
            "whitened", "explained", F.lit(error).cast("double").alias("identity_error")))
    return out
