"""Operator 12: embedding whitening by shifted CholeskyQR.

Each entry c of a vector becomes the whole number floor(64 * c) + 1000000. The fit
list holds each distinct whole vector once: n vectors with sums S per dimension. The
covariance V (divisor n) is that of the centred rows x - S / n, and is never formed.

1. *Fit list.* Whole vectors are made distinct, combined before the shuffle (a vector
   that a third of the rows share is one row a task), and written to the shared folder.
2. *Sums.* S is added as decimals, so it is exact.
3. *Orthogonalisation.* A pass solves the centred rows with the triangular factors
   found so far and adds up their Gram matrix: each task adds its rows, Spark adds the
   tasks' matrices entry by entry. The driver factors the Gram matrix (dimension x
   dimension numbers), shifted so that it is positive definite however ill-conditioned
   the data are, and the next pass uses the new factor as well. Passes end when the Gram
   matrix is the identity to ``TOLERANCE``.
4. *Components.* R, the product of the factors, has the singular values and right
   singular vectors of the centred rows, without the squaring of the condition that an
   eigenvalue problem of V has. Eigenvalues are the squared singular values over n.
5. A last pass over the fit list measures the covariance of the whitened rows, and one
   over all rows projects them.

Centring is exact: x less the whole part of S / n, in integers, less its fraction.

Cases: a vector that is null, empty, or holds a null, NaN or infinite entry is dropped.
The dimension is the one that most distinct vectors have (ties: the larger); vectors of
others are dropped. |64 * c| is cut at 2**62. Of components beyond the numerical rank
(singular values under ``RANK`` times the largest), ``whitened`` is null and
``explained`` 0 (null where all variance is 0); ``identity_error`` is that of the others
(null if there are none). Components with equal eigenvalues are any basis of their space,
the same for all rows; a component's largest entry is positive. Repeated rows and ids
each give their own rows; a null id stays null. Other columns are not looked at. An empty
table, or one without a valid vector, gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, stage

SCALE, LIFT = 64, 1_000_000
TOLERANCE = 1e-12
RANK = 1e-13
MAX_PASSES = 12
#: Rows made at once for the output, which has one for each component.
OUT_ROWS = 1 << 15


@dataclass
class Whitening:
    n: int
    sums: list[int]
    components: np.ndarray  # one column each, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    rank: int
    identity_error: float | None
    passes: int

    @property
    def dim(self) -> int:
        return len(self.sums)


def whole(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a list column that count, and their whole vectors grouped by length: (places, [(rows, values)])."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    ends = np.cumsum(lengths)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (lengths > 0) & (broken[ends] == broken[ends - lengths])
    out = []
    for size in np.unique(lengths[good]) if dim is None else [dim]:
        at = np.flatnonzero(good & (lengths == size))
        if len(at):
            rows = flat[(ends[at] - size)[:, None] + np.arange(size)]
            out.append((at, np.clip(np.floor(SCALE * rows), -2.0**62, 2.0**62).astype(np.int64) + LIFT))
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())


def _quantise(batches):
    for batch in batches:
        for _, rows in whole(batch.column(0)):
            yield pa.RecordBatch.from_arrays([_lists(rows)], ["x"])


def _matrix(batch) -> np.ndarray:
    column = batch.column(0)
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _sum_of(batches):
    total = None
    for batch in batches:
        if batch.num_rows:
            rows = _matrix(batch)
            wide = np.abs(rows).max().astype(float) * len(rows) >= 2.0**62
            part = (rows.astype(object) if wide else rows).sum(0)
            total = [int(x) + (total[i] if total else 0) for i, x in enumerate(part)]
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(x) for x in total], pa.decimal128(38, 0))],
                                         ["i", "total"])


def _centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    base = np.array([s // n for s in sums], np.int64)
    return (rows - base).astype(np.float64) - np.array([s % n / n for s in sums])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows times the inverses of the upper triangular factors, one after the other."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def _gram(n: int, sums: list[int], change):
    """Task side of a Gram pass: the upper triangle of the sum of yᵀy of its rows."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = change(_centred(_matrix(batch), n, sums))
                part = y.T @ y
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"])
    return run


def _gram_of(fit: DataFrame, size: int, run) -> np.ndarray:
    rows = fit.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((size, size))
    for r in rows:  # size * (size + 1) / 2 numbers
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def fit_list(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Each distinct whole vector of the dimension, as the column ``x``; written to the shared folder."""
    prepare(vectors.sparkSession)
    xs = (vectors.select(F.col(f"`{vec_col}`").cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
          .mapInArrow(_quantise, "x array<bigint>").distinct())
    xs = stage(xs, "whole-vectors")
    sizes = xs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return xs.filter(F.size("x") == (sizes[0]["d"] if sizes else 0))


def fit(xs: DataFrame, most: int = 16) -> Whitening | None:
    """Components of a fit list; ``None`` of an empty one."""
    n = xs.count()
    if not n:
        return None
    parts = xs.mapInArrow(_sum_of, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    sums = [int(r["total"]) for r in sorted(parts.collect(), key=lambda r: r["i"])]  # one a dimension
    d = len(sums)
    factors: list[np.ndarray] = []
    trace, passes = 0.0, 0
    unit = np.finfo(float).eps
    while passes < MAX_PASSES:
        held = list(factors)
        gram = _gram_of(xs, d, _gram(n, sums, lambda rows, held=held: _solved(rows, held)))
        passes += 1
        if not factors:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                break
        elif np.abs(gram - np.eye(d)).max() <= TOLERANCE:
            break
        # the bound of the rounding errors of a Gram matrix keeps the shifted one positive definite
        shift = 11 * (min(n, 1 << 20) * d + d * (d + 1)) * unit * float(np.trace(gram)) if passes == 1 else 4 * d * unit * float(np.linalg.norm(gram, 2))
        while True:
            try:
                factors.append(np.linalg.cholesky(gram + shift * np.eye(d)).T)
                break
            except np.linalg.LinAlgError:
                shift *= 16
    r = np.eye(d)
    for f in factors:
        r = f @ r
    _, sigma, vt = np.linalg.svd(r if trace else np.zeros((d, d)))
    rank = int((sigma > RANK * sigma[0]).sum()) if trace else 0
    vt = vt * np.sign(vt[np.arange(d), np.abs(vt).argmax(1)])[:, None]
    keep = min(most, d)
    made = Whitening(n, sums, vt[:keep].T.copy(), np.where(np.arange(keep) < rank, sigma[:keep] ** 2 / n, 0.0), trace, rank, None, passes)
    live = min(rank, keep)
    if live:
        basis = made.components[:, :live] / np.sqrt(made.eigenvalues[:live])
        made.identity_error = float(np.abs(_gram_of(xs, live, _gram(n, sums, lambda rows: rows @ basis)) / n - np.eye(live)).max())
    return made


def _project(model: Whitening):
    k = model.components.shape[1]
    live = min(model.rank, k)
    basis = model.components[:, :live] / np.sqrt(model.eigenvalues[:live])
    explained = pa.array(model.eigenvalues / model.trace if model.trace else [None] * k, pa.float64())
    base = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([s % model.n for s in model.sums], np.int64)

    def deviations(rows: np.ndarray) -> pa.Array:
        off = rows - base
        # |n * off - rest| is at most n * (|off| + 1)
        if (float(np.abs(off).max()) + 1) * model.n * model.dim ** 0.5 < 2.0**31:
            return pa.array(((model.n * off - rest) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(int(x)) for x in ((model.n * off.astype(object) - rest.astype(object)) ** 2).sum(1)], pa.decimal128(38, 0))

    def run(batches):
        for batch in batches:
            for at, rows in whole(batch.column(1), model.dim):
                for i in range(0, len(at), OUT_ROWS // k + 1):
                    part, xs = at[i:i + OUT_ROWS // k + 1], rows[i:i + OUT_ROWS // k + 1]
                    each = pa.array(np.repeat(np.arange(len(part)), k))
                    made = np.full((len(part), k), np.nan)
                    made[:, :live] = _centred(xs, model.n, model.sums) @ basis
                    white = pa.array(made.ravel(), mask=np.tile(np.arange(k) >= live, len(part)))
                    again = pa.array(np.tile(np.arange(k), len(part)))
                    m = len(each)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(part)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                         pa.array(np.full(m, model.n, np.int64)), deviations(xs).take(each), white, explained.take(again),
                         pa.array([model.identity_error], pa.float64()).take(pa.array(np.zeros(m, np.int64)))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per valid vector and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    schema = T.StructType([rows.schema["vec_id"], *T._parse_datatype_string(
        "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double").fields])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    prepare(vectors.sparkSession)
    return rows.filter(F.col("v").isNotNull()).mapInArrow(_project(model), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the first 16 whitened components of every embedding."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(vectors, fit(fit_list(vectors))).withColumn("deviation", F.col("deviation").cast("long"))
