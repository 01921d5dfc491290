import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchlake.llm import whitening as w

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="float", extra=False):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("x") for c in ("x", "v", "n", "component", "i", "value")}) if extra else df


def expected(vectors):
    """Eigenvalues and whitened rows by numpy, and exact deviations."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    centred = (n * u - s) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return n, values, basis, (n * x - s) / n, [int(v) for v in ((n * x.astype(object) - s.astype(object))**2).sum(1)]


def check(spark, vectors, kind="double", tolerance=1e-9, most=16):
    df = frame(spark, list(enumerate([list(map(float, v)) for v in vectors])), kind, extra=True)
    model = w.fit(w.fit_list(df), most)
    n, values, basis, centred, deviations = expected(vectors)
    rows = w.whiten(df, model).collect()
    k = min(most, len(vectors[0]))
    assert len(rows) == len(vectors) * k
    got = np.full((len(vectors), k), np.nan)
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = np.nan if r["whitened"] is None else r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-6, abs=1e-12)
    live = min(model.rank, k)
    want = centred @ basis[:, :live] / np.sqrt(values[:live])
    assert np.abs(np.abs(got[:, :live]) - np.abs(want)).max() < tolerance and np.isnan(got[:, live:]).all()
    assert model.identity_error < 1e-9
    return model


def test_matches_an_eigen_decomposition(spark):
    random = np.random.default_rng(0)
    vectors = random.normal(size=(400, 20)) @ np.diag(np.linspace(3, 0.5, 20))
    model = check(spark, np.concatenate([vectors, vectors[:150], np.repeat(vectors[:1], 200, axis=0)]))
    assert model.n == 400 and model.rank == 20


def test_ill_conditioned_vectors(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(300, 6)) * 10.0 ** np.arange(6, 0, -1) * [1e4, 1e3, 1e2, 10, 1, 1]
    vectors[:, 5] += 50_000_000 * vectors[:, 0] / vectors[:, 0].max()
    model = w.fit(w.fit_list(frame(spark, list(enumerate(vectors.tolist())), "double")))
    x = np.floor(64 * vectors) + 1_000_000
    sigma = np.linalg.svd(x - x.mean(0), compute_uv=False)
    assert sigma[0] / sigma[-1] > 1e7
    assert np.allclose(model.eigenvalues, sigma**2 / len(x), rtol=1e-7) and model.identity_error < 1e-6 and model.passes < w.MAX_PASSES


def test_dependent_and_constant_dimensions(spark):
    random = np.random.default_rng(2)
    base = np.floor(random.normal(size=(100, 3)) * 640) / 64
    vectors = np.concatenate([base, base[:, :1], np.full((100, 1), 2.5)], axis=1)
    assert check(spark, vectors).rank == 3


def test_rows_that_do_not_count(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [0.0, 9.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[1]), (None, good[2])]
    odd = [(10, None), (11, []), (12, [1.0, None]), (13, [NAN, 1.0]), (14, [INF, 1.0]), (15, [1.0, -INF]), (16, [1.0, 2.0, 3.0])]
    df = frame(spark, rows + odd)
    got = w.whiten(df, w.fit(w.fit_list(df))).collect()
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i, _ in rows for _ in range(2))
    assert all(r["n"] == 4 and not math.isnan(r["whitened"]) for r in got)


def test_one_vector_and_none(spark):
    df = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    got = w.whiten(df, w.fit(w.fit_list(df))).collect()
    assert len(got) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None) for r in got)
    for empty in (df.limit(0), frame(spark, [(1, None)])):
        assert w.whiten(empty, w.fit(w.fit_list(empty))).collect() == []


def test_large_entries_have_exact_deviations(spark):
    check(spark, [[1e12, 5.0], [-3e12, 7.0], [2e11, -1.0], [0.0, 0.0]], tolerance=1e-3)
