"""Mergeable sketches per upload against the exact operators."""

import random

from pyspark.sql import functions as F

from searchlake.operators import attempts as A
from searchlake.operators import reconcile as H
from searchlake.operators import sketches as K

ATTEMPTS = "job_id string, upload_id string, n_items bigint, duration_ms bigint"


def test_medians_of_few_rows_are_exact(spark):
    rows = [("j1", "u1", 0, 10), ("j1", "u1", 3, 5), ("j1", "u2", 3, 7), ("j2", "u3", 1, 100), ("j2", "u3", 0, None),
            ("j2", "u4", None, None), (None, "u5", 2, 9), (None, None, 2, 11)]
    log = spark.createDataFrame(rows, ATTEMPTS)
    got = {r.is_empty: (r.p50_ms, r.n) for r in K.approx_empties_vs_successes(K.duration_sketches(log)).collect()}
    assert got == {True: (10, 2), False: (9, 5), None: (None, 1)}
    exact = {r.is_empty: r.n for r in A.empties_vs_successes(log).collect()}
    assert exact == {k: n for k, (_, n) in got.items()}
    one = {r.is_empty: (r.p50_ms, r.n) for r in K.approx_empties_vs_successes(K.duration_sketches(log), job_id="j1").collect()}
    assert one == {True: (10, 1), False: (5, 2)}
    assert K.approx_empties_vs_successes(K.duration_sketches(log.limit(0))).collect() == []


def test_merged_median_is_within_the_stated_error(spark):
    rng = random.Random(5)
    values = sorted(int(rng.expovariate(1 / 3000)) for _ in range(60_000))
    log = (spark.createDataFrame([(v,) for v in values], "duration_ms bigint")
           .select(F.lit("j").alias("job_id"), F.concat(F.lit("u"), F.col("duration_ms") % 97).alias("upload_id"),
                   F.lit(1).cast("bigint").alias("n_items"), "duration_ms"))
    got = K.approx_empties_vs_successes(K.duration_sketches(log)).first()
    below, upto = sum(v < got.p50_ms for v in values), sum(v <= got.p50_ms for v in values)
    slack = 3 * K.KLL_RANK_ERROR * len(values)
    assert got.n == len(values) and below - slack <= len(values) / 2 <= upto + slack


def test_replayed_uploads_count_once(spark, tmp_path):
    path = str(tmp_path / "sketches")
    first = spark.createDataFrame([("j", "u1", 0, 4), ("j", "u1", 5, 6), ("j", "u2", 5, 8), ("j", None, 5, 8)], ATTEMPTS)
    again = spark.createDataFrame([("j", "u1", 5, 20), ("j", "u1", 5, 20)], ATTEMPTS)
    K.append_sketches(K.duration_sketches(first, now="2025-01-01 00:00:00"), path)
    K.append_sketches(K.duration_sketches(first, now="2025-01-01 00:00:00"), path)   # the same write, repeated
    stored = lambda: K.latest_sketches(spark.read.parquet(path))
    got = {r.is_empty: r.n for r in K.approx_empties_vs_successes(stored()).collect()}
    assert got == {True: 1, False: 3}
    K.append_sketches(K.duration_sketches(again, now="2025-01-02 00:00:00"), path)   # u1 without an empty answer
    got = {r.is_empty: (r.p50_ms, r.n) for r in K.approx_empties_vs_successes(stored()).collect()}
    assert got == {False: (8, 4)}


def test_distinct_domains(spark):
    rows = ([("j1", f"u{i % 7}", f"https://www.site{i % 3000}.com/") for i in range(9000)]
            + [("j1", "u0", f"site{i}.com") for i in range(1000)] + [("j2", "u9", "A.com"), ("j2", "u9", "a.com"), ("j3", "u8", None)])
    table = spark.createDataFrame(rows, "job_id string, upload_id string, domain string")
    sk = K.domain_sketches(table)
    by = {r.job_id: r for r in K.approx_distinct_domains(sk, ("job_id",)).collect()}
    assert set(by) == {"j1", "j2"}
    assert (by["j2"].row_count, by["j2"].raw_domains, by["j2"].norm_domains) == (2, 2, 1)
    assert by["j1"].row_count == 10_000
    assert abs(by["j1"].raw_domains - 4000) <= 5 * K.HLL_ERROR * 4000
    assert abs(by["j1"].norm_domains - 3000) <= 5 * K.HLL_ERROR * 3000
    total = K.approx_distinct_domains(sk).first()
    assert total.row_count == H.domain_inventory(table, table.select("domain").limit(0)).agg(F.sum("row_count")).first()[0]
    assert K.approx_distinct_domains(sk.limit(0)).first().raw_domains == 0


def test_latest_sketches_take_one_shuffle(spark, tmp_path):
    """Stored sketches are shuffled once by upload, not joined with themselves and shuffled again."""
    path = str(tmp_path / "sketches")
    log = spark.createDataFrame([("j", "u1", 0, 4), ("j", "u1", 5, 6), (None, None, 5, 8)], ATTEMPTS)
    K.append_sketches(K.duration_sketches(log, now="2025-01-01 00:00:00"), path)
    latest = K.latest_sketches(spark.read.parquet(path))
    assert latest._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((str(r.job_id), str(r.is_empty), r.n) for r in latest.collect()) == [
        ("None", "False", 1), ("j", "False", 1), ("j", "True", 1)]
