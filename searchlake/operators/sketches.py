"""Mergeable sketches per upload: medians of durations (C9), distinct domains (H9).

The exact operators read every row of every upload on each call. Here each
upload is read once, when it arrives: its rows become one sketch row, which is
appended to a stored table. A question about any set of uploads merges sketch
rows, so its cost follows the number of uploads, not of rows. All sketches
are Spark's own aggregates, combined before the shuffle.

Stated errors, for any number of merged uploads:

* durations, KLL with ``KLL_K``: the rank of a quantile is off by at most
  ``KLL_RANK_ERROR`` of the rows in 99 of 100 cases; sets of fewer than ``KLL_K``
  rows are exact (the lower of two middle values).
* domains, HyperLogLog with ``2 ** HLL_LG_K`` registers: a relative standard
  error of ``HLL_ERROR``; the same rows always give the same estimate.

Appending an upload a second time (a replay) adds rows with a later
``sketched_at``; ``latest_sketches`` keeps the last of each key, so no
upload counts twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.functions.domains import normalize_domain_sql

KLL_K = 800
KLL_RANK_ERROR = 2.296 / KLL_K ** 0.9723    # of one quantile, 99 % confidence
HLL_LG_K = 14
HLL_ERROR = 1.04 / math.sqrt(1 << HLL_LG_K)  # one standard deviation, after merges


def _stamp(now: str | None) -> Column:
    return (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")).alias("sketched_at")


def duration_sketches(attempts: DataFrame, now: str | None = None) -> DataFrame:
    """One row per job, upload and kind of answer (``is_empty``, null where the
    number of items is unknown): rows ``n`` and a sketch of their durations.
    Null durations count in ``n`` and not in the sketch."""
    return (attempts.groupBy("job_id", "upload_id", (F.col("n_items") == 0).alias("is_empty"))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("duration_ms", KLL_K).alias("durations"))
            .select("*", _stamp(now)))


def domain_sketches(table: DataFrame, now: str | None = None) -> DataFrame:
    """One row per job and upload: rows with a domain, sketches of the raw
    domains and of those after G3 normalization."""
    rows = table.where(F.col("domain").isNotNull())
    return (rows.groupBy("job_id", "upload_id")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.hll_sketch_agg("domain", HLL_LG_K).alias("raw_domains"),
                 F.hll_sketch_agg(normalize_domain_sql(F.col("domain")), HLL_LG_K).alias("norm_domains"))
            .select("*", _stamp(now)))


def append_sketches(sketches: DataFrame, path: str) -> None:
    """Append the sketch rows of new (or replayed) uploads to the stored table."""
    sketches.write.mode("append").parquet(path)


def latest_sketches(stored: DataFrame) -> DataFrame:
    """The stored rows without those of earlier writes of the same upload.

    A replay replaces the upload as a whole: a key that only an earlier write has
    (a kind of answer that is gone) does not stay.
    """
    one = [c for c in stored.columns if c in ("job_id", "upload_id", "is_empty")]
    # one shuffle: the window's partitions serve dropDuplicates as well
    last = F.max("sketched_at").over(Window.partitionBy("job_id", "upload_id"))
    kept = stored.withColumn("_last", last).where(F.col("sketched_at") == F.col("_last")).drop("_last")
    # a write repeated with the same stamp holds the same rows twice
    return kept.dropDuplicates(one)


def approx_empties_vs_successes(sketches: DataFrame, job_id: str | None = None) -> DataFrame:
    """C9 from sketches: rows and the approximate median duration of empty and
    non-empty answers; null where no duration is known. ``n`` is exact."""
    rows = sketches if job_id is None else sketches.where(F.col("job_id") == job_id)
    merged = rows.groupBy("is_empty").agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("durations", KLL_K).alias("all"))
    return merged.select("is_empty", F.when(F.kll_sketch_get_n_bigint("all") > 0,
                                            F.kll_sketch_get_quantile_bigint("all", F.lit(0.5))).alias("p50_ms"), "n")


def approx_distinct_domains(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """H9 from sketches: rows with a domain and the approximate numbers of
    distinct raw and normalized domains, in all or for each value of ``by``."""
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.hll_union_agg("raw_domains").alias("raw"), F.hll_union_agg("norm_domains").alias("norm"))
    return merged.select(*by, "row_count", F.coalesce(F.hll_sketch_estimate("raw"), F.lit(0)).alias("raw_domains"),
                         F.coalesce(F.hll_sketch_estimate("norm"), F.lit(0)).alias("norm_domains"))
