"""Changes of stored tables (H6-H8, H14): only partitions with a row to change are rewritten.

The rows to change are found by a filter that reaches the scan (a sentinel id is
tested against the row groups' statistics and Bloom filters). Their partition
values, at most as many as the table has partitions, prune a second scan; its rows
are changed, written whole to a table in the shared folder and put into place with
Spark's dynamic partition overwrite. Files of all other partitions stay as they
are. A job that dies while it writes leaves the stored rows or their staged copy
whole, and every change is a function of the row, so it can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.operators import ingest as A
from searchlake.operators import reconcile as H
from searchlake.schemas import SENTINEL
from searchlake.session import scratch_path


def _within(column: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    out = F.col(column).isin(known) if known else F.lit(False)
    return out | F.col(column).isNull() if None in values else out


def change_partitions(spark: SparkSession, path: str, find: Callable[[DataFrame], DataFrame],
                      change: Callable[[DataFrame], DataFrame], partition: str = "ingest_date",
                      cluster=("domain_id", "job_id")) -> list:
    """Rewrite the partitions that hold a row of ``find(table)`` with ``change(rows)``.

    ``change`` returns the rows with the same columns and may not move one to
    another partition (a job that would is refused before anything is replaced).
    Null partitions count as one. Returns the partition values rewritten; a
    table without such rows is not touched.
    """
    table = spark.read.parquet(path)
    values = [r[0] for r in find(table).select(partition).distinct().collect()]
    if not values:
        return []
    staged = scratch_path(spark, "rewrite")
    rows = change(table.where(_within(partition, values))).select(*table.columns)
    order = [partition, *[c for c in cluster if c in table.columns and c != partition]]
    A._with_blooms(rows.hint("rebalance", partition).sortWithinPartitions(*order).write, table.columns).parquet(staged)
    new = spark.read.schema(table.schema).parquet(staged)
    if not new.where(~_within(partition, values)).isEmpty():
        raise ValueError(f"the change moves rows to other partitions of {partition}")
    lost = set(values) - {r[0] for r in new.select(partition).distinct().collect()}
    if lost:
        raise ValueError(f"the change empties partitions of {partition}")
    writer = new.hint("rebalance", partition).sortWithinPartitions(*order).write.mode("overwrite")
    A._with_blooms(writer.option("partitionOverwriteMode", "dynamic"), table.columns).partitionBy(partition).parquet(path)
    A._delete(spark, staged)
    return values


def backfill_stored(spark: SparkSession, path: str, table: str, mode: str = "both", events: str | None = None,
                    dataset: str = "warehouse", partition: str = "ingest_date", now=None) -> list:
    """H6 (``both``) or H7 (``upload``) on a stored table, with the H8 events.

    Sentinel ids get their synthetic ones in place. Events are counted from the
    marked rows and written before the rows change, except those the log has
    (same job and upload id), so a run that died between the two can be repeated.
    Returns the partitions rewritten; without sentinel rows nothing is written.
    """
    if mode not in ("both", "upload"):
        raise ValueError(f"mode must be both or upload, not {mode!r}")
    hit = F.col("upload_id") == SENTINEL
    if mode == "both":
        hit = hit | (F.col("job_id") == SENTINEL)
    if events is not None:
        new = H.backfill_events(spark.read.parquet(path), table, mode, dataset, now)
        if A.path_exists(spark, events):
            new = new.join(spark.read.parquet(events).select("job_id", "upload_id"), ["job_id", "upload_id"], "left_anti")
        new.write.mode("append").parquet(events)
    fill = H.backfill_ids_by_hour if mode == "both" else H.backfill_upload_by_job_hour
    return change_partitions(spark, path, lambda t: t.where(hit), lambda t: fill(t, table), partition)


def map_stored(spark: SparkSession, path: str, mapping: DataFrame, partition: str = "ingest_date") -> list:
    """H14 on a stored table: partitions with a row that the mapping changes are rewritten.

    A row that has its canonical name and id already is no reason to rewrite, so
    a repeated run with the same mapping touches nothing (unless a canonical
    name is itself mapped on). Returns the partitions rewritten.
    """
    def find(t: DataFrame) -> DataFrame:
        last = H._one_per_raw(mapping)
        m = last.select(F.col("raw_domain").alias("domain"), F.col("domain_id").alias("_id"), F.col("canonical").alias("_canon"))
        j = t.select(partition, "domain", "domain_id").join(m, "domain")
        return j.where(F.col("_id").isNotNull() & ~(F.col("domain_id").eqNullSafe(F.col("_id"))
                                                    & F.col("domain").eqNullSafe(F.col("_canon"))))
    return change_partitions(spark, path, find, lambda t: H.apply_mapping(t, mapping), partition)
