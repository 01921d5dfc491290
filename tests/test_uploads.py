"""One-owner and one-upload reads of a stored table."""

import os
import tempfile

from pyspark.sql import functions as F

from searchlake.operators import ingest as A
from searchlake.operators import uploads as U


def _stored(spark):
    """Job j1: upload u1 over three days, upload u2 without an event on a fourth; job j2 is another owner's."""
    rows = spark.createDataFrame(
        [("j1", "u1", "a", "2024-01-01 10:00:00"), ("j1", "u1", "b", "2024-01-02 10:00:00"),
         ("j1", "u1", "c", "2024-01-05 10:00:00"), ("j1", "u2", "d", "2024-01-09 10:00:00"),
         ("j2", "u3", "e", "2024-01-01 10:00:00")],
        "job_id string, upload_id string, keyword string, ts string").select(
            "job_id", "upload_id", "keyword", F.col("ts").cast("timestamp").alias("ingest_timestamp"))
    base = tempfile.mkdtemp(prefix="sl-")
    table, log = os.path.join(base, "t"), os.path.join(base, "log")
    A.create_table(spark, table, rows.schema)
    A.append_batch(rows, table, cluster=("job_id",))
    for job, owner in (("j1", 1), ("j2", 2)):
        A.upload_event(rows.where((F.col("job_id") == job) & (F.col("upload_id") != "u2")), "api", "fetch", "warehouse", "ranked",
                       client_id=owner, project_id=f"p{owner}").write.mode("append").parquet(log)
    return spark.read.parquet(table), spark.read.parquet(log)


def _keywords(df):
    return sorted(r.keyword for r in df.collect())


def test_reads_take_rows_of_every_day(spark):
    data, log = _stored(spark)
    assert _keywords(U.client_data(data, log, client_id=1)) == ["a", "b", "c", "d"]
    assert _keywords(U.project_data(data, log, project_id="p1")) == ["a", "b", "c", "d"]
    assert _keywords(U.preview_upload(log, data, "u1", None)) == ["a", "b", "c"]
    assert _keywords(U.preview_upload(log, data, "u1", 2, ["keyword"])) == ["a", "b"]
    assert _keywords(U.preview_upload(log, data, "u2", None)) == []
    assert _keywords(U.client_data(data, log, client_id=3)) == []


def _scanned(df):
    """Rows that the file scans of an executed plan gave out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        if "FileSourceScan" in leaves.apply(i).getClass().getSimpleName():
            total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_one_owner_skips_row_groups_of_others(spark):
    n, jobs = 40_000, 400
    # random order inside a file and no common day: neither statistics nor partitions tell the jobs apart
    rows = spark.range(n).select(F.md5((F.col("id") % jobs).cast("string")).alias("job_id"), F.md5((F.col("id") % (4 * jobs)).cast("string")).alias("upload_id"),
                                 F.col("id").cast("string").alias("keyword"), F.timestamp_seconds(F.col("id") % 86_400).alias("ingest_timestamp"))
    base = tempfile.mkdtemp(prefix="sl-")
    table = os.path.join(base, "t")
    A.create_table(spark, table, rows.schema)
    for part in range(8):
        A.append_batch(rows.where(F.pmod(F.xxhash64("job_id"), F.lit(8)) == part), table, cluster=("keyword",))
    log = rows.where(F.col("job_id").isin([F.md5(F.lit("7")), F.md5(F.lit("8"))])).select(
        "job_id", "upload_id", F.lit("5").alias("client_id"), F.lit("t").alias("table_name"))
    data = spark.read.parquet(table)
    mine = U.client_data(data, log, client_id=5)
    assert mine.count() == 2 * n // jobs
    assert _scanned(U.client_data(data, log, client_id=5)) <= n // 2
    one = rows.first()["upload_id"]
    found = U.preview_upload(rows.select("upload_id"), data, one, None)
    assert found.count() == n // (4 * jobs) and _scanned(data.where(F.col("upload_id") == one)) <= n // 4


def test_an_owner_of_many_jobs(spark):
    rows = spark.range(1000).select(F.concat(F.lit("j"), "id").alias("job_id"), F.col("id").cast("string").alias("keyword"))
    log = rows.select("job_id", F.when(F.col("keyword").cast("long") % 2 == 0, "1").alias("client_id"))
    assert U.client_data(rows, log, client_id=1).count() == 500


def test_client_summary_measures_each_data_row_once(spark):
    """Text lengths and cents are made below the join, once a data row, not once an expanded row."""
    from searchlake.plans import registry
    registry.load_all()
    df = registry.QUERIES["d8_client_data_by_domain"](spark, "/root/testdata/sf0.001")
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Join ", 1)
    assert "length(" not in above and "round(" not in above
    assert below.count("length(") >= 4 and "round(" in below
