"""Write path, request side and streaming idempotency."""

import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from searchlake.operators import ingest as A
from searchlake.streaming import jobs as K

JOB = "3f2b8a1e-5d4c-4e7f-9a6b-1c2d3e4f5a6b"


def _rows(spark):
    return spark.createDataFrame(
        [(1, "a.com", "2024-01-01 10:00:00"), (2, "b.com", "2024-01-02 11:00:00")],
        "domain_id bigint, domain string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))


def test_stamp_upload_rejects_bad_job_id(spark):
    with pytest.raises(ValueError):
        A.stamp_upload(_rows(spark), "not-a-uuid")
    out = A.stamp_upload(_rows(spark), JOB, "u1", "2025-01-01 00:00:00").collect()
    assert {r.upload_id for r in out} == {"u1"} and {r.job_id for r in out} == {JOB}


def test_append_refuses_missing_table_and_skips_empty(spark):
    base = tempfile.mkdtemp(prefix="sl-")
    df = A.stamp_upload(_rows(spark), JOB, "u1").withColumn("ingest_timestamp", F.col("ts"))
    with pytest.raises(FileNotFoundError):
        A.append_batch(df, os.path.join(base, "missing"))
    path = os.path.join(base, "t")
    A.create_table(spark, path, df.schema)
    assert A.append_batch(df.limit(0), path) is False
    assert A.append_batch(df, path) is True
    back = spark.read.parquet(path)
    assert back.count() == 2 and "ingest_date" in back.columns


def test_reload_moves_pointer(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="sl-"), "t")
    A.reload(spark.range(5), base)
    A.reload(spark.range(3), base)
    assert A.read_current(spark, base).count() == 3


def test_dedupe_keeps_newest(spark):
    df = spark.createDataFrame([("k", 1, "2024-01-01"), ("k", 2, "2024-02-01"), ("j", 3, "2024-01-01")],
                               "kw string, v bigint, ingest_timestamp string")
    got = {r.kw: r.v for r in A.dedupe(df, ["kw"]).collect()}
    assert got == {"k": 2, "j": 3}


def test_assemble_pages(spark):
    pages = spark.createDataFrame([("t", 0, 10), ("t", 10, 10), ("t", 20, 4), ("t", 30, 10),
                                   ("u", 0, 0), ("u", 10, 10)], "target string, offset bigint, n_rows bigint")
    kept = sorted((r.target, r.offset) for r in A.assemble_pages(pages, "backlinks", page_size=10).collect())
    assert kept == [("t", 0), ("t", 10), ("t", 20)]
    ranked = spark.createDataFrame([("t", 0, 5), ("t", 10, 0), ("t", 20, 5), ("t", 30, 0), ("t", 40, 0),
                                    ("t", 50, 5)], "target string, offset bigint, n_rows bigint")
    kept = sorted(r.offset for r in A.assemble_pages(ranked, "ranked", page_size=10, limit=100).collect())
    assert kept == [0, 20]


def test_build_requests_and_batches(spark):
    t = spark.createDataFrame([("x.com",)], "target string")
    payload = json.loads(A.build_requests(t, "backlinks").first().payload)
    assert payload == [{"target": "x.com", "limit": 1000, "offset": 0, "filters": [["dofollow", "=", True]]}]
    kws = spark.createDataFrame([(i, f"k{i}") for i in range(25)], "i bigint, target string")
    b = A.batch_targets(kws, 10, ["i"]).orderBy("batch_no").collect()
    assert [r.n_targets for r in b] == [10, 10, 5] and b[2].targets[0] == "k20"


def test_prepare_export(spark):
    df = spark.createDataFrame([(2, None, None), (1, "x", "https://u")], "id bigint, note string, page_url string")
    rows = A.prepare_export(df, ["id"], max_cells=6).orderBy("sheet_row").collect()
    assert [(r.id, r.note, r.page_url, r.sheet_row, r.batch_no) for r in rows] == \
        [("1", "x", "https://u", 2, 0), ("2", "", "Not ranking", 3, 1)]


def test_stream_ingest_replay_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="sl-")
    doc = {"tasks": [{"id": "t1", "data": {"location_code": 2840}, "result": [{"items": [
        {"keyword_data": {"keyword": "a", "keyword_info": {"search_volume": 1}},
         "ranked_serp_element": {"serp_item": {"rank_group": 1, "url": "u"}}}]}]}]}
    landing = os.path.join(base, "landing")
    spark.createDataFrame([("ranked_keywords", "x.com", 0, json.dumps(doc))], K.RESPONSE_SCHEMA) \
        .write.parquet(landing)
    table, events = os.path.join(base, "table"), os.path.join(base, "events")
    empty = spark.read.parquet(landing).limit(0)
    from searchlake.operators.flatten import flatten
    layout = A.to_table_layout(A.stamp_upload(A.stamp_fetch(flatten(empty, "ranked_keywords"), None, None),
                                              JOB, "x"), "ranked_keywords")
    A.create_table(spark, table, layout.schema, "upload_id")

    def run(checkpoint):
        K.stream_ingest(spark, landing, "ranked_keywords", table, events, checkpoint, JOB).awaitTermination()
        return spark.read.parquet(table).count(), [r.row_count for r in spark.read.parquet(events).collect()]

    def uncommit(checkpoint):
        for name in ("0", ".0.crc"):
            os.remove(os.path.join(checkpoint, "commits", name))

    first = os.path.join(base, "ck1")
    assert run(first) == (1, [1])
    # the batch failed before its commit: it runs again and replaces itself
    uncommit(first)
    assert run(first) == (1, [1])
    # its event was lost as well
    up = K.batch_upload_id(first, JOB, table, 0)
    shutil.rmtree(os.path.join(events, f"upload_id={up}"))
    uncommit(first)
    assert run(first) == (1, [1])
    # it failed before Spark committed the partition
    shutil.rmtree(os.path.join(table, f"upload_id={up}"))
    uncommit(first)
    assert run(first) == (1, [1])
    # another stream into the same table and events is no replay
    assert run(os.path.join(base, "ck2")) == (2, [1, 1])
    back = spark.read.parquet(table).select("upload_id", "job_id").collect()
    assert {r.upload_id for r in back} == {K.batch_upload_id(os.path.join(base, c), JOB, table, 0) for c in ("ck1", "ck2")}


def test_replacing_an_upload_leaves_others(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="sl-"), "t")
    rows = lambda *ks: spark.createDataFrame([(k, "j") for k in ks], "keyword string, job_id string")
    for up, ks in (("u1", "ab"), ("u2", "c"), ("u1", "x")):
        assert A.replace_upload(rows(*ks), path, up, ("job_id",)).count() == len(ks)
    assert sorted((r.upload_id, r.keyword) for r in spark.read.parquet(path).collect()) == [("u1", "x"), ("u2", "c")]
    assert A.replace_upload(rows("x").limit(0), path, "u3", ("job_id",)) is None


def test_event_counts_the_stored_attempts(spark):
    base = tempfile.mkdtemp(prefix="sl-")
    path, events = f"{base}/log", f"{base}/events"
    A.create_table(spark, path, A.ATTEMPT_LOG_SCHEMA)
    records = spark.createDataFrame([("e", f"t{i}", 1) for i in range(7)], "endpoint string, target string, attempt long")
    filled = records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in A.ATTEMPT_LOG_SCHEMA.fields if f.name not in records.columns})
    for up in ("u1", "u2"):
        A.append_attempts(A.attempt_log_rows(filled, JOB, up), path, events)
    assert sorted((r.upload_id, r.row_count) for r in spark.read.parquet(events).collect()) == [("u1", 7), ("u2", 7)]


def test_posted_tasks_that_no_get_saw_time_out(spark):
    base = tempfile.mkdtemp(prefix="sl-")
    day = "2024-01-01 "

    def land(folder, schema, files):
        for i, rows in enumerate(files):
            spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{base}/{folder}/b{i}")
            os.utime(f"{base}/{folder}/b{i}", (1_700_000_000 + i, 1_700_000_000 + i))
    land("posts", "task_id string, ts string", [[("a", day + "00:00:00"), ("lost", day + "00:01:00"), ("slow", day + "00:02:00")],
                                                [("young", day + "08:30:00")], [("z", day + "09:00:00")]])
    land("gets", "task_id string, ts string, status_code long, n_items long",
         [[("a", day + "00:05:00", 40601, 0), ("slow", day + "00:05:00", 40601, 0)], [("a", day + "00:20:00", 20000, 3)],
          [("young", day + "09:00:00", 40601, 0), ("slow", day + "08:00:00", 20000, 1)]])
    read = lambda folder, schema: (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                                   .option("recursiveFileLookup", "true").parquet(f"{base}/{folder}"))
    states = K.task_states(read("gets", "task_id string, ts timestamp, status_code long, n_items long"),
                           posts=read("posts", "task_id string, ts timestamp"))
    (states.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    got = {r.task_id: (r.state, r.observations) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got.pop("slow") in (("timed_out", 1), ("ready", 2))  # as the watermark or the late answer comes first
    assert got == {"a": ("ready", 2), "lost": ("timed_out", 0)}


def test_task_states_ready_and_timeout(spark):
    base = tempfile.mkdtemp(prefix="sl-k3-")
    schema = "task_id string, ts string, event_id bigint, status_code bigint, n_items bigint"
    batches = [[("a", "2024-01-01 00:00:00", 1, 40602, 0), ("b", "2024-01-01 00:00:00", 2, 40602, 0)],
               [("b", "2024-01-01 01:00:00", 3, 20000, 5), ("c", "2024-01-01 05:00:00", 4, 40602, 0),
                ("d", "2024-01-01 05:00:00", 5, 40402, 0)]]
    os.makedirs(os.path.join(base, "in"))
    for i, rows in enumerate(batches):
        out = os.path.join(base, f"p{i}")
        spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp")) \
            .coalesce(1).write.parquet(out)
        part = [f for f in os.listdir(out) if f.endswith(".parquet")][0]
        shutil.copy(os.path.join(out, part), os.path.join(base, "in", f"{i}.parquet"))
    stream = spark.readStream.schema("task_id string, ts timestamp, event_id bigint, status_code bigint, "
                                     "n_items bigint").option("maxFilesPerTrigger", 1) \
        .parquet(os.path.join(base, "in"))
    q = (K.task_states(stream).writeStream.queryName("k3_test").format("memory").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.task_id: (r.state, r.reason) for r in spark.table("k3_test").collect()}
    assert got["b"] == ("ready", None)
    assert got["d"] == ("failed", "task_not_found (40402)")
    assert got["a"] == ("timed_out", "timeout")      # watermark passed first sight + 2 h
    assert "c" not in got                           # still within its 2 h


def test_dedupe_stream(spark):
    base = tempfile.mkdtemp(prefix="sl-dd-")
    spark.createDataFrame([("k", 1, "2024-01-01 00:00:00"), ("k", 2, "2024-01-01 00:10:00"),
                           ("j", 3, "2024-01-01 00:00:00")], "kw string, v bigint, ts string") \
        .withColumn("ingest_timestamp", F.col("ts").cast("timestamp")).drop("ts") \
        .coalesce(1).write.parquet(os.path.join(base, "in"))
    src = spark.readStream.schema("kw string, v bigint, ingest_timestamp timestamp") \
        .parquet(os.path.join(base, "in"))
    q = (A.dedupe_stream(src, ["kw"]).writeStream.queryName("dd_test").format("memory")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.kw for r in spark.table("dd_test").collect()) == ["j", "k"]


def test_created_table_is_readable(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="sl-"), "t")
    A.create_table(spark, path, A.ATTEMPT_LOG_SCHEMA)
    back = spark.read.parquet(path)
    assert back.count() == 0 and set(A.ATTEMPT_LOG_SCHEMA.names) <= set(back.columns)
    with pytest.raises(FileExistsError):
        A.create_table(spark, path, A.ATTEMPT_LOG_SCHEMA)


def test_task_decisions():
    import numpy as np
    waiting = [40601, 40602]

    def first(codes, items, errors=0):
        return K._decision(np.array(codes), np.array(items), errors, 3, waiting)
    assert first([40601, 20000, 20000], [0, 0, 4]) == ((2, "ready", None), 0)
    assert first([50000, 40402], [0, 0]) == ((1, "failed", "task_not_found (40402)"), 1)
    assert first([50000, 50001], [0, 0], errors=1) == ((1, "failed", "status_50001_after_3_retries"), 3)
    assert first([40601, 50000], [0, 0]) == (None, 1) and first([], []) == (None, 0)


def test_task_states_over_micro_batches(spark):
    """One file per micro-batch: a late answer of a decided task is ignored, an
    undecided task times out with the watermark."""
    base = tempfile.mkdtemp(prefix="sl-")
    schema = "task_id string, ts timestamp, event_id long, status_code long, n_items long"
    day = "2024-01-01 "
    batches = [[("a", day + "00:00:00", 1, 40601, 0), ("b", day + "00:00:00", 2, 40602, 0)],
               [("a", day + "00:05:00", 3, 20000, 7)],
               [("a", day + "00:06:00", 4, 40402, 0), ("c", day + "09:00:00", 5, 20000, 1)],
               [("d", day + "09:30:00", 6, 20000, 1)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "task_id string, ts string, event_id long, status_code long, n_items long").selectExpr(
            "task_id", "cast(ts as timestamp) ts", "event_id", "status_code", "n_items").coalesce(1).write.parquet(f"{base}/in/b{i}")
        os.utime(f"{base}/in/b{i}", (1_700_000_000 + i, 1_700_000_000 + i))
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    (K.task_states(src).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    got = {r.task_id: (r.state, r.observations) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {"a": ("ready", 2), "b": ("timed_out", 1), "c": ("ready", 1), "d": ("ready", 1)}
