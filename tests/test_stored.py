"""Stored tables changed in place (H6-H8, H14), drift by checksums (H15), JSON streams (A1, K1)."""

import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from searchlake.operators import reconcile as H
from searchlake.operators import stored as S
from searchlake.operators.ingest import append_batch, create_table
from searchlake.schemas import SENTINEL

ROWS = [("j1", "u1", "2025-01-01 10:00:00", "a.com", 1, "x"), ("j1", SENTINEL, "2025-01-02 10:05:00", "a.com", 1, "y"),
        (SENTINEL, "u3", "2025-01-02 10:50:00", "b.com", 2, "z"), ("j4", "u4", "2025-01-03 00:00:00", "c.com", None, "w"),
        ("j5", "u5", None, "d.com", 5, "v")]
SCHEMA = "job_id string, upload_id string, ts string, domain string, domain_id bigint, keyword string"


def _table(spark, rows=ROWS):
    path = os.path.join(tempfile.mkdtemp(prefix="stored-"), "t")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ingest_timestamp", F.col("ts").cast("timestamp")).drop("ts")
    create_table(spark, path, df.withColumn("ingest_date", F.to_date("ingest_timestamp")).schema)
    append_batch(df, path)
    return path


def _files(path):
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(root, n)] = hashlib.sha256(open(os.path.join(root, n), "rb").read()).hexdigest()
    return out


def _days(files):
    return {os.path.basename(os.path.dirname(f)) for f in files}


def test_backfill_rewrites_only_days_with_a_sentinel(spark):
    path, events = _table(spark), os.path.join(tempfile.mkdtemp(prefix="ev-"), "e")
    before = _files(path)
    days = S.backfill_stored(spark, path, "t", "both", events)
    after = _files(path)
    assert [str(d) for d in days] == ["2025-01-02"]
    assert _days([f for f in before if after.get(f) != before[f]]) == {"ingest_date=2025-01-02"}
    rows = {r["keyword"]: r for r in spark.read.parquet(path).collect()}
    assert len(rows) == 5 and all(SENTINEL not in (r["job_id"], r["upload_id"]) for r in rows.values())
    assert rows["y"]["job_id"] == "j1" and rows["z"]["upload_id"] == "u3"
    assert [r["row_count"] for r in spark.read.parquet(events).collect()] == [2]
    assert S.backfill_stored(spark, path, "t", "both", events) == [] and _files(path) == after
    assert spark.read.parquet(events).count() == 1


def test_a_repeat_after_the_event_was_written_adds_no_event(spark):
    path, events = _table(spark), os.path.join(tempfile.mkdtemp(prefix="ev-"), "e")
    H.backfill_events(spark.read.parquet(path), "t", "upload").write.parquet(events)  # died before the rows changed
    S.backfill_stored(spark, path, "t", "upload", events)
    ev = spark.read.parquet(events).collect()
    assert len(ev) == 1 and ev[0]["row_count"] == 1
    stored = spark.read.parquet(path).where("keyword = 'y'").first()
    assert stored["upload_id"] == ev[0]["upload_id"]


def test_null_day_is_a_partition_like_others(spark):
    path = _table(spark, ROWS[:1] + [("j5", SENTINEL, None, "d.com", 5, "v")])
    before = _files(path)
    assert S.change_partitions(spark, path, lambda t: t.where(F.col("upload_id") == SENTINEL),
                               lambda t: t.withColumn("upload_id", F.lit("u9"))) == [None]
    after = _files(path)
    assert _days([f for f in before if after.get(f) == before[f]]) == {"ingest_date=2025-01-01"}
    assert {r["upload_id"] for r in spark.read.parquet(path).collect()} == {"u1", "u9"}


def test_a_change_may_not_move_rows_or_empty_a_partition(spark):
    path = _table(spark)
    before = _files(path)
    hit = lambda t: t.where("keyword = 'x'")
    with pytest.raises(ValueError, match="other partitions"):
        S.change_partitions(spark, path, hit, lambda t: t.withColumn("ingest_date", F.date_add("ingest_date", 30)))
    with pytest.raises(ValueError, match="empties"):
        S.change_partitions(spark, path, hit, lambda t: t.where("keyword <> 'x'"))
    assert _files(path) == before


def test_mapping_rewrites_only_days_that_it_changes(spark):
    path = _table(spark)
    before = _files(path)
    mapping = spark.createDataFrame([("a.com", 7, "A.com"), ("a.com", 9, "a9.com"), ("c.com", 3, "c.com"), ("none", 1, "n")],
                                    "raw_domain string, domain_id bigint, canonical string")
    days = S.map_stored(spark, path, mapping)
    assert sorted(str(d) for d in days) == ["2025-01-01", "2025-01-02", "2025-01-03"]
    got = {r["keyword"]: (r["domain_id"], r["domain"]) for r in spark.read.parquet(path).collect()}
    assert got == {"x": (9, "a9.com"), "y": (9, "a9.com"), "z": (2, "b.com"), "w": (3, "c.com"), "v": (5, "d.com")}
    after = _files(path)
    assert _days([f for f in before if after.get(f) == before[f]]) == {"ingest_date=__HIVE_DEFAULT_PARTITION__"}
    assert S.map_stored(spark, path, mapping) == [] and _files(path) == after


def test_drift_by_checksums_equals_drift(spark):
    cols = ["k", "v", "t"]
    a = spark.createDataFrame([(i % 40, float(i), None if i % 7 == 0 else f"t{i % 5}") for i in range(200)] + [(1, 2.0, "same")] * 3,
                              "k bigint, v double, t string")
    b = a.where("v <> 13 or v is null").unionByName(spark.createDataFrame(
        [(1, 2.0, "same"), (None, None, None), (None, float("nan"), "-")], a.schema)).withColumn("k", F.col("k").cast("double"))
    for buckets in (1, 8, 65536):
        got = sorted(map(str, H.drift_by_checksums(a, b, cols, buckets).collect()))
        assert got == sorted(map(str, H.drift(a, b, cols).collect())) and len(got) == 4
    assert H.drift_by_checksums(a, a, cols).isEmpty() and H.unequal_buckets(a, a, cols).isEmpty()
    assert H.drift_by_checksums(a.limit(0), a.limit(0), cols).isEmpty()


def test_checksums_tell_swapped_nulls_and_texts_apart(spark):
    a = spark.createDataFrame([("x", None), ("a|b", "c")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), ("a", "b|c")], "p string, q string")
    assert H.drift_by_checksums(a, b, ["p", "q"]).count() == 4
    n, t = spark.createDataFrame([(1,)], "p bigint"), spark.createDataFrame([("1",)], "p string")
    assert H.drift_by_checksums(n, t, ["p"]).count() == 2


@pytest.mark.parametrize("fmt", ["json", "jsonl"])
def test_documents_stream_by_path(spark, fmt):
    from searchlake.sources.responses import stream_responses
    base = tempfile.mkdtemp(prefix="docs-")
    docs = [("serp", "a.com", {"tasks": [1]}), ("serp", "b.com", {"tasks": []}), ("ranked_keywords", "a.com", {"x": "ä"})]
    for i, (endpoint, target, doc) in enumerate(docs):
        folder = os.path.join(base, endpoint, target)
        os.makedirs(folder, exist_ok=True)
        text = json.dumps(doc, indent=1 if fmt == "json" else None, ensure_ascii=False)
        open(os.path.join(folder, f"{i}.{fmt}"), "w", encoding="utf8").write(text + ("\n\n" if fmt == "jsonl" else ""))
    out, ckpt = (os.path.join(tempfile.mkdtemp(prefix="out-"), n) for n in ("o", "c"))
    stream = stream_responses(spark, base, fmt, max_files=1)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    got = {(r["endpoint"], r["target"]): json.loads(r["raw"]) for r in spark.read.schema(stream.schema).parquet(out).collect()}
    assert got == {(e, t): d for e, t, d in docs}
