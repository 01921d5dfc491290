"""What derived tables and stored uploads cost: one exchange of lines, one landing for two streams, views made once."""

import glob

import pytest
from pyspark.sql import functions as F

from searchlake.operators import ingest as A
from searchlake.plans import registry
from searchlake.session import scratch_path
from searchlake.sources import responses as R
from searchlake.sources import testviews as V
from searchlake.streaming import jobs as K

SF = "/root/testdata/sf0.001"
registry.load_all()


def _files(path, pattern):
    return glob.glob(f"{path.removeprefix('file:')}/{pattern}", recursive=True)


def test_ranked_responses_shuffle_lines_only(spark):
    r = V.ranked_responses(spark, SF, 5)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "RoundRobin" not in plan
    exchanged = plan.split("Exchange hashpartitioning(")[1]  # what lies below the exchange
    assert "se_type" not in exchanged and "named_struct" not in exchanged
    assert r.rdd.getNumPartitions() == 5
    plain = V.ranked_responses(spark, SF)
    assert r.exceptAll(plain).isEmpty() and plain.exceptAll(r).isEmpty()
    assert r.where(F.col("raw").contains("__ITEMS__")).isEmpty()


def test_upload_is_stored_without_a_shuffle(spark):
    path = scratch_path(spark, "stored")
    rows = spark.range(30, numPartitions=3).select(F.lit("j").alias("job_id"), "id", F.lit("u").alias("upload_id"))
    A.create_table(spark, path, rows.schema, "upload_id")
    assert A.replace_upload(rows, path, "u", ("job_id",)).count() == 30
    assert len(_files(path, "upload_id=u/*.parquet")) == 3


@pytest.mark.parametrize("name", ["k1_stream_json", "k1_stream_events"])
def test_streams_share_a_packed_landing(spark, monkeypatch, name):
    seen, stream = set(), K.stream_ingest

    def spy(spark, landing, *args, **options):
        seen.add(landing)
        return stream(spark, landing, *args, **options)
    monkeypatch.setattr(K, "stream_ingest", spy)
    registry.QUERIES[name](spark, SF).collect()
    assert len(seen) == 1
    files = _files(seen.pop(), "**/part-*")
    assert files and all(f.endswith((".txt.gz", ".zstd.parquet")) for f in files)


def test_batch_job_computes_its_rows_once(spark):
    """An accumulator in the row path counts the responses read: each once, also for none."""
    from searchlake.schemas import ENDPOINTS
    read = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame
    table, events = scratch_path(spark, "job"), scratch_path(spark, "job_events")
    A.create_table(spark, table, ENDPOINTS["ranked_keywords"].table_schema())
    some = V.ranked_responses(spark, SF).limit(20).localCheckpoint()
    job = "7c0a5e1d-2b3f-4a6c-9d8e-1f2a3b4c5d6e"
    up = A.ingest_responses(some.mapInPandas(count, some.schema), "ranked_keywords", table, events, job)
    assert up and read.value == 20
    assert spark.read.parquet(events).first()["row_count"] == spark.read.parquet(table).count() > 0
    before = sorted(_files(table, "**/*.parquet"))
    assert A.ingest_responses(some.limit(0), "ranked_keywords", table, events, job) is None
    assert sorted(_files(table, "**/*.parquet")) == before and spark.read.parquet(events).count() == 1
    bad = some.withColumn("raw", F.lit("garbage"))
    assert A.ingest_responses(bad, "ranked_keywords", table, events, job) is None
    assert sorted(_files(table, "**/*.parquet")) == before


def test_drift_report_makes_its_views_once_and_shuffles_hashes(spark):
    from searchlake.operators import reconcile as H
    report = registry.QUERIES["h15_drift_report"](spark, SF)
    assert not any("lineitem" in f for f in report.inputFiles())  # stored before, not joined on each side
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, ""), (4, "y"), (4, "y")], "k int, v string")
    s = H.drift_summary(a, b, ["k", "v"], "t")
    assert "hashpartitioning(_h1" in s._jdf.queryExecution().executedPlan().toString()
    assert tuple(s.first()) == ("t", 2, 3, "DRIFT")
    assert tuple(H.drift_summary(a, a, ["v", "k"], "t").first()) == ("t", 0, 0, "clean")


def test_parsing_tasks_follow_the_bytes_of_the_lines(spark, monkeypatch):
    """The tasks that make and parse responses follow the lines' bytes, not the few bytes shuffled."""
    from searchlake.plans import registry
    from searchlake.sources import tables
    registry.load_all()
    monkeypatch.setattr(tables, "RESPONSE_BYTES", 2048, raising=False)
    size = int(tables.read_table(spark, SF, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert registry.QUERIES["b6_flatten_ranked_keywords"](spark, SF).rdd.getNumPartitions() == -(-size // 2048)


def test_calls_are_made_behind_the_exchange_of_events(spark, monkeypatch):
    """K2: events are shuffled, not the JSON of calls; a batch has more files than by the bytes of lines."""
    from searchlake.plans import q_streaming as Q
    from searchlake.sources.tables import read_table
    plan = V.attempt_calls(spark, SF, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RoundRobinPartitioning(5)") == 1 and "to_json" not in plan.split("RoundRobinPartitioning(5)")[1]
    a, b = V.attempt_calls(spark, SF, 5), V.attempt_calls(spark, SF)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    events = read_table(spark, "/root/testdata/sf0.1", "events")
    assert Q._files_a_batch(events, 3, Q.EVENT_FILE_BYTES) > Q._files_a_batch(events, 3)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _aggregated(plan):
    """What the plan's aggregates collect."""
    return [line for line in plan.splitlines() if "collect_list(" in line]


def test_backlinks_are_made_behind_the_exchange_of_lines(spark):
    r = R.backlinks_responses(spark, SF, 5)
    plan = _plan(r)
    assert plan.count("Exchange hashpartitioning(") == 1
    assert "domain_from" not in plan.split("Exchange hashpartitioning(")[1]
    assert not any("StructsToJson" in line.split("functions=")[1].split("output=")[0] for line in _aggregated(plan))
    assert r.rdd.getNumPartitions() == 5
    plain = R.backlinks_responses(spark, SF)
    assert r.exceptAll(plain).isEmpty() and plain.exceptAll(r).isEmpty()
    # Spark's own reading of the texts: one page of a supplier's lines of an order each
    item = "array<struct<url_from:string>>"
    doc = f"tasks array<struct<id:string,cost:string,data:struct<target:string>,result:array<struct<target:string,items:{item}>>>>"
    d = r.select("target", F.from_json("raw", doc)["tasks"].alias("t"))
    d = d.select("target", F.size("t").alias("n"), F.col("t")[0].alias("t"))
    bad = (F.col("n") != 1) | (F.col("t.cost") != "0.01") | (F.col("t.data.target") != F.col("target")) \
        | (F.size("t.result") != 1) | (F.col("t.result")[0]["target"] != F.col("target"))
    assert d.where(F.coalesce(bad, F.lit(True))).isEmpty()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert d.select(F.sum(F.size(F.col("t.result")[0]["items"]))).first()[0] == lines.count()


def test_serp_is_made_behind_the_exchange_of_lines(spark):
    r = R.serp_responses(spark, SF, 5)
    plan = _plan(r)
    assert plan.count("Exchange hashpartitioning(") == 2 and "ShuffledHashJoin" in plan  # lines, orders
    assert not any("StructsToJson" in line.split("functions=")[1].split("output=")[0] for line in _aggregated(plan))
    plain = R.serp_responses(spark, SF)
    assert r.exceptAll(plain).isEmpty() and plain.exceptAll(r).isEmpty()


@pytest.mark.parametrize("name", ["b1_flatten_serp", "b2_extract_paa", "b3_flatten_backlinks",
                                  "b6_flatten_ranked_keywords", "d10_top_keywords"])
def test_parsed_texts_are_made_before(spark, name):
    """``from_json`` interprets its arguments: the responses' texts are to be columns by then."""
    plan = _plan(registry.QUERIES[name](spark, SF))
    lines = [line for line in plan.splitlines() if "from_json(" in line and "tasks" in line]
    assert lines and not any("StructsToJson" in line or "array_join" in line for line in lines)


@pytest.mark.parametrize("name", ["k1_stream_ingest", "k1_stream_events"])
def test_two_streams_run_side_by_side(spark, monkeypatch, name):
    """Both streams of K1 are started before either is waited for, over a landing of more files than K1's by JSON has."""
    from searchlake.plans import q_streaming as Q
    monkeypatch.setattr(Q, "LANDING_FILE_BYTES", 4_000, raising=False)
    seen, files, stream = [], set(), K.stream_ingest

    class Seen:
        def __init__(self, query):
            self.query = query

        def awaitTermination(self):
            seen.append("wait")
            return self.query.awaitTermination()

        def stop(self):
            self.query.stop()

    def spy(spark, landing, *args, **options):
        seen.append("start")
        files.add(len(_files(landing, "part-*")))
        return Seen(stream(spark, landing, *args, **options))
    monkeypatch.setattr(K, "stream_ingest", spy)
    registry.QUERIES[name](spark, SF).collect()
    assert seen == ["start", "start", "wait", "wait"] * 2
    assert len(files) == 1 and min(files) > 12


def test_a_failed_stream_ends_the_other(spark):
    from searchlake.plans import q_streaming as Q
    ended = []

    class Stream:
        def __init__(self, name, fails=False):
            self.name, self.fails = name, fails

        def awaitTermination(self):
            if self.fails:
                raise RuntimeError(self.name)

        def stop(self):
            ended.append(self.name)
    with pytest.raises(RuntimeError, match="a"):
        Q._finish(Stream("a", True), Stream("b"))
    assert ended == ["a", "b"]


def test_batches_follow_the_files_that_landed(spark, monkeypatch):
    """A landing of other than the files asked for is still read in four and in three batches."""
    right = V.ranked_responses
    monkeypatch.setattr(V, "ranked_responses", lambda spark, d, parts: right(spark, d, 2 * parts + 2))
    assert tuple(registry.QUERIES["k1_stream_events"](spark, SF).first())[:2] == (7, 7)
