"""Checked queries for the upload log (D) and the attempt log (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators import attempts as A
from searchlake.operators import sketches as K
from searchlake.operators import uploads as U
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.registry import register
from searchlake.session import scratch_path
from searchlake.sources import testviews as V

UPLOAD_COLS = ("job_id, upload_id, source, source_program, dataset, table_name, row_count, "
               "ingest_timestamp, client_id, project_id, notes")
DATA_COLS = ("job_id, upload_id, ingest_timestamp, domain_id, domain, keyword, search_volume, "
             "rank, round(traffic_volume, 6) AS traffic_volume")


# ------------------------------------------------------------------ D rows
@register("d1_search_uploads", W(f"""
SELECT {UPLOAD_COLS} FROM v_uploads
WHERE dataset = 'click' AND ingest_timestamp >= TIMESTAMP '2024-01-10 00:00:00'
ORDER BY ingest_timestamp DESC, upload_id LIMIT 50""", "v_uploads"))
def q_d1(spark, d):
    return scalar_output(U.search_uploads(V.uploads(spark, d), dataset="click",
                                          since="2024-01-10 00:00:00", limit=50))


@register("d2_upload_summary", W("""
SELECT dataset, table_name, CAST(sum(row_count) AS BIGINT) AS total_rows,
       count(*) AS upload_count, max(ingest_timestamp) AS latest_upload
FROM v_uploads GROUP BY dataset, table_name""", "v_uploads"))
def q_d2(spark, d):
    return scalar_output(U.upload_summary(V.uploads(spark, d)))


@register("d3_preview_upload", W(f"""
SELECT {DATA_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY upload_id ORDER BY job_id NULLS FIRST,
           ingest_timestamp NULLS FIRST, domain_id NULLS FIRST, domain NULLS FIRST, keyword NULLS FIRST,
           search_volume NULLS FIRST, rank NULLS FIRST, traffic_volume NULLS FIRST) AS rn
  FROM v_data WHERE upload_id IN (SELECT upload_id FROM v_uploads)) x
WHERE rn <= 100""", "v_uploads", "v_data"))
def q_d3(spark, d):
    return scalar_output(U.preview_upload(V.uploads(spark, d), V.data_rows(spark, d), limit=100))


@register("d4_available_datasets", W("""
SELECT DISTINCT dataset FROM v_uploads WHERE dataset IS NOT NULL AND dataset <> ''""",
                                     "v_uploads"))
def q_d4(spark, d):
    return U.available_datasets(V.uploads(spark, d))


@register("d5_available_tables", W("""
SELECT DISTINCT dataset, table_name FROM v_uploads
WHERE table_name IS NOT NULL AND table_name <> ''""", "v_uploads"))
def q_d5(spark, d):
    return U.available_tables(V.uploads(spark, d), per_dataset=True)


@register("d6_client_job_ids", W("""
SELECT DISTINCT client_id, job_id FROM v_uploads WHERE client_id IS NOT NULL AND job_id IS NOT NULL""",
                                 "v_uploads"))
def q_d6(spark, d):
    return U.client_job_ids(V.uploads(spark, d))


@register("d7_client_data", W(f"""
SELECT p.client_id, p.table_name, {DATA_COLS} FROM v_data
JOIN (SELECT DISTINCT client_id, table_name, job_id FROM v_uploads
      WHERE client_id IS NOT NULL AND table_name IS NOT NULL) p
USING (job_id)""", "v_uploads", "v_data"))
def q_d7(spark, d):
    return scalar_output(U.client_data(V.data_rows(spark, d), V.uploads(spark, d), per_table=True))


# D8 for all clients as one batch is one output row per (data row, owning
# client): about 90x the data rows here. The registered check runs the full
# join over the whole tables and compares per-client summaries of it; the
# row-level output is compared with DuckDB on the smallest tables in tests/.
D8_ROWS_SQL = f"""
SELECT o.client_id, {DATA_COLS} FROM v_data
JOIN (SELECT cd.client_id, dm.domain FROM v_client_domains cd JOIN v_domains dm
      ON dm.domain_id = cd.domain_id WHERE NOT cd.is_competitor) o USING (domain)"""


@register("d8_client_data_by_domain", W(f"""
SELECT client_id, count(*) AS n_rows,
       CAST(sum(search_volume) AS BIGINT) AS search_volume, CAST(sum(rank) AS BIGINT) AS rank_sum,
       CAST(sum(CAST(round(traffic_volume * 100) AS BIGINT)) AS BIGINT) AS traffic_cents,
       CAST(sum(length(domain)) AS BIGINT) AS domain_chars,
       CAST(sum(length(keyword)) AS BIGINT) AS keyword_chars,
       CAST(sum(length(upload_id)) AS BIGINT) AS upload_id_chars,
       CAST(sum(length(job_id)) AS BIGINT) AS job_id_chars,
       min(ingest_timestamp) AS first_ingest, max(ingest_timestamp) AS last_ingest
FROM ({D8_ROWS_SQL}) r GROUP BY client_id""", "v_data", "v_client_domains", "v_domains"))
def q_d8(spark, d):
    # fixed-width aggregates only, so the summary stays a hash aggregate over
    # the expanded rows (string min/max would sort them); what is summed is made
    # once a data row, not once an expanded row
    texts = ("domain", "keyword", "upload_id", "job_id")
    data = V.data_rows(spark, d).withColumns({f"{c}_chars": F.length(c) for c in texts} | {
        "traffic_cents": F.round(F.col("traffic_volume") * 100).cast("bigint")})
    rows = d8_rows(spark, d, data)
    chars = {c: F.sum(f"{c}_chars").cast("bigint").alias(f"{c}_chars") for c in texts}
    return scalar_output(rows.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("search_volume").cast("bigint").alias("search_volume"),
        F.sum("rank").cast("bigint").alias("rank_sum"),
        F.sum("traffic_cents").alias("traffic_cents"),
        *chars.values(),
        F.min("ingest_timestamp").alias("first_ingest"), F.max("ingest_timestamp").alias("last_ingest")))


def d8_rows(spark, d, data=None):
    """D8 rows for the batch of every client (client_id first, then the data row)."""
    return U.client_data_by_domain(V.data_rows(spark, d) if data is None else data, V.client_domains(spark, d),
                                   V.domains(spark, d), V.clients(spark, d))


@register("d9_project_data", W(f"""
SELECT p.project_id, {DATA_COLS} FROM v_data
JOIN (SELECT DISTINCT project_id, job_id FROM v_uploads WHERE project_id IS NOT NULL) p USING (job_id)""",
                               "v_uploads", "v_data"))
def q_d9(spark, d):
    return scalar_output(U.project_data(V.data_rows(spark, d), V.uploads(spark, d)))


# One-owner forms over a stored table (partitioned by ingest day) and a log
# written by A5: one upload has one ingest time, one client's jobs have a
# third of the uploads.
_STORED = """
stored AS (SELECT job_id, upload_id, DATE '2024-01-01' + CAST(coalesce(TRY_CAST(substr(upload_id, 4) AS BIGINT), 0) % 24 AS INTEGER)
                  + INTERVAL 0 HOUR AS ingest_timestamp, domain, keyword, search_volume, rank FROM v_data),
owned AS (SELECT *, CAST(coalesce(TRY_CAST(substr(job_id, 5) AS BIGINT), 0) % 3 AS VARCHAR) AS owner FROM stored)"""
_STORED_COLS = "job_id, upload_id, ingest_timestamp, domain, keyword, search_volume, rank"


def _stored(spark, d):
    from searchlake.operators import ingest as G
    from searchlake.session import scratch_path
    n = lambda c, at: F.coalesce(F.substring(c, at, 20).try_cast("bigint"), F.lit(0))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (n("upload_id", 4) % 24).cast("int")).cast("timestamp")
    rows = V.data_rows(spark, d).select("job_id", "upload_id", day.alias("ingest_timestamp"), "domain", "keyword", "search_volume", "rank")
    table, log = scratch_path(spark, "stored"), scratch_path(spark, "stored_log")
    G.create_table(spark, table, rows.schema)
    G.append_batch(rows, table, cluster=("job_id",))
    for owner in range(3):
        G.upload_event(rows.where(n("job_id", 5) % 3 == owner), "api", "fetch", "warehouse", "ranked_keywords",
                       client_id=owner, project_id=f"p{owner}").write.mode("append").parquet(log)
    return spark.read.parquet(table), spark.read.parquet(log)


@register("d3_preview_one_upload", W(f"""
WITH {_STORED} SELECT {_STORED_COLS} FROM stored WHERE upload_id = 'up-33'
ORDER BY keyword, rank, search_volume, job_id, domain LIMIT 100""", "v_data"))
def q_d3_one(spark, d):
    data, log = _stored(spark, d)
    return scalar_output(U.preview_upload(log, data, "up-33", 100, ["keyword", "rank", "search_volume", "job_id", "domain"])
                         .select(*_STORED_COLS.split(", ")))


@register("d6_one_client_job_ids", W(f"WITH {_STORED} SELECT DISTINCT job_id FROM owned WHERE owner = '1'", "v_data"))
def q_d6_one(spark, d):
    return U.client_job_ids(_stored(spark, d)[1], client_id=1)


@register("d7_one_client_data", W(f"""
WITH {_STORED} SELECT {_STORED_COLS} FROM stored WHERE job_id IN (SELECT job_id FROM owned WHERE owner = '1')""", "v_data"))
def q_d7_one(spark, d):
    data, log = _stored(spark, d)
    return scalar_output(U.client_data(data, log, client_id=1).select(*_STORED_COLS.split(", ")))


@register("d9_one_project_data", W(f"""
WITH {_STORED} SELECT {_STORED_COLS} FROM stored WHERE job_id IN (SELECT job_id FROM owned WHERE owner = '2')""", "v_data"))
def q_d9_one(spark, d):
    data, log = _stored(spark, d)
    return scalar_output(U.project_data(data, log, project_id="p2").select(*_STORED_COLS.split(", ")))


@register("d8_one_client_data", W(f"""
SELECT {DATA_COLS} FROM v_data WHERE domain IN (
  SELECT dm.domain FROM v_client_domains cd JOIN v_domains dm ON dm.domain_id = cd.domain_id
  WHERE NOT cd.is_competitor AND cd.client_id = 7)""", "v_data", "v_client_domains", "v_domains"))
def q_d8_one(spark, d):
    return scalar_output(U.client_data_by_domain(V.data_rows(spark, d), V.client_domains(spark, d), V.domains(spark, d), 7)
                         .select(*V.data_rows(spark, d).columns))


@register("d1_search_uploads_of_client", W(f"""
SELECT {UPLOAD_COLS} FROM v_uploads WHERE client_id = '7' AND table_name = 't3'
ORDER BY ingest_timestamp DESC, upload_id LIMIT 50""", "v_uploads"))
def q_d1c(spark, d):
    return scalar_output(U.search_uploads(V.uploads(spark, d), client_id=7, table="t3", limit=50))


@register("d11_html_ok_urls", W("""
SELECT address FROM v_crawl
WHERE lower(CAST(content_type AS VARCHAR)) LIKE '%html%' AND CAST(status_code AS VARCHAR) = '200'
  AND address IS NOT NULL AND address <> ''""", "v_crawl"))
def q_d11(spark, d):
    return U.html_ok_urls(V.crawl(spark, d))


# ------------------------------------------------------------------ C rows
@register("c1_attempt_records", W("""
SELECT endpoint, 'worker-' || event_id % 4 AS thread_name,
       CASE WHEN event_id % 9 = 0 THEN '["' || target || '","extra"]' ELSE target END AS target,
       attempt, strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f') AS started_at, duration_ms, http_status,
       CASE WHEN http_status = 200 THEN task_status_code END AS task_status_code,
       CASE WHEN http_status = 200 THEN task_status_message END AS task_status_message,
       round(CASE WHEN http_status = 200 THEN coalesce(task_cost, 0.0) ELSE 0.0 END, 6) AS task_cost,
       CASE WHEN http_status = 200 THEN n_items ELSE 0 END AS n_items,
       coalesce(error, '') AS error
FROM v_attempts""", "v_attempts"))
def q_c1(spark, d):
    rec = A.attempt_records(V.attempt_calls(spark, d)).drop("payload", "response")
    return scalar_output(rec.withColumn("attempt", F.col("attempt").cast("bigint")))


@register("c2_first_success", W("""
SELECT endpoint, target, attempt, started_at, event_id, n_items FROM (
  SELECT *, row_number() OVER (PARTITION BY endpoint, target
                               ORDER BY attempt, started_at, event_id) AS rn
  FROM v_attempts WHERE n_items > 0) x WHERE rn = 1""", "v_attempts"))
def q_c2(spark, d):
    a = V.attempts(spark, d).select("endpoint", "target", "attempt", "started_at", "event_id",
                                    "n_items")
    return scalar_output(A.first_success(a, tie=("event_id",)))


@register("c2_first_success_by_status", W("""
SELECT endpoint, target, attempt, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY endpoint, target
                               ORDER BY attempt, started_at, event_id) AS rn
  FROM v_attempts WHERE task_status_code = 20000) x WHERE rn = 1""", "v_attempts"))
def q_c2s(spark, d):
    a = V.attempts(spark, d).select("endpoint", "target", "attempt", "started_at", "event_id",
                                    "task_status_code", "n_items")
    return scalar_output(A.first_success(a, mode="status", tie=("event_id",))
                         .select("endpoint", "target", "attempt", "event_id"))


@register("c2_first_success_parsed", W("""
SELECT endpoint, target, attempt, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY endpoint, target
                               ORDER BY attempt, started_at, event_id) AS rn
  FROM v_attempts WHERE http_status = 200) x WHERE rn = 1""", "v_attempts"))
def q_c2p(spark, d):
    a = V.attempts(spark, d).select("endpoint", "target", "attempt", "started_at", "event_id", "http_status")
    return scalar_output(A.first_success(a, mode="parsed", tie=("event_id",)).select("endpoint", "target", "attempt", "event_id"))


@register("c3_mark_terminal", W("""
SELECT event_id, attempt, n_items, n_items > 0 OR attempt >= 3 AS is_terminal
FROM v_attempts""", "v_attempts"))
def q_c3(spark, d):
    a = V.attempts(spark, d).select("event_id", "attempt", "n_items")
    return scalar_output(A.mark_terminal(a, 3))


@register("c4_classify_task", W("""
SELECT event_id,
  CASE WHEN http_status <> 200 THEN 'not_ready'
       WHEN task_status_code IN (40601, 40602, 40202) THEN 'not_ready'
       WHEN task_status_code = 40402 THEN 'failed'
       WHEN task_status_code <> 20000 THEN 'error' ELSE 'ready' END AS state,
  CASE WHEN http_status <> 200 THEN 'not_ready'
       WHEN task_status_code IN (40102, 40601, 40602, 40202) THEN 'not_ready'
       WHEN task_status_code = 40402 THEN 'failed'
       WHEN task_status_code <> 20000 THEN 'error' ELSE 'ready' END AS state_bulk
FROM v_attempts""", "v_attempts"))
def q_c4(spark, d):
    a = V.attempts(spark, d)
    has_task = F.col("http_status") == 200
    items_null = F.lit(False)
    return a.select("event_id",
                    A.classify_task(F.col("task_status_code"), has_task, items_null).alias("state"),
                    A.classify_task(F.col("task_status_code"), has_task, items_null,
                                    "bulk").alias("state_bulk"))


@register("c5_failed_targets", W("""
SELECT endpoint, target AS keyword, 'task-' || CAST(event_id AS VARCHAR) AS task_id,
  CASE WHEN http_status <> 200 THEN 'exception_after_3_retries: '
            || substr(coalesce(nullif(error, ''), 'http ' || CAST(http_status AS VARCHAR)), 1, 100)
       WHEN task_status_code = 40402 THEN 'task_not_found (40402)'
       WHEN task_status_code IN (40601, 40602, 40202) THEN 'timeout'
       WHEN task_status_code <> 20000 THEN 'status_' || CAST(task_status_code AS VARCHAR)
            || '_after_3_retries' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY endpoint, target
                                   ORDER BY attempt DESC, started_at DESC, event_id DESC) AS rn
      FROM v_attempts) x
WHERE rn = 1 AND (http_status <> 200 OR task_status_code <> 20000)""", "v_attempts"))
def q_c5(spark, d):
    return A.failed_targets(_with_tasks(V.attempts(spark, d)), task_id="task_id", tie=("event_id",))


def _with_tasks(attempts):
    return attempts.withColumn("task_id", F.concat(F.lit("task-"), F.col("event_id").cast("string")))


# The 18-column log as A6 stores it: calls -> C1 -> C3 -> stamps -> append. Equal starts are
# ordered by the log's remaining columns.
_LOG = """
log AS (
  SELECT endpoint, CASE WHEN event_id % 9 = 0 THEN '["' || target || '","extra"]' ELSE target END AS target, attempt,
         strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f') AS started_at, started_at AS moment,
         CASE WHEN http_status = 200 THEN n_items ELSE 0 END > 0 OR attempt >= 3 AS is_terminal, duration_ms,
         'worker-' || event_id % 4 AS thread_name, http_status,
         CASE WHEN http_status = 200 THEN task_status_code END AS task_status_code,
         CASE WHEN http_status = 200 THEN n_items ELSE 0 END AS n_items, coalesce(error, '') AS error,
         CASE WHEN http_status = 200 THEN 'task-' || CAST(event_id AS VARCHAR) END AS task_id
  FROM v_attempts)"""
_LOG_TIES = "is_terminal, duration_ms, thread_name, http_status, task_status_code NULLS FIRST"
_LOG_LAST = ("attempt DESC, started_at DESC, is_terminal DESC, duration_ms DESC, thread_name DESC, http_status DESC, "
             "task_status_code DESC NULLS LAST")


def _log(spark, d):
    from searchlake.operators import ingest as G
    from searchlake.session import scratch_path
    path, events = scratch_path(spark, "attempt_log"), scratch_path(spark, "log_events")
    G.create_table(spark, path, G.ATTEMPT_LOG_SCHEMA)
    G.append_attempts(G.attempt_log_rows(A.mark_terminal(A.attempt_records(V.attempt_calls(spark, d))),
                                         "0b9f3f61-3c1e-4a77-8f6c-52a4f1a0a001"), path, events)
    return spark.read.parquet(path).select(*G.ATTEMPT_LOG_SCHEMA.names)


@register("c2_first_success_of_log", W(f"""
WITH {_LOG}
SELECT endpoint, target, attempt, started_at, is_terminal, duration_ms, thread_name, http_status, task_status_code, n_items FROM (
  SELECT *, row_number() OVER (PARTITION BY endpoint, target ORDER BY attempt, started_at, {_LOG_TIES}) AS rn
  FROM log WHERE n_items > 0) x WHERE rn = 1""", "v_attempts"))
def q_c2_log(spark, d):
    return A.first_success(_log(spark, d)).select("endpoint", "target", "attempt", "started_at", "is_terminal", "duration_ms",
                                                  "thread_name", "http_status", "task_status_code", "n_items")


@register("c5_failed_targets_of_log", W(f"""
WITH {_LOG},
known AS (SELECT endpoint, target, arg_max(task_id, struct_pack(attempt := attempt, s := started_at, t := task_id)) AS task_id
          FROM log WHERE task_id IS NOT NULL GROUP BY ALL)
SELECT x.endpoint, x.target AS keyword, k.task_id,
  CASE WHEN http_status <> 200 THEN 'exception_after_3_retries: '
            || substr(coalesce(nullif(error, ''), 'http ' || CAST(http_status AS VARCHAR)), 1, 100)
       WHEN task_status_code = 40402 THEN 'task_not_found (40402)'
       WHEN task_status_code IN (40601, 40602, 40202) THEN 'timeout'
       ELSE 'status_' || CAST(task_status_code AS VARCHAR) || '_after_3_retries' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY endpoint, target ORDER BY {_LOG_LAST}) AS rn FROM log) x
LEFT JOIN known k ON k.endpoint = x.endpoint AND k.target = x.target
WHERE rn = 1 AND (http_status <> 200 OR task_status_code <> 20000)""", "v_attempts"))
def q_c5_log(spark, d):
    return A.failed_targets(_log(spark, d))


@register("c11_task_progress_of_log", W(f"""
WITH {_LOG},
firsts AS (SELECT DISTINCT endpoint, target FROM log WHERE n_items > 0),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY endpoint, target ORDER BY {_LOG_LAST}) AS rn FROM log) x
         WHERE rn = 1 AND (http_status <> 200 OR task_status_code <> 20000)),
bad AS (SELECT endpoint, count(*) AS failed FROM last l
        WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.endpoint = l.endpoint AND f.target = l.target) GROUP BY endpoint),
ok AS (SELECT endpoint, count(*) AS collected FROM firsts GROUP BY endpoint),
span AS (SELECT endpoint, count(DISTINCT target) AS total_tasks, (epoch(max(moment)) - epoch(min(moment))) / 60.0 AS elapsed_min
         FROM log GROUP BY endpoint)
SELECT endpoint, total_tasks, coalesce(collected, 0) AS collected, coalesce(failed, 0) AS failed,
       total_tasks - coalesce(collected, 0) - coalesce(failed, 0) AS remaining,
       round(CASE WHEN elapsed_min > 0 THEN coalesce(collected, 0) / elapsed_min ELSE 0.0 END, 6) AS rate_per_min,
       round(CASE WHEN elapsed_min > 0 AND coalesce(collected, 0) > 0
                  THEN (total_tasks - collected - coalesce(failed, 0)) / (collected / elapsed_min) ELSE 0.0 END, 6) AS minutes_left
FROM span LEFT JOIN ok USING (endpoint) LEFT JOIN bad USING (endpoint)""", "v_attempts"))
def q_c11_log(spark, d):
    return scalar_output(A.task_progress(_log(spark, d)))


@register("c6_accepted_tasks", """
SELECT 'task-' || CAST(event_id AS VARCHAR) AS task_id, CAST(20100 AS BIGINT) AS status_code,
       'kw-' || CAST(user_id AS VARCHAR) AS tag
FROM events WHERE event_id % 8 <> 0 AND event_id % 5 <> 0""")
def q_c6(spark, d):
    return A.accepted_tasks(V.task_posts(spark, d), mode="serp")


@register("c6_accepted_tasks_volume", """
SELECT 'task-' || CAST(event_id AS VARCHAR) AS task_id,
       CAST(CASE WHEN event_id % 5 = 0 THEN 40501 ELSE 20100 END AS BIGINT) AS status_code, 'kw-' || CAST(user_id AS VARCHAR) AS tag
FROM events WHERE event_id % 8 <> 0""")
def q_c6v(spark, d):
    return A.accepted_tasks(V.task_posts(spark, d), mode="volume")


@register("c7_ready_ids", """
SELECT 'task-' || CAST(event_id AS VARCHAR) AS task_id, CAST(20000 AS BIGINT) AS status_code,
       'Ok.' AS status_message
FROM events""")
def q_c7(spark, d):
    return A.ready_ids(V.task_ready(spark, d))


@register("c8_incomplete_tasks", """
SELECT 'task-' || CAST(event_id AS VARCHAR) AS task_id
FROM events WHERE event_id % 8 <> 0 AND event_id % 5 <> 0 AND event_id % 3 = 0""")
def q_c8(spark, d):
    sub = A.accepted_tasks(V.task_posts(spark, d), mode="serp").select("task_id")
    return A.incomplete_tasks(sub, A.ready_ids(V.task_ready(spark, d, F.col("event_id") % 3 != 0)))


@register("c9_empties_vs_successes", W("""
SELECT n_items = 0 AS is_empty, quantile_cont(duration_ms, 0.5)::DOUBLE AS p50_ms, count(*) AS n
FROM v_attempts GROUP BY 1""", "v_attempts"))
def q_c9(spark, d):
    return scalar_output(A.empties_vs_successes(V.attempts(spark, d)))


def stored_sketches(spark, rows, make, name):
    """Sketches of all uploads, appended, appended again as a replay, and read back."""
    path = scratch_path(spark, name)
    K.append_sketches(make(rows, now="2025-06-01 00:00:00"), path)
    again = spark.read.parquet(path).withColumn("sketched_at", F.expr("sketched_at + INTERVAL 1 HOUR"))
    K.append_sketches(again, path)
    return K.latest_sketches(spark.read.parquet(path))


@register("c9_median_from_sketches", W("""
SELECT n_items = 0 AS is_empty, count(*) AS n, count(duration_ms) > 0 AS has_median, true AS within_error
FROM v_attempts GROUP BY 1""", "v_attempts"))
def q_c9_sketches(spark, d):
    """The merged median's exact rank lies within three times the stated error."""
    rows = V.attempts(spark, d)
    got = K.approx_empties_vs_successes(stored_sketches(spark, rows, K.duration_sketches, "duration-sketches"))
    ms, mid = F.col("duration_ms"), F.col("p50_ms")
    side = (F.col("n_items") == 0).alias("is_empty")
    at = (rows.groupBy(side, "duration_ms").agg(F.count(F.lit(1)).alias("c")).where(ms.isNotNull()).alias("r")
          .join(F.broadcast(got).alias("g"), F.col("r.is_empty").eqNullSafe(F.col("g.is_empty")))
          .groupBy("g.is_empty").agg(F.sum("c").alias("known"), F.coalesce(F.sum(F.when(ms < mid, F.col("c"))), F.lit(0)).alias("below"),
                                     F.sum(F.when(ms <= mid, F.col("c"))).alias("upto")))
    slack = F.col("known") * 3 * K.KLL_RANK_ERROR + 1
    return got.alias("g").join(at.alias("a"), F.col("g.is_empty").eqNullSafe(F.col("a.is_empty")), "left").select(
        "g.is_empty", "n", mid.isNotNull().alias("has_median"),
        F.coalesce((F.col("below") - slack <= F.col("known") / 2) & (F.col("upto") + slack >= F.col("known") / 2),
                   mid.isNull()).alias("within_error"))


@register("c10_cost_by_endpoint", W("""
SELECT endpoint, round(CAST(sum(CAST(task_cost AS DECIMAL(18, 9))) AS DOUBLE), 6) AS total_cost, count(*) AS calls,
       CAST(grouping(endpoint) AS TINYINT) AS is_total
FROM v_attempts WHERE task_cost IS NOT NULL GROUP BY ROLLUP (endpoint)""", "v_attempts"))
def q_c10(spark, d):
    return scalar_output(A.cost_by_endpoint(V.attempts(spark, d)))


@register("c11_task_progress", W("""
WITH firsts AS (SELECT DISTINCT endpoint, target FROM v_attempts WHERE n_items > 0),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY endpoint, target
                 ORDER BY attempt DESC, started_at DESC, event_id DESC) AS rn FROM v_attempts) x
         WHERE rn = 1 AND (http_status <> 200 OR task_status_code <> 20000)),
bad AS (SELECT endpoint, count(*) AS failed FROM last l
        WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.endpoint = l.endpoint AND f.target = l.target)
        GROUP BY endpoint),
ok AS (SELECT endpoint, count(*) AS collected FROM firsts GROUP BY endpoint),
span AS (SELECT endpoint, count(DISTINCT target) AS total_tasks,
                (epoch(max(started_at)) - epoch(min(started_at))) / 60.0 AS elapsed_min
         FROM v_attempts GROUP BY endpoint),
j AS (SELECT s.endpoint, s.total_tasks, coalesce(o.collected, 0) AS collected,
             coalesce(b.failed, 0) AS failed, s.elapsed_min
      FROM span s LEFT JOIN ok o USING (endpoint) LEFT JOIN bad b USING (endpoint))
SELECT endpoint, total_tasks, collected, failed, total_tasks - collected - failed AS remaining,
       round(CASE WHEN elapsed_min > 0 THEN collected / elapsed_min ELSE 0.0 END, 6) AS rate_per_min,
       round(CASE WHEN elapsed_min > 0 AND collected > 0
                  THEN (total_tasks - collected - failed) / (collected / elapsed_min)
                  ELSE 0.0 END, 6) AS minutes_left
FROM j""", "v_attempts"))
def q_c11(spark, d):
    return scalar_output(A.task_progress(_with_tasks(V.attempts(spark, d)), task_id="task_id", tie=("event_id",)))


@register("c12_drop_invalid_targets", """
SELECT url AS target FROM pages WHERE page_id % 3 <> 0""")
def q_c12(spark, d):
    from searchlake.sources.tables import read_table
    pages = read_table(spark, d, "pages")
    k = F.col("page_id")
    answers = pages.select(
        F.when(k % 3 == 0, F.lit(40501)).otherwise(F.lit(20000)).alias("task_status_code"),
        F.when(k % 3 == 0, F.concat(F.lit("Invalid Field: 'target' ("), F.col("url"), F.lit(").")))
        .otherwise(F.lit("Ok.")).alias("task_status_message"))
    return A.drop_invalid_targets(pages.select(F.col("url").alias("target")), answers)
