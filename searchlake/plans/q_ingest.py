"""Checked queries for the write path (A) and request side.

Sink operators are checked by a round trip: the query writes to a fresh
table under the shared checkpoint folder, reads it back and returns what
was stored; the oracle states what the input tables say should be there.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions import typing as TY
from searchlake.operators import ingest as A
from searchlake.operators import reconcile as H
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import supp_domain
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.registry import register
from searchlake.session import scratch_path
from searchlake.sources import responses as R
from searchlake.sources import testviews as V
from searchlake.sources.tables import read_table

JOB = "3f2b8a1e-5d4c-4e7f-9a6b-1c2d3e4f5a6b"
UPLOAD = "9b1c2d3e-4f5a-4b6c-8d7e-0f1a2b3c4d5e"
TS = "2025-06-01 12:00:00"


def _stamped(spark, d):
    """Ranked keyword rows from the data view, stamped like a fetch + upload."""
    rows = V.data_rows(spark, d).select("keyword", "search_volume", "rank", "traffic_volume",
                                        F.col("ingest_timestamp").alias("_ts"))
    rows = A.stamp_fetch(rows, 42, "site42.com", "live")
    rows = A.stamp_upload(rows, JOB, UPLOAD, TS)
    # keep the source day as the ingest time so the day layout is exercised
    return rows.withColumn("ingest_timestamp", F.col("_ts").cast("timestamp")).drop("_ts")


@register("a1_read_responses", """
SELECT 'ranked_keywords' AS endpoint, count(*) AS responses FROM (SELECT DISTINCT l_orderkey FROM lineitem) x""")
def q_a1(spark, d):
    path = scratch_path(spark, "landing")
    V.ranked_responses(spark, d).write.parquet(path)
    landed = R.read_responses(spark, path)
    return landed.groupBy("endpoint").agg(F.count(F.lit(1)).alias("responses"))


@register("a2_a3_stamp", f"""
SELECT 'kw' || CAST(l_partkey AS VARCHAR) AS keyword, CAST(42 AS BIGINT) AS domain_id, 'site42.com' AS domain,
       'live' AS endpoint_mode, '{JOB}' AS job_id, '{UPLOAD}' AS upload_id, l_shipdate AS ingest_timestamp
FROM lineitem""")
def q_a23(spark, d):
    return scalar_output(_stamped(spark, d).select("keyword", "domain_id", "domain", "endpoint_mode",
                                                   "job_id", "upload_id", "ingest_timestamp"))


@register("a4_append_batch_roundtrip", f"""
SELECT CAST(l_shipdate AS DATE) AS ingest_date, 'kw' || CAST(l_partkey AS VARCHAR) AS keyword,
       CAST(l_quantity AS BIGINT) AS search_volume, CAST(42 AS BIGINT) AS domain_id, 'site42.com' AS domain,
       '{JOB}' AS job_id, '{UPLOAD}' AS upload_id, l_shipdate AS ingest_timestamp, CAST(0 AS BIGINT) AS rows_before
FROM lineitem""")
def q_a4(spark, d):
    path = scratch_path(spark, "ranked_table")
    schema = A.to_table_layout(_stamped(spark, d).limit(0), "ranked_keywords").schema
    A.create_table(spark, path, schema)
    before = spark.read.parquet(path).count()
    A.append_batch(A.to_table_layout(_stamped(spark, d), "ranked_keywords"), path)
    return scalar_output(spark.read.parquet(path).select(
        F.col("ingest_date").cast("date").alias("ingest_date"), "keyword", "search_volume", "domain_id", "domain", "job_id",
        "upload_id", "ingest_timestamp", F.lit(before).cast("bigint").alias("rows_before")))


@register("a5_upload_event", f"""
SELECT '{JOB}' AS job_id, CASE WHEN l_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS upload_id,
       'api' AS source, 'ranked' AS source_program, 'warehouse' AS dataset, 'ranked_keywords' AS table_name,
       count(*) AS row_count, min(l_shipdate) AS ingest_timestamp, '7' AS client_id,
       CAST(NULL AS VARCHAR) AS project_id, CAST(NULL AS VARCHAR) AS notes
FROM lineitem GROUP BY 2""")
def q_a5(spark, d):
    li = read_table(spark, d, "lineitem")
    rows = li.select(F.lit(JOB).alias("job_id"),
                     F.when(F.col("l_partkey") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")).alias("upload_id"),
                     F.col("l_shipdate").alias("ingest_timestamp"))
    return scalar_output(A.upload_event(rows, "api", "ranked", "warehouse", "ranked_keywords", client_id=7))


def _attempt_log(spark, d):
    """C1 and C3 output appended in two flushes; the log and its events."""
    from searchlake.operators import attempts as C
    path, ev = scratch_path(spark, "attempt_log"), scratch_path(spark, "upload_events")
    A.create_table(spark, path, A.ATTEMPT_LOG_SCHEMA)
    calls = V.attempt_calls(spark, d)
    for half, up in enumerate((UPLOAD, JOB)):
        records = C.mark_terminal(C.attempt_records(calls.where(F.col("event_id") % 2 == half)))
        A.append_attempts(A.attempt_log_rows(records, JOB, up, TS), path, ev)
    return spark.read.parquet(path), spark.read.parquet(ev)


@register("a6_append_attempts_roundtrip", W(f"""
SELECT '{JOB}' AS job_id, CASE WHEN event_id % 2 = 0 THEN '{UPLOAD}' ELSE '{JOB}' END AS upload_id, endpoint,
       CASE WHEN event_id % 9 = 0 THEN '["' || target || '","extra"]' ELSE target END AS target, attempt,
       CASE WHEN http_status = 200 THEN n_items ELSE 0 END > 0 OR attempt >= 3 AS is_terminal,
       strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f') AS started_at, duration_ms, 'worker-' || event_id % 4 AS thread_name, http_status,
       CASE WHEN http_status = 200 THEN task_status_code END AS task_status_code,
       CASE WHEN http_status = 200 THEN task_status_message END AS task_status_message,
       round(CASE WHEN http_status = 200 THEN coalesce(task_cost, 0.0) ELSE 0.0 END, 6) AS task_cost,
       CASE WHEN http_status = 200 THEN n_items ELSE 0 END AS n_items,
       '[{{"keyword":"' || target || '","location_code":2840}}]' AS payload, http_status = 200 AS has_response,
       coalesce(error, '') AS error, TIMESTAMP '{TS}' AS ingest_timestamp
FROM v_attempts""", "v_attempts"))
def q_a6(spark, d):
    log, _ = _attempt_log(spark, d)
    assert sorted(c for c in log.columns if c != "ingest_date") == sorted(A.ATTEMPT_LOG_SCHEMA.names)
    return scalar_output(log.withColumn("has_response", F.col("response").isNotNull()).drop("response", "ingest_date"))


@register("a6_attempt_upload_events", W(f"""
SELECT '{JOB}' AS job_id, CASE WHEN event_id % 2 = 0 THEN '{UPLOAD}' ELSE '{JOB}' END AS upload_id, count(*) AS row_count
FROM v_attempts GROUP BY 2""", "v_attempts"))
def q_a6e(spark, d):
    _, events = _attempt_log(spark, d)
    return events.select("job_id", "upload_id", "row_count")


@register("a7_snapshot", "SELECT * FROM customer")
def q_a7(spark, d):
    src, dst = scratch_path(spark, "clients"), scratch_path(spark, "clients_backup")
    read_table(spark, d, "customer").write.parquet(src)
    A.snapshot(spark, src, dst)
    return spark.read.parquet(dst)


@register("a8_reload", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def q_a8(spark, d):
    base = scratch_path(spark, "projects")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    A.reload(o, base)
    A.reload(o.where(F.col("o_orderstatus") == "F"), base)
    return A.read_current(spark, base)


@register("a9_a10_inventory_csv_roundtrip", W("""
SELECT domain AS raw_domain, '' AS decision, count(*) AS rows_total FROM v_data
WHERE domain IS NOT NULL AND domain <> '' GROUP BY domain""", "v_data"))
def q_a910(spark, d):
    inv = H.domain_inventory_union({"ranked_keywords": V.data_rows(spark, d)}, V.domains(spark, d))
    inv = inv.select("raw_domain", "normalized_domain", "rows_ranked_keywords",
                     F.lit(0).cast("bigint").alias("rows_backlinks_backlinks"), "rows_total",
                     "meta_match_domain_id", "meta_match_domain", "suggested")
    path = scratch_path(spark, "inventory_csv")
    A.write_inventory_csv(inv, path)
    back = A.read_mapping_csv(spark, path)
    return back.select("raw_domain", "decision", "rows_total")


@register("a11_prepare_export", W("""
SELECT CAST(client_id AS VARCHAR) AS client_id, client_name, abbreviation,
       CASE WHEN is_active THEN 'true' ELSE 'false' END AS is_active, coalesce(notes, '') AS notes,
       coalesce(CAST(created_at AS VARCHAR), '') AS created_at,
       CASE WHEN client_id % 4 = 0 THEN 'Not ranking' ELSE 'https://' || CAST(client_id AS VARCHAR) END AS site_url,
       row_number() OVER (ORDER BY client_id) + 1 AS sheet_row,
       CAST((row_number() OVER (ORDER BY client_id)) // (6000 // 7) AS BIGINT) AS batch_no
FROM v_clients""", "v_clients"))
def q_a11(spark, d):
    c = V.clients(spark, d).withColumn(
        "site_url", F.when(F.col("client_id") % 4 != 0, F.concat(F.lit("https://"), F.col("client_id").cast("string"))))
    return A.prepare_export(c, ["client_id"], max_cells=6000)


_B13_SRC = """CASE event_id % 5 WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0'
                  WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN 'abc'
                  WHEN 3 THEN CAST(user_id AS VARCHAR) ELSE NULL END"""


@register("b13_cast_types", f"""
SELECT event_id,
  CASE event_id % 5 WHEN 0 THEN CAST(floor(value) AS BIGINT)
       WHEN 1 THEN CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END
       WHEN 3 THEN user_id END AS as_bigint,
  CASE event_id % 5 WHEN 0 THEN floor(value) WHEN 1 THEN value WHEN 3 THEN CAST(user_id AS DOUBLE) END AS as_double,
  CASE WHEN event_type = 'click' THEN true WHEN event_type = 'view' THEN false END AS as_boolean,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS as_timestamp
FROM events""")
def q_b13(spark, d):
    e = read_table(spark, d, "events")
    k = F.col("event_id") % 5
    txt = (F.when(k == 0, F.concat(F.floor("value").cast("bigint").cast("string"), F.lit(".0")))
           .when(k == 1, F.col("value").cast("string")).when(k == 2, F.lit("abc"))
           .when(k == 3, F.col("user_id").cast("string")))
    boo = (F.when(F.col("event_type") == "click", F.lit("true"))
           .when(F.col("event_type") == "view", F.lit("false")).otherwise(F.lit("maybe")))
    tst = F.when(F.col("event_id") % 3 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss '+00:00'"))
    df = e.select("event_id", txt.alias("as_bigint"), txt.alias("as_double"), boo.alias("as_boolean"),
                  tst.alias("as_timestamp"))
    out = TY.cast_types(df, {"as_bigint": "bigint", "as_double": "double", "as_boolean": "boolean",
                             "as_timestamp": "timestamp"})
    return scalar_output(out)


@register("b14_join_foreign_intent", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type || ',x'
                      WHEN event_id % 3 = 1 THEN event_type ELSE NULL END AS labels
FROM events""")
def q_b14(spark, d):
    e = read_table(spark, d, "events")
    k = F.col("event_id") % 3
    txt = (F.when(k == 0, F.concat(F.lit('["'), F.col("event_type"), F.lit('", null, "x"]')))
           .when(k == 1, F.col("event_type")))
    return e.select("event_id", TY.join_labels(txt).alias("labels"))


@register("b15_stringify_json", """
SELECT event_id, replace(props, ' ', '') AS props_json FROM events""")
def q_b15(spark, d):
    e = read_table(spark, d, "events")
    schema = T.StructType([T.StructField("p", T.StringType())])
    wrapped = F.from_json(F.concat(F.lit('{"p":'), F.col("props"), F.lit("}")), schema)
    return e.select("event_id", TY.stringify_json(wrapped["p"]).alias("props_json"))


@register("b15_stringify_nested", """
SELECT p_partkey, p_size, '["' || p_brand || '",null]' AS labels,
       '{"size":' || p_size || ',"type":' || CASE WHEN p_partkey % 3 = 0 THEN 'null' ELSE '"' || p_type || '"' END || '}' AS info,
       CASE WHEN p_partkey % 2 = 0 THEN '[{"n":' || p_partkey || '}]' END AS items
FROM part""")
def q_b15n(spark, d):
    k = F.col("p_partkey")
    nested = read_table(spark, d, "part").select(
        k, "p_size", F.array(F.col("p_brand"), F.lit(None)).alias("labels"),
        F.struct(F.col("p_size").alias("size"), F.when(k % 3 != 0, F.col("p_type")).alias("type")).alias("info"),
        F.when(k % 2 == 0, F.array(F.struct(k.alias("n")))).alias("items"))
    return TY.stringify_nested(nested)


@register("b16_dedupe_by_endpoint", W("""
SELECT * EXCLUDE (rn) FROM (
  SELECT keyword, 'en' AS language_code, CAST(2840 AS BIGINT) AS location_code, search_volume, ingest_timestamp,
         row_number() OVER (PARTITION BY keyword ORDER BY ingest_timestamp DESC, search_volume DESC) AS rn FROM v_data) x
WHERE rn = 1""", "v_data"))
def q_b16e(spark, d):
    rows = V.data_rows(spark, d).select("keyword", F.lit("en").alias("language_code"), F.lit(2840).cast("bigint").alias("location_code"),
                                        "search_volume", "ingest_timestamp")
    return scalar_output(A.dedupe(rows, "keyword_overview"))


@register("b16_dedupe", W("""
SELECT job_id, upload_id, ingest_timestamp, domain_id, domain, keyword, search_volume, rank,
       round(traffic_volume, 6) AS traffic_volume FROM (
  SELECT *, row_number() OVER (PARTITION BY keyword, job_id ORDER BY ingest_timestamp DESC,
         upload_id DESC, domain_id DESC NULLS LAST, domain DESC, search_volume DESC, rank DESC,
         traffic_volume DESC) AS rn FROM v_data) x WHERE rn = 1""", "v_data"))
def q_b16(spark, d):
    return scalar_output(A.dedupe(V.data_rows(spark, d), ["keyword", "job_id"]))


def _pages(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    from pyspark.sql import Window
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    k = F.col("o_orderkey")
    n = (F.when(k % 11 == 0, F.lit(0)).when(k % 7 == 0, (F.col("o_totalprice") % 100).cast("bigint"))
         .otherwise(F.lit(100)))
    return o.select(F.col("o_custkey").alias("target"),
                    ((F.row_number().over(w) - 1) * 100).cast("bigint").alias("offset"),
                    n.cast("bigint").alias("n_rows"))


_PAGES_SQL = """pages AS (
  SELECT o_custkey AS target, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) * 100 AS "offset",
         CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 7 = 0 THEN trunc(o_totalprice % 100)
                   ELSE 100 END AS BIGINT) AS n_rows
  FROM orders)"""


@register("b17_assemble_pages_backlinks", f"""
WITH {_PAGES_SQL},
f AS (SELECT *, coalesce(sum(n_rows) OVER w, 0) AS fetched FROM pages
      WINDOW w AS (PARTITION BY target ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, least(100, 1000 - fetched) AS req FROM f),
s AS (SELECT *, coalesce(max(CASE WHEN n_rows < req THEN 1 ELSE 0 END) OVER w2, 0) AS stopped FROM r
      WINDOW w2 AS (PARTITION BY target ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT target, CAST("offset" AS BIGINT) AS "offset", n_rows FROM s
WHERE stopped = 0 AND n_rows > 0 AND "offset" < 20000 AND req > 0""")
def q_b17b(spark, d):
    return A.assemble_pages(_pages(spark, d), "backlinks", page_size=100, limit=1000)


@register("b17_assemble_pages_by_run", f"""
WITH {_PAGES_SQL},
runs AS (SELECT r AS run, target, "offset", CASE WHEN r = 'b' AND target % 2 = 0 AND "offset" = 100 THEN 3 ELSE n_rows END AS n_rows
         FROM pages CROSS JOIN (VALUES ('a'), ('b')) t(r)),
f AS (SELECT *, coalesce(sum(n_rows) OVER w, 0) AS fetched FROM runs
      WINDOW w AS (PARTITION BY run, target ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT *, least(100, 1000 - fetched) AS req FROM f),
s AS (SELECT *, coalesce(max(CASE WHEN n_rows < req THEN 1 ELSE 0 END) OVER w2, 0) AS stopped FROM q
      WINDOW w2 AS (PARTITION BY run, target ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT run, target, CAST("offset" AS BIGINT) AS "offset", CAST(n_rows AS BIGINT) AS n_rows FROM s
WHERE stopped = 0 AND n_rows > 0 AND "offset" < 20000 AND req > 0""")
def q_b17run(spark, d):
    """Two runs fetched every target; the second stops early for every other one."""
    p = _pages(spark, d)
    short = (F.col("target") % 2 == 0) & (F.col("offset") == 100)
    b = p.withColumn("n_rows", F.when(short, F.lit(3)).otherwise(F.col("n_rows")).cast("bigint"))
    both = p.withColumn("run", F.lit("a")).unionByName(b.withColumn("run", F.lit("b")))
    return A.assemble_pages(both, "backlinks", page_size=100, limit=1000, run=("run",)).select("run", "target", "offset", "n_rows")


@register("b17_assemble_pages_ranked", f"""
WITH {_PAGES_SQL},
t AS (SELECT *, CASE WHEN lag(n_rows) OVER (PARTITION BY target ORDER BY "offset") = 0 AND n_rows = 0
                     THEN 1 ELSE 0 END AS two FROM pages),
s AS (SELECT *, coalesce(max(two) OVER (PARTITION BY target ORDER BY "offset"
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM t)
SELECT target, CAST("offset" AS BIGINT) AS "offset", n_rows FROM s WHERE stopped = 0 AND n_rows > 0 AND "offset" < 1500""")
def q_b17r(spark, d):
    return A.assemble_pages(_pages(spark, d), "ranked", page_size=100, limit=1500)


@register("b19_build_requests", f"""
SELECT {supp_domain('s_suppkey')} AS target,
  '[{{"target":"' || {supp_domain('s_suppkey')} || '","language_name":"English","location_code":2840,'
  || '"limit":1000,"offset":0,"load_rank_absolute":true,"order_by":["ranked_serp_element.serp_item.etv,desc"],'
  || '"filters":null}}]'
  AS payload
FROM supplier""")
def q_b19(spark, d):
    from searchlake.sources.testviews import supplier_domain
    t = read_table(spark, d, "supplier").select(supplier_domain(F.col("s_suppkey")).alias("target"))
    return A.build_requests(t, "ranked_keywords")


@register("b19_build_requests_batched", """
SELECT CAST((p_partkey - 0) // 7 AS BIGINT) AS batch_no,
  '[{"keywords":[' || string_agg('"' || p_name || '"', ',' ORDER BY p_partkey) || '],"language_code":"en"}]' AS payload,
  CAST(count(*) AS INTEGER) AS n_targets
FROM part GROUP BY 1""")
def q_b19b(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", F.col("p_name").alias("target"))
    return A.build_requests(A.batch_targets(p, 7, ["p_partkey"]), "search_intent")


@register("b20_batch_targets", """
SELECT CAST(p_partkey // 7 AS BIGINT) AS batch_no, string_agg(p_name, '|' ORDER BY p_partkey) AS targets,
       CAST(count(*) AS INTEGER) AS n_targets
FROM part GROUP BY 1""")
def q_b20(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", F.col("p_name").alias("target"))
    b = A.batch_targets(p, 7, ["p_partkey"])
    return b.select("batch_no", F.array_join("targets", "|").alias("targets"), "n_targets")


@register("a4_ingest_responses_job", W("""
SELECT count(*) AS row_count, CAST(sum(search_volume) AS BIGINT) AS search_volume,
       CAST(1 AS BIGINT) AS uploads, CAST(1 AS BIGINT) AS events, CAST(count(*) AS BIGINT) AS event_rows
FROM v_ranked""", "v_ranked"))
def q_a4_job(spark, d):
    table, events = scratch_path(spark, "ranked_job"), scratch_path(spark, "ranked_job_events")
    stamped = A.to_table_layout(_stamped(spark, d).limit(0), "ranked_keywords")
    A.create_table(spark, table, stamped.schema)
    up = A.ingest_responses(V.ranked_responses(spark, d), "ranked_keywords", table, events, JOB,
                            upload_id=UPLOAD)
    rows = spark.read.parquet(table)
    ev = spark.read.parquet(events).where(F.col("upload_id") == up)
    stats = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("search_volume").alias("search_volume"),
                     F.countDistinct("upload_id").alias("uploads"))
    evs = ev.agg(F.count(F.lit(1)).alias("events"), F.sum("row_count").alias("event_rows")).first()
    return stats.withColumns({"events": F.lit(evs["events"]).cast("bigint"),
                              "event_rows": F.lit(evs["event_rows"]).cast("bigint")})


@register("h5_h15_append_reconciles", """
SELECT 'ranked_keywords' AS table_name, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b,
       'clean' AS status, (SELECT count(*) FROM lineitem) AS old_rows, (SELECT count(*) FROM lineitem) AS new_rows,
       true AS equal""")
def q_h5_h15(spark, d):
    """The write path checked with the reconciliation operators: the rows
    appended (A4) and the rows read back agree in count (H5) and as a
    multiset on the business columns (H15)."""
    path = scratch_path(spark, "reconciled")
    rows = A.to_table_layout(_stamped(spark, d), "ranked_keywords")
    A.create_table(spark, path, rows.schema)
    A.append_batch(rows.withColumn("ingest_timestamp", F.lit(TS).cast("timestamp")), path)
    back = spark.read.parquet(path)
    cols = ["keyword", "search_volume", "rank", "traffic_volume", "job_id", "upload_id", "domain_id"]
    dr = H.drift_summary(rows, back, cols, "ranked_keywords")
    vc = H.verify_counts([("ranked_keywords", rows, back)])
    return dr.join(vc, "table_name")
