"""Checked queries for alignment, backfill and reconciliation (H rows)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.operators import reconcile as H
from searchlake.operators import sketches as K
from searchlake.operators import stored as S
from searchlake.operators.ingest import append_batch, create_table
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import raw_domain, supp_domain
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.q_logs import stored_sketches
from searchlake.plans.registry import register
from searchlake.session import scratch_path, written
from searchlake.sources import testviews as V
from searchlake.sources.tables import read_table

NOW = "2025-06-01 00:00:00"

ALIGN_TARGET = T.StructType([
    T.StructField("keyword", T.StringType()),
    T.StructField("search_volume", T.LongType()),
    T.StructField("rank", T.LongType()),
    T.StructField("traffic_volume", T.DoubleType()),
    T.StructField("categories", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("cpc", T.DoubleType()),
    T.StructField("competition_index", T.LongType()),
    T.StructField("is_lost", T.BooleanType()),
])


def _old(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select(
        F.concat(F.lit("kw"), F.col("l_partkey").cast("string")).alias("keyword"),
        F.col("l_quantity").cast("bigint").cast("string").alias("search_volume"),
        F.col("l_linenumber").alias("rank"),
        F.col("l_extendedprice").alias("traffic_volume"),
        F.array(F.col("l_partkey"), F.col("l_suppkey")).alias("categories"),
        F.struct(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).alias("item"),
        F.col("l_linenumber").alias("competition_index"),
        F.col("l_orderkey").alias("project_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("yes")).otherwise(F.lit("false")).alias("is_lost"))


@register("h1_align_schema", """
SELECT 'kw' || CAST(l_partkey AS VARCHAR) AS keyword, CAST(l_quantity AS BIGINT) AS search_volume,
       CAST(l_linenumber AS BIGINT) AS rank, round(l_extendedprice, 6) AS traffic_volume,
       CAST(to_json([l_partkey, l_suppkey]) AS VARCHAR) AS categories,
       '{"f":"' || l_returnflag || '","s":"' || l_linestatus || '"}' AS item,
       CAST(NULL AS DOUBLE) AS cpc, CAST(l_linenumber AS BIGINT) AS competition_index,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE false END AS is_lost
FROM lineitem""")
def q_h1(spark, d):
    return scalar_output(H.align_schema(_old(spark, d), ALIGN_TARGET))


def _meta_old(spark, d):
    li = read_table(spark, d, "lineitem")
    ok = F.col("l_orderkey")
    return li.select(
        F.when(ok % 13 != 0, F.concat(F.lit("job-"), (F.col("l_suppkey") % 40).cast("string"))).alias("job_id"),
        F.when(ok % 17 != 0, F.concat(F.lit("up-"), ok.cast("string"))).alias("upload_id"),
        F.when(ok % 29 != 0, F.col("l_shipdate").cast("timestamp")).alias("ingest_timestamp"),
        V.raw_domain(F.col("l_suppkey"), ok).alias("domain"),
        F.col("l_linenumber").cast("bigint").alias("rank"))


_META_SQL = f"""
SELECT coalesce(CASE WHEN l_orderkey % 13 <> 0 THEN 'job-' || CAST(l_suppkey % 40 AS VARCHAR) END,
                'pending-backfill') AS job_id,
       coalesce(CASE WHEN l_orderkey % 17 <> 0 THEN 'up-' || CAST(l_orderkey AS VARCHAR) END,
                'pending-backfill') AS upload_id,
       coalesce(CASE WHEN l_orderkey % 29 <> 0 THEN l_shipdate END, TIMESTAMP '{NOW}') AS ingest_timestamp,
       {{domain}} AS domain, CAST(l_linenumber AS BIGINT) AS rank,
       CAST(NULL AS BIGINT) AS domain_id, CAST(NULL AS VARCHAR) AS task_id, 'live' AS endpoint_mode
FROM lineitem"""


@register("h2_fill_metadata_keep_domain", _META_SQL.replace("{domain}", raw_domain("l_suppkey", "l_orderkey")))
def q_h2k(spark, d):
    return scalar_output(H.fill_metadata(_meta_old(spark, d), keep_domain=True, now=NOW))


@register("h2_fill_metadata_null_domain", _META_SQL.replace("{domain}", "CAST(NULL AS VARCHAR)"))
def q_h2n(spark, d):
    return scalar_output(H.fill_metadata(_meta_old(spark, d), keep_domain=False, now=NOW))


RENAME_TARGET = T.StructType([
    T.StructField("keyword", T.StringType()), T.StructField("search_volume", T.LongType()),
    T.StructField("location_code", T.LongType()), T.StructField("cpc", T.DoubleType())])


@register("h3_rename_backfill", """
SELECT 'kw' || CAST(p_partkey AS VARCHAR) AS keyword, CAST(p_size AS BIGINT) AS search_volume,
       CAST(2000 + p_partkey % 25 AS BIGINT) AS location_code, CAST(NULL AS DOUBLE) AS cpc
FROM part""")
def q_h3(spark, d):
    p = read_table(spark, d, "part")
    old = p.select(F.concat(F.lit("kw"), F.col("p_partkey").cast("string")).alias("keyword"),
                   F.col("p_size").alias("local_search_volume"),
                   (F.lit(2000) + F.col("p_partkey") % 25).alias("local_location_code"),
                   F.col("p_brand").alias("brand"))
    return H.rename_backfill(old, RENAME_TARGET)


_INTENT_SRC = ("CASE p_partkey % 5 WHEN 0 THEN 'commercial,navigational' WHEN 1 THEN ' informational , ' "
               "WHEN 2 THEN '' WHEN 3 THEN ',' ELSE NULL END")


@register("h4_intents_to_json", f"""
SELECT p_partkey, CASE WHEN trim(coalesce(s, '')) = '' THEN NULL ELSE
  CAST(to_json(list_transform(list_filter(string_split(s, ','), lambda x: trim(x) <> ''),
                              lambda x: {{'label': trim(x)}})) AS VARCHAR) END AS intents
FROM (SELECT p_partkey, {_INTENT_SRC} AS s FROM part) x""")
def q_h4(spark, d):
    p = read_table(spark, d, "part")
    k = F.col("p_partkey") % 5
    s = (F.when(k == 0, F.lit("commercial,navigational")).when(k == 1, F.lit(" informational , "))
         .when(k == 2, F.lit("")).when(k == 3, F.lit(",")).otherwise(F.lit(None)))
    return p.select("p_partkey", H.intents_to_json(s).alias("intents"))


@register("h5_verify_counts", W("""
SELECT 'data' AS table_name, (SELECT count(*) FROM lineitem) AS old_rows, (SELECT count(*) FROM v_data) AS new_rows,
       (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM v_data) AS equal
UNION ALL
SELECT 'clients', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer WHERE c_acctbal > 0),
       (SELECT count(*) FROM customer) = (SELECT count(*) FROM customer WHERE c_acctbal > 0)""", "v_data"))
def q_h5(spark, d):
    cust = read_table(spark, d, "customer")
    return H.verify_counts([("data", read_table(spark, d, "lineitem"), V.data_rows(spark, d)),
                            ("clients", cust, cust.where(F.col("c_acctbal") > 0))])


def _sha_id(*parts: str) -> str:
    h = "sha256(concat_ws('|', " + ", ".join(parts) + "))"
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'"
            f"||substr({h},17,4)||'-'||substr({h},21,12))")


_HB = "strftime(date_trunc('hour', ingest_timestamp), '%Y-%m-%d %H:%M:%S')"


@register("h6_backfill_ids_by_hour", W(f"""
SELECT CASE WHEN job_id = 'pending-backfill' THEN {_sha_id("'data'", "'job'", _HB)} ELSE job_id END AS job_id,
       CASE WHEN upload_id = 'pending-backfill' THEN {_sha_id("'data'", "'upload'", _HB)} ELSE upload_id END AS upload_id,
       ingest_timestamp, keyword, rank
FROM v_data""", "v_data"))
def q_h6(spark, d):
    return H.backfill_ids_by_hour(V.data_rows(spark, d), "data").select(
        "job_id", "upload_id", "ingest_timestamp", "keyword", "rank")


@register("h7_backfill_upload_by_job_hour", W(f"""
SELECT job_id,
       CASE WHEN upload_id = 'pending-backfill' THEN {_sha_id("'data'", "job_id", _HB)} ELSE upload_id END AS upload_id,
       ingest_timestamp, keyword, rank
FROM v_data""", "v_data"))
def q_h7(spark, d):
    return H.backfill_upload_by_job_hour(V.data_rows(spark, d), "data").select(
        "job_id", "upload_id", "ingest_timestamp", "keyword", "rank")


_H8_TAIL = f"""'backfill' AS source, 'migration' AS source_program, 'warehouse' AS dataset, 'data' AS table_name,
       count(*) AS row_count, TIMESTAMP '{NOW}' AS ingest_timestamp, CAST(NULL AS VARCHAR) AS client_id,
       CAST(NULL AS VARCHAR) AS project_id,
       'backfill of rows ingested in hour ' || strftime(hb, '%Y-%m-%d %H:00') AS notes"""


@register("h8_backfill_events", W(f"""
SELECT job_id, upload_id, {_H8_TAIL}
FROM (SELECT job_id, {_sha_id("'data'", "job_id", _HB)} AS upload_id, date_trunc('hour', ingest_timestamp) AS hb
      FROM v_data WHERE upload_id = 'pending-backfill') x
GROUP BY job_id, upload_id, hb""", "v_data"))
def q_h8(spark, d):
    return scalar_output(H.backfill_events(V.data_rows(spark, d), "data", mode="upload", now=NOW))


@register("h8_backfill_events_both", W(f"""
SELECT job_id, upload_id, {_H8_TAIL}
FROM (SELECT {_sha_id("'data'", "'job'", _HB)} AS job_id, {_sha_id("'data'", "'upload'", _HB)} AS upload_id,
             date_trunc('hour', ingest_timestamp) AS hb
      FROM v_data WHERE upload_id = 'pending-backfill' OR job_id = 'pending-backfill') x
GROUP BY job_id, upload_id, hb""", "v_data"))
def q_h8_both(spark, d):
    return scalar_output(H.backfill_events(V.data_rows(spark, d), "data", mode="both", now=NOW))


# stored by month, ids missing and raw names in every third month only: files of the other months must stay
_STORED_SQL = """
st AS (SELECT * REPLACE (
         date_trunc('month', ingest_timestamp) + to_hours(rank) AS ingest_timestamp,
         CASE WHEN month(ingest_timestamp) % 3 <> 0 AND job_id = 'pending-backfill' THEN 'job-late' ELSE job_id END AS job_id,
         CASE WHEN month(ingest_timestamp) % 3 <> 0 AND upload_id = 'pending-backfill' THEN 'up-late' ELSE upload_id END AS upload_id,
         CASE WHEN month(ingest_timestamp) % 3 <> 0 THEN 'unmapped.example' ELSE domain END AS domain) FROM v_data)"""


def _stored(spark, d):
    """Path of the stored table and its files before a change."""
    ts = F.col("ingest_timestamp").cast("timestamp")
    other = F.month(ts) % 3 != 0
    rows = V.data_rows(spark, d).withColumns({
        "job_id": F.when(other & (F.col("job_id") == "pending-backfill"), F.lit("job-late")).otherwise(F.col("job_id")),
        "upload_id": F.when(other & (F.col("upload_id") == "pending-backfill"), F.lit("up-late")).otherwise(F.col("upload_id")),
        "domain": F.when(other, F.lit("unmapped.example")).otherwise(F.col("domain")),
        "ingest_timestamp": F.date_trunc("month", ts) + F.make_dt_interval(hours=F.col("rank").cast("int"))})
    path, files = scratch_path(spark, "data"), scratch_path(spark, "files")
    create_table(spark, path, T.StructType(rows.withColumn("ingest_date", F.to_date("ingest_timestamp")).schema.fields))
    append_batch(rows, path)
    _files(spark, path).distinct().write.parquet(files)
    return path, spark.read.parquet(files).withColumn("kept_file", F.lit(True))


def _files(spark, path):
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("at"))


def _rows_and_files(spark, path, files):
    now = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"),
                                          F.col("_metadata.file_modification_time").alias("at"))
    return scalar_output(now.join(files, ["file", "at"], "left").fillna(False, ["kept_file"]).drop("file", "at"))


def _backfill_stored_sql(job, upload):
    return W(f"""
WITH {_STORED_SQL}
SELECT {job} AS job_id, {upload} AS upload_id, ingest_timestamp, domain, keyword, rank,
       month(ingest_timestamp) % 3 <> 0 AS kept_file
FROM st""", "v_data")


_STORED_COLS = ["job_id", "upload_id", "ingest_timestamp", "domain", "keyword", "rank", "kept_file"]


@register("h6_backfill_stored", _backfill_stored_sql(
    f"CASE WHEN job_id = 'pending-backfill' THEN {_sha_id("'data'", "'job'", _HB)} ELSE job_id END",
    f"CASE WHEN upload_id = 'pending-backfill' THEN {_sha_id("'data'", "'upload'", _HB)} ELSE upload_id END"))
def q_h6_stored(spark, d):
    path, files = _stored(spark, d)
    S.backfill_stored(spark, path, "data", "both")
    return _rows_and_files(spark, path, files).select(*_STORED_COLS)


@register("h7_backfill_stored", _backfill_stored_sql(
    "job_id", f"CASE WHEN upload_id = 'pending-backfill' THEN {_sha_id("'data'", "job_id", _HB)} ELSE upload_id END"))
def q_h7_stored(spark, d):
    path, files = _stored(spark, d)
    S.backfill_stored(spark, path, "data", "upload")
    return _rows_and_files(spark, path, files).select(*_STORED_COLS)


@register("h8_backfill_stored_events", W(f"""
WITH {_STORED_SQL}
SELECT {_sha_id("'data'", "'job'", _HB)} AS job_id, {_sha_id("'data'", "'upload'", _HB)} AS upload_id, count(*) AS row_count
FROM st WHERE upload_id = 'pending-backfill' OR job_id = 'pending-backfill' GROUP BY 1, 2""", "v_data"))
def q_h8_stored(spark, d):
    """The second run finds nothing to do: each event is there once."""
    path, _ = _stored(spark, d)
    events = scratch_path(spark, "events")
    for _ in range(2):
        S.backfill_stored(spark, path, "data", "both", events)
    return spark.read.parquet(events).select("job_id", "upload_id", "row_count")


_NORM = ("lower(regexp_replace(regexp_replace(regexp_replace({c}, '^(https?://)?(www\\.)?', ''), "
         "'/+$', ''), '\\s+', '', 'g'))")


_INV_SQL = f"""
inv AS (SELECT s.raw_domain, s.norm_domain, s.row_count, m.meta_domain,
               m.meta_domain IS NOT NULL AS matched, m.meta_domain = s.raw_domain AS exact_match
        FROM (SELECT domain AS raw_domain, {_NORM.format(c='domain')} AS norm_domain, count(*) AS row_count
              FROM v_data WHERE domain IS NOT NULL GROUP BY 1, 2) s
        LEFT JOIN (SELECT DISTINCT domain AS meta_domain, {_NORM.format(c='domain')} AS norm_domain
                   FROM v_domains) m ON m.norm_domain = s.norm_domain)"""


@register("h9_domain_inventory", W(f"WITH {_INV_SQL} SELECT * FROM inv", "v_data", "v_domains"))
def q_h9(spark, d):
    return H.domain_inventory(V.data_rows(spark, d), V.domains(spark, d))


@register("h9_inventory_summary", W(f"""
WITH {_INV_SQL}
SELECT count(*) AS total_distinct, CAST(sum(row_count) AS BIGINT) AS total_rows,
       count(*) FILTER (WHERE coalesce(exact_match, false)) AS exact,
       CAST(coalesce(sum(row_count) FILTER (WHERE coalesce(exact_match, false)), 0) AS BIGINT) AS exact_rows,
       count(*) FILTER (WHERE matched AND NOT coalesce(exact_match, false)) AS normalized,
       CAST(coalesce(sum(row_count) FILTER (WHERE matched AND NOT coalesce(exact_match, false)), 0) AS BIGINT) AS normalized_rows,
       count(*) FILTER (WHERE NOT matched) AS unknown,
       CAST(coalesce(sum(row_count) FILTER (WHERE NOT matched), 0) AS BIGINT) AS unknown_rows
FROM inv""", "v_data", "v_domains"))
def q_h9s(spark, d):
    return H.inventory_summary(H.domain_inventory(V.data_rows(spark, d), V.domains(spark, d)))


@register("h9_distinct_from_sketches", W("""
SELECT job_id, count(*) AS row_count, true AS raw_within_error, true AS norm_within_error
FROM v_data WHERE domain IS NOT NULL GROUP BY 1""", "v_data"))
def q_h9_sketches(spark, d):
    """Merged estimates of each job lie within five standard errors of the exact counts."""
    rows = V.data_rows(spark, d)
    got = K.approx_distinct_domains(stored_sketches(spark, rows, K.domain_sketches, "domain-sketches"), ("job_id",))
    # the distinct domains of a job come first: each is normalized once, and rows are not copied for two distinct counts
    per_job = rows.where(F.col("domain").isNotNull()).select("job_id", "domain").distinct()
    norms = per_job.withColumn("norm", H.normalize_domain_sql(F.col("domain"))).groupBy("job_id", "norm").agg(
        F.count(F.lit(1)).alias("raws"))
    exact = norms.groupBy("job_id").agg(F.sum("raws").alias("raw"), F.count("norm").alias("norm"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 5 * K.HLL_ERROR
    return got.join(exact, "job_id").select("job_id", "row_count", near("raw_domains", "raw").alias("raw_within_error"),
                                            near("norm_domains", "norm").alias("norm_within_error"))


def _backlinks_domains(spark, d):
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(V.raw_domain(k % 120, k).alias("domain"))


@register("h9_top_unknown", W(f"""
WITH bl AS (SELECT {raw_domain('(p_partkey % 120)', 'p_partkey')} AS domain FROM part),
inv AS (SELECT s.raw_domain, s.norm_domain, s.row_count, m.meta_domain,
               m.meta_domain IS NOT NULL AS matched, m.meta_domain = s.raw_domain AS exact_match
        FROM (SELECT domain AS raw_domain, {_NORM.format(c='domain')} AS norm_domain, count(*) AS row_count
              FROM bl WHERE domain IS NOT NULL GROUP BY 1, 2) s
        LEFT JOIN (SELECT DISTINCT domain AS meta_domain, {_NORM.format(c='domain')} AS norm_domain
                   FROM v_domains) m ON m.norm_domain = s.norm_domain)
SELECT * FROM inv WHERE NOT matched ORDER BY row_count DESC, raw_domain LIMIT 20""", "v_domains"))
def q_h9t(spark, d):
    return H.top_unknown(H.domain_inventory(_backlinks_domains(spark, d), V.domains(spark, d)), 20)


_UNION_SQL = f"""
bl AS (SELECT {raw_domain('(p_partkey % 120)', 'p_partkey')} AS domain FROM part),
src AS (SELECT domain AS raw_domain, 'ranked' AS src_table FROM v_data WHERE domain IS NOT NULL AND domain <> ''
        UNION ALL SELECT domain, 'backlinks' FROM bl WHERE domain IS NOT NULL AND domain <> ''),
g AS (SELECT raw_domain, count(*) FILTER (WHERE src_table = 'ranked') AS rows_ranked,
             count(*) FILTER (WHERE src_table = 'backlinks') AS rows_backlinks, count(*) AS rows_total,
             {_NORM.format(c='raw_domain')} AS normalized_domain
      FROM src GROUP BY raw_domain),
inv AS (SELECT g.*, m.domain_id AS meta_match_domain_id, m.domain AS meta_match_domain,
               CASE WHEN m.domain_id IS NOT NULL THEN 'MATCH' ELSE 'CREATE' END AS suggested
        FROM g LEFT JOIN v_domains m ON {_NORM.format(c='m.domain')} = g.normalized_domain)"""


def _union_inv(spark, d):
    return H.domain_inventory_union({"ranked": V.data_rows(spark, d),
                                     "backlinks": _backlinks_domains(spark, d)}, V.domains(spark, d))


@register("h10_domain_inventory_union", W(f"WITH {_UNION_SQL} SELECT * FROM inv", "v_data", "v_domains"))
def q_h10(spark, d):
    return _union_inv(spark, d)


@register("h10_inventory_overlap", W(f"""
WITH {_UNION_SQL}
SELECT count(*) FILTER (WHERE rows_ranked > 0 AND NOT rows_backlinks > 0) AS only_ranked,
       count(*) FILTER (WHERE rows_backlinks > 0 AND NOT rows_ranked > 0) AS only_backlinks,
       count(*) FILTER (WHERE rows_ranked > 0 AND rows_backlinks > 0) AS both
FROM inv""", "v_data", "v_domains"))
def q_h10o(spark, d):
    return H.inventory_overlap(_union_inv(spark, d), "ranked", "backlinks")


def _decisions(spark, d):
    s = read_table(spark, d, "supplier")
    k = F.col("s_suppkey")
    dec = (F.when(k % 6 == 0, F.concat(F.lit("MATCH "), k.cast("string"), F.lit("\t\n")))
           .when(k % 6 == 1, F.lit("\nCREATE "))
           .when(k % 6 == 2, F.concat(F.lit("CREATE https://new"), (k % 9).cast("string"), F.lit(".com/")))
           .when(k % 6 == 3, F.lit("SKIP")).when(k % 6 == 4, F.lit(" \t"))
           .when(k % 4 == 1, F.lit("MATCH 99999999999999999999")).otherwise(F.lit("maybe later")))
    one = s.select(k.alias("pos"), V.raw_domain(k, k).alias("raw_domain"), dec.alias("decision"),
                   V.supplier_domain(k).alias("meta_match_domain"))
    # every fifth raw domain is decided a second time, for another id
    again = s.where(k % 5 == 0).select((k + 1_000_000).alias("pos"), V.raw_domain(k, k).alias("raw_domain"),
                                       F.concat(F.lit("MATCH "), (k + 1).cast("string")).alias("decision"),
                                       V.supplier_domain(k + 1).alias("meta_match_domain"))
    return one.unionByName(again)


_T = "trim(decision, chr(32) || chr(9) || chr(10))"
_DEC_SQL = f"""
dec AS (SELECT s_suppkey AS pos, {raw_domain('s_suppkey', 's_suppkey')} AS raw_domain,
          CASE s_suppkey % 6 WHEN 0 THEN 'MATCH ' || CAST(s_suppkey AS VARCHAR) || chr(9) || chr(10)
               WHEN 1 THEN chr(10) || 'CREATE '
               WHEN 2 THEN 'CREATE https://new' || CAST(s_suppkey % 9 AS VARCHAR) || '.com/' WHEN 3 THEN 'SKIP'
               WHEN 4 THEN ' ' || chr(9)
               ELSE CASE WHEN s_suppkey % 4 = 1 THEN 'MATCH 99999999999999999999' ELSE 'maybe later' END END AS decision,
          {supp_domain('s_suppkey')} AS meta_match_domain
        FROM supplier
        UNION ALL
        SELECT s_suppkey + 1000000, {raw_domain('s_suppkey', 's_suppkey')}, 'MATCH ' || CAST(s_suppkey + 1 AS VARCHAR),
               {supp_domain('(s_suppkey + 1)')}
        FROM supplier WHERE s_suppkey % 5 = 0),
read AS (SELECT *, {_T} AS t, TRY_CAST(regexp_extract({_T}, '^MATCH\\s+(\\d+)$', 1) AS BIGINT) AS m FROM dec),
parsed AS (SELECT pos, trim(raw_domain) AS raw_domain,
  CASE WHEN t = '' THEN NULL WHEN t = 'SKIP' THEN 'SKIP' WHEN m IS NOT NULL THEN 'MATCH'
       WHEN t = 'CREATE' THEN 'CREATE' WHEN regexp_matches(t, '^CREATE\\s+(.+)$') THEN 'CREATE' END AS action,
  m AS domain_id, CASE WHEN m IS NOT NULL THEN meta_match_domain END AS canonical,
  CASE WHEN t = 'CREATE' THEN trim(raw_domain)
       WHEN regexp_matches(t, '^CREATE\\s+(.+)$') THEN trim(regexp_extract(t, '^CREATE\\s+(.+)$', 1)) END AS provision_target,
  CASE WHEN t = '' THEN 'no decision for ' || trim(raw_domain)
       WHEN NOT (t = 'SKIP' OR t = 'CREATE' OR m IS NOT NULL OR regexp_matches(t, '^CREATE\\s+(.+)$'))
       THEN 'cannot read the decision for ' || trim(raw_domain) || ': ' || t END AS error
FROM read)"""


@register("h11_provision_list", f"""
WITH {_DEC_SQL} SELECT provision_target, min(pos) AS pos FROM parsed WHERE action = 'CREATE' GROUP BY 1""")
def q_h11p(spark, d):
    return H.provision_list(H.parse_decisions(_decisions(spark, d)))


@register("h11_parse_decisions", f"WITH {_DEC_SQL} SELECT * FROM parsed")
def q_h11(spark, d):
    return H.parse_decisions(_decisions(spark, d))


@register("h12_auto_decide", W(f"""
WITH {_UNION_SQL},
dec AS (SELECT *, CASE WHEN rows_total % 5 = 0 THEN 'SKIP' ELSE '' END AS decision FROM inv)
SELECT raw_domain, CASE WHEN trim(coalesce(decision, '')) = '' AND suggested = 'MATCH'
                             AND meta_match_domain_id IS NOT NULL
                        THEN 'MATCH ' || CAST(meta_match_domain_id AS VARCHAR) ELSE decision END AS decision
FROM dec""", "v_data", "v_domains"))
def q_h12(spark, d):
    inv = _union_inv(spark, d).withColumn(
        "decision", F.when(F.col("rows_total") % 5 == 0, F.lit("SKIP")).otherwise(F.lit("")))
    return H.auto_decide(inv).select("raw_domain", "decision")


@register("h12_decision_progress", W(f"""
WITH {_UNION_SQL},
dec AS (SELECT *, CASE WHEN rows_total % 5 = 0 THEN 'SKIP' ELSE '' END AS decision FROM inv)
SELECT count(*) AS total, count(*) FILTER (trim(decision) <> '') AS already_done,
       count(*) FILTER (suggested = 'MATCH') AS auto_matches,
       count(*) - count(*) FILTER (suggested = 'MATCH') - count(*) FILTER (trim(decision) <> '') AS remaining_manual
FROM dec""", "v_data", "v_domains"))
def q_h12p(spark, d):
    return H.decision_progress(_union_inv(spark, d).withColumn(
        "decision", F.when(F.col("rows_total") % 5 == 0, F.lit("SKIP")).otherwise(F.lit(""))))


_G2 = ("regexp_replace(regexp_replace(regexp_extract(h, '^([^/]*)', 1), ':[^:]*$', '') || "
       "regexp_extract(h, '^[^/]*(/.*)?$', 1), '/+$', '')")
_G2H = ("regexp_replace(regexp_replace(regexp_replace(lower(trim(provision_target)), '^.*?://', ''), "
        "'^www\\.', ''), '[?#].*$', '')")


_MAP_SQL = f"""
WITH {_DEC_SQL},
cr AS (SELECT pos, raw_domain, {_G2} AS domain FROM (SELECT pos, raw_domain, {_G2H} AS h FROM parsed
       WHERE action = 'CREATE') x),
every AS (SELECT pos, raw_domain, domain_id, canonical FROM parsed WHERE action = 'MATCH'
      UNION ALL SELECT cr.pos, cr.raw_domain, d.domain_id, cr.domain FROM cr JOIN v_domains d ON d.domain = cr.domain),
m AS (SELECT raw_domain, domain_id, canonical FROM every
      QUALIFY row_number() OVER (PARTITION BY raw_domain ORDER BY pos DESC) = 1)"""


@register("h13_decision_map", W(_MAP_SQL + " SELECT * FROM m", "v_domains"))
def q_h13(spark, d):
    mapping, _ = H.decision_map(H.parse_decisions(_decisions(spark, d)), V.domains(spark, d))
    return mapping


@register("h13_decision_errors", W(_MAP_SQL + """
SELECT raw_domain, domain FROM cr WHERE domain NOT IN (SELECT domain FROM v_domains)""", "v_domains"))
def q_h13e(spark, d):
    _, errors = H.decision_map(H.parse_decisions(_decisions(spark, d)), V.domains(spark, d))
    return errors


_H14_SQL = _MAP_SQL + """, t AS (
SELECT t.upload_id, t.keyword, t.rank, coalesce(m.domain_id, t.domain_id) AS domain_id,
       CASE WHEN m.raw_domain IS NOT NULL THEN m.canonical ELSE t.domain END AS domain
FROM v_data t LEFT JOIN m ON m.raw_domain = t.domain)"""


def _mapped(spark, d):
    mapping, _ = H.decision_map(H.parse_decisions(_decisions(spark, d)), V.domains(spark, d))
    return H.apply_mapping(V.data_rows(spark, d), mapping)


@register("h14_apply_mapping", W(_H14_SQL + " SELECT * FROM t", "v_domains", "v_data"))
def q_h14(spark, d):
    return _mapped(spark, d).select("upload_id", "keyword", "rank", "domain_id", "domain")


@register("h14_mapping_coverage", W(_H14_SQL + " SELECT count(domain_id) AS populated, count(*) AS total FROM t",
                                    "v_domains", "v_data"))
def q_h14c(spark, d):
    return H.mapping_coverage(_mapped(spark, d))


@register("h14_repeated_mapping", W(_MAP_SQL + """,
twice AS (SELECT raw_domain, max(domain_id) AS domain_id FROM (
  SELECT raw_domain, domain_id FROM m UNION ALL SELECT raw_domain, domain_id + 5 FROM m) x GROUP BY 1)
SELECT t.upload_id, t.keyword, t.rank, coalesce(w.domain_id, t.domain_id) AS domain_id
FROM v_data t LEFT JOIN twice w ON w.raw_domain = t.domain""", "v_domains", "v_data"))
def q_h14r(spark, d):
    mapping, _ = H.decision_map(H.parse_decisions(_decisions(spark, d)), V.domains(spark, d))
    twice = mapping.unionByName(mapping.withColumn("domain_id", F.col("domain_id") + 5))
    return H.apply_mapping(V.data_rows(spark, d), twice).select("upload_id", "keyword", "rank", "domain_id")


@register("h14_map_stored", W(_MAP_SQL + f""", {_STORED_SQL}, hit AS (
SELECT st.*, m.raw_domain, coalesce(m.domain_id, st.domain_id) AS new_id,
       CASE WHEN m.raw_domain IS NOT NULL THEN m.canonical ELSE st.domain END AS new_domain
FROM st LEFT JOIN m ON m.raw_domain = st.domain)
SELECT upload_id, keyword, rank, new_id AS domain_id, new_domain AS domain,
       NOT bool_or(raw_domain IS NOT NULL AND (domain_id IS DISTINCT FROM new_id OR domain IS DISTINCT FROM new_domain))
           OVER (PARTITION BY date_trunc('month', ingest_timestamp)) AS kept_file
FROM hit""", "v_data", "v_domains"))
def q_h14_stored(spark, d):
    mapping, _ = H.decision_map(H.parse_decisions(_decisions(spark, d)), V.domains(spark, d))
    path, files = _stored(spark, d)
    S.map_stored(spark, path, mapping)
    return _rows_and_files(spark, path, files).select("upload_id", "keyword", "rank", "domain_id", "domain", "kept_file")


DRIFT_COLS = ["client_id", "client_name", "abbreviation", "is_active", "notes"]


@register("h15_drift", W("""
WITH a AS (SELECT CAST(client_id AS VARCHAR) AS client_id, client_name, abbreviation,
                  CAST(is_active AS VARCHAR) AS is_active, notes FROM v_clients),
b0 AS (SELECT * FROM v_clients WHERE client_id % 50 <> 0
       UNION ALL SELECT * FROM v_clients WHERE client_id % 70 = 0),
b AS (SELECT CAST(client_id AS VARCHAR) AS client_id, client_name, abbreviation,
             CAST(is_active AS VARCHAR) AS is_active,
             CASE WHEN client_id % 30 = 0 THEN 'changed' ELSE notes END AS notes FROM b0),
u AS (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b),
g AS (SELECT client_id, client_name, abbreviation, is_active, notes, sum(s) AS net FROM u
      GROUP BY ALL)
SELECT client_id, client_name, abbreviation, is_active, notes,
       CASE WHEN net > 0 THEN 'only_a' ELSE 'only_b' END AS side, CAST(abs(net) AS BIGINT) AS n
FROM g WHERE net <> 0""", "v_clients"))
def q_h15(spark, d):
    a = V.clients(spark, d)
    b0 = a.where(F.col("client_id") % 50 != 0).unionByName(a.where(F.col("client_id") % 70 == 0))
    b = b0.withColumn("notes", F.when(F.col("client_id") % 30 == 0, F.lit("changed"))
                      .otherwise(F.col("notes"))).withColumn("client_id", F.col("client_id").cast("double"))
    return H.drift(a, b, DRIFT_COLS)


@register("h15_drift_text_and_number", W("""
SELECT CAST(client_id AS VARCHAR) AS client_id, side, CAST(1 AS BIGINT) AS n
FROM v_clients CROSS JOIN (VALUES ('only_a'), ('only_b')) t(side) WHERE client_id % 3 = 0""", "v_clients"))
def q_h15k(spark, d):
    """Ids of every third client are text on the other side; all others, the same numbers, do not drift."""
    c = V.clients(spark, d).select("client_id")
    ident = F.col("client_id")
    mixed = F.when(ident % 3 == 0, ident.cast("string").cast("variant")).otherwise(ident.cast("bigint").cast("variant"))
    return H.drift(c, c.select(mixed.alias("client_id")), ["client_id"])


# stored rows against a copy that lost some, holds some twice and has others changed
@register("h15_drift_by_checksums", W("""
WITH a AS (SELECT job_id, upload_id, domain, keyword, rank, traffic_volume,
                  CAST(replace(upload_id, 'up-', '') AS VARCHAR) AS o FROM v_data),
b AS (SELECT job_id, upload_id, domain, keyword, rank,
             CASE WHEN o LIKE '%77' THEN traffic_volume + 1 ELSE traffic_volume END AS traffic_volume
      FROM a WHERE o NOT LIKE '%55'
      UNION ALL SELECT job_id, upload_id, domain, keyword, rank, traffic_volume FROM a WHERE o LIKE '%99'),
g AS (SELECT job_id, upload_id, domain, keyword, rank, traffic_volume, sum(s) AS net
      FROM (SELECT * EXCLUDE (o), 1 AS s FROM a UNION ALL SELECT *, -1 FROM b) u GROUP BY ALL)
SELECT job_id, upload_id, domain, keyword, CAST(rank AS VARCHAR) AS rank, round(traffic_volume, 2) AS traffic_volume,
       CASE WHEN net > 0 THEN 'only_a' ELSE 'only_b' END AS side, CAST(abs(net) AS BIGINT) AS n
FROM g WHERE net <> 0""", "v_data"))
def q_h15_checksums(spark, d):
    cols = ["job_id", "upload_id", "domain", "keyword", "rank", "traffic_volume"]
    a = V.data_rows(spark, d).select(*cols)
    up = F.col("upload_id")
    b = a.where(~up.endswith("55")).withColumn("traffic_volume", F.when(up.endswith("77"), F.col("traffic_volume") + 1)
                                                .otherwise(F.col("traffic_volume"))).unionByName(a.where(up.endswith("99")))
    stored = []
    for side in (a, b):
        path = scratch_path(spark, "side")
        side.write.parquet(path)
        stored.append(spark.read.parquet(path))
    out = H.drift_by_checksums(stored[0], stored[1], cols)
    return out.withColumn("traffic_volume", F.round(F.col("traffic_volume").cast("double"), 2))


def _entity_tables(spark, d):
    return {"clients": V.clients(spark, d), "domains": V.domains(spark, d), "client_domains": V.client_domains(spark, d),
            "projects": V.projects(spark, d), "project_domains": V.project_domains(spark, d),
            "dataset_catalog": V.dataset_catalog(spark, d), "client_datasets": V.client_datasets(spark, d),
            "table_catalog": V.table_catalog(spark, d)}


@register("h15_drift_report", W("""
SELECT 'clients' AS table_name, count(*) FILTER (client_id % 50 = 0) AS only_a, CAST(0 AS BIGINT) AS only_b, 'DRIFT' AS status FROM v_clients
UNION ALL SELECT 'domains', 0, 0, 'clean'
UNION ALL SELECT 'client_domains', 0, count(*) FILTER (client_id % 10 = 0), 'DRIFT' FROM v_client_domains
UNION ALL SELECT 'projects', 0, 0, 'clean' UNION ALL SELECT 'project_domains', 0, 0, 'clean'
UNION ALL SELECT 'dataset_catalog', 0, 0, 'clean'
UNION ALL SELECT 'client_datasets', count(*) FILTER (client_id % 3 = 0), count(*) FILTER (client_id % 3 = 0), 'DRIFT' FROM v_client_datasets
UNION ALL SELECT 'table_catalog', 0, 0, 'clean'""", "v_clients", "v_client_domains", "v_dataset_names", "v_client_datasets"))
def q_h15r(spark, d):
    """Projects of the other side have split ids that are mapped back first. Tables
    made by joins or groupings are stored once, not made again on each side."""
    a = _entity_tables(spark, d)
    for name in ("client_domains", "project_domains", "client_datasets"):
        a[name] = written(a[name], name)
    b = dict(a)
    b["clients"] = a["clients"].where(F.col("client_id") % 50 != 0)
    b["client_domains"] = a["client_domains"].unionByName(a["client_domains"].where(F.col("client_id") % 10 == 0))
    b["client_datasets"] = a["client_datasets"].withColumn(
        "notes", F.when(F.col("client_id") % 3 == 0, F.lit("moved")).otherwise(F.col("notes")))
    shifted = F.when(F.col("project_id") % 7 == 0, F.col("project_id") + 10_000_000).otherwise(F.col("project_id"))
    for name in ("projects", "project_domains"):
        b[name] = a[name].withColumn("project_id", shifted)
    remap = a["projects"].where(F.col("project_id") % 7 == 0).select(
        (F.col("project_id") + 10_000_000).alias("project_id"), F.col("project_id").alias("old_id"))
    return H.drift_report(a, b, remap)


@register("h16_orphans", W("""
WITH p AS (SELECT * FROM v_clients WHERE client_id % 10 <> 3),
dm AS (SELECT * FROM v_domains WHERE domain_id % 9 <> 4),
pr AS (SELECT * FROM v_projects WHERE project_id % 8 <> 5)
SELECT 'client_domains_bad_client' AS "check", client_id || ',' || domain_id AS child_key
FROM v_client_domains WHERE client_id NOT IN (SELECT client_id FROM p)
UNION ALL SELECT 'client_domains_bad_domain', client_id || ',' || domain_id
FROM v_client_domains WHERE domain_id NOT IN (SELECT domain_id FROM dm)
UNION ALL SELECT 'projects_bad_client', project_id || ',' || client_id FROM pr WHERE client_id NOT IN (SELECT client_id FROM p)
UNION ALL SELECT 'project_domains_bad_project', project_id || ',' || domain_id
FROM v_project_domains WHERE project_id NOT IN (SELECT project_id FROM pr)
UNION ALL SELECT 'project_domains_bad_domain', project_id || ',' || domain_id
FROM v_project_domains WHERE domain_id NOT IN (SELECT domain_id FROM dm)
UNION ALL SELECT 'client_datasets_bad_client', concat_ws(',', client_id, domain_id, dataset_id)
FROM v_client_datasets WHERE client_id NOT IN (SELECT client_id FROM p)
UNION ALL SELECT 'client_datasets_bad_domain', concat_ws(',', client_id, domain_id, dataset_id)
FROM v_client_datasets WHERE domain_id IS NOT NULL AND domain_id NOT IN (SELECT domain_id FROM dm)""",
                           "v_clients", "v_domains", "v_client_domains", "v_dataset_names",
                           "v_client_datasets", "v_projects", "v_project_domains"))
def q_h16(spark, d):
    clients = V.clients(spark, d).where(F.col("client_id") % 10 != 3)
    doms = V.domains(spark, d).where(F.col("domain_id") % 9 != 4)
    projects = V.projects(spark, d).where(F.col("project_id") % 8 != 5)
    return H.entity_orphans(clients, doms, V.client_domains(spark, d), projects,
                            V.project_domains(spark, d), V.client_datasets(spark, d))


@register("h18_project_to_schema", """
SELECT l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE round(l_tax, 6) END AS l_tax
FROM lineitem""")
def q_h18(spark, d):
    li = read_table(spark, d, "lineitem")
    df = li.select("l_orderkey", F.when(F.col("l_orderkey") % 5 == 0, F.lit(float("nan")))
                   .otherwise(F.col("l_tax")).alias("l_tax"), "l_returnflag")
    out, _ = H.project_to_schema(df, ["l_orderkey", "l_tax"])
    return scalar_output(out)


@register("h19_bad_timestamps", """
SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, count(*) FILTER (WHERE o_orderdate > TIMESTAMP '9999-12-31 23:59:59') AS bad FROM orders
UNION ALL SELECT 'lineitem', 'l_shipdate', count(*) FILTER (WHERE l_shipdate > TIMESTAMP '9999-12-31 23:59:59') FROM lineitem
UNION ALL SELECT 'events', 'ts', count(*) FILTER (WHERE ts > TIMESTAMP '9999-12-31 23:59:59') FROM events""")
def q_h19(spark, d):
    return H.bad_timestamps({"orders": read_table(spark, d, "orders").select("o_orderdate"),
                             "lineitem": read_table(spark, d, "lineitem").select("l_shipdate"),
                             "events": read_table(spark, d, "events").select("ts")})


def _collided_projects(spark, d):
    """Every 97th project id is used twice, every 194th three times, two of
    them with one domain."""
    p = V.projects(spark, d)
    domain = V.supplier_domain(F.col("project_id") % 50)
    out = p
    for every, tail in ((97, "_001"), (194, "_002")):
        out = out.unionByName(p.where(F.col("project_id") % every == 0).withColumn(
            "project_name", F.concat(domain, F.lit(tail))))
    return out


def _keepers(spark, d):
    """Of every 291st id the shop domain keeps the id, not the first by name."""
    return V.projects(spark, d).where(F.col("project_id") % 291 == 0).select(
        "project_id", V.supplier_domain(F.col("project_id") % 50).alias("domain"))


def _h17_sql(keepers: bool) -> str:
    keep = (f"(project_id % 291 = 0 AND dom = {supp_domain('(project_id % 50)')})" if keepers else "false")
    copies = " ".join(f"""
           UNION ALL
           SELECT project_id, client_id, project_type, {supp_domain('(project_id % 50)')} || '{tail}',
                  status, notes, created_at FROM v_projects WHERE project_id % {every} = 0"""
                      for every, tail in ((97, "_001"), (194, "_002")))
    return f"""
WITH p AS (SELECT * FROM v_projects {copies}),
pd AS (SELECT *, regexp_replace(project_name, '_[0-9]+$', '') AS dom FROM p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY {keep} DESC, project_name) AS nth,
                  count(*) OVER (PARTITION BY project_id) AS uses FROM pd),
movers AS (SELECT *, (SELECT max(project_id) FROM p) + row_number() OVER (ORDER BY project_id, nth) AS new_id
           FROM ranked WHERE nth > 1),
kept AS (SELECT project_id, dom FROM ranked WHERE nth = 1 AND uses > 1),
target AS (SELECT project_id, dom, min(new_id) AS new_id FROM movers m
           WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.project_id = m.project_id AND k.dom = m.dom) GROUP BY 1, 2)"""


_H17_OUT = {
    "projects": """
SELECT coalesce(m.new_id, r.project_id) AS project_id, r.client_id, r.project_type, r.project_name, r.status, r.notes, r.created_at
FROM ranked r LEFT JOIN movers m ON m.project_id = r.project_id AND m.nth = r.nth""",
    "links": """
SELECT coalesce(t.new_id, l.project_id) AS project_id, l.domain_id, l.role, l.priority, l.notes
FROM v_project_domains l LEFT JOIN v_domains d ON d.domain_id = l.domain_id
LEFT JOIN target t ON t.project_id = l.project_id AND t.dom = d.domain""",
    "remap": "SELECT new_id AS project_id, project_id AS old_id FROM movers",
    "duplicates": "SELECT project_id, dom AS domain, count(*) AS n FROM ranked WHERE uses > 1 GROUP BY 1, 2 HAVING count(*) > 1",
}


def _h17(part: str, keepers: bool):
    at = list(_H17_OUT).index(part)
    name = f"h17_split_collided_{part}" + "_with_keepers" * keepers

    def query(spark, d):
        out = H.split_collided(_collided_projects(spark, d), V.project_domains(spark, d), V.domains(spark, d),
                               _keepers(spark, d) if keepers else None)[at]
        return scalar_output(out) if part == "projects" else out
    register(name, W(_h17_sql(keepers) + _H17_OUT[part], "v_projects", "v_project_domains", "v_domains"))(query)


for _part in _H17_OUT:
    _h17(_part, False)
_h17("projects", True)
_h17("links", True)
