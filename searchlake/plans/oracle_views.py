"""The derived views of :mod:`searchlake.sources.testviews` in DuckDB SQL.

The oracle never reads JSON: where the Spark side builds and parses API
responses, the SQL here states the expected rows straight from the tables.
``with_views(sql, names)`` prefixes the CTEs a check needs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

# ranked keyword rows the flattener must produce (B6), straight from lineitem
VIEWS["v_ranked"] = """
SELECT p.p_name AS keyword,
       CAST(l.l_linenumber AS BIGINT) AS rank,
       'https://site' || CAST(l.l_orderkey % 1000 AS VARCHAR) || '.com/p/' || CAST(l.l_partkey AS VARCHAR) AS url,
       CASE WHEN l.l_orderkey % 31 = 0 THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS search_volume,
       CAST(l.l_partkey % 100 AS BIGINT) AS keyword_difficulty,
       CAST(2840 AS BIGINT) AS national_location_code,
       l.l_extendedprice AS traffic_volume,
       CAST(2840 AS BIGINT) AS keyword_location_code,
       'en' AS language_code,
       'site' || CAST(l.l_orderkey % 1000 AS VARCHAR) || '.com' AS main_domain,
       l.l_discount AS cpc,
       l.l_tax AS competition,
       CASE l.l_linenumber % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' ELSE 'HIGH' END AS competition_level,
       CASE WHEN l.l_orderkey % 37 = 0 THEN NULL ELSE l.l_shipdate END AS keyword_info_last_updated_time,
       l.l_linenumber = 7 AS is_another_language,
       CAST(l.l_linenumber + 1 AS BIGINT) AS rank_absolute,
       'left' AS position,
       CASE l.l_partkey % 4 WHEN 0 THEN 'informational' WHEN 1 THEN 'navigational'
            WHEN 2 THEN 'commercial' ELSE 'transactional' END AS main_intent,
       CASE WHEN l.l_partkey % 2 = 0 THEN
            CASE l.l_partkey % 4 WHEN 0 THEN 'informational' WHEN 1 THEN 'navigational'
                 WHEN 2 THEN 'commercial' ELSE 'transactional' END || ',commercial' END AS foreign_intent,
       'organic' AS serp_item_type,
       l.l_linenumber = 1 AS is_featured_snippet,
       CAST(l.l_linenumber + 2 AS BIGINT) AS previous_rank_absolute,
       l.l_returnflag = 'N' AS rank_is_new,
       CAST(l.l_suppkey AS BIGINT) AS serp_item_backlinks,
       l.l_linestatus = 'F' AS is_lost,
       'task-' || CAST(l.l_orderkey AS VARCHAR) AS task_id
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE (l.l_orderkey + l.l_linenumber) % 23 <> 0
  AND NOT (l.l_orderkey % 41 = 0 AND l.l_linenumber = 1)
  AND l.l_orderkey % 43 <> 0
  AND l.l_orderkey % 29 <> 0
"""


def with_views(sql: str, *names: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"


def _pick(key: str, values: list) -> str:
    n = len(values)
    arms = " ".join(f"WHEN {i} THEN {v!r}" if isinstance(v, str) else f"WHEN {i} THEN {v}"
                    for i, v in enumerate(values))
    return f"(CASE {key} % {n} {arms} END)"


VIEWS["v_uploads"] = """
SELECT 'job-' || CAST(user_id % 40 AS VARCHAR) AS job_id,
       'up-' || CAST(event_id AS VARCHAR) AS upload_id,
       'api' AS source,
       'prog-' || CAST(event_id % 3 AS VARCHAR) AS source_program,
       event_type AS dataset,
       't' || CAST(event_id % 7 AS VARCHAR) AS table_name,
       CAST(floor(value) AS BIGINT) AS row_count,
       ts AS ingest_timestamp,
       CASE WHEN event_id % 5 <> 0 THEN CAST(user_id % 20 AS VARCHAR) END AS client_id,
       CASE WHEN event_id % 3 <> 0 THEN CAST(user_id % 30 AS VARCHAR) END AS project_id,
       CAST(NULL AS VARCHAR) AS notes
FROM events
"""

_CODES = [40601, 40602, 40402, 50000, 20000, 20000, 20000, 20000, 20000, 20000]
_MSGS = ["Task Handed.", "Task In Queue.", "Task Not Found.", "Internal Error.",
         "Ok.", "Ok.", "Ok.", "Ok.", "Ok.", "Ok."]

VIEWS["v_attempts"] = f"""
SELECT 'job-' || CAST(user_id % 40 AS VARCHAR) AS job_id,
       'att-' || CAST(event_id // 1000 AS VARCHAR) AS upload_id,
       event_id,
       event_type AS endpoint,
       'kw-' || CAST(user_id AS VARCHAR) AS target,
       event_id % 3 + 1 AS attempt,
       ts AS started_at,
       CAST(floor(value * 100) AS BIGINT) AS duration_ms,
       CAST(CASE WHEN event_id % 11 = 0 THEN 500 ELSE 200 END AS BIGINT) AS http_status,
       CAST({_pick('event_id', _CODES)} AS BIGINT) AS task_status_code,
       {_pick('event_id', _MSGS)} AS task_status_message,
       CASE WHEN event_id % 6 <> 0 THEN value / 1000 END AS task_cost,
       CAST(CASE WHEN event_type = 'error' OR event_id % 4 = 0 THEN 0 ELSE floor(value) END AS BIGINT) AS n_items,
       CASE WHEN event_type = 'error' THEN 'HTTP 500: failure on ' || CAST(user_id AS VARCHAR) END AS error
FROM events
"""

_SUPP_DOMAIN = "('supp' || CAST({k} AS VARCHAR) || " + _pick("{k}", [".com", ".com.au", ".co.nz"]) + ")"


def supp_domain(k: str) -> str:
    return _SUPP_DOMAIN.replace("{k}", k)


def raw_domain(k: str, v: str) -> str:
    d = supp_domain(k)
    return (f"(CASE {v} % 4 WHEN 0 THEN {d} WHEN 1 THEN 'https://www.' || {d} || '/' "
            f"WHEN 2 THEN upper({d}) ELSE 'http://' || {d} || ':8080/x' END)")


VIEWS["v_domains"] = f"""
SELECT s_suppkey AS domain_id, {supp_domain('s_suppkey')} AS domain,
       'Supp' || CAST(s_suppkey AS VARCHAR) AS domain_name,
       s_acctbal > 0 AS is_active, CAST(NULL AS VARCHAR) AS notes
FROM supplier
"""

VIEWS["v_data"] = f"""
SELECT CASE WHEN l_orderkey % 13 = 0 THEN 'pending-backfill'
            ELSE 'job-' || CAST(l_suppkey % 40 AS VARCHAR) END AS job_id,
       CASE WHEN l_orderkey % 17 = 0 THEN 'pending-backfill'
            ELSE 'up-' || CAST(l_orderkey AS VARCHAR) END AS upload_id,
       l_shipdate AS ingest_timestamp,
       CASE WHEN l_orderkey % 19 <> 0 THEN l_suppkey END AS domain_id,
       {raw_domain('l_suppkey', 'l_orderkey')} AS domain,
       'kw' || CAST(l_partkey AS VARCHAR) AS keyword,
       CAST(l_quantity AS BIGINT) AS search_volume,
       CAST(l_linenumber AS BIGINT) AS rank,
       l_extendedprice AS traffic_volume
FROM lineitem
"""

VIEWS["v_client_domains"] = """
SELECT client_id, domain_id, (client_id + domain_id) % 4 = 0 AS is_competitor,
       CASE (client_id + domain_id) % 5 WHEN 0 THEN 'VERY LOW' WHEN 1 THEN 'LOW'
            WHEN 2 THEN 'NORMAL' WHEN 3 THEN 'HIGH' ELSE 'VERY HIGH' END AS priority,
       CAST(NULL AS VARCHAR) AS notes
FROM (SELECT DISTINCT o.o_custkey AS client_id, l.l_suppkey AS domain_id
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) p
"""

VIEWS["v_crawl"] = """
SELECT 'crawl-' || CAST(page_id % 2 AS VARCHAR) AS job_id, url AS address,
       CASE page_id % 5 WHEN 0 THEN 'application/json' WHEN 1 THEN 'TEXT/HTML; charset=UTF-8'
            WHEN 2 THEN 'text/html' WHEN 3 THEN 'text/html' ELSE 'image/png' END AS content_type,
       CAST(CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS BIGINT) AS status_code
FROM pages
"""

_U = "md5(CAST(event_id AS VARCHAR))"
_UUID = (f"substr({_U},1,8)||'-'||substr({_U},9,4)||'-'||substr({_U},13,4)||'-'"
         f"||substr({_U},17,4)||'-'||substr({_U},21,12)")
VIEWS["v_api_urls"] = f"""
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN 'https://api.host/v3/' || event_type || '/task_get/' || {_UUID} || '/extra'
            WHEN event_id % 3 = 1 THEN 'https://api.host/v3/' || event_type || '/live'
            ELSE 'https://other.host/' || event_type END AS url
FROM events
"""


VIEWS["v_usage"] = """
SELECT conv_id, turn, role, text, (CASE conv_id % 6 WHEN 0 THEN 'openai' WHEN 1 THEN 'gemini' WHEN 2 THEN 'perplexity' WHEN 3 THEN 'anthropic' WHEN 4 THEN 'grok' WHEN 5 THEN 'mystery' END) AS provider,
       (CASE conv_id % 6 WHEN 0 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-5-mini' WHEN 2 THEN 'gpt-unknown' END) WHEN 1 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'gemini-2.5-flash' WHEN 1 THEN 'gemini-3-pro' WHEN 2 THEN 'gemini-x' END) WHEN 2 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'sonar' WHEN 1 THEN 'sonar-pro' WHEN 2 THEN 'sonar-x' END) WHEN 3 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'claude-sonnet-4-20250514' WHEN 1 THEN 'claude-haiku-3-5-20241022' WHEN 2 THEN 'claude-x' END) WHEN 4 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'grok-3' WHEN 1 THEN 'grok-3-mini' WHEN 2 THEN 'grok-x' END) WHEN 5 THEN (CASE (conv_id + turn) % 3 WHEN 0 THEN 'm1' WHEN 1 THEN 'm2' WHEN 2 THEN 'm3' END) END) AS model,
       (CASE turn % 3 WHEN 0 THEN 'enrichment' WHEN 1 THEN 'answer' WHEN 2 THEN 'fact_check' END) AS step,
       CAST(floor(length(text) / 3) AS BIGINT) AS input_tokens,
       CAST(floor(length(text) / 4) AS BIGINT) AS output_tokens
FROM conversations
"""

VIEWS["v_locations"] = """
SELECT CAST(2000 + n_nationkey AS BIGINT) AS location_code, n_name || ',' || r_name AS location_name,
       (CASE n_nationkey % 3 WHEN 0 THEN 'City' WHEN 1 THEN 'State' WHEN 2 THEN 'Country' END) AS location_type,
       substr(n_name, 1, 2) AS country_iso_code
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["v_clients"] = """
SELECT c_custkey AS client_id, c_name AS client_name, 'C' || CAST(c_custkey % 97 AS VARCHAR) AS abbreviation,
       c_acctbal > 0 AS is_active, c_mktsegment AS notes, CAST(NULL AS TIMESTAMP) AS created_at
FROM customer
"""

VIEWS["v_projects"] = """
SELECT o_orderkey AS project_id, o_custkey AS client_id, o_orderpriority AS project_type,
       'project_' || CAST(o_orderkey AS VARCHAR) AS project_name,
       CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'completed' ELSE 'paused' END AS status,
       CAST(NULL AS VARCHAR) AS notes, o_orderdate AS created_at
FROM orders
"""

VIEWS["v_project_domains"] = f"""
SELECT project_id, domain_id,
       CASE WHEN (project_id + domain_id) % 2 = 0 THEN 'primary' ELSE 'competitor' END AS role,
       CASE WHEN (project_id + domain_id) % 7 <> 0 THEN
            {_pick('(project_id + domain_id)', ['VERY LOW', 'LOW', 'NORMAL', 'HIGH', 'VERY HIGH'])} END AS priority,
       CAST(NULL AS VARCHAR) AS notes
FROM (SELECT DISTINCT l_orderkey AS project_id, l_suppkey AS domain_id FROM lineitem) p
"""

_DOM_US = "replace(" + supp_domain("p_partkey") + ", '.', '_')"
VIEWS["v_dataset_names"] = f"""
SELECT p_partkey AS part_id,
  CASE WHEN p_partkey % 6 = 0 THEN 'analytics_' || CAST(p_partkey AS VARCHAR)
       WHEN p_partkey % 6 = 1 THEN 'jepto_gsc_' || {_DOM_US}
       WHEN p_partkey % 12 = 8 THEN 'searchconsole_x_SC_DOMAIN_www_' || {_DOM_US}
       WHEN p_partkey % 6 = 2 THEN 'searchconsole_x_sc_domain_www_' || {_DOM_US}
       WHEN p_partkey % 6 = 3 THEN 'JEPTO_GMB_' || CAST(p_partkey AS VARCHAR)
       WHEN p_partkey % 6 = 4 THEN 'JEPTO_GSC_supp' || CAST(p_partkey AS VARCHAR)
       ELSE 'misc_' || {_DOM_US} || '_' || CAST(p_partkey AS VARCHAR) END AS dataset
FROM part
"""

VIEWS["v_dataset_catalog"] = f"""
SELECT dataset,
  CASE part_id % 6 WHEN 0 THEN 'ga4' WHEN 3 THEN 'gmb' WHEN 5 THEN 'other' ELSE 'gsc' END AS dataset_type,
  CASE WHEN part_id % 6 = 0 THEN 'www.' || {supp_domain('(part_id % 50 + 1)')} END AS hostname,
  part_id % 2 = 0 AS is_standardized, 'team' AS owner, part_id % 9 <> 0 AS active,
  CAST(NULL AS TIMESTAMP) AS updated_at
FROM v_dataset_names WHERE part_id % 10 <> 9
"""

VIEWS["v_client_datasets"] = """
SELECT g.o_custkey AS client_id, CASE WHEN g.part_id % 4 <> 0 THEN g.s END AS domain_id,
       n.dataset AS dataset_id, (g.o_custkey + g.part_id) % 5 <> 0 AS is_active,
       CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS TIMESTAMP) AS created_at
FROM (SELECT o.o_custkey, l.l_partkey - l.l_partkey % 7 AS part_id, min(l.l_suppkey) AS s
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2) g
JOIN v_dataset_names n ON n.part_id = g.part_id
"""

VIEWS["v_table_groups"] = """
SELECT 'ds' || CAST(l_suppkey % 3 AS VARCHAR) AS dataset,
       CASE WHEN l_partkey % 53 = 0 THEN 'temp_' || CAST(l_partkey % 50 AS VARCHAR)
            WHEN l_partkey % 59 = 0 THEN '_temp_' || CAST(l_partkey % 50 AS VARCHAR)
            ELSE 't' || CAST(l_partkey % 50 AS VARCHAR) END AS table_name,
       count(*) AS row_count, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS size_bytes
FROM lineitem GROUP BY 1, 2
"""

VIEWS["v_table_catalog"] = """
SELECT dataset, 't' || CAST(t AS VARCHAR) AS table_name, CAST(NULL AS BIGINT) AS row_count,
       CAST(sz AS BIGINT) AS size_bytes, t % 4 <> 0 AS is_active,
       TIMESTAMP '2024-01-01 00:00:00' AS status_changed_at, CAST(NULL AS VARCHAR) AS notes,
       CAST(NULL AS TIMESTAMP) AS last_indexed_at
FROM (SELECT 'ds' || CAST(p_partkey % 3 AS VARCHAR) AS dataset, p_partkey % 60 AS t, min(p_size) AS sz
      FROM part GROUP BY 1, 2) g
WHERE t % 11 <> 5
"""
