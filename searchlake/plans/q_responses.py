"""Checked queries for the response flatteners (B rows)."""

from __future__ import annotations

from searchlake.operators.flatten import flatten_ranked_keywords
from searchlake.operators.uploads import top_keywords
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import with_views
from searchlake.plans.registry import DUCK_TYPES, register
from searchlake.schemas import RANKED_KEYWORDS
from searchlake.sources.testviews import ranked_responses
from searchlake.sources.tables import read_table, response_parts
from pyspark.sql import functions as F


def _ranked_select() -> str:
    known = {"keyword", "rank", "url", "search_volume", "keyword_difficulty",
             "national_location_code", "traffic_volume", "keyword_location_code",
             "language_code", "main_domain", "cpc", "competition", "competition_level",
             "keyword_info_last_updated_time", "is_another_language", "rank_absolute",
             "position", "main_intent", "foreign_intent", "serp_item_type",
             "is_featured_snippet", "previous_rank_absolute", "rank_is_new",
             "serp_item_backlinks", "is_lost"}
    cols = []
    for name, _, kind in RANKED_KEYWORDS.columns:
        if name in known:
            e = f"round({name}, 6)" if kind == "double" else name
        else:
            e = f"CAST(NULL AS {DUCK_TYPES[kind]})"
        cols.append(f"{e} AS {name}")
    cols.append("task_id")
    return "SELECT " + ", ".join(cols) + " FROM v_ranked"


@register("b6_flatten_ranked_keywords", with_views(_ranked_select(), "v_ranked"))
def q_flatten_ranked_keywords(spark, sf_dir):
    return scalar_output(flatten_ranked_keywords(ranked_responses(spark, sf_dir, response_parts(spark, sf_dir))))


@register("d10_top_keywords", with_views("""
SELECT domain, keyword, search_volume, kw_rank FROM (
  SELECT domain, keyword, search_volume,
         CAST(row_number() OVER (PARTITION BY domain ORDER BY search_volume DESC NULLS LAST,
                                 keyword ASC) AS BIGINT) AS kw_rank
  FROM (SELECT main_domain AS domain, keyword, max(search_volume) AS search_volume
        FROM v_ranked GROUP BY 1, 2) g) r
WHERE kw_rank <= 50""", "v_ranked"))
def q_top_keywords(spark, sf_dir):
    ranked = flatten_ranked_keywords(ranked_responses(spark, sf_dir, response_parts(spark, sf_dir)),
                                     columns=["keyword", "search_volume", "main_domain"])
    return scalar_output(top_keywords(ranked, 50))


# --------------------------------------------------------------- other endpoints
from searchlake.operators import flatten as B  # noqa: E402
from searchlake.plans.oracle_views import supp_domain  # noqa: E402
from searchlake.schemas import ENDPOINTS  # noqa: E402
from searchlake.sources import responses as R  # noqa: E402


def _expected(endpoint: str, known: dict[str, str], from_sql: str, skip=(), extra=()) -> str:
    """SELECT list in registry order: known expressions, typed nulls else."""
    cols = []
    for name, _, kind in ENDPOINTS[endpoint].columns:
        if name in skip:
            continue
        e = known.get(name)
        if e is None:
            e = f"CAST(NULL AS {DUCK_TYPES[kind]})"
        elif kind == "double":
            e = f"round({e}, 6)"
        cols.append(f"{e} AS {name}")
    cols += list(extra)
    return "SELECT " + ",\n       ".join(cols) + "\n" + from_sql


_SERP_FROM = """FROM (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem l) l
JOIN orders o ON o.o_orderkey = l.l_orderkey"""


_SERP_TYPE = "CASE l_linenumber % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'people_also_ask' ELSE 'paid' END"
_SERP_DATA = """'{"keyword":"kw' || CAST(l_orderkey AS VARCHAR) || '","datetime":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S +00:00')
  || '","se_domain":"google.com","se_results_count":' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR)
  || ',"check_url":"https://google.com/search","item_types":["organic","paid"]}'"""
_SERP_ITEM = f"""'{{"type":"' || {_SERP_TYPE} || '","rank_group":' || CAST(l_linenumber AS VARCHAR)
  || ',"rank_absolute":' || CAST(rn AS VARCHAR) || ',"page":1,"position":"left","url":"https://x.example/' || CAST(l_partkey AS VARCHAR)
  || '","title":"T' || CAST(l_partkey AS VARCHAR) || '"' || CASE WHEN l_linenumber % 3 = 1 THEN
     ',"items":[{{"title":"Q' || CAST(l_partkey AS VARCHAR) || '","url":"https://a.example/' || CAST(l_suppkey AS VARCHAR) || '"'
     || CASE WHEN l_suppkey % 2 = 0 THEN ',"expanded_element":[{{"description":"A' || CAST(l_suppkey AS VARCHAR) || '"}}]' ELSE '' END
     || '}},{{' || CASE WHEN l_partkey % 3 <> 0 THEN '"title":"Q2-' || CAST(l_partkey AS VARCHAR) || '"' ELSE '' END || '}}]'
     ELSE '' END || '}}'"""


@register("b1_flatten_serp", _expected("serp_organic", {
    "keyword": "'kw' || CAST(l_orderkey AS VARCHAR)",
    "serp_datetime": "o_orderdate", "se_domain": "'google.com'",
    "location_code": "CAST(2840 AS BIGINT)", "language_code": "'en'",
    "device": "CASE WHEN l_orderkey % 2 = 0 THEN 'desktop' ELSE 'mobile' END",
    "os": "CASE WHEN l_orderkey % 2 = 0 THEN 'windows' END",
    "se_results_count": "CAST(trunc(o_totalprice) AS BIGINT)",
    "check_url": "'https://google.com/search'", "item_types": "'[\"organic\",\"paid\"]'",
    "item_type": _SERP_TYPE,
    "rank_group": "CAST(l_linenumber AS BIGINT)", "rank_absolute": "rn",
    "page": "CAST(1 AS BIGINT)", "position": "'left'",
    "url": "'https://x.example/' || CAST(l_partkey AS VARCHAR)", "title": "'T' || CAST(l_partkey AS VARCHAR)",
    "data": _SERP_DATA, "item": _SERP_ITEM,
}, _SERP_FROM, extra=["'task-' || CAST(l_orderkey AS VARCHAR) AS task_id"]))
def q_b1(spark, d):
    return scalar_output(B.flatten_serp(R.serp_responses(spark, d, response_parts(spark, d))))


@register("b2_extract_paa", """
SELECT 'kw' || CAST(l_orderkey AS VARCHAR) AS keyword, 'Q' || CAST(l_partkey AS VARCHAR) AS question,
       CASE WHEN l_suppkey % 2 = 0 THEN 'A' || CAST(l_suppkey AS VARCHAR) ELSE '' END AS answer,
       'https://a.example/' || CAST(l_suppkey AS VARCHAR) AS url, 'Q' || CAST(l_partkey AS VARCHAR) AS title
FROM lineitem WHERE l_linenumber % 3 = 1
UNION ALL
SELECT 'kw' || CAST(l_orderkey AS VARCHAR),
       CASE WHEN l_partkey % 3 <> 0 THEN 'Q2-' || CAST(l_partkey AS VARCHAR) ELSE '' END, '', '',
       CASE WHEN l_partkey % 3 <> 0 THEN 'Q2-' || CAST(l_partkey AS VARCHAR) ELSE '' END
FROM lineitem WHERE l_linenumber % 3 = 1""")
def q_b2(spark, d):
    return B.extract_paa(B.flatten_serp(R.serp_responses(spark, d, response_parts(spark, d))))


_BL_DOM = supp_domain("l_suppkey")


@register("b3_flatten_backlinks", _expected("backlinks", {
    "url": _BL_DOM, "type": "'backlink'",
    "item_type": "CASE l_linenumber % 3 WHEN 0 THEN 'anchor' WHEN 1 THEN 'image' ELSE 'redirect' END",
    "attributes": "CASE WHEN l_linenumber % 2 = 0 THEN '[\"nofollow\"]' END",
    "domain_from": "'site' || CAST(l_orderkey AS VARCHAR) || '.com'",
    "url_from": "'https://site' || CAST(l_orderkey AS VARCHAR) || '.com/p' || CAST(l_linenumber AS VARCHAR)",
    "backlink_to": f"'https://' || {_BL_DOM} || '/'",
    "dofollow": "l_returnflag <> 'R'", "first_seen": "l_shipdate",
    "rank": "CAST(l_partkey % 1000 AS BIGINT)", "anchor": "'anchor' || CAST(l_partkey AS VARCHAR)",
    "is_new": "l_linenumber = 1", "page_from_keywords_count_top_10": "CAST(l_quantity AS BIGINT)",
}, "FROM lineitem", extra=["'bl-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_orderkey AS VARCHAR) AS task_id"]))
def q_b3(spark, d):
    return scalar_output(B.flatten_backlinks(R.backlinks_responses(spark, d, response_parts(spark, d))))


@register("b4_flatten_bulk_pages", _expected("bulk_pages_summary", {
    "url": "'https://shop.example/p/' || CAST(p_partkey AS VARCHAR)",
    "backlinks": "CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size * 10 AS BIGINT) END",
    "rank": "CAST(p_partkey % 100 AS BIGINT)", "spam_score": "p_retailprice / 100",
    "nofollow": "CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size ELSE 0 END AS BIGINT)",
    "dofollow": "CAST(coalesce(CASE WHEN p_partkey % 7 <> 0 THEN p_size * 10 END, 0) "
                "- CASE WHEN p_partkey % 3 <> 0 THEN p_size ELSE 0 END AS BIGINT)",
    "referring_links_attributes": "CASE WHEN p_partkey % 3 <> 0 THEN '{\"nofollow\":' || CAST(p_size AS VARCHAR) "
                                  "|| ',\"noopener\":' || CAST(p_size + 1 AS VARCHAR) || '}' END",
    "broken_pages": "CAST(p_size % 5 AS BIGINT)",
}, "FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0",
    extra=["'bp-' || CAST(p_partkey // 50 AS VARCHAR) AS task_id"]))
def q_b4(spark, d):
    return scalar_output(B.flatten_bulk_pages(R.bulk_pages_responses(spark, d)))


_BS_TARGET = (f"CASE WHEN s_suppkey % 5 = 0 THEN 'https://' || {supp_domain('s_suppkey')} || '/blog' "
              f"ELSE {supp_domain('s_suppkey')} END")


@register("b5_flatten_backlinks_summary", _expected("backlinks_summary", {
    "target": _BS_TARGET,
    "target_type": "CASE WHEN s_suppkey % 5 = 0 THEN 'url' ELSE 'domain' END",
    "rank": "CAST(s_suppkey % 1000 AS BIGINT)", "backlinks": "CAST(s_suppkey * 17 AS BIGINT)",
    "target_spam_score": "CAST(s_suppkey % 30 AS BIGINT)",
    "referring_domains": "CAST(trunc(s_acctbal) AS BIGINT)",
    "referring_links_tld": "'{\"com\":' || CAST(s_suppkey % 7 AS VARCHAR) || ',\"net\":' || CAST(s_suppkey % 3 AS VARCHAR) || '}'",
    "first_seen": "TIMESTAMP '2019-11-15 12:57:46'",
}, "FROM supplier", extra=["'bs-' || CAST(s_suppkey AS VARCHAR) AS task_id"]))
def q_b5(spark, d):
    return scalar_output(B.flatten_backlinks_summary(R.backlinks_summary_responses(spark, d)))


_GRP = "(p_partkey // 20)"


@register("b7_flatten_keyword_suggestions", _expected("keyword_suggestions", {
    "se_type": f"CASE WHEN {_GRP} % 4 <> 0 THEN 'bing' ELSE 'google' END",
    "seed_keyword": f"CASE WHEN {_GRP} % 3 <> 0 THEN 'seed' ELSE 'target' END || CAST({_GRP} AS VARCHAR)",
    "keyword": "CASE WHEN p_partkey % 5 = 0 THEN 'kd ' || p_name ELSE p_name END",
    "location_code": "CAST(CASE WHEN p_partkey % 3 <> 0 THEN 2036 WHEN p_partkey % 7 = 0 THEN NULL ELSE 2840 END AS BIGINT)",
    "language_code": "'en'", "search_volume": "CAST(p_size AS BIGINT)", "cpc": "p_retailprice / 1000",
    "keyword_difficulty": "CAST(p_partkey % 100 AS BIGINT)",
    "words_count": "CAST(len(string_split(p_name, ' ')) AS BIGINT)",
}, "FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 13 <> 0",
    extra=[f"'ks-' || CAST({_GRP} AS VARCHAR) AS task_id"]))
def q_b7(spark, d):
    return scalar_output(B.flatten_keyword_suggestions(R.suggestions_responses(spark, d)))


@register("b8_flatten_related_keywords", _expected("related_keywords", {
    "seed_keyword": f"CASE WHEN {_GRP} % 3 <> 0 THEN 'seed' ELSE 'target' END || CAST({_GRP} AS VARCHAR)",
    "related_keyword": "CASE WHEN p_partkey % 5 = 0 THEN 'alt ' || p_name WHEN p_partkey % 13 <> 0 THEN p_name END",
    "depth": "CAST(p_partkey % 3 AS BIGINT)", "location_code": "CAST(2840 AS BIGINT)",
    "language_code": "'en'", "search_volume": "CAST(p_size AS BIGINT)", "competition_level": "'LOW'",
    "is_other_language": "p_partkey % 2 = 0", "foreign_intent": "'informational'",
    "related_keywords": "'[\"a\",\"b\"]'",
}, "FROM part", extra=[f"'rk-' || CAST({_GRP} AS VARCHAR) AS task_id"]))
def q_b8(spark, d):
    return scalar_output(B.flatten_related_keywords(R.related_responses(spark, d)))


@register("b9_flatten_keyword_overview", _expected("keyword_overview", {
    "keyword": "p_name",
    "location_code": "CAST(CASE WHEN p_partkey % 2 = 0 THEN 2840 END AS BIGINT)",
    "language_code": "CASE WHEN p_partkey % 4 <> 0 THEN 'de' WHEN p_partkey % 6 = 0 THEN NULL ELSE 'en' END",
    "search_volume": "CAST(p_size AS BIGINT)", "search_volume_trend_monthly": "(p_partkey % 10) / 10",
    "foreign_intent": "'commercial,local'",
}, "FROM part", extra=[f"'ko-' || CAST({_GRP} AS VARCHAR) AS task_id"]))
def q_b9(spark, d):
    return scalar_output(B.flatten_keyword_overview(R.overview_responses(spark, d)))


@register("b10_flatten_search_intent", _expected("search_intent", {
    "keyword": "p_name",
    "search_intent": "CASE p_partkey % 3 WHEN 0 THEN 'informational' WHEN 1 THEN 'commercial' ELSE 'navigational' END",
    "intent_probability": "p_size / 50",
    "secondary_keyword_intents": "CASE WHEN p_partkey % 2 = 0 THEN '[{\"label\":\"commercial\",\"probability\":0.25}]' END",
    "language_code": "CASE WHEN p_partkey % 3 <> 0 THEN 'fr' WHEN p_partkey % 9 = 0 THEN NULL ELSE 'en' END",
}, "FROM part", extra=[f"'si-' || CAST({_GRP} AS VARCHAR) AS task_id"]))
def q_b10(spark, d):
    return scalar_output(B.flatten_search_intent(R.intent_responses(spark, d)))


def _dr(loc: int, scale: int) -> str:
    return _expected("domain_rank_overview", {
        "target": supp_domain("s_suppkey"), "location_code": f"CAST({loc} AS BIGINT)",
        "language_code": "'en'",
        "organic_count": f"CAST(CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * {scale} END AS BIGINT)",
        "organic_etv": f"s_acctbal * {scale}", "organic_is_new": "CAST(s_suppkey % 4 AS BIGINT)",
        "organic_is_lost": "CAST(s_suppkey % 6 AS BIGINT)", "organic_pos_1": "CAST(s_suppkey % 3 AS BIGINT)",
        "organic_pos_4_10": "CAST(s_suppkey % 11 AS BIGINT)",
        "organic_pos_91_100": "CAST(s_suppkey % 13 AS BIGINT)",
        "paid_count": "CAST(s_suppkey % 2 AS BIGINT)", "paid_etv": "CAST(1.5 AS DOUBLE)",
        "paid_is_up": "CAST(s_suppkey % 5 AS BIGINT)",
    }, "FROM supplier", extra=["'dr-' || CAST(s_suppkey AS VARCHAR) AS task_id"])


@register("b11_flatten_domain_rank", _dr(2840, 10) + "\nUNION ALL\n" + _dr(2036, 3))
def q_b11(spark, d):
    return scalar_output(B.flatten_domain_rank(R.domain_rank_responses(spark, d)))


@register("b12_flatten_search_volume", _expected("search_volume", {
    "keyword": "p_name", "search_volume": "CAST(p_size AS BIGINT)",
    "location_code": "CAST(CASE WHEN p_partkey % 4 <> 0 THEN 2276 ELSE 2840 END AS BIGINT)",
    "cpc": "p_retailprice / 100",
    "competition": "CASE p_partkey % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' ELSE 'HIGH' END",
    "monthly_searches": "CASE WHEN p_partkey % 3 = 0 THEN '[{\"year\":2024,\"search_volume\":' || CAST(p_size AS VARCHAR) || '}]' END",
}, "FROM part WHERE p_partkey % 10 <> 0", extra=[f"'sv-' || CAST({_GRP} AS VARCHAR) AS task_id"]))
def q_b12(spark, d):
    return scalar_output(B.flatten_search_volume(R.volume_responses(spark, d)))


@register("b18_keyword_count", f"""
SELECT {supp_domain('s_suppkey')} AS target,
       CAST(CASE WHEN s_suppkey % 8 = 7 OR s_suppkey % 5 = 0 THEN -1 ELSE s_suppkey * 10 END AS BIGINT) AS keyword_count
FROM supplier
UNION ALL SELECT 'unknown.example', CAST(-1 AS BIGINT)""")
def q_b18(spark, d):
    from searchlake.sources.testviews import supplier_domain
    # some targets have no answer: their overview pages were never landed
    landed = R.domain_rank_responses(spark, d).join(
        read_table(spark, d, "supplier").where(F.col("s_suppkey") % 8 == 7)
        .select(supplier_domain(F.col("s_suppkey")).alias("target")), "target", "left_anti")
    dr = B.flatten_domain_rank(landed, with_position=True)
    s = read_table(spark, d, "supplier").select(supplier_domain(F.col("s_suppkey")).alias("target"))
    targets = s.unionByName(spark.range(1).select(F.lit("unknown.example").alias("target")))
    return B.keyword_count(dr, targets)
