"""Responses whose items have every documented field filled (for B1-B12).

``LAYOUT`` states each endpoint's JSON by object, field by field, with the
table column it ends up in and its kind; it is written apart from
``searchlake.schemas`` so that a wrong path there shows. Values are a plain
function of the part key and the field's number, and every seventh one of a
field is an explicit null, a missing key or text that does not parse.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.sources.responses import envelope
from searchlake.sources.tables import Tables

# Field names of the remote API by object, as "field column kind"
# ("=" when the column has the field's name). Kinds: int, num, text, bool,
# time, json (a list), csv (a list of labels). "!" marks a field that is always
# there, since rows without it are dropped or filled from elsewhere.
_TREND = {"search_volume_trend": """
monthly search_volume_trend_monthly num
quarterly search_volume_trend_quarterly num
yearly search_volume_trend_yearly num"""}
_INFO = """
competition = num
competition_level = text
cpc = num
low_top_of_page_bid = num
high_top_of_page_bid = num
monthly_searches = json
last_updated_time keyword_info_last_updated_time time"""
_PROPERTIES = """
core_keyword = text
keyword_difficulty = int
detected_language = text"""
_INTENT = """
foreign_intent = csv
last_updated_time search_intent_last_updated_time time"""

LAYOUT: dict[str, dict] = {
    "ranked_keywords": {
        "keyword_data": {
            "": "keyword = text!\nlocation_code keyword_location_code int\nlanguage_code = text",
            "keyword_info": {"": _INFO + "\nsearch_volume = int!\ncategories = json", **_TREND},
            "keyword_properties": _PROPERTIES + "\nis_another_language = bool",
            "serp_info": "serp_item_types = json\nse_results_count = int",
            "search_intent_info": _INTENT + "\nmain_intent = text",
            "avg_backlinks_info": """
backlinks avg_backlinks num
referring_domains avg_referring_domains num
referring_main_domains avg_referring_main_domains num
rank avg_rank num
main_domain_rank avg_main_domain_rank num
last_updated_time avg_backlinks_last_updated_time time"""},
        "ranked_serp_element": {
            "": "keyword_difficulty serp_keyword_difficulty int\nis_lost = bool",
            "serp_item": {
                "": """
rank_group rank int!
rank_absolute = int
position = text
url = text!
etv traffic_volume num
main_domain = text
type serp_item_type text
title serp_item_title text
description serp_item_description text
is_featured_snippet = bool
estimated_paid_traffic_cost = num""",
                "rank_changes": "previous_rank_absolute = int\nis_new rank_is_new bool\nis_up rank_is_up bool\nis_down rank_is_down bool",
                "backlinks_info": """
referring_domains serp_item_referring_domains int
referring_main_domains serp_item_referring_main_domains int
backlinks serp_item_backlinks int""",
                "rank_info": "page_rank serp_item_page_rank int\nmain_domain_rank serp_item_main_domain_rank int"}}},
    "backlinks": {
        "": """
type = text
item_type = text
attributes = json
original = bool
domain_from = text
url_from = text
url_from_https = bool
tld_from = text
domain_from_rank = int
domain_from_platform_type = json
domain_from_is_ip = bool
domain_from_ip = text
domain_from_country = text
domain_to = text
url_to backlink_to text
url_to_https backlink_to_https bool
url_to_status_code backlink_to_status_code int
url_to_spam_score backlink_to_spam_score int
url_to_redirect_target backlink_to_redirect_target text
dofollow = bool
backlink_spam_score = int
is_broken = bool
is_indirect_link = bool
indirect_link_path = json
anchor = text
alt = text
image_url = text
text_pre = text
text_post = text
semantic_location = text
first_seen = time
prev_seen = time
last_seen = time
is_new = bool
is_lost = bool
rank = int
page_from_rank = int
page_from_title = text
page_from_status_code = int
page_from_external_links = int
page_from_internal_links = int
page_from_size = int
page_from_encoding = text
page_from_language = text
links_count = int
group_count = int""",
        "ranked_keywords_info": """
page_from_keywords_count_top_3 = int
page_from_keywords_count_top_10 = int
page_from_keywords_count_top_100 = int"""},
    "bulk_pages_summary": {
        "": """
url = text
backlinks = int
referring_domains = int
referring_domains_nofollow = int
referring_main_domains = int
referring_main_domains_nofollow = int
rank = int
main_domain_rank = int
backlinks_spam_score spam_score num
referring_ips = int
referring_subnets = int
referring_pages = int
referring_pages_nofollow = int
broken_backlinks = int
broken_pages = int
first_seen = time
lost_date = time"""},
    "backlinks_summary": {
        "": """
target = text!
rank = int
backlinks = int
backlinks_spam_score = int
crawled_pages = int
referring_domains = int
referring_domains_nofollow = int
referring_main_domains = int
referring_main_domains_nofollow = int
referring_ips = int
referring_subnets = int
referring_pages = int
referring_pages_nofollow = int
referring_links_tld = json
referring_links_types = json
referring_links_attributes = json
referring_links_platform_types = json
referring_links_semantic_locations = json
referring_links_countries = json
internal_links_count = int
external_links_count = int
broken_backlinks = int
broken_pages = int
first_seen = time
lost_date = time""",
        "info": "target_spam_score = int"},
    "keyword_suggestions": {
        "": "keyword = text!\nlocation_code = int!\nlanguage_code = text!",
        "keyword_info": {"": _INFO + "\nsearch_volume = int\ncategories = json", **_TREND},
        "keyword_properties": _PROPERTIES + "\nis_another_language = bool\nwords_count = int",
        "search_intent_info": _INTENT + "\nmain_intent = text",
        "avg_backlinks_info": """
backlinks avg_backlinks num
dofollow avg_dofollow num
referring_pages avg_referring_pages num
referring_domains avg_referring_domains num
referring_main_domains avg_referring_main_domains num
rank avg_rank num
main_domain_rank avg_main_domain_rank num
last_updated_time avg_backlinks_last_updated_time time"""},
    "related_keywords": {
        "": "depth = int\nrelated_keywords = json",
        "keyword_data": {
            "": "keyword related_keyword text!",
            "keyword_info": {"": _INFO + "\nsearch_volume = int", **_TREND},
            "keyword_properties": _PROPERTIES + "\nis_another_language is_other_language bool",
            "serp_info": """
serp_item_types = json
se_results_count = int
last_updated_time serp_last_updated_time time
check_url serp_info_check_url text
previous_updated_time serp_info_previous_updated_time time""",
            "search_intent_info": _INTENT + "\nmain_intent search_intent_main text",
            "avg_backlinks_info": """
backlinks = num
dofollow = num
referring_pages = num
referring_domains = num
referring_main_domains = num
main_domain_rank = num
rank avg_rank num
last_updated_time avg_backlinks_last_updated_time time"""}},
    "keyword_overview": {
        "": "keyword = text\nlocation_code = int\nlanguage_code = text!",
        "keyword_info": {"": _INFO + "\nsearch_volume = int\ncategories = json", **_TREND},
        "keyword_properties": _PROPERTIES + "\nis_another_language = bool",
        "search_intent_info": _INTENT + "\nmain_intent = text",
        "avg_backlinks_info": """
backlinks avg_backlinks num
dofollow avg_dofollow num
referring_pages avg_referring_pages num
referring_domains avg_referring_domains num
referring_main_domains avg_referring_main_domains num
rank avg_rank num
main_domain_rank avg_main_domain_rank num
last_updated_time avg_backlinks_last_updated_time time"""},
    "search_intent": {
        "": "keyword = text\nlanguage_code = text!\nsecondary_keyword_intents = json",
        "keyword_intent": "label search_intent text\nprobability intent_probability num"},
    "domain_rank_overview": {
        "": "location_code = int\nlanguage_code = text",
        "metrics": {
            "organic": """
count organic_count int
etv organic_etv num
estimated_paid_traffic_cost organic_estimated_paid_traffic_cost num
is_new organic_is_new int
is_up organic_is_up int
is_down organic_is_down int
is_lost organic_is_lost int
""" + "\n".join(f"pos_{b} organic_pos_{b} int" for b in (
                "1", "2_3", "4_10", "11_20", "21_30", "31_40", "41_50", "51_60", "61_70", "71_80", "81_90", "91_100")),
            "paid": """
count paid_count int
etv paid_etv num
estimated_paid_traffic_cost paid_estimated_paid_traffic_cost num
is_new paid_is_new int
is_up paid_is_up int
is_down paid_is_down int
is_lost paid_is_lost int"""}},
    "search_volume": {
        "": """
keyword = text!
search_volume = int
location_code = int!
cpc = num
competition = text
competition_index = int
low_top_of_page_bid = num
high_top_of_page_bid = num
monthly_searches = json"""},
    "serp_organic": {
        "": """
type item_type text
rank_group = int
rank_absolute = int
page = int
position = text
url = text
title = text
description = text"""},
}
RESULT_ROWS = ("backlinks_summary", "search_volume")  # the results are the rows


def fields(endpoint: str) -> Iterator[tuple[tuple[str, ...], str, str, bool, int]]:
    """(path, column, kind, always there, number) of every field."""
    number = 0

    def walk(node, path):
        nonlocal number
        if isinstance(node, str):
            for line in node.strip().splitlines():
                field, column, kind = line.split()
                number += 1
                yield (*path, field), field if column == "=" else column, kind.rstrip("!"), kind.endswith("!"), number
            return
        for name, inner in node.items():
            yield from walk(inner, (*path, name) if name else path)
    yield from walk(LAYOUT[endpoint], ())


def _value(kind: str, k: Column, i: int) -> Column:
    """JSON text of a proper value."""
    if kind == "int":
        n = k % 1000 * 7 + i
        return F.when((k + i) % 7 == 2, F.concat(F.lit('"'), n.cast("string"), F.lit('.0"'))).otherwise(n.cast("string"))
    if kind == "num":
        return ((k % 1000 + i) / 8.0).cast("string")
    if kind == "text":
        return F.concat(F.lit(f'"c{i}-'), k.cast("string"), F.lit('"'))
    if kind == "bool":
        return F.when((k + i) % 2 == 0, F.lit("true")).otherwise(F.lit("false"))
    if kind == "time":
        return F.concat(F.lit('"2024-01-'), F.lpad(((k + i) % 28 + 1).cast("string"), 2, "0"), F.lit(' 10:20:30 +00:00"'))
    if kind == "csv":
        return F.concat(F.lit(f'["l{i}",null,"m'), (k % 5).cast("string"), F.lit('"]'))
    return F.concat(F.lit("["), k.cast("string"), F.lit(f",{i}]"))


def _field(name: str, kind: str, always: bool, k: Column, i: int) -> Column:
    """``"name":value``, or null when the key is missing."""
    value = _value(kind, k, i)
    if not always:
        bad = {"int": '"n/a"', "num": '"n/a"', "bool": '"maybe"', "time": '"soon"'}.get(kind)
        value = F.when((k + i) % 7 == 0, F.lit("null")).when(
            (k + i) % 7 == 3, F.lit(bad) if bad else value).otherwise(value)
        value = F.when((k + i) % 7 != 1, value)
    return F.concat(F.lit(f'"{name}":'), value)


def _item(endpoint: str, k: Column) -> Column:
    tree: dict = {}
    for path, _, kind, always, i in fields(endpoint):
        node = tree
        for name in path[:-1]:
            node = node.setdefault(name, {})
        node[path[-1]] = (kind, always, i)

    def text(node) -> Column:
        parts = [F.concat(F.lit(f'"{name}":'), text(x)) if isinstance(x, dict) else _field(name, x[0], x[1], k, x[2])
                 for name, x in node.items()]
        return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))
    return text(tree)


def full_responses(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    """One response per 20 parts, one item (or result) per part."""
    p = Tables(spark, sf_dir).part.select(F.col("p_partkey").alias("k"))
    items = p.select((F.col("k") / 20).cast("bigint").alias("g"), "k", _item(endpoint, F.col("k")).alias("t"))
    rows = items.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", "t"))).alias("all")).withColumn(
        "text", F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["t"]), ","), F.lit("]")))
    g = F.col("g").cast("string")
    head = F.concat(F.lit('{"keyword":"q'), g, F.lit(
        '","datetime":"2024-02-03 04:05:06 +00:00","se_domain":"s.example","se_type":"bing","seed_keyword":"seed'), g, F.lit(
        '","location_code":2036,"language_code":"nl","check_url":"https://s.example/?q","se_results_count":"12.0",'
        '"item_types":["a","b"],"refinement_chips":{"n":1},"items":'))
    result = F.col("text") if endpoint in RESULT_ROWS else F.concat(F.lit("["), head, F.col("text"), F.lit("}]"))
    data = F.lit('{"location_code":2840,"language_code":"en","device":"desktop","os":"linux"}')
    return rows.select(F.lit(endpoint).alias("endpoint"), F.concat(F.lit("target"), g).alias("target"),
                       F.lit(0).cast("bigint").alias("offset"), envelope(rows, F.concat(F.lit("full-"), g), data, result).alias("raw"))


def duck_value(kind: str, always: bool, i: int) -> str:
    """DuckDB: the typed value that a field's column must hold."""
    k = "p_partkey"
    value = {
        "int": f"CAST({k} % 1000 * 7 + {i} AS BIGINT)",
        "num": f"({k} % 1000 + {i}) / 8.0",
        "text": f"'c{i}-' || {k}",
        "bool": f"({k} + {i}) % 2 = 0",
        "time": f"TIMESTAMP '2024-01-01 10:20:30' + INTERVAL 1 DAY * CAST(({k} + {i}) % 28 AS INTEGER)",
        "csv": f"'l{i},m' || {k} % 5",
        "json": f"'[' || {k} || ',{i}]'",
    }[kind]
    if always:
        return value
    gone = "(0, 1, 3)" if kind in ("int", "num", "bool", "time") else "(0, 1)"
    return f"CASE WHEN ({k} + {i}) % 7 IN {gone} THEN NULL ELSE {value} END"
