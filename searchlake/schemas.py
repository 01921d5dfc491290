"""Endpoint table registry: column name, JSON path, kind.

Each endpoint table is declared once. A path is relative to the exploded
element (item or result); ``task.`` and ``result.`` prefixes address the
enclosing task and result blocks. The registry drives both the ``from_json``
read schema (all leaves as STRING) and the typed projection.

Fixed values: the JSON field names below are the remote API's response
layout and the warehouse column names; they must stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from searchlake.functions.typing import SPARK_TYPES

# Shared lineage block, in table order.
METADATA_FIELDS = [
    ("job_id", T.StringType(), False),
    ("upload_id", T.StringType(), False),
    ("ingest_timestamp", T.TimestampType(), False),
    ("domain_id", T.LongType(), True),
    ("domain", T.StringType(), True),
    ("task_id", T.StringType(), True),
    ("endpoint_mode", T.StringType(), False),
]

SENTINEL = "pending-backfill"


@dataclass(frozen=True)
class Endpoint:
    name: str                 # warehouse table name
    explode: str              # "items" (result[0].items), "results" (task.result[]),
                              # "first_items" (items of the first result that has the key)
    columns: list             # (column, path, kind)
    key: tuple = ()           # natural key (B16)
    required: tuple = ()      # rows lacking any of these raw values are dropped
    nonempty: tuple = ()      # ... and these must also be non-empty text
    fallbacks: dict = field(default_factory=dict)  # column -> (path, mode)
    # mode: "null" (null or missing), "missing" (item key absent only),
    # "missing_res" (result key absent only), "falsy" (null or "").
    # A fallback path may be "$target" (the requested target) or "$lit:<text>".
    skip_empty_items: bool = False  # null or {} items give no row
    as_text: tuple = ()  # columns whose numbers may also come as JSON text ("12.0")

    def spark_schema(self, with_task_id: bool = True) -> T.StructType:
        fields = [T.StructField(c, SPARK_TYPES[k], True) for c, _, k in self.columns]
        if with_task_id:
            fields.append(T.StructField("task_id", T.StringType(), True))
        return T.StructType(fields)

    def table_schema(self) -> T.StructType:
        body = [T.StructField(c, SPARK_TYPES[k], True) for c, _, k in self.columns]
        meta = [T.StructField(n, t, nl) for n, t, nl in METADATA_FIELDS]
        return T.StructType(meta + body)

    def kinds(self) -> dict[str, str]:
        return {c: k for c, _, k in self.columns}


def _cols(spec: str) -> list:
    """Parse ``name path kind`` lines (path ``=`` means same as name)."""
    out = []
    for line in spec.strip().splitlines():
        name, path, kind = line.split()
        out.append((name, name if path == "=" else path, kind))
    return out


RANKED_KEYWORDS = Endpoint(
    name="ranked_keywords",
    explode="items",
    key=("keyword", "job_id", "upload_id", "domain", "national_location_code"),
    required=("keyword", "rank", "url", "search_volume"),
    nonempty=("keyword", "url"),
    as_text=("search_volume",),
    columns=_cols("""
keyword keyword_data.keyword string
rank ranked_serp_element.serp_item.rank_group bigint
url ranked_serp_element.serp_item.url string
search_volume keyword_data.keyword_info.search_volume bigint
keyword_difficulty keyword_data.keyword_properties.keyword_difficulty bigint
national_location_code task.data.location_code bigint
traffic_volume ranked_serp_element.serp_item.etv double
keyword_location_code keyword_data.location_code bigint
language_code keyword_data.language_code string
main_domain ranked_serp_element.serp_item.main_domain string
cpc keyword_data.keyword_info.cpc double
low_top_of_page_bid keyword_data.keyword_info.low_top_of_page_bid double
high_top_of_page_bid keyword_data.keyword_info.high_top_of_page_bid double
competition keyword_data.keyword_info.competition double
competition_level keyword_data.keyword_info.competition_level string
categories keyword_data.keyword_info.categories json
monthly_searches keyword_data.keyword_info.monthly_searches json
search_volume_trend_monthly keyword_data.keyword_info.search_volume_trend.monthly double
search_volume_trend_quarterly keyword_data.keyword_info.search_volume_trend.quarterly double
search_volume_trend_yearly keyword_data.keyword_info.search_volume_trend.yearly double
keyword_info_last_updated_time keyword_data.keyword_info.last_updated_time timestamp
core_keyword keyword_data.keyword_properties.core_keyword string
detected_language keyword_data.keyword_properties.detected_language string
is_another_language keyword_data.keyword_properties.is_another_language boolean
rank_absolute ranked_serp_element.serp_item.rank_absolute bigint
position ranked_serp_element.serp_item.position string
serp_keyword_difficulty ranked_serp_element.keyword_difficulty bigint
serp_item_types keyword_data.serp_info.serp_item_types json
se_results_count keyword_data.serp_info.se_results_count bigint
main_intent keyword_data.search_intent_info.main_intent string
foreign_intent keyword_data.search_intent_info.foreign_intent csv
search_intent_last_updated_time keyword_data.search_intent_info.last_updated_time timestamp
avg_backlinks keyword_data.avg_backlinks_info.backlinks double
avg_referring_domains keyword_data.avg_backlinks_info.referring_domains double
avg_referring_main_domains keyword_data.avg_backlinks_info.referring_main_domains double
avg_rank keyword_data.avg_backlinks_info.rank double
avg_main_domain_rank keyword_data.avg_backlinks_info.main_domain_rank double
avg_backlinks_last_updated_time keyword_data.avg_backlinks_info.last_updated_time timestamp
serp_item_type ranked_serp_element.serp_item.type string
serp_item_title ranked_serp_element.serp_item.title string
serp_item_description ranked_serp_element.serp_item.description string
is_featured_snippet ranked_serp_element.serp_item.is_featured_snippet boolean
estimated_paid_traffic_cost ranked_serp_element.serp_item.estimated_paid_traffic_cost double
previous_rank_absolute ranked_serp_element.serp_item.rank_changes.previous_rank_absolute bigint
rank_is_new ranked_serp_element.serp_item.rank_changes.is_new boolean
rank_is_up ranked_serp_element.serp_item.rank_changes.is_up boolean
rank_is_down ranked_serp_element.serp_item.rank_changes.is_down boolean
serp_item_referring_domains ranked_serp_element.serp_item.backlinks_info.referring_domains bigint
serp_item_referring_main_domains ranked_serp_element.serp_item.backlinks_info.referring_main_domains bigint
serp_item_backlinks ranked_serp_element.serp_item.backlinks_info.backlinks bigint
serp_item_page_rank ranked_serp_element.serp_item.rank_info.page_rank bigint
serp_item_main_domain_rank ranked_serp_element.serp_item.rank_info.main_domain_rank bigint
is_lost ranked_serp_element.is_lost boolean
"""),
)

SEARCH_VOLUME = Endpoint(
    name="search_volume",
    explode="results",
    key=("keyword", "location_code"),
    required=("keyword",),
    nonempty=("keyword",),
    fallbacks={"location_code": ("task.data.location_code", "null")},
    columns=_cols("""
keyword = string
search_volume = bigint
location_code = bigint
cpc = double
competition = string
competition_index = bigint
low_top_of_page_bid = double
high_top_of_page_bid = double
monthly_searches = json
"""),
)

SEARCH_INTENT = Endpoint(
    name="search_intent",
    explode="items",
    key=("keyword", "language_code"),
    fallbacks={"language_code": ("result.language_code", "missing")},
    columns=_cols("""
keyword = string
search_intent keyword_intent.label string
intent_probability keyword_intent.probability double
secondary_keyword_intents = json
language_code = string
"""),
)

BACKLINKS_SUMMARY = Endpoint(
    name="backlinks_summary",
    explode="results",
    key=("target",),
    fallbacks={"target": ("$target", "falsy")},
    columns=_cols("""
target = string
target_type $derived string
rank = bigint
backlinks = bigint
backlinks_spam_score = bigint
target_spam_score info.target_spam_score bigint
crawled_pages = bigint
referring_domains = bigint
referring_domains_nofollow = bigint
referring_main_domains = bigint
referring_main_domains_nofollow = bigint
referring_ips = bigint
referring_subnets = bigint
referring_pages = bigint
referring_pages_nofollow = bigint
referring_links_tld = json
referring_links_types = json
referring_links_attributes = json
referring_links_platform_types = json
referring_links_semantic_locations = json
referring_links_countries = json
internal_links_count = bigint
external_links_count = bigint
broken_backlinks = bigint
broken_pages = bigint
first_seen = timestamp
lost_date = timestamp
"""),
)

SERP_ORGANIC = Endpoint(
    name="serp_organic",
    explode="items",
    key=("task_id", "rank_absolute", "item_type"),
    columns=_cols("""
keyword $target string
serp_datetime result.datetime timestamp
se_domain result.se_domain string
location_code task.data.location_code bigint
language_code task.data.language_code string
device task.data.device string
os task.data.os string
se_results_count result.se_results_count bigint
check_url result.check_url string
item_types result.item_types json
refinement_chips result.refinement_chips json
item_type type string
rank_group = bigint
rank_absolute = bigint
page = bigint
position = string
url = string
title = string
description = string
data $result_data json
item $item_json json
"""),
)

BACKLINKS = Endpoint(
    name="backlinks",
    explode="items",
    key=("url_from", "backlink_to", "item_type", "anchor"),
    columns=_cols("""
url $target string
type = string
item_type = string
attributes = json
original = boolean
domain_from = string
url_from = string
url_from_https = boolean
tld_from = string
domain_from_rank = bigint
domain_from_platform_type = json
domain_from_is_ip = boolean
domain_from_ip = string
domain_from_country = string
domain_to = string
backlink_to url_to string
backlink_to_https url_to_https boolean
backlink_to_status_code url_to_status_code bigint
backlink_to_spam_score url_to_spam_score bigint
backlink_to_redirect_target url_to_redirect_target string
dofollow = boolean
backlink_spam_score = bigint
is_broken = boolean
is_indirect_link = boolean
indirect_link_path = json
anchor = string
alt = string
image_url = string
text_pre = string
text_post = string
semantic_location = string
first_seen = timestamp
prev_seen = timestamp
last_seen = timestamp
is_new = boolean
is_lost = boolean
rank = bigint
page_from_rank = bigint
page_from_keywords_count_top_3 ranked_keywords_info.page_from_keywords_count_top_3 bigint
page_from_keywords_count_top_10 ranked_keywords_info.page_from_keywords_count_top_10 bigint
page_from_keywords_count_top_100 ranked_keywords_info.page_from_keywords_count_top_100 bigint
page_from_title = string
page_from_status_code = bigint
page_from_external_links = bigint
page_from_internal_links = bigint
page_from_size = bigint
page_from_encoding = string
page_from_language = string
links_count = bigint
group_count = bigint
"""),
)

BULK_PAGES = Endpoint(
    name="bulk_pages_summary",
    explode="items",
    key=("url",),
    skip_empty_items=True,
    columns=_cols("""
url = string
backlinks = bigint
referring_domains = bigint
referring_domains_nofollow = bigint
referring_main_domains = bigint
referring_main_domains_nofollow = bigint
rank = bigint
main_domain_rank = bigint
spam_score backlinks_spam_score double
referring_ips = bigint
referring_subnets = bigint
referring_pages = bigint
referring_pages_nofollow = bigint
dofollow $derived bigint
nofollow $derived bigint
referring_links_attributes = json
broken_backlinks = bigint
broken_pages = bigint
first_seen = timestamp
lost_date = timestamp
"""),
)

KEYWORD_SUGGESTIONS = Endpoint(
    name="keyword_suggestions",
    explode="first_items",
    key=("seed_keyword", "keyword", "location_code", "language_code"),
    required=("keyword",),
    nonempty=("keyword",),
    fallbacks={
        "se_type": ("$lit:google", "missing_res"),
        "seed_keyword": ("$target", "missing_res"),
        "keyword": ("keyword_data.keyword", "falsy"),
        "location_code": ("result.location_code", "missing"),
        "language_code": ("result.language_code", "missing"),
    },
    columns=_cols("""
se_type result.se_type string
seed_keyword result.seed_keyword string
keyword = string
location_code = bigint
language_code = string
search_volume keyword_info.search_volume bigint
competition keyword_info.competition double
competition_level keyword_info.competition_level string
cpc keyword_info.cpc double
low_top_of_page_bid keyword_info.low_top_of_page_bid double
high_top_of_page_bid keyword_info.high_top_of_page_bid double
categories keyword_info.categories json
monthly_searches keyword_info.monthly_searches json
search_volume_trend_monthly keyword_info.search_volume_trend.monthly double
search_volume_trend_quarterly keyword_info.search_volume_trend.quarterly double
search_volume_trend_yearly keyword_info.search_volume_trend.yearly double
keyword_info_last_updated_time keyword_info.last_updated_time timestamp
core_keyword keyword_properties.core_keyword string
keyword_difficulty keyword_properties.keyword_difficulty bigint
detected_language keyword_properties.detected_language string
is_another_language keyword_properties.is_another_language boolean
words_count keyword_properties.words_count bigint
main_intent search_intent_info.main_intent string
foreign_intent search_intent_info.foreign_intent csv
search_intent_last_updated_time search_intent_info.last_updated_time timestamp
avg_backlinks avg_backlinks_info.backlinks double
avg_dofollow avg_backlinks_info.dofollow double
avg_referring_pages avg_backlinks_info.referring_pages double
avg_referring_domains avg_backlinks_info.referring_domains double
avg_referring_main_domains avg_backlinks_info.referring_main_domains double
avg_rank avg_backlinks_info.rank double
avg_main_domain_rank avg_backlinks_info.main_domain_rank double
avg_backlinks_last_updated_time avg_backlinks_info.last_updated_time timestamp
"""),
)

RELATED_KEYWORDS = Endpoint(
    name="related_keywords",
    explode="items",
    key=("task_id", "related_keyword", "depth"),
    fallbacks={
        "seed_keyword": ("$target", "missing_res"),
        "related_keyword": ("keyword", "falsy"),
    },
    columns=_cols("""
seed_keyword result.seed_keyword string
related_keyword keyword_data.keyword string
depth = bigint
location_code result.location_code bigint
language_code result.language_code string
search_volume keyword_data.keyword_info.search_volume bigint
cpc keyword_data.keyword_info.cpc double
competition keyword_data.keyword_info.competition double
competition_level keyword_data.keyword_info.competition_level string
low_top_of_page_bid keyword_data.keyword_info.low_top_of_page_bid double
high_top_of_page_bid keyword_data.keyword_info.high_top_of_page_bid double
monthly_searches keyword_data.keyword_info.monthly_searches json
search_volume_trend_monthly keyword_data.keyword_info.search_volume_trend.monthly double
search_volume_trend_quarterly keyword_data.keyword_info.search_volume_trend.quarterly double
search_volume_trend_yearly keyword_data.keyword_info.search_volume_trend.yearly double
keyword_info_last_updated_time keyword_data.keyword_info.last_updated_time timestamp
core_keyword keyword_data.keyword_properties.core_keyword string
keyword_difficulty keyword_data.keyword_properties.keyword_difficulty bigint
detected_language keyword_data.keyword_properties.detected_language string
is_other_language keyword_data.keyword_properties.is_another_language boolean
serp_item_types keyword_data.serp_info.serp_item_types json
se_results_count keyword_data.serp_info.se_results_count bigint
serp_last_updated_time keyword_data.serp_info.last_updated_time timestamp
serp_info_check_url keyword_data.serp_info.check_url string
serp_info_previous_updated_time keyword_data.serp_info.previous_updated_time timestamp
backlinks keyword_data.avg_backlinks_info.backlinks double
dofollow keyword_data.avg_backlinks_info.dofollow double
referring_pages keyword_data.avg_backlinks_info.referring_pages double
referring_domains keyword_data.avg_backlinks_info.referring_domains double
referring_main_domains keyword_data.avg_backlinks_info.referring_main_domains double
main_domain_rank keyword_data.avg_backlinks_info.main_domain_rank double
avg_rank keyword_data.avg_backlinks_info.rank double
avg_backlinks_last_updated_time keyword_data.avg_backlinks_info.last_updated_time timestamp
search_intent_main keyword_data.search_intent_info.main_intent string
foreign_intent keyword_data.search_intent_info.foreign_intent csv
search_intent_last_updated_time keyword_data.search_intent_info.last_updated_time timestamp
related_keywords = json
"""),
)

KEYWORD_OVERVIEW = Endpoint(
    name="keyword_overview",
    explode="items",
    key=("keyword", "location_code", "language_code"),
    fallbacks={"language_code": ("result.language_code", "missing")},
    columns=_cols("""
keyword = string
location_code = bigint
language_code = string
search_volume keyword_info.search_volume bigint
competition keyword_info.competition double
competition_level keyword_info.competition_level string
cpc keyword_info.cpc double
low_top_of_page_bid keyword_info.low_top_of_page_bid double
high_top_of_page_bid keyword_info.high_top_of_page_bid double
categories keyword_info.categories json
monthly_searches keyword_info.monthly_searches json
search_volume_trend_monthly keyword_info.search_volume_trend.monthly double
search_volume_trend_quarterly keyword_info.search_volume_trend.quarterly double
search_volume_trend_yearly keyword_info.search_volume_trend.yearly double
keyword_info_last_updated_time keyword_info.last_updated_time timestamp
core_keyword keyword_properties.core_keyword string
keyword_difficulty keyword_properties.keyword_difficulty bigint
detected_language keyword_properties.detected_language string
is_another_language keyword_properties.is_another_language boolean
main_intent search_intent_info.main_intent string
foreign_intent search_intent_info.foreign_intent csv
search_intent_last_updated_time search_intent_info.last_updated_time timestamp
avg_backlinks avg_backlinks_info.backlinks double
avg_dofollow avg_backlinks_info.dofollow double
avg_referring_pages avg_backlinks_info.referring_pages double
avg_referring_domains avg_backlinks_info.referring_domains double
avg_referring_main_domains avg_backlinks_info.referring_main_domains double
avg_rank avg_backlinks_info.rank double
avg_main_domain_rank avg_backlinks_info.main_domain_rank double
avg_backlinks_last_updated_time avg_backlinks_info.last_updated_time timestamp
"""),
)

_ORGANIC_POS = ["1", "2_3", "4_10", "11_20", "21_30", "31_40", "41_50", "51_60", "61_70",
                "71_80", "81_90", "91_100"]

DOMAIN_RANK = Endpoint(
    name="domain_rank_overview",
    explode="items",
    key=("target", "location_code", "language_code"),
    columns=_cols("""
target $target string
location_code = bigint
language_code = string
organic_count metrics.organic.count bigint
organic_etv metrics.organic.etv double
organic_estimated_paid_traffic_cost metrics.organic.estimated_paid_traffic_cost double
organic_is_new metrics.organic.is_new bigint
organic_is_up metrics.organic.is_up bigint
organic_is_down metrics.organic.is_down bigint
organic_is_lost metrics.organic.is_lost bigint
""") + [(f"organic_pos_{b}", f"metrics.organic.pos_{b}", "bigint") for b in _ORGANIC_POS] + _cols("""
paid_count metrics.paid.count bigint
paid_etv metrics.paid.etv double
paid_estimated_paid_traffic_cost metrics.paid.estimated_paid_traffic_cost double
paid_is_new metrics.paid.is_new bigint
paid_is_up metrics.paid.is_up bigint
paid_is_down metrics.paid.is_down bigint
paid_is_lost metrics.paid.is_lost bigint
"""),
)

ENDPOINTS = {e.name: e for e in (
    SERP_ORGANIC, BACKLINKS, BULK_PAGES, BACKLINKS_SUMMARY, RANKED_KEYWORDS,
    KEYWORD_SUGGESTIONS, RELATED_KEYWORDS, KEYWORD_OVERVIEW, SEARCH_INTENT, DOMAIN_RANK,
    SEARCH_VOLUME)}
