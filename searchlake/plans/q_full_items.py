"""Checked queries: every documented field of every endpoint reaches its column."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators.flatten import flatten
from searchlake.plans.checks import scalar_output
from searchlake.plans.registry import DUCK_TYPES, register
from searchlake.schemas import ENDPOINTS
from searchlake.sources import full_items as X

#: Columns that come from the request, the task or the result, or are derived.
_G = "(p_partkey // 20)"
OUTSIDE = {
    "ranked_keywords": {"national_location_code": "CAST(2840 AS BIGINT)"},
    "backlinks": {"url": f"'target' || {_G}"},
    "bulk_pages_summary": {
        "dofollow": "coalesce(backlinks, CAST(0 AS BIGINT))", "nofollow": "CAST(0 AS BIGINT)",
        "referring_links_attributes": "CAST(NULL AS VARCHAR)"},
    "backlinks_summary": {"target_type": "'domain'"},
    "keyword_suggestions": {"se_type": "'bing'", "seed_keyword": f"'seed' || {_G}"},
    "related_keywords": {"seed_keyword": f"'seed' || {_G}", "location_code": "CAST(2036 AS BIGINT)", "language_code": "'nl'"},
    "domain_rank_overview": {"target": f"'target' || {_G}"},
    "serp_organic": {
        "keyword": f"'target' || {_G}", "serp_datetime": "TIMESTAMP '2024-02-03 04:05:06'", "se_domain": "'s.example'",
        "location_code": "CAST(2840 AS BIGINT)", "language_code": "'en'", "device": "'desktop'", "os": "'linux'",
        "se_results_count": "CAST(12 AS BIGINT)", "check_url": "'https://s.example/?q'", "item_types": "'[\"a\",\"b\"]'",
        "refinement_chips": "'{\"n\":1}'"},
}
#: Compared as parsed JSON (see ``_json_columns``).
JSON_COLUMNS = {"serp_organic": ("data", "item")}


def _sql(endpoint: str) -> str:
    inner = {column: X.duck_value(kind, always, i) for _, column, kind, always, i in X.fields(endpoint)}
    outer = OUTSIDE.get(endpoint, {})
    cols = []
    for name, _, kind in ENDPOINTS[endpoint].columns:
        if name in JSON_COLUMNS.get(endpoint, ()):
            continue
        e = name if name in inner else outer[name]
        cols.append(f"round({e}, 6) AS {name}" if kind == "double" else f"CAST({e} AS {DUCK_TYPES[kind]}) AS {name}")
    cols += [f"'full-' || {_G} AS task_id"]
    if endpoint in JSON_COLUMNS:
        cols += ["true AS item_is_whole", "true AS data_has_no_items"]
    listed = ", ".join(f"{e} AS {c}" for c, e in inner.items())
    return f"SELECT {', '.join(cols)} FROM (SELECT p_partkey, {listed} FROM part) x"


def _whole_json(df):
    """The item and data columns as checks: ``item`` holds the row's own
    values, ``data`` the result without its items."""
    field = lambda c, name: F.get_json_object(c, f"$.{name}")
    same = (field("item", "title").eqNullSafe(F.col("title")) & field("item", "url").eqNullSafe(F.col("url"))
            & field("item", "description").eqNullSafe(F.col("description")))
    clean = (field("data", "items").isNull() & (field("data", "se_domain") == "s.example")
             & (field("data", "keyword") == F.concat(F.lit("q"), F.substring(F.col("keyword"), 7, 20))))
    return df.withColumns({"item_is_whole": same, "data_has_no_items": clean}).drop("item", "data")


def _register(endpoint: str) -> None:
    def query(spark, d):
        out = flatten(X.full_responses(spark, d, endpoint), endpoint)
        return scalar_output(_whole_json(out) if endpoint in JSON_COLUMNS else out)
    register(f"b0_full_{endpoint}", _sql(endpoint))(query)


for _name in X.LAYOUT:
    _register(_name)
