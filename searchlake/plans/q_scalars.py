"""Checked queries for the scalar domain / URL / name functions (G rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.functions import domains as G
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.registry import register
from searchlake.sources import testviews as V
from searchlake.sources.tables import read_table

def _duck_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


_RULES = G.read_suffix_list()
_MOST = max(r.lstrip("!").removeprefix("*.").count(".") + 1 for r in _RULES)
_KINDS = {
    "plain": {r for r in _RULES if not r.startswith(("!", "*."))},
    "wild": {r[2:] for r in _RULES if r.startswith("*.")},
    "exception": {r[1:] for r in _RULES if r.startswith("!")},
}


def duck_host(url: str) -> str:
    return (f"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace({url}, "
            "'^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[/?#].*$', ''), '^.*@', ''), ':[0-9]*$', ''))")


def duck_suffix_k(host: str) -> str:
    """DuckDB: labels in the public suffix (0 when none)."""
    labels = f"string_split({host}, '.')"
    n = f"len({labels})"
    k = {kind: "0" for kind in _KINDS}
    for size in range(1, _MOST + 1):
        cand = f"array_to_string({labels}[{n}-{size}+1:{n}], '.')"
        for kind, least, take in (("plain", size, size), ("wild", size + 1, size + 1), ("exception", size, size - 1)):
            by_size = {r for r in _KINDS[kind] if r.count(".") + 1 == size}
            if by_size:
                k[kind] = f"CASE WHEN {n} >= {least} AND list_contains({_duck_list(by_size)}, {cand}) THEN {take} ELSE {k[kind]} END"
    return f"CASE WHEN ({k['exception']}) > 0 THEN ({k['exception']}) ELSE greatest({k['plain']}, {k['wild']}) END"


def _duck_title(s: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(" + s +
            ", '(\\p{L}+|\\P{L}+)', 1), lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')")


_G1 = ("trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), "
       "'^.*?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':[^:]*$', ''))")


@register("g1_clean_domain", f"SELECT page_id, {_G1} AS domain FROM pages")
def q_g1(spark, d):
    p = read_table(spark, d, "pages")
    return p.select("page_id", G.clean_domain(F.col("url")).alias("domain"))


@register("g1_clean_domain_data", W("""
SELECT upload_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         lower(trim(domain)), '^.*?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':[^:]*$', '')) AS clean
FROM v_data""", "v_data"))
def q_g1d(spark, d):
    return V.data_rows(spark, d).select("upload_id", G.clean_domain(F.col("domain")).alias("clean"))


_G2_HEAD = "regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^.*?://', ''), '^www\\.', ''), '[?#].*$', '')"


@register("g2_clean_domain_keep_path", f"""
SELECT page_id, regexp_replace(
         regexp_replace(regexp_extract(h, '^([^/]*)', 1), ':[^:]*$', '') ||
         regexp_extract(h, '^[^/]*(/.*)?$', 1), '/+$', '') AS domain_path
FROM (SELECT page_id, {_G2_HEAD} AS h FROM pages) x""")
def q_g2(spark, d):
    p = read_table(spark, d, "pages")
    return p.select("page_id", G.clean_domain_keep_path(F.col("url")).alias("domain_path"))


@register("g3_normalize_domain_sql", W("""
SELECT upload_id, lower(regexp_replace(regexp_replace(regexp_replace(domain,
         '^(https?://)?(www\\.)?', ''), '/+$', ''), '\\s+', '', 'g')) AS norm
FROM v_data""", "v_data"))
def q_g3(spark, d):
    return V.data_rows(spark, d).select("upload_id", G.normalize_domain_sql(F.col("domain")).alias("norm"))


@register("g4_normalize_domain_review", W("""
SELECT upload_id, coalesce(lower(regexp_replace(regexp_replace(regexp_replace(trim(domain),
         '(?i)^(?:https?://)?(?:www\\.)?', ''), '/+$', ''), '\\s+', '', 'g')), '') AS norm
FROM v_data""", "v_data"))
def q_g4(spark, d):
    return V.data_rows(spark, d).select("upload_id",
                                        G.normalize_domain_review(F.col("domain")).alias("norm"))


def duck_name(source: str, text: str, keep: str) -> str:
    """DuckDB: ``keep`` columns and the display name of ``text`` over ``source``."""
    pick = "CASE WHEN k > 0 AND len(labels) > k AND labels[len(labels) - k] <> '' THEN labels[len(labels) - k] ELSE fallback END"
    named = _duck_title(f"translate({pick}, '-_', '  ')")
    return f"""
SELECT {keep}, {named} AS domain_name
FROM (SELECT *, string_split(host, '.') AS labels, {duck_suffix_k('host')} AS k,
             string_split(replace(lower({text}), 'www.', ''), '.')[1] AS fallback
      FROM (SELECT *, {duck_host(text)} AS host FROM {source}) a) b"""


# one domain of every kind of rule: plain, two labels, wildcard, exception,
# four labels, a bare suffix, an unknown one
SUFFIX_CASES = ["com", "eu", "co.uk", "co.il", "com.tr", "ck", "www.ck", "kawasaki.jp", "x.kawasaki.jp",
                "city.kawasaki.jp", "pvt.k12.ma.us", "nosuchtld"]
_CASE_SQL = (f"(SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'shop-' || s_suppkey || '.' END || "
             f"([{', '.join(repr(c) for c in SUFFIX_CASES)}])[s_suppkey % {len(SUFFIX_CASES)} + 1] AS domain FROM supplier) AS cases")


def _suffix_cases(spark, d):
    k = F.col("s_suppkey")
    return read_table(spark, d, "supplier").select(k, F.concat(
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("shop-"), k.cast("string"), F.lit("."))),
        F.get(F.array(*[F.lit(c) for c in SUFFIX_CASES]), (k % len(SUFFIX_CASES)).cast("int"))).alias("domain"))


@register("g5_domain_to_name", duck_name(_CASE_SQL, "domain", "s_suppkey, domain"))
def q_g5(spark, d):
    return G.domain_to_name(_suffix_cases(spark, d), "domain", G.suffix_rules(spark))


_REGISTERED = f"""
SELECT id, url,
  CASE WHEN k > 0 AND NOT regexp_matches(host, '^[0-9]+(\\.[0-9]+){{3}}$')
       THEN CASE WHEN len(labels) > k THEN labels[len(labels) - k] ELSE '' END || '.' ||
            array_to_string(labels[len(labels)-k+1:len(labels)], '.')
       ELSE (CASE WHEN regexp_matches(host, '^[0-9]+(\\.[0-9]+){{3}}$') THEN host ELSE labels[len(labels)] END) || '.'
  END AS registered
FROM (SELECT id, url, host, string_split(host, '.') AS labels, {duck_suffix_k('host')} AS k
      FROM (SELECT *, {duck_host('url')} AS host FROM (
        SELECT page_id AS id, url FROM pages
        UNION ALL SELECT -1 - s_suppkey, 'https://u@www.' || domain || ':8080/p' FROM {_CASE_SQL}) u) a) b"""


@register("g6_registered_domain", _REGISTERED)
def q_g6(spark, d):
    p = read_table(spark, d, "pages").select(F.col("page_id").alias("id"), "url")
    cases = _suffix_cases(spark, d).select((-1 - F.col("s_suppkey")).alias("id"), F.concat(
        F.lit("https://u@www."), F.col("domain"), F.lit(":8080/p")).alias("url"))
    return G.registered_domain(p.unionByName(cases), "url", G.suffix_rules(spark))


@register("g7_url_path", """
SELECT page_id, CASE WHEN p = '' THEN '/' ELSE p END AS path
FROM (SELECT page_id, regexp_extract(regexp_replace(regexp_replace(url,
        '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//[^/?#]*', ''), '^([^?#]*)', 1) AS p FROM pages) x""")
def q_g7(spark, d):
    p = read_table(spark, d, "pages")
    return p.select("page_id", G.url_path(F.col("url")).alias("path"))


@register("g8_endpoint_slug", W("""
SELECT event_id, CASE WHEN s = '' THEN 'unknown' ELSE s END AS slug FROM (
  SELECT event_id, array_to_string(
    CASE WHEN stop = 0 THEN parts ELSE parts[1:stop-1] END, '-') AS s
  FROM (SELECT event_id, parts,
               coalesce(list_position(list_transform(parts,
                   lambda p: length(p) = 36 AND len(string_split(p, '-')) = 5), true), 0) AS stop
        FROM (SELECT event_id, list_filter(string_split(
                 CASE WHEN position('/v3/' IN url) > 0 THEN substr(url, position('/v3/' IN url) + 4)
                      ELSE url END, '/'), lambda p: p <> '') AS parts
              FROM v_api_urls) a) b) c""", "v_api_urls"))
def q_g8(spark, d):
    return V.api_urls(spark, d).select("event_id", G.endpoint_slug(F.col("url")).alias("slug"))


@register("g9_project_domain_name", """
SELECT p_partkey, regexp_replace(
  replace(p_name, ' ', '_') || CASE WHEN p_partkey % 2 = 0 THEN '_' || CAST(p_partkey AS VARCHAR) ELSE '' END,
  '_[0-9]+$', '') AS name
FROM part""")
def q_g9(spark, d):
    p = read_table(spark, d, "part")
    raw = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")),
                   F.when(F.col("p_partkey") % 2 == 0,
                          F.concat(F.lit("_"), F.col("p_partkey").cast("string"))).otherwise(F.lit("")))
    return p.select("p_partkey", G.project_domain_name(raw).alias("name"))
