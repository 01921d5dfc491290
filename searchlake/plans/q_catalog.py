"""Checked queries for the catalog (E) and entity (F) operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.functions.domains import suffix_rules
from searchlake.operators import catalog as E
from searchlake.operators import entities as Fx
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import raw_domain
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.q_scalars import duck_name
from searchlake.plans.registry import register
from searchlake.sources import testviews as V
from searchlake.sources.tables import read_table

NOW = "2025-06-01 00:00:00"


def _scan(spark, d):
    inv, sto = V.table_scan(spark, d)
    return E.scan_tables(inv, sto)


SCAN_SQL = """
scan AS (SELECT g.dataset, g.table_name,
                CASE WHEN g.table_name NOT LIKE '%3' THEN g.row_count END AS row_count,
                CASE WHEN g.table_name NOT LIKE '%3' THEN g.size_bytes END AS size_bytes
         FROM v_table_groups g
         WHERE g.table_name NOT LIKE '%7' AND NOT starts_with(g.table_name, 'temp_')
           AND NOT starts_with(g.table_name, '_temp_'))"""


# ------------------------------------------------------------------ E rows
@register("e1_list_tables", W("""
SELECT * FROM v_table_catalog WHERE is_active""", "v_table_catalog"))
def q_e1(spark, d):
    return scalar_output(E.list_tables(V.table_catalog(spark, d)))


@register("e2_scan_tables", W(f"WITH {SCAN_SQL} SELECT * FROM scan", "v_table_groups"))
def q_e2(spark, d):
    return _scan(spark, d)


@register("e3_catalog_diff", W(f"""
WITH {SCAN_SQL}
SELECT coalesce(c.dataset, s.dataset) AS dataset, coalesce(c.table_name, s.table_name) AS table_name,
       CASE WHEN c.table_name IS NULL THEN 'new'
            WHEN s.table_name IS NULL AND c.is_active THEN 'deactivated'
            WHEN s.table_name IS NULL THEN 'unchanged'
            WHEN NOT c.is_active THEN 'reactivated' ELSE 'updated' END AS change
FROM v_table_catalog c FULL OUTER JOIN scan s
  ON c.dataset = s.dataset AND c.table_name = s.table_name""", "v_table_groups", "v_table_catalog"))
def q_e3(spark, d):
    return E.catalog_diff(V.table_catalog(spark, d), _scan(spark, d))


@register("e3_catalog_diff_summary", W(f"""
WITH {SCAN_SQL}
SELECT coalesce(c.dataset, s.dataset) AS dataset,
       count(*) FILTER (c.table_name IS NULL) AS new,
       count(*) FILTER (s.table_name IS NULL AND c.is_active) AS deactivated,
       count(*) FILTER (c.table_name IS NOT NULL AND s.table_name IS NOT NULL AND NOT c.is_active) AS reactivated,
       count(*) FILTER (c.table_name IS NOT NULL AND s.table_name IS NOT NULL AND c.is_active) AS updated,
       count(*) FILTER (s.table_name IS NOT NULL) AS total
FROM v_table_catalog c FULL OUTER JOIN scan s
  ON c.dataset = s.dataset AND c.table_name = s.table_name GROUP BY 1""", "v_table_groups", "v_table_catalog"))
def q_e3s(spark, d):
    return E.catalog_diff_summary(V.table_catalog(spark, d), _scan(spark, d))


@register("e4_apply_catalog_diff", W(f"""
WITH {SCAN_SQL}
SELECT coalesce(c.dataset, s.dataset) AS dataset, coalesce(c.table_name, s.table_name) AS table_name,
       CASE WHEN s.table_name IS NOT NULL THEN s.row_count ELSE c.row_count END AS row_count,
       CASE WHEN s.table_name IS NOT NULL THEN s.size_bytes ELSE c.size_bytes END AS size_bytes,
       CASE WHEN s.table_name IS NOT NULL THEN true
            WHEN coalesce(c.is_active, false) THEN false ELSE c.is_active END AS is_active,
       CASE WHEN (s.table_name IS NOT NULL AND c.table_name IS NOT NULL AND NOT coalesce(c.is_active, false))
              OR (s.table_name IS NULL AND coalesce(c.is_active, false))
            THEN TIMESTAMP '{NOW}' ELSE c.status_changed_at END AS status_changed_at,
       c.notes,
       CASE WHEN s.table_name IS NOT NULL OR coalesce(c.is_active, false) THEN TIMESTAMP '{NOW}'
            ELSE c.last_indexed_at END AS last_indexed_at
FROM v_table_catalog c FULL OUTER JOIN scan s
  ON c.dataset = s.dataset AND c.table_name = s.table_name""", "v_table_groups", "v_table_catalog"))
def q_e4(spark, d):
    return scalar_output(E.apply_catalog_diff(V.table_catalog(spark, d), _scan(spark, d), NOW))


_CLASSIFY = """CASE WHEN starts_with(lower(dataset), 'analytics_') THEN 'ga4'
       WHEN starts_with(lower(dataset), 'jepto_gsc_') THEN 'gsc'
       WHEN starts_with(lower(dataset), 'searchconsole_') THEN 'gsc'
       WHEN starts_with(lower(dataset), 'jepto_gmb_') THEN 'gmb'
       WHEN starts_with(lower(dataset), 'jepto_facebook_') THEN 'facebook' ELSE 'other' END"""


@register("e5_classify_datasets", W(f"""
SELECT part_id, dataset, {_CLASSIFY} AS dataset_type FROM v_dataset_names""", "v_dataset_names"))
def q_e5(spark, d):
    return E.classify_datasets(V.dataset_names(spark, d))


_GSC_HOST = """CASE WHEN contains(lower(dataset), '_sc_domain_') THEN
            CASE WHEN contains(dataset, '_sc_domain_') THEN
                 replace(lower(replace(split_part(dataset, '_sc_domain_', 2), '_', '.')), 'www.', '') END
       WHEN starts_with(lower(dataset), 'jepto_gsc_') THEN lower(replace(substr(dataset, 11), '_', '.'))
       WHEN starts_with(lower(dataset), 'searchconsole_') THEN lower(replace(substr(dataset, 15), '_', '.'))
  END"""


@register("e6_gsc_hostname", W(f"""
SELECT part_id, {_GSC_HOST} AS hostname FROM v_dataset_names""", "v_dataset_names"))
def q_e6(spark, d):
    return V.dataset_names(spark, d).select("part_id", E.gsc_hostname(F.col("dataset")).alias("hostname"))


def _ga4_events(spark, d):
    e = read_table(spark, d, "events")
    k = F.col("event_id")
    host = (F.when(k % 7 == 0, F.lit("Error: quota exceeded")).when(k % 7 == 1, F.lit(None))
            .otherwise(F.concat(F.lit("site"), (F.col("user_id") % 5).cast("string"), F.lit(".com"))))
    return e.select(F.concat(F.lit("analytics_"), (F.col("user_id") % 30).cast("string")).alias("dataset"),
                    host.alias("hostname"))


@register("e7_ga4_hostname", """
SELECT 'analytics_' || CAST(user_id % 30 AS VARCHAR) AS dataset,
       min(CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN NULL
                ELSE 'site' || CAST(user_id % 5 AS VARCHAR) || '.com' END) AS hostname
FROM events GROUP BY 1""")
def q_e7(spark, d):
    return E.ga4_hostname(_ga4_events(spark, d))


@register("e8_gsc_datasets", W("""
SELECT part_id, dataset FROM v_dataset_names WHERE regexp_matches(lower(dataset), '^(jepto|searchconsole)')""",
                               "v_dataset_names"))
def q_e8(spark, d):
    return E.gsc_datasets(V.dataset_names(spark, d))


@register("e9_upsert_datasets", W(f"""
WITH found AS (SELECT dataset, {_CLASSIFY} AS dataset_type, {_GSC_HOST} AS hostname
               FROM v_dataset_names WHERE part_id % 4 <> 0)
SELECT coalesce(c.dataset, f.dataset) AS dataset,
       CASE WHEN f.dataset IS NOT NULL THEN f.dataset_type ELSE c.dataset_type END AS dataset_type,
       CASE WHEN f.dataset IS NOT NULL THEN coalesce(f.hostname, c.hostname) ELSE c.hostname END AS hostname,
       c.is_standardized, c.owner,
       CASE WHEN f.dataset IS NOT NULL THEN true ELSE c.active END AS active,
       CASE WHEN f.dataset IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE c.updated_at END AS updated_at
FROM v_dataset_catalog c FULL OUTER JOIN found f ON c.dataset = f.dataset""",
                                  "v_dataset_names", "v_dataset_catalog"))
def q_e9(spark, d):
    names = V.dataset_names(spark, d).where(F.col("part_id") % 4 != 0)
    found = E.classify_datasets(names).select(
        "dataset", "dataset_type", E.gsc_hostname(F.col("dataset")).alias("hostname"))
    return scalar_output(E.upsert_datasets(V.dataset_catalog(spark, d), found, True, NOW))


@register("e9_upsert_datasets_link_path", W(f"""
WITH found AS (SELECT dataset, {_CLASSIFY} AS dataset_type, {_GSC_HOST} AS hostname
               FROM v_dataset_names WHERE part_id % 4 <> 0)
SELECT coalesce(c.dataset, f.dataset) AS dataset,
       CASE WHEN f.dataset IS NOT NULL THEN f.dataset_type ELSE c.dataset_type END AS dataset_type,
       CASE WHEN f.dataset IS NOT NULL THEN f.hostname ELSE c.hostname END AS hostname,
       c.is_standardized, c.owner,
       CASE WHEN f.dataset IS NOT NULL THEN true ELSE c.active END AS active,
       CASE WHEN f.dataset IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE c.updated_at END AS updated_at
FROM v_dataset_catalog c FULL OUTER JOIN found f ON c.dataset = f.dataset""",
                                            "v_dataset_names", "v_dataset_catalog"))
def q_e9l(spark, d):
    names = V.dataset_names(spark, d).where(F.col("part_id") % 4 != 0)
    found = E.classify_datasets(names).select(
        "dataset", "dataset_type", E.gsc_hostname(F.col("dataset")).alias("hostname"))
    return scalar_output(E.upsert_datasets(V.dataset_catalog(spark, d), found, False, NOW))


# each dataset found three times, by scans that disagree: the last type and the last known hostname count
@register("e9_upsert_datasets_found_often", W(f"""
WITH found AS (SELECT dataset, {_CLASSIFY} AS dataset_type, {_GSC_HOST} AS hostname, part_id FROM v_dataset_names WHERE part_id % 4 <> 0),
seen AS (
  SELECT dataset, 'ga4' AS dataset_type, 'first.' || part_id AS hostname, 1 AS scan FROM found UNION ALL
  SELECT dataset, 'other', CASE WHEN part_id % 3 = 0 THEN 'second.' || part_id END, 2 FROM found UNION ALL
  SELECT dataset, dataset_type, hostname, 3 FROM found),
f AS (SELECT dataset, arg_max(dataset_type, scan) FILTER (scan = 3) AS dataset_type,
             arg_max(hostname, scan) FILTER (hostname IS NOT NULL) AS hostname FROM seen GROUP BY dataset)
SELECT coalesce(c.dataset, f.dataset) AS dataset,
       CASE WHEN f.dataset IS NOT NULL THEN f.dataset_type ELSE c.dataset_type END AS dataset_type,
       CASE WHEN f.dataset IS NOT NULL THEN coalesce(f.hostname, c.hostname) ELSE c.hostname END AS hostname,
       c.is_standardized, c.owner,
       CASE WHEN f.dataset IS NOT NULL THEN true ELSE c.active END AS active,
       CASE WHEN f.dataset IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE c.updated_at END AS updated_at
FROM v_dataset_catalog c FULL OUTER JOIN f ON c.dataset = f.dataset""", "v_dataset_names", "v_dataset_catalog"))
def q_e9o(spark, d):
    names = V.dataset_names(spark, d).where(F.col("part_id") % 4 != 0)
    kinds = E.classify_datasets(names).select("dataset", "dataset_type")
    part, host = F.col("part_id").cast("string"), E.gsc_hostname(F.col("dataset"))
    found = names.select("dataset", "part_id").join(kinds, "dataset")
    seen = (found.select("dataset", F.lit("ga4").alias("dataset_type"), F.concat(F.lit("first."), part).alias("hostname"), F.lit(1).alias("scan"))
            .unionByName(found.select("dataset", F.lit("other").alias("dataset_type"),
                                      F.when(F.col("part_id") % 3 == 0, F.concat(F.lit("second."), part)).alias("hostname"), F.lit(2).alias("scan")))
            .unionByName(found.select("dataset", "dataset_type", host.alias("hostname"), F.lit(3).alias("scan"))))
    return scalar_output(E.upsert_datasets(V.dataset_catalog(spark, d), seen, True, NOW, order="scan"))


@register("e10_prune_datasets_full", W("""
SELECT * FROM v_dataset_catalog c WHERE c.dataset IN (SELECT dataset FROM v_dataset_names WHERE part_id % 8 <> 0)""",
                                       "v_dataset_names", "v_dataset_catalog"))
def q_e10f(spark, d):
    live = V.dataset_names(spark, d).where(F.col("part_id") % 8 != 0)
    return scalar_output(E.prune_datasets(V.dataset_catalog(spark, d), live, full=True))


@register("e10_prune_datasets", W(f"""
SELECT * FROM v_dataset_catalog c
WHERE NOT (c.dataset NOT IN (SELECT dataset FROM v_dataset_names WHERE part_id % 8 <> 0)
           AND ({_CLASSIFY.replace('dataset', 'c.dataset')}) <> 'other')""",
                                  "v_dataset_names", "v_dataset_catalog"))
def q_e10(spark, d):
    live = V.dataset_names(spark, d).where(F.col("part_id") % 8 != 0)
    return scalar_output(E.prune_datasets(V.dataset_catalog(spark, d), live, full=False))


@register("e11_dataset_catalog_unassigned", W("""
SELECT * FROM v_dataset_catalog WHERE dataset_type = 'ga4'
  AND dataset NOT IN (SELECT dataset_id FROM v_client_datasets)""",
                                              "v_dataset_names", "v_dataset_catalog", "v_client_datasets"))
def q_e11(spark, d):
    return scalar_output(E.dataset_catalog(V.dataset_catalog(spark, d), V.client_datasets(spark, d),
                                           "ga4", unassigned_only=True))


@register("e12_client_datasets", W("""
SELECT l.dataset_id, l.client_id, l.domain_id, l.is_active, l.notes, l.created_at, c.dataset_type, c.hostname
FROM v_client_datasets l LEFT JOIN v_dataset_catalog c ON c.dataset = l.dataset_id
WHERE l.is_active""", "v_dataset_names", "v_dataset_catalog", "v_client_datasets"))
def q_e12(spark, d):
    return scalar_output(E.client_datasets(V.client_datasets(spark, d), V.dataset_catalog(spark, d)))


@register("e13_dataset_assignment", W("""
SELECT f.client_id, f.dataset_id, c.client_name
FROM (SELECT dataset_id, min(client_id) AS client_id FROM v_client_datasets
      WHERE client_id IN (SELECT client_id FROM v_clients) GROUP BY dataset_id) f JOIN v_clients c ON c.client_id = f.client_id""",
                                      "v_dataset_names", "v_client_datasets", "v_clients"))
def q_e13(spark, d):
    return E.dataset_assignment(V.client_datasets(spark, d), V.clients(spark, d))


_E14_SQL = """
WITH lk0 AS (SELECT replace(lower(d.domain), 'www.', '') AS key, cd.client_id, d.domain_id, d.domain,
                    row_number() OVER (PARTITION BY replace(lower(d.domain), 'www.', '')
                                       ORDER BY cd.client_id, d.domain_id, d.domain) AS rn
             FROM v_client_domains cd JOIN v_domains d ON d.domain_id = cd.domain_id
             WHERE NOT cd.is_competitor AND d.is_active AND d.domain IS NOT NULL),
lk AS (SELECT key, client_id, domain_id, domain, split_part(key, '.', 1) AS first_label FROM lk0 WHERE rn = 1),
linked AS (SELECT dataset_id AS dataset, min(domain_id) AS domain_id, min(client_id) AS client_id
           FROM v_client_datasets GROUP BY 1),
open AS (SELECT * FROM v_dataset_catalog WHERE dataset NOT IN (SELECT dataset FROM linked)),
hosts AS (
  SELECT dataset, 1 AS rule, replace(lower(hostname), 'www.', '') AS h FROM open WHERE hostname IS NOT NULL
  UNION ALL
  SELECT dataset, 2, replace(lower(replace(split_part(dataset, '_sc_domain_', 2), '_', '.')), 'www.', '')
  FROM open WHERE dataset_type = 'gsc' AND contains(dataset, '_sc_domain_')
  UNION ALL
  SELECT dataset, 3, lower(replace(substr(dataset, 11), '_', '.'))
  FROM open WHERE dataset_type = 'gsc' AND starts_with(lower(dataset), 'jepto_gsc_')),
cands AS (
  SELECT h.dataset, h.rule, 0 AS sub, lk.key, lk.client_id, lk.domain_id, lk.domain
  FROM hosts h JOIN lk ON lk.key = h.h
  UNION ALL
  SELECT h.dataset, h.rule, 1, lk.key, lk.client_id, lk.domain_id, lk.domain
  FROM hosts h JOIN lk ON lk.first_label = split_part(h.h, '.', 1)
  WHERE lk.first_label = h.h OR starts_with(lk.key, h.h || '.')
  UNION ALL
  SELECT o.dataset, 4, 0, lk.key, lk.client_id, lk.domain_id, lk.domain
  FROM open o JOIN lk ON contains(replace(lower(o.dataset), '_', '.'), lk.key)
  WHERE o.dataset_type IS NULL OR o.dataset_type <> 'ga4'),
best AS (SELECT dataset, client_id, domain_id, domain, rule FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY rule, sub,
           CASE WHEN rule = 4 THEN -length(key) ELSE length(key) END, key, domain_id) AS rn
  FROM cands) x WHERE rn = 1),
known AS (SELECT l.dataset, l.client_id, l.domain_id, d.domain, 0 AS rule
          FROM linked l LEFT JOIN v_domains d ON d.domain_id = l.domain_id),
m AS (SELECT * FROM known UNION ALL SELECT * FROM best)
SELECT c.dataset, c.dataset_type, m.client_id, m.domain_id, m.domain, m.rule,
       CASE m.rule WHEN 0 THEN 'known' WHEN 1 THEN 'host' WHEN 2 THEN 'sc_domain'
                   WHEN 3 THEN 'jepto_gsc' WHEN 4 THEN 'substring' END AS match_rule,
       CASE WHEN m.rule = 0 THEN 'known' WHEN m.rule IS NOT NULL THEN 'proposed' ELSE 'unmatched' END AS status,
       CASE WHEN m.rule = 0 THEN c.hostname
            WHEN m.rule IS NOT NULL AND c.dataset_type = 'ga4' THEN replace(lower(c.hostname), 'www.', '')
            WHEN m.rule IS NOT NULL THEN m.domain
            WHEN c.dataset_type = 'ga4' THEN c.hostname END AS hostname
FROM v_dataset_catalog c LEFT JOIN m ON m.dataset = c.dataset"""


@register("e14_match_datasets", W(_E14_SQL, "v_dataset_names", "v_dataset_catalog", "v_client_datasets",
                                  "v_domains", "v_client_domains"))
def q_e14(spark, d):
    return E.match_datasets(V.dataset_catalog(spark, d), V.client_datasets(spark, d),
                            V.client_domains(spark, d), V.domains(spark, d))


_APPROVALS = """
WITH owner AS (SELECT domain_id, min(client_id) AS client_id FROM v_client_domains GROUP BY 1),
appr AS (SELECT o.client_id, p.domain_id, p.dataset AS dataset_id, p.dataset_type, p.hostname FROM (
           SELECT c.dataset, c.dataset_type, d.domain AS hostname, domain_id FROM v_dataset_catalog c JOIN v_domains d
             ON d.domain = replace(replace(split_part(lower(c.dataset), '_sc_domain_', 2), '_', '.'), 'www.', '')
           WHERE contains(lower(c.dataset), '_sc_domain_')) p JOIN owner o ON o.domain_id = p.domain_id)"""
_APPROVAL_VIEWS = ("v_dataset_names", "v_dataset_catalog", "v_client_datasets", "v_domains", "v_client_domains")


def _approved(spark, d):
    cat = V.dataset_catalog(spark, d)
    owner = V.client_domains(spark, d).groupBy("domain_id").agg(F.min("client_id").alias("client_id"))
    sc = F.replace(F.replace(F.element_at(F.split(F.lower("dataset"), "_sc_domain_", 2), 2),
                             F.lit("_"), F.lit(".")), F.lit("www."), F.lit(""))
    picks = (cat.where(F.lower("dataset").contains("_sc_domain_"))
             .select("dataset", "dataset_type", sc.alias("domain"))
             .join(V.domains(spark, d).select("domain", "domain_id"), "domain"))
    appr = picks.join(owner, "domain_id").select("client_id", "domain_id", F.col("dataset").alias("dataset_id"),
                                                 "dataset_type", F.col("domain").alias("hostname"))
    return E.approve_matches(cat, V.client_datasets(spark, d), appr, NOW)


@register("e15_approve_matches_links", W(_APPROVALS + """
SELECT client_id, domain_id, dataset_id, true AS is_active FROM appr a
WHERE NOT EXISTS (SELECT 1 FROM v_client_datasets l
                  WHERE l.client_id = a.client_id AND l.dataset_id = a.dataset_id)""", *_APPROVAL_VIEWS))
def q_e15(spark, d):
    return _approved(spark, d)[1]


@register("e15_approve_matches_catalog", W(_APPROVALS + f""",
last AS (SELECT * FROM appr QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY client_id DESC) = 1)
SELECT c.dataset, coalesce(a.dataset_type, c.dataset_type) AS dataset_type,
       CASE WHEN a.dataset_id IS NOT NULL THEN a.hostname ELSE c.hostname END AS hostname, c.is_standardized, c.owner,
       CASE WHEN a.dataset_id IS NOT NULL THEN true ELSE c.active END AS active,
       CASE WHEN a.dataset_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE c.updated_at END AS updated_at
FROM v_dataset_catalog c LEFT JOIN last a ON a.dataset_id = c.dataset""", *_APPROVAL_VIEWS))
def q_e15c(spark, d):
    return scalar_output(_approved(spark, d)[0])


@register("e15_approve_matches_count", W(_APPROVALS + " SELECT count(*) AS saved FROM appr", *_APPROVAL_VIEWS))
def q_e15n(spark, d):
    return _approved(spark, d)[2]


# ------------------------------------------------------------------ F rows
@register("f1_lookup_domains_by_text", W("""
SELECT raw, t.domain, d.domain_id FROM (
  SELECT raw, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)),
           '^.*?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':[^:]*$', '')) AS domain
  FROM (SELECT DISTINCT domain AS raw FROM v_data) r) t
LEFT JOIN v_domains d ON d.domain = t.domain""", "v_data", "v_domains"))
def q_f1(spark, d):
    texts = V.data_rows(spark, d).select(F.col("domain").alias("raw")).distinct()
    return Fx.lookup_domains_by_text(V.domains(spark, d), texts)


@register("f2_list_clients", W("""
SELECT * FROM v_clients WHERE contains(lower(client_name), '#00000012') OR contains(lower(abbreviation), '#00000012')""",
                               "v_clients"))
def q_f2(spark, d):
    return scalar_output(Fx.list_clients(V.clients(spark, d), "#00000012"))


@register("f3_client_counts", W("""
WITH l AS (SELECT cd.* FROM v_client_domains cd JOIN v_domains d ON d.domain_id = cd.domain_id WHERE d.is_active),
dc AS (SELECT client_id, count(*) FILTER (WHERE NOT is_competitor) AS domain_count,
              count(*) FILTER (WHERE is_competitor) AS competitor_count FROM l GROUP BY 1),
pc AS (SELECT client_id, count(*) AS project_count FROM v_projects GROUP BY 1)
SELECT c.client_id, c.client_name, c.abbreviation, c.is_active, c.notes, c.created_at,
       coalesce(dc.domain_count, 0) AS domain_count, coalesce(dc.competitor_count, 0) AS competitor_count,
       coalesce(pc.project_count, 0) AS project_count
FROM v_clients c LEFT JOIN dc ON dc.client_id = c.client_id LEFT JOIN pc ON pc.client_id = c.client_id""",
                                "v_clients", "v_client_domains", "v_domains", "v_projects"))
def q_f3(spark, d):
    return scalar_output(Fx.client_counts(V.clients(spark, d), V.client_domains(spark, d),
                                          V.domains(spark, d), V.projects(spark, d)))


@register("f4_search_domains", W("""
SELECT domain_id, domain, domain_name, is_active FROM v_domains
WHERE contains(lower(domain), 'supp12') ORDER BY domain_id LIMIT 10""", "v_domains"))
def q_f4(spark, d):
    return Fx.search_domains(V.domains(spark, d), "https://www.supp12.com.au/x", suffix_rules(spark), 10)


@register("f5_client_domains", W("""
SELECT cd.domain_id, cd.client_id, cd.is_competitor, cd.priority, cd.notes, d.domain, d.domain_name, d.is_active
FROM v_client_domains cd JOIN v_domains d ON d.domain_id = cd.domain_id""",
                                 "v_client_domains", "v_domains"))
def q_f5(spark, d):
    return Fx.client_domain_list(V.client_domains(spark, d), V.domains(spark, d))


@register("f6_list_projects", W("""
SELECT * FROM v_projects WHERE project_type = '1-URGENT' AND status = 'active'""", "v_projects"))
def q_f6(spark, d):
    return scalar_output(Fx.list_projects(V.projects(spark, d), project_type="1-URGENT", status="active"))


@register("f7_project_domains", W("""
SELECT pd.domain_id, pd.project_id, pd.role, pd.priority, pd.notes, d.domain, d.domain_name
FROM v_project_domains pd JOIN v_domains d ON d.domain_id = pd.domain_id""",
                                  "v_project_domains", "v_domains"))
def q_f7(spark, d):
    return Fx.project_domain_list(V.project_domains(spark, d), V.domains(spark, d))


@register("f8_add_rows", W("""
SELECT (SELECT max(client_id) FROM v_clients) + row_number() OVER (ORDER BY s_suppkey) AS client_id,
       s_name AS client_name, 'S' || CAST(s_suppkey AS VARCHAR) AS abbreviation, true AS is_active,
       CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS TIMESTAMP) AS created_at
FROM supplier""", "v_clients"))
def q_f8(spark, d):
    s = read_table(spark, d, "supplier")
    new = s.select("s_suppkey", F.col("s_name").alias("client_name"),
                   F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("abbreviation"))
    return Fx.add_rows(V.clients(spark, d), new, "client_id", ["s_suppkey"], {"is_active": True})


def _f9_batch(spark, d):
    p = read_table(spark, d, "pages").select(F.col("url").alias("raw"), F.col("page_id").alias("pos"))
    s = V.domains(spark, d).select(
        F.concat(F.lit("https://www."), F.col("domain"), F.lit("/")).alias("raw"),
        (F.lit(1_000_000) + F.col("domain_id")).alias("pos"))
    return p.unionByName(s)


_G2_SQL = ("regexp_replace(regexp_replace(regexp_extract(h, '^([^/]*)', 1), ':[^:]*$', '') || "
           "regexp_extract(h, '^[^/]*(/.*)?$', 1), '/+$', '')")
_G2_HEAD = ("regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)), '^.*?://', ''), "
            "'^www\\.', ''), '[?#].*$', '')")


@register("f9_add_domains", W(f"""
WITH batch AS (SELECT url AS raw, page_id AS pos FROM pages
               UNION ALL SELECT 'https://www.' || domain || '/', 1000000 + domain_id FROM v_domains),
c AS (SELECT {_G2_SQL} AS domain, pos FROM (SELECT {_G2_HEAD} AS h, pos FROM batch WHERE trim(raw) <> '') x),
firsts AS (SELECT domain, min(pos) AS first_pos FROM c WHERE domain <> '' GROUP BY 1),
k AS (SELECT f.domain, f.first_pos, d.domain_id FROM firsts f LEFT JOIN v_domains d ON d.domain = f.domain),
ids AS (SELECT domain, first_pos, domain_id FROM k WHERE domain_id IS NOT NULL
        UNION ALL
        SELECT domain, first_pos, (SELECT max(domain_id) FROM v_domains)
               + row_number() OVER (ORDER BY first_pos, domain) FROM k WHERE domain_id IS NULL),
flagged AS (
SELECT i.domain_id, i.domain, i.first_pos,
       EXISTS (SELECT 1 FROM v_client_domains l WHERE l.client_id = 7 AND l.domain_id = i.domain_id) AS skipped
FROM ids i)
{duck_name("flagged", "domain", "domain_id, domain, first_pos, skipped")}""", "v_domains", "v_client_domains"))
def q_f9(spark, d):
    res, _, _ = Fx.add_domains(V.domains(spark, d), V.client_domains(spark, d), _f9_batch(spark, d),
                               suffix_rules(spark), V.clients(spark, d), client_id=7)
    return res


@register("f10_patch_clients", W("""
SELECT client_id,
       CASE WHEN client_id % 10 = 0 THEN upper(client_name) ELSE client_name END AS client_name,
       abbreviation, is_active,
       CASE WHEN client_id % 20 = 0 THEN 'patched' ELSE notes END AS notes, created_at
FROM v_clients""", "v_clients"))
def q_f10(spark, d):
    c = V.clients(spark, d)
    changes = c.where(F.col("client_id") % 10 == 0).select(
        "client_id", F.upper("client_name").alias("client_name"),
        F.when(F.col("client_id") % 20 == 0, F.lit("patched")).alias("notes"))
    return scalar_output(Fx.patch(c, changes, ["client_id"]))


@register("f10_patch_priority", W("""
SELECT client_id, domain_id, is_competitor,
       CASE WHEN (client_id + domain_id) % 3 = 0 THEN 'HIGH'
            WHEN (client_id + domain_id) % 3 = 1 THEN 'NORMAL' ELSE priority END AS priority, notes
FROM v_client_domains""", "v_client_domains"))
def q_f10p(spark, d):
    cd = V.client_domains(spark, d)
    s = F.col("client_id") + F.col("domain_id")
    ch = cd.where(s % 3 != 2).select(
        "client_id", "domain_id",
        Fx.normalize_priority(F.when(s % 3 == 0, F.lit("high")).otherwise(F.lit("urgent"))).alias("priority"))
    return Fx.patch(cd, ch, ["client_id", "domain_id"])


@register("f10_patch_set_null", W("""
SELECT client_id, CASE WHEN client_id % 6 = 0 THEN upper(client_name) ELSE client_name END AS client_name,
       CASE WHEN client_id % 4 = 0 THEN NULL ELSE abbreviation END AS abbreviation, is_active,
       CASE WHEN client_id % 4 = 0 AND client_id % 6 = 0 THEN NULL ELSE notes END AS notes
FROM v_clients""", "v_clients"))
def q_f10n(spark, d):
    c = V.clients(spark, d).drop("created_at")
    k = F.col("client_id")
    nulls = F.when((k % 4 == 0) & (k % 6 == 0), F.array(F.lit("abbreviation"), F.lit("notes"))).when(
        k % 4 == 0, F.array(F.lit("abbreviation"))).otherwise(F.array().cast("array<string>"))
    changes = c.select("client_id", F.when(k % 6 == 0, F.upper("client_name")).alias("client_name"),
                       F.lit(None).cast("string").alias("abbreviation"), F.lit(None).cast("string").alias("notes"),
                       nulls.alias("to_null"))
    return Fx.patch(c, changes, ["client_id"], set_null="to_null")


# two changes of every client: the later one leaves the name alone, sets notes for some and nulls them for others
@register("f10_patch_keys_twice", W("""
SELECT client_id, 'first ' || client_name AS client_name, abbreviation, is_active,
       CASE WHEN client_id % 4 = 0 THEN NULL WHEN client_id % 3 = 0 THEN 'second' ELSE 'first' END AS notes
FROM v_clients""", "v_clients"))
def q_f10t(spark, d):
    c = V.clients(spark, d).drop("created_at")
    k = F.col("client_id")
    none = F.array().cast("array<string>")
    first = c.select("client_id", F.lit(1).alias("nth"), F.concat(F.lit("first "), "client_name").alias("client_name"),
                     F.lit("first").alias("notes"), none.alias("to_null"))
    second = c.select("client_id", F.lit(2).alias("nth"), F.lit(None).cast("string").alias("client_name"),
                      F.when(k % 3 == 0, F.lit("second")).alias("notes"),
                      F.when(k % 4 == 0, F.array(F.lit("notes"))).otherwise(none).alias("to_null"))
    return Fx.patch(c, second.unionByName(first), ["client_id"], set_null="to_null", order="nth")


@register("f10_project_status", W("""
SELECT project_id, CASE WHEN project_id % 11 = 0 THEN 'active' WHEN project_id % 5 = 0 THEN 'completed' ELSE status END AS status
FROM v_projects""", "v_projects"))
def q_f10s(spark, d):
    p = V.projects(spark, d).select("project_id", "status")
    done = Fx.set_status(p, p.where(F.col("project_id") % 5 == 0), "project_id", "status", "completed")
    return Fx.set_status(done, p.where(F.col("project_id") % 11 == 0), "project_id", "status", "active")


@register("f11_link_project_domains", W("""
SELECT DISTINCT l_orderkey AS project_id, (l_suppkey + 1) AS domain_id, 'competitor' AS role,
       'HIGH' AS priority, CAST(NULL AS VARCHAR) AS notes
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM v_project_domains p WHERE p.project_id = l.l_orderkey
                  AND p.domain_id = l.l_suppkey + 1)""", "v_project_domains"))
def q_f11(spark, d):
    li = read_table(spark, d, "lineitem")
    pairs = li.select(F.col("l_orderkey").alias("project_id"), (F.col("l_suppkey") + 1).alias("domain_id"),
                      F.lit("competitor").alias("role"), F.lit("high").alias("priority"))
    return Fx.link_project_domains(V.project_domains(spark, d), pairs)


@register("f12_delete_keys", W("""
SELECT * FROM v_client_domains WHERE (client_id + domain_id) % 3 <> 0""", "v_client_domains"))
def q_f12(spark, d):
    cd = V.client_domains(spark, d)
    keys = cd.where((F.col("client_id") + F.col("domain_id")) % 3 == 0)
    return Fx.delete_keys(cd, keys, ["client_id", "domain_id"])


_F13 = """
WITH off AS (SELECT c_custkey AS client_id FROM customer WHERE c_nationkey = 3),
newc AS (SELECT client_id, CASE WHEN client_id IN (SELECT client_id FROM off) THEN false ELSE is_active END
                AS is_active FROM v_clients),
theirs AS (SELECT DISTINCT domain_id FROM v_client_domains WHERE client_id IN (SELECT client_id FROM off)),
others AS (SELECT DISTINCT domain_id FROM v_client_domains
           WHERE client_id IN (SELECT client_id FROM newc WHERE is_active)),
orphaned AS (SELECT domain_id FROM theirs WHERE domain_id NOT IN (SELECT domain_id FROM others))"""


@register("f13_deactivate_clients_datasets", W(_F13 + """
SELECT l.client_id, l.domain_id, l.dataset_id,
       CASE WHEN l.client_id IN (SELECT client_id FROM off) THEN false ELSE l.is_active END AS is_active,
       l.notes, l.created_at
FROM v_client_datasets l""", "v_clients", "v_client_domains", "v_dataset_names", "v_client_datasets"))
def q_f13(spark, d):
    ids = read_table(spark, d, "customer").where(F.col("c_nationkey") == 3).select(
        F.col("c_custkey").alias("client_id"))
    _, _, links = Fx.deactivate_clients(V.clients(spark, d), ids, V.client_domains(spark, d),
                                        V.domains(spark, d), V.client_datasets(spark, d), cascade=True)
    return scalar_output(links)


@register("f13_deactivate_clients_no_cascade", W(_F13 + """
SELECT 'clients' AS what, count(*) FILTER (NOT is_active) AS off FROM newc
UNION ALL SELECT 'domains', count(*) FILTER (NOT is_active) FROM v_domains
UNION ALL SELECT 'datasets', count(*) FILTER (NOT is_active) FROM v_client_datasets""",
                                                 "v_clients", "v_client_domains", "v_domains", "v_dataset_names", "v_client_datasets"))
def q_f13n(spark, d):
    ids = read_table(spark, d, "customer").where(F.col("c_nationkey") == 3).select(F.col("c_custkey").alias("client_id"))
    out = Fx.deactivate_clients(V.clients(spark, d), ids, V.client_domains(spark, d), V.domains(spark, d),
                                V.client_datasets(spark, d))
    parts = [df.agg(F.count_if(~F.col("is_active")).alias("off")).select(F.lit(what).alias("what"), "off")
             for what, df in zip(("clients", "domains", "datasets"), out)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("f13_deactivate_clients_domains", W(_F13 + """
SELECT domain_id, domain, domain_name,
       CASE WHEN domain_id IN (SELECT domain_id FROM orphaned) THEN false ELSE is_active END AS is_active, notes
FROM v_domains""", "v_clients", "v_client_domains", "v_domains"))
def q_f13d(spark, d):
    ids = read_table(spark, d, "customer").where(F.col("c_nationkey") == 3).select(
        F.col("c_custkey").alias("client_id"))
    _, doms, _ = Fx.deactivate_clients(V.clients(spark, d), ids, V.client_domains(spark, d),
                                       V.domains(spark, d), V.client_datasets(spark, d), cascade=True)
    return doms


@register("f13_deactivate_clients", W(_F13 + """
SELECT * FROM newc""", "v_clients", "v_client_domains"))
def q_f13c(spark, d):
    ids = read_table(spark, d, "customer").where(F.col("c_nationkey") == 3).select(
        F.col("c_custkey").alias("client_id"))
    clients, _, _ = Fx.deactivate_clients(V.clients(spark, d), ids, V.client_domains(spark, d),
                                          V.domains(spark, d), V.client_datasets(spark, d), cascade=True)
    return clients.select("client_id", "is_active")


@register("f14_resolve_domains", W(f"""
WITH t AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN
                    CASE WHEN l_orderkey % 23 = 0 THEN l_suppkey + 1000000 ELSE l_suppkey END END AS target_id,
                  {raw_domain('l_suppkey', 'l_orderkey')} AS target
           FROM lineitem),
c AS (SELECT target_id, target, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        lower(trim(target)), '^.*?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':[^:]*$', '')) AS domain
      FROM t WHERE target_id IS NULL)
SELECT t.target_id, t.target, d.domain_id, d.domain FROM t JOIN v_domains d ON d.domain_id = t.target_id
UNION ALL
SELECT c.target_id, c.target, d.domain_id, d.domain FROM c JOIN v_domains d ON d.domain = c.domain""",
                                     "v_domains"))
def q_f14(spark, d):
    li = read_table(spark, d, "lineitem")
    ok, sk = F.col("l_orderkey"), F.col("l_suppkey")
    t = li.select(F.when(ok % 3 == 0, F.when(ok % 23 == 0, sk + 1_000_000).otherwise(sk)).alias("target_id"),
                  V.raw_domain(sk, ok).alias("target"))
    resolved, _, _ = Fx.resolve_domains(V.domains(spark, d), t)
    return resolved


@register("f14_resolve_domains_unknown_ids", """
SELECT l_suppkey + 1000000 AS target_id FROM lineitem WHERE l_orderkey % 3 = 0 AND l_orderkey % 23 = 0""")
def q_f14u(spark, d):
    li = read_table(spark, d, "lineitem")
    ok, sk = F.col("l_orderkey"), F.col("l_suppkey")
    t = li.select(F.when(ok % 3 == 0, F.when(ok % 23 == 0, sk + 1_000_000).otherwise(sk)).alias("target_id"),
                  V.raw_domain(sk, ok).alias("target"))
    _, unknown, _ = Fx.resolve_domains(V.domains(spark, d), t)
    return unknown.select("target_id")


@register("f14_resolve_domains_to_create", W(f"""
WITH t AS (SELECT {raw_domain('(l_suppkey + (l_orderkey % 2) * 500000)', 'l_orderkey')} AS target
           FROM lineitem WHERE l_orderkey % 3 <> 0),
c AS (SELECT target, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        lower(trim(target)), '^.*?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':[^:]*$', '')) AS domain FROM t)
SELECT target FROM c WHERE domain NOT IN (SELECT domain FROM v_domains)""", "v_domains"))
def q_f14c(spark, d):
    li = read_table(spark, d, "lineitem")
    ok, sk = F.col("l_orderkey"), F.col("l_suppkey")
    t = li.select(F.when(ok % 3 == 0, F.when(ok % 23 == 0, sk + 1_000_000).otherwise(sk)).alias("target_id"),
                  V.raw_domain(sk + (ok % 2) * 500000, ok).alias("target"))
    return Fx.resolve_domains(V.domains(spark, d), t)[2]


@register("f15_format_ids", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR),
       CAST(greatest((SELECT max(length(CAST(c_custkey AS VARCHAR))) FROM customer),
                     length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS formatted
FROM customer""")
def q_f15(spark, d):
    return Fx.format_ids(read_table(spark, d, "customer").select("c_custkey"), "c_custkey")


_F16 = """
WITH batch AS (SELECT DISTINCT o.o_custkey AS client_id, n.dataset AS dataset_id, 'ga4' AS dataset_type,
                      'host' || n.part_id || '.com' AS hostname, n.part_id % 100 AS domain_id, 'linked' AS notes
               FROM orders o JOIN v_dataset_names n ON n.part_id = o.o_orderkey % (SELECT count(*) FROM part)),
held AS (SELECT dataset_id, min(client_id) AS client_id FROM v_client_datasets
         WHERE client_id IN (SELECT client_id FROM v_clients) GROUP BY 1)"""
_F16_VIEWS = ("v_dataset_names", "v_dataset_catalog", "v_client_datasets", "v_clients")


def _linked(spark, d):
    parts = read_table(spark, d, "part").count()
    names = V.dataset_names(spark, d)
    batch = (read_table(spark, d, "orders").select(F.col("o_custkey").alias("client_id"), (F.col("o_orderkey") % parts).alias("part_id"))
             .join(names, "part_id").select(
                 "client_id", F.col("dataset").alias("dataset_id"), F.lit("ga4").alias("dataset_type"),
                 F.concat(F.lit("host"), F.col("part_id").cast("string"), F.lit(".com")).alias("hostname"),
                 (F.col("part_id") % 100).alias("domain_id"), F.lit("linked").alias("notes")).distinct())
    return Fx.add_client_datasets(V.client_datasets(spark, d), V.dataset_catalog(spark, d), batch, V.clients(spark, d), NOW)


@register("f16_add_client_datasets_warnings", W(_F16 + """
SELECT b.dataset_id, b.client_id, h.client_id AS held_by, c.client_name AS held_by_name
FROM batch b JOIN held h ON h.dataset_id = b.dataset_id JOIN v_clients c ON c.client_id = h.client_id""", *_F16_VIEWS))
def q_f16(spark, d):
    return _linked(spark, d)[0]


@register("f16_add_client_datasets_catalog", W(_F16 + f""",
last AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY client_id DESC, dataset_type DESC, hostname DESC) = 1)
SELECT coalesce(c.dataset, l.dataset_id) AS dataset, coalesce(l.dataset_type, c.dataset_type) AS dataset_type,
       CASE WHEN l.dataset_id IS NOT NULL THEN l.hostname ELSE c.hostname END AS hostname, c.is_standardized, c.owner,
       CASE WHEN l.dataset_id IS NOT NULL THEN true ELSE c.active END AS active,
       CASE WHEN l.dataset_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE c.updated_at END AS updated_at
FROM v_dataset_catalog c FULL OUTER JOIN last l ON l.dataset_id = c.dataset""", *_F16_VIEWS))
def q_f16c(spark, d):
    return scalar_output(_linked(spark, d)[1])


@register("f16_add_client_datasets_links", W(_F16 + """
SELECT client_id, domain_id, dataset_id, true AS is_active, notes FROM batch""", *_F16_VIEWS))
def q_f16l(spark, d):
    return _linked(spark, d)[2]
