"""Table and dataset catalog (E1-E15): scan, diff, classify, upsert, match.

A catalog refresh is one full outer join of the catalog snapshot with the
scan: the same join yields the change summary and the next snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.session import written

# Dataset type prefixes, in lookup order.
DEFAULT_DATASET_PREFIXES = [
    ("ga4", "analytics_"),
    ("gsc", "jepto_gsc_"),
    ("gsc", "searchconsole_"),
    ("gmb", "jepto_gmb_"),
    ("facebook", "jepto_facebook_"),
]


def list_tables(catalog: DataFrame, dataset: str | None = None, active_only: bool = True) -> DataFrame:
    """Catalog rows by filter, ordered."""
    df = catalog
    if dataset is not None:
        df = df.where(F.col("dataset") == dataset)
    if active_only:
        df = df.where(F.col("is_active"))
    return df.orderBy("dataset", "table_name")


def scan_tables(inventory: DataFrame, storage: DataFrame) -> DataFrame:
    """Base tables with their row and byte counts; ``temp_`` and
    ``_temp_`` names left out."""
    base = inventory.where((F.col("table_type") == "BASE TABLE")
                           & ~F.col("table_name").startswith("temp_")
                           & ~F.col("table_name").startswith("_temp_"))
    return base.select("dataset", "table_name").join(
        storage.select("dataset", "table_name", "row_count", "size_bytes"),
        ["dataset", "table_name"], "left")


def _diff(catalog: DataFrame, scan: DataFrame) -> DataFrame:
    c = catalog.select("dataset", "table_name", F.col("is_active").alias("_was_active"),
                       F.lit(True).alias("_in_cat"))
    s = scan.select("dataset", "table_name", F.lit(True).alias("_in_scan"))
    j = c.join(s, ["dataset", "table_name"], "full_outer")
    change = (F.when(F.col("_in_cat").isNull(), F.lit("new"))
              .when(F.col("_in_scan").isNull() & F.col("_was_active"), F.lit("deactivated"))
              .when(F.col("_in_scan").isNull(), F.lit("unchanged"))
              .when(~F.col("_was_active"), F.lit("reactivated"))
              .otherwise(F.lit("updated")))
    return j.withColumn("change", change)


def catalog_diff(catalog: DataFrame, scan: DataFrame) -> DataFrame:
    """Per table: new (scan - catalog), deactivated (active - scan),
    reactivated (inactive and scanned), updated (active and scanned)."""
    return _diff(catalog, scan).select("dataset", "table_name", "change")


def catalog_diff_summary(catalog: DataFrame, scan: DataFrame) -> DataFrame:
    d = _diff(catalog, scan)
    return d.groupBy("dataset").agg(
        *[F.count_if(F.col("change") == c).alias(c) for c in
          ("new", "deactivated", "reactivated", "updated")],
        F.count_if(F.col("_in_scan").isNotNull()).alias("total"))


def apply_catalog_diff(catalog: DataFrame, scan: DataFrame, now) -> DataFrame:
    """The next catalog snapshot. Scanned tables take rows and bytes, are
    active and indexed now; ``status_changed_at`` moves only when an
    inactive table turns active again (a new table has none yet) or an
    active one is turned off (also indexed now); other tables stay
    untouched."""
    now_c = F.lit(now).cast("timestamp")
    s = scan.select("dataset", "table_name", F.col("row_count").alias("_rows"),
                    F.col("size_bytes").alias("_bytes"), F.lit(True).alias("_in_scan"))
    j = catalog.withColumn("_in_cat", F.lit(True)).join(s, ["dataset", "table_name"], "full_outer")
    in_scan = F.col("_in_scan").isNotNull()
    was = F.coalesce(F.col("is_active"), F.lit(False))
    turned_on = in_scan & F.col("_in_cat").isNotNull() & ~was
    turned_off = ~in_scan & was
    return j.select(
        "dataset", "table_name",
        F.when(in_scan, F.col("_rows")).otherwise(F.col("row_count")).alias("row_count"),
        F.when(in_scan, F.col("_bytes")).otherwise(F.col("size_bytes")).alias("size_bytes"),
        F.when(in_scan, F.lit(True)).when(turned_off, F.lit(False))
         .otherwise(F.col("is_active")).alias("is_active"),
        F.when(turned_on | turned_off, now_c).otherwise(F.col("status_changed_at")).alias("status_changed_at"),
        F.col("notes"),
        F.when(in_scan | turned_off, now_c).otherwise(F.col("last_indexed_at")).alias("last_indexed_at"),
    )


def classify_dataset(name: Column, prefixes=DEFAULT_DATASET_PREFIXES, full: bool = True) -> Column:
    """E5: type of the first prefix (case-insensitive, in order) the name
    starts with; else ``other`` when ``full`` (null means: leave it out)."""
    low = F.lower(name)
    e = None
    for typ, pre in prefixes:
        cond = low.startswith(pre.lower())
        e = F.when(cond, F.lit(typ)) if e is None else e.when(cond, F.lit(typ))
    return e.otherwise(F.lit("other") if full else F.lit(None))


def classify_datasets(names: DataFrame, col: str = "dataset", prefixes=DEFAULT_DATASET_PREFIXES,
                      full: bool = True) -> DataFrame:
    """E5: each dataset name with its type (first matching prefix, any
    case); unknown names are ``other`` when ``full``, else left out."""
    out = names.withColumn("dataset_type", classify_dataset(F.col(col), prefixes, full))
    return out if full else out.where(F.col("dataset_type").isNotNull())


def gsc_hostname(dataset: Column) -> Column:
    """Host from a search-console dataset name: after ``_sc_domain_``
    (case-sensitive split, ``_`` -> ``.``, ``www.`` removed), else after
    ``jepto_gsc_`` or ``searchconsole_``; otherwise null."""
    low = F.lower(dataset)
    # the part between the first and a second separator; the split itself is
    # case-sensitive (after a case-insensitive test), so no part -> null
    after_sc = F.get(F.split(dataset, "_sc_domain_"), 1)
    sc = F.replace(F.lower(F.replace(after_sc, F.lit("_"), F.lit("."))), F.lit("www."), F.lit(""))
    jg = F.lower(F.replace(F.substring(dataset, len("jepto_gsc_") + 1, 1 << 30), F.lit("_"), F.lit(".")))
    sc2 = F.lower(F.replace(F.substring(dataset, len("searchconsole_") + 1, 1 << 30), F.lit("_"), F.lit(".")))
    return (F.when(low.contains("_sc_domain_"), sc)
            .when(low.startswith("jepto_gsc_"), jg)
            .when(low.startswith("searchconsole_"), sc2))


def ga4_hostname(events: DataFrame) -> DataFrame:
    """One web hostname per dataset (the smallest non-null one); a value
    starting ``Error:`` counts as none."""
    h = F.when(~F.col("hostname").startswith("Error:"), F.col("hostname"))
    return events.groupBy("dataset").agg(F.min(h).alias("hostname"))


def gsc_datasets(names: DataFrame, col: str = "dataset") -> DataFrame:
    """Names starting ``jepto`` or ``searchconsole`` (any case)."""
    return names.where(F.lower(F.col(col)).rlike("^(jepto|searchconsole)"))


def upsert_datasets(catalog: DataFrame, found: DataFrame, keep_hostname: bool = True,
                    now=None, order: str | None = None) -> DataFrame:
    """Upsert by dataset: type replaced, the row made active and stamped
    ``now``. With ``keep_hostname`` (the scan path) a null new hostname
    keeps the old one; otherwise (the link path) it overwrites. A dataset
    found several times is one upsert, as if they were made one after the
    other by ``order`` (a column of ``found``; else by type and hostname): the
    last type, and the last hostname (the last known one with
    ``keep_hostname``)."""
    at = F.col(order) if order else F.lit(0)
    last = F.struct(at.alias("at"), F.col("dataset_type").alias("t"), F.col("hostname").alias("h"))
    named = F.when(F.col("hostname").isNotNull(), last) if keep_hostname else last
    f = found.groupBy("dataset").agg(F.max(last)["t"].alias("_t"), F.max(named)["h"].alias("_h"), F.lit(True).alias("_hit"))
    j = catalog.join(f, "dataset", "full_outer")
    hit = F.col("_hit").isNotNull()
    host = F.coalesce(F.col("_h"), F.col("hostname")) if keep_hostname else F.col("_h")
    cols = [F.col("dataset"),
            F.when(hit, F.col("_t")).otherwise(F.col("dataset_type")).alias("dataset_type"),
            F.when(hit, host).otherwise(F.col("hostname")).alias("hostname")]
    for c in catalog.columns:
        if c in ("dataset", "dataset_type", "hostname"):
            continue
        if c == "updated_at" and now is not None:
            cols.append(F.when(hit, F.lit(now).cast("timestamp")).otherwise(F.col(c)).alias(c))
        elif c == "active":
            cols.append(F.when(hit, F.lit(True)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def prune_datasets(catalog: DataFrame, live: DataFrame, prefixes=DEFAULT_DATASET_PREFIXES,
                   full: bool = False) -> DataFrame:
    """The catalog without rows missing from the live list; without
    ``full`` only rows with a known prefix may go (``startswith``, not a
    LIKE pattern)."""
    gone = catalog.join(live.select("dataset"), "dataset", "left_anti")
    if not full:
        gone = gone.where(classify_dataset(F.col("dataset"), prefixes, full=False).isNotNull())
    return catalog.join(gone.select("dataset"), "dataset", "left_anti")


def dataset_catalog(catalog: DataFrame, links: DataFrame, dataset_type: str | None = None,
                    unassigned_only: bool = False) -> DataFrame:
    """Catalog rows, optionally of one type or with no client link."""
    df = catalog
    if dataset_type is not None:
        df = df.where(F.col("dataset_type") == dataset_type)
    if unassigned_only:
        df = df.join(links.select(F.col("dataset_id").alias("dataset")), "dataset", "left_anti")
    return df.orderBy("dataset")


def client_datasets(links: DataFrame, catalog: DataFrame, client_id=None,
                    dataset_type: str | None = None, active_only: bool = True) -> DataFrame:
    """Links left join catalog for type and hostname, ordered."""
    cat = catalog.select(F.col("dataset").alias("dataset_id"), "dataset_type", "hostname")
    df = links.join(cat, "dataset_id", "left")
    if client_id is not None:
        df = df.where(F.col("client_id") == client_id)
    if dataset_type is not None:
        df = df.where(F.col("dataset_type") == dataset_type)
    if active_only:
        df = df.where(F.col("is_active"))
    return df.orderBy("client_id", "dataset_id")


def dataset_assignment(links: DataFrame, clients: DataFrame) -> DataFrame:
    """The client holding each dataset by any link, active or not (the
    lowest client id when more than one), joined to the client name."""
    first = links.join(clients.select("client_id"), "client_id", "left_semi").groupBy("dataset_id").agg(
        F.min("client_id").alias("client_id"))
    return first.join(clients.select("client_id", "client_name"), "client_id", "inner")


def approve_matches(catalog: DataFrame, links: DataFrame, approvals: DataFrame, now):
    """Upsert the approved datasets into the catalog (link path: the
    hostname given overwrites; made active, stamped ``now``) and add the links
    not present yet. A dataset approved twice takes its last approval by
    client id. Returns (catalog, new_links, count of approvals)."""
    last = approvals.groupBy("dataset_id").agg(F.max(F.struct("client_id", "dataset_type", "hostname")).alias("_a"))
    found = last.select(F.col("dataset_id").alias("dataset"), "_a.dataset_type", "_a.hostname")
    new_catalog = upsert_datasets(catalog, found, keep_hostname=False, now=now)
    new_links = (approvals.select("client_id", "domain_id", "dataset_id").distinct()
                 .join(links.select("client_id", "dataset_id"), ["client_id", "dataset_id"], "left_anti")
                 .withColumn("is_active", F.lit(True)))
    return new_catalog, new_links, approvals.agg(F.count(F.lit(1)).alias("saved"))


# ----------------------------------------------------------------- E14
#: Gram sizes; a domain has grams of the largest size that it is long enough for.
GRAMS = (1, 2, 4, 8)


def _norm_host(c: Column) -> Column:
    """lower case, ``www.`` removed wherever it occurs"""
    return F.replace(F.lower(c), F.lit("www."), F.lit(""))


def match_lookup(client_domains: DataFrame, domains: DataFrame) -> DataFrame:
    """The known domains a dataset may match: active domains linked to a
    client as its own (not competitor). One entry per normalized domain;
    a domain held by several clients goes to the lowest client id."""
    own = client_domains.where(~F.col("is_competitor")).select("client_id", "domain_id")
    act = domains.where(F.col("is_active") & F.col("domain").isNotNull()).select("domain_id", "domain")
    j = own.join(act, "domain_id").withColumn("key", _norm_host(F.col("domain")))
    best = j.groupBy("key").agg(F.min(F.struct("client_id", "domain_id", "domain")).alias("_b"))
    return best.select("key", F.col("_b.client_id").alias("client_id"),
                       F.col("_b.domain_id").alias("domain_id"), F.col("_b.domain").alias("domain"),
                       F.split(F.col("key"), r"\.")[0].alias("first_label"))


def _host_candidates(hosts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Host rule for (dataset, rule, h): exact key (sub 0), else keys whose
    first label equals h or that start with h + '.' (sub 1; shortest wins).
    Both are equi joins (on the key, on the first label)."""
    lk = lookup.select("key", "client_id", "domain_id", "domain", "first_label")
    exact = hosts.join(lk, hosts["h"] == lk["key"]).select(
        "dataset", "rule", F.lit(0).alias("sub"), "key", "client_id", "domain_id", "domain")
    hp = hosts.withColumn("first_label", F.split(F.col("h"), r"\.")[0])
    fuzzy = (hp.join(lk, "first_label")
             .where((F.col("first_label") == F.col("h")) | F.col("key").startswith(F.concat(F.col("h"), F.lit("."))))
             .select("dataset", "rule", F.lit(1).alias("sub"), "key", "client_id", "domain_id", "domain"))
    return exact.unionByName(fuzzy)


def rarest_grams(keys: DataFrame) -> DataFrame:
    """One row per distinct non-empty ``key``: its rarest gram and the gram's
    size (the largest of ``GRAMS`` that the key is long enough for).

    The frequency of a gram is the number of keys of its size that hold it;
    ties go to the gram that sorts first. A start that many domains share
    (``www-shop``, ``the.``) so files none of them, unless it is all they have.
    """
    size = F.array_max(F.filter(F.array(*[F.lit(g) for g in GRAMS]), lambda g: g <= F.length("key")))
    every = (keys.where(F.length("key") > 0).select("key").distinct().withColumn("size", size)
             .select("key", "size", F.explode(F.array_distinct(F.transform(
                 F.sequence(F.lit(1), F.length("key") - F.col("size") + 1),
                 lambda i: F.substring(F.col("key"), i, F.col("size"))))).alias("gram")))
    held_by = every.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("held_by"))
    return (every.join(held_by, ["size", "gram"]).groupBy("key", "size")
            .agg(F.min(F.struct("held_by", "gram"))["gram"].alias("gram")))


def name_grams(names: DataFrame, index: DataFrame) -> DataFrame:
    """The grams of each name (dataset, nm), of the sizes that ``index`` has:
    one row a character and size, mostly one size or two."""
    sizes = index.agg(F.collect_set("size")).scalar()
    starts = names.select("dataset", "nm", F.explode(sizes).alias("size")).where(F.col("size") <= F.length("nm"))
    return (starts.select("dataset", "nm", "size",
                          F.explode(F.sequence(F.lit(1), F.length("nm") - F.col("size") + 1)).alias("i"))
            .select("dataset", "nm", "size", F.substring("nm", F.col("i"), F.col("size")).alias("gram")))


def _longest_contained(names: DataFrame, keys: DataFrame) -> DataFrame:
    """The longest key in each name, if any; equally long ones: the first in order.

    A key in a name brings its rarest gram along, so the join on grams finds
    it; the whole key is then checked. The best key per name is combined before
    the shuffle, and only the key travels.
    """
    index = rarest_grams(keys)
    return (name_grams(names, index).join(index, ["size", "gram"]).where(F.contains("nm", "key"))
            .groupBy("dataset").agg(F.min(F.struct((-F.length("key")).alias("shorter"), "key"))["key"].alias("key")))


def match_datasets(catalog: DataFrame, links: DataFrame, client_domains: DataFrame,
                   domains: DataFrame) -> DataFrame:
    """Propose a client domain for each catalog dataset.

    Datasets already linked to a client (active or not) are ``known``.
    Otherwise, in order: (1) the host rule on the catalog hostname (all
    types); for gsc only, (2) on the name after ``_sc_domain_`` and (3) on
    the name after ``jepto_gsc_``; for gsc and other types, (4) the longest
    known domain contained in the name with ``_`` -> ``.``. The host rule:
    the exact normalized domain, else the shortest domain whose first label
    equals the host or that starts with host + ``.``. Hosts and domains are
    lower-cased with ``www.`` removed. Ties: domain text, then id.

    Candidates of the host rule come from equi joins (exact key, first
    label), ranked per dataset. Names that it leaves open go to the substring
    rule, an index of each domain under its rarest gram (``rarest_grams``).

    Returns one row per dataset: ``status`` is ``known``, ``proposed`` or
    ``unmatched``; ``hostname`` is the cleaned host of a proposed ga4 dataset,
    else the proposed domain; an unmatched dataset shows its own host name if
    it is ga4, else none (the substring rule, tried last, clears it).
    """
    # both are read by several branches below and cost a join or an aggregate of the links
    lookup = written(match_lookup(client_domains, domains), "match-lookup")
    link_agg = links.groupBy(F.col("dataset_id").alias("dataset")).agg(
        F.min("domain_id").alias("domain_id"), F.min("client_id").alias("client_id"), F.lit(0).alias("rule"))
    cat = written(catalog.select("dataset", "dataset_type", "hostname").join(link_agg, "dataset", "left"), "match-catalog")
    linked = cat.where(F.col("rule") == 0)
    open_ = cat.where(F.col("rule").isNull()).select("dataset", "dataset_type", "hostname")
    ds, typ = F.col("dataset"), F.col("dataset_type")
    low = F.lower(ds)
    gsc = typ == "gsc"
    sc_part = F.get(F.split(ds, "_sc_domain_"), 1)
    hosts = (open_.where(F.col("hostname").isNotNull())
             .select("dataset", F.lit(1).alias("rule"), _norm_host(F.col("hostname")).alias("h"))
             .unionByName(open_.where(gsc & ds.contains("_sc_domain_") & sc_part.isNotNull())
                          .select("dataset", F.lit(2).alias("rule"),
                                  _norm_host(F.replace(sc_part, F.lit("_"), F.lit("."))).alias("h")))
             .unionByName(open_.where(gsc & low.startswith("jepto_gsc_"))
                          .select("dataset", F.lit(3).alias("rule"),
                                  F.lower(F.replace(F.substring(ds, len("jepto_gsc_") + 1, 1 << 30),
                                                    F.lit("_"), F.lit("."))).alias("h"))))
    host_c = _host_candidates(hosts, lookup)
    names = open_.where(typ.isNull() | (typ != "ga4")).select(
        "dataset", F.replace(low, F.lit("_"), F.lit(".")).alias("nm"))
    length_key = F.length("key")
    w = Window.partitionBy("dataset").orderBy("rule", "sub", length_key, "key", "domain_id")
    best_host = (host_c.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
                 .select("dataset", "client_id", "domain_id", "domain", "rule"))
    contained = _longest_contained(names.join(best_host.select("dataset"), "dataset", "left_anti"),
                                   lookup.select("key"))
    best_sub = contained.join(lookup.drop("first_label"), "key").select(
        "dataset", "client_id", "domain_id", "domain", F.lit(4).alias("rule"))
    best = best_host.unionByName(best_sub)
    known = linked.join(domains.select("domain_id", "domain"), "domain_id", "left")
    matched = known.unionByName(open_.join(best, "dataset", "left"))
    names_of_rule = {0: "known", 1: "host", 2: "sc_domain", 3: "jepto_gsc", 4: "substring"}
    rule_name = None
    for k, v in names_of_rule.items():
        cond = F.col("rule") == k
        rule_name = F.when(cond, F.lit(v)) if rule_name is None else rule_name.when(cond, F.lit(v))
    # the substring rule, tried last, leaves no host name when it finds nothing
    missed = F.when(typ == "ga4", F.col("hostname"))
    rule = F.col("rule")
    return (matched
            .select("dataset", "dataset_type", "client_id", "domain_id", "domain", "rule", rule_name.alias("match_rule"),
                    F.when(rule == 0, F.lit("known")).when(rule.isNotNull(), F.lit("proposed"))
                    .otherwise(F.lit("unmatched")).alias("status"),
                    F.when(rule == 0, F.col("hostname"))
                    .when(rule.isNotNull() & (typ == "ga4"), _norm_host(F.col("hostname")))
                    .when(rule.isNotNull(), F.col("domain")).otherwise(missed).alias("hostname")))
