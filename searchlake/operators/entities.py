"""Entity tables (F1-F16): lookups, counts and batch changes on snapshots.

Single-row CRUD becomes batch work: a DataFrame of changes is joined onto a
table snapshot and gives the next snapshot. Id allocation follows the
reference's rule (new ids above the current maximum) with one writer per
entity table; the maximum is one scalar read by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.functions.domains import clean_domain, clean_domain_keep_path, domain_to_name
from searchlake.functions.domains import registered_name
from searchlake.operators.catalog import dataset_assignment, upsert_datasets
from searchlake.operators.ids import dense_index

# Link priorities, default priority and statuses.
PRIORITIES = ("VERY LOW", "LOW", "NORMAL", "HIGH", "VERY HIGH")
DEFAULT_PRIORITY = "NORMAL"


def max_id(snapshot: DataFrame, id_col: str) -> int:
    v = snapshot.agg(F.max(id_col)).first()[0]
    return int(v) if v is not None else 0


# ----------------------------------------------------------------- reads
def lookup(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows of ``table`` for a batch of keys (semi join)."""
    return table.join(keys.select(key).distinct(), key, "left_semi")


def lookup_domains_by_text(domains: DataFrame, texts: DataFrame, text_col: str = "raw") -> DataFrame:
    """domain row for each raw text after G1 cleaning (null when unknown)."""
    t = texts.select(text_col, clean_domain(F.col(text_col)).alias("domain"))
    return t.join(domains.select("domain", "domain_id"), "domain", "left")


def list_clients(clients: DataFrame, search: str | None = None) -> DataFrame:
    """case-insensitive contains on name or abbreviation, by name."""
    df = clients
    if search:
        q = F.lit(search.lower())
        df = df.where(F.lower("client_name").contains(q) | F.lower("abbreviation").contains(q))
    return df.orderBy("client_name", "client_id")


def client_counts(clients: DataFrame, client_domains: DataFrame, domains: DataFrame,
                  projects: DataFrame) -> DataFrame:
    """per client, active own domains, active competitor domains and
    projects; 0 when none. Two grouped aggregates and left joins replace the
    correlated sub-queries."""
    active = domains.where(F.col("is_active")).select("domain_id")
    links = client_domains.join(active, "domain_id", "left_semi")
    dc = links.groupBy("client_id").agg(
        F.count_if(~F.col("is_competitor")).alias("domain_count"),
        F.count_if(F.col("is_competitor")).alias("competitor_count"))
    pc = projects.groupBy("client_id").agg(F.count(F.lit(1)).alias("project_count"))
    out = clients.join(dc, "client_id", "left").join(pc, "client_id", "left")
    return out.fillna(0, ["domain_count", "competitor_count", "project_count"])


def search_domains(domains: DataFrame, query: str, rules: DataFrame, limit: int | None = 10) -> DataFrame:
    """domains whose text contains the registered name of the query
    (the query itself when it has none); a stable order before the limit."""
    spark = domains.sparkSession
    one = spark.range(1).select(F.lit(query).alias("q"))
    term = registered_name(one, "q", rules, "t").first()["t"]
    term = (term or query).lower()
    df = (domains.where(F.lower("domain").contains(F.lit(term)))
          .select("domain_id", "domain", "domain_name", "is_active").orderBy("domain_id"))
    return df.limit(limit) if limit is not None else df


def client_domain_list(client_domains: DataFrame, domains: DataFrame, client_id=None,
                       is_competitor: bool | None = None) -> DataFrame:
    """a client's links joined to their domains, ordered (all clients'
    links when ``client_id`` is None)."""
    links = client_domains
    if client_id is not None:
        links = links.where(F.col("client_id") == client_id)
    if is_competitor is not None:
        links = links.where(F.col("is_competitor") == is_competitor)
    return (links.join(domains.select("domain_id", "domain", "domain_name", "is_active"),
                       "domain_id")
            .orderBy("client_id", "is_competitor", "domain"))


def list_projects(projects: DataFrame, client_id=None, project_type=None, status=None) -> DataFrame:
    """filters given, by id."""
    df = projects
    for col, val in (("client_id", client_id), ("project_type", project_type), ("status", status)):
        if val is not None:
            df = df.where(F.col(col) == val)
    return df.orderBy("project_id")


def project_domain_list(project_domains: DataFrame, domains: DataFrame, project_id=None) -> DataFrame:
    """links of a project (of all projects when ``project_id`` is None)
    joined to domains with role and priority."""
    links = project_domains
    if project_id is not None:
        links = links.where(F.col("project_id") == project_id)
    return (links.join(domains.select("domain_id", "domain", "domain_name"), "domain_id")
            .orderBy("project_id", "role", "domain"))


# ----------------------------------------------------------------- writes
def add_rows(table: DataFrame, new: DataFrame, id_col: str, order: list[str],
             defaults: dict | None = None) -> DataFrame:
    """F8: new rows with ids above the current maximum, in ``order``;
    missing columns take ``defaults`` (else null). Returns the new rows."""
    start = max_id(table, id_col) + 1
    rows = dense_index(new, order, start=start, name=id_col)
    cols = []
    for f in table.schema.fields:
        if f.name in rows.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif defaults and f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rows.select(*cols)


def normalize_priority(p: Column, strict: bool = False) -> Column:
    """Upper-cased priority; an unknown value becomes NORMAL (``strict``
    marks it null so the caller can report the row as an error)."""
    u = F.upper(F.trim(F.coalesce(p, F.lit(DEFAULT_PRIORITY))))
    ok = u.isin(*PRIORITIES)
    return F.when(ok, u).otherwise(F.lit(None) if strict else F.lit(DEFAULT_PRIORITY))


def add_domains(domains: DataFrame, client_domains: DataFrame, batch: DataFrame, rules: DataFrame,
                clients: DataFrame | None = None, client_id=None, is_competitor: bool = False, priority: str = "NORMAL",
                raw_col: str = "raw", pos_col: str = "pos"):
    """add a batch of raw domain texts.

    Clean (keeping paths), drop empties, keep the first of equal texts, reuse
    ids of known domains, give new ones ids above the maximum (in first
    position order) and display names (``rules``: the public suffixes), and
    link to ``client_id`` the pairs not linked yet; a client that is not in
    ``clients`` is refused. Returns (result, new_domains, new_links): result
    has domain_id, domain, domain_name, skipped per distinct cleaned domain.
    """
    p = (priority or DEFAULT_PRIORITY).strip().upper()
    if p not in PRIORITIES:
        raise ValueError(f"priority {priority!r} is not one of {', '.join(PRIORITIES)}")
    if client_id is not None and clients is not None and clients.where(F.col("client_id") == client_id).isEmpty():
        raise ValueError(f"no client has the id {client_id}")
    cleaned = (batch.where(F.trim(F.col(raw_col)) != "")
               .select(clean_domain_keep_path(F.col(raw_col)).alias("domain"), F.col(pos_col))
               .where(F.col("domain") != ""))
    firsts = cleaned.groupBy("domain").agg(F.min(pos_col).alias("first_pos"))
    known = firsts.join(domains.select("domain", "domain_id"), "domain", "left")
    new = known.where(F.col("domain_id").isNull()).drop("domain_id")
    new_rows = dense_index(new, ["first_pos", "domain"], start=max_id(domains, "domain_id") + 1,
                           name="domain_id")
    new_domains = domain_to_name(new_rows, "domain", rules).select("domain_id", "domain", "domain_name", F.lit(True).alias("is_active"),
                                  F.lit(None).cast("string").alias("notes"))
    ids = domain_to_name(known.where(F.col("domain_id").isNotNull())
                         .unionByName(new_rows.select("domain", "first_pos", "domain_id")), "domain", rules)
    if client_id is None:
        result = ids.select("domain_id", "domain", "domain_name", F.lit(False).alias("skipped"), "first_pos")
        return result, new_domains, client_domains.limit(0)
    linked = client_domains.where(F.col("client_id") == client_id).select("domain_id")
    flagged = ids.join(linked.withColumn("skipped", F.lit(True)), "domain_id", "left") \
                 .fillna(False, ["skipped"])
    new_links = flagged.where(~F.col("skipped")).select(
        F.lit(client_id).cast("bigint").alias("client_id"), "domain_id",
        F.lit(is_competitor).alias("is_competitor"), F.lit(p).alias("priority"),
        F.lit(None).cast("string").alias("notes"))
    return flagged.select("domain_id", "domain", "domain_name", "skipped", "first_pos"), new_domains, new_links


def patch(table: DataFrame, changes: DataFrame, keys: list[str],
          set_null: str | None = None, order: str | None = None) -> DataFrame:
    """set only the fields given. ``changes`` holds the keys and the
    changed columns; a null there means "unchanged", unless the column is
    listed in the optional array column ``set_null`` (then null is set).

    Several changes of one key are applied one after the other by the column
    ``order``: each field takes the last change that names it (without
    ``order``, or at one place of it, the greatest value; a null set is the
    least). The table keeps its rows, however often a key is changed."""
    fields = [c for c in changes.columns if c not in keys and c not in (set_null, order)]
    at = F.col(order) if order else F.lit(0)

    def last(c: str) -> Column:
        nulled = F.coalesce(F.array_contains(F.col(set_null), F.lit(c)), F.lit(False)) if set_null else F.lit(False)
        value = F.when(~nulled, F.col(c))
        return F.max(F.when(nulled | F.col(c).isNotNull(), F.struct(at.alias("at"), value.alias("v")))).alias(f"_new_{c}")
    if not fields:
        return table
    j = table.join(changes.groupBy(*keys).agg(*[last(c) for c in fields]), keys, "left")
    return j.select(*[F.when(F.col(f"_new_{f.name}").isNotNull(), F.col(f"_new_{f.name}.v").cast(f.dataType))
                      .otherwise(F.col(f.name)).alias(f.name) if f.name in fields else F.col(f.name) for f in table.schema.fields])


def set_status(table: DataFrame, keys: DataFrame, key: str, status_col: str, value) -> DataFrame:
    """F10 status changes (deactivate, complete, reactivate) for a key batch."""
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return (table.join(hit, key, "left")
            .withColumn(status_col, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(status_col)))
            .drop("_hit"))


def link_project_domains(project_domains: DataFrame, pairs: DataFrame) -> DataFrame:
    """new links with upper-cased priority; pairs already linked are
    left out. Returns the rows to add."""
    add = pairs.select("project_id", "domain_id", "role",
                       F.upper(F.col("priority")).alias("priority"),
                       F.col("notes") if "notes" in pairs.columns else F.lit(None).cast("string").alias("notes"))
    return add.join(project_domains.select("project_id", "domain_id"),
                    ["project_id", "domain_id"], "left_anti").dropDuplicates(["project_id", "domain_id"])


def delete_keys(table: DataFrame, keys: DataFrame, key_cols: list[str]) -> DataFrame:
    """the snapshot without the given keys (anti join)."""
    return table.join(keys.select(*key_cols), key_cols, "left_anti")


def deactivate_clients(clients: DataFrame, ids: DataFrame, client_domains: DataFrame,
                       domains: DataFrame, client_datasets: DataFrame, cascade: bool = False):
    """switch clients off. With ``cascade`` also switch off their
    domains that no other active client is linked to (own or competitor),
    and all their dataset links.

    For a batch of ids, "other" means active and not in the batch (the
    result of switching them off one after the other). Returns the
    (clients, domains, client_datasets) snapshots.
    """
    off = ids.select("client_id").distinct().withColumn("_off", F.lit(True))
    new_clients = set_status(clients, off, "client_id", "is_active", False)
    if not cascade:
        return new_clients, domains, client_datasets
    theirs = client_domains.join(off, "client_id", "left_semi").select("domain_id").distinct()
    still_active = new_clients.where(F.col("is_active")).select("client_id")
    others = client_domains.join(still_active, "client_id", "left_semi").select("domain_id").distinct()
    orphaned = theirs.join(others, "domain_id", "left_anti")
    new_domains = set_status(domains, orphaned, "domain_id", "is_active", False)
    new_links = set_status(client_datasets, off, "client_id", "is_active", False)
    return new_clients, new_domains, new_links


def resolve_domains(domains: DataFrame, targets: DataFrame):
    """targets by id must exist; by text they are cleaned and looked up.

    ``targets`` has ``target_id`` (bigint, nullable) and ``target`` (text).
    Returns (resolved, unknown_ids, to_create): resolved rows carry
    domain_id and domain; unknown ids are reported; texts with no domain are
    the batch to hand to :func:`add_domains`.
    """
    by_id = targets.where(F.col("target_id").isNotNull())
    by_text = targets.where(F.col("target_id").isNull())
    d = domains.select("domain_id", "domain")
    ok_id = by_id.join(d, by_id["target_id"] == d["domain_id"], "inner").select(
        "target_id", "target", "domain_id", "domain")
    unknown = by_id.join(d, by_id["target_id"] == d["domain_id"], "left_anti")
    cleaned = by_text.withColumn("domain", clean_domain(F.col("target")))
    found = cleaned.join(d, "domain", "left")
    resolved = ok_id.unionByName(found.where(F.col("domain_id").isNotNull())
                                 .select("target_id", "target", "domain_id", "domain"))
    to_create = found.where(F.col("domain_id").isNull()).select("target")
    return resolved, unknown, to_create


def format_ids(ids: DataFrame, id_col: str) -> DataFrame:
    """ids zero-padded to the width of the largest id, never cut."""
    width = ids.agg(F.max(F.length(F.col(id_col).cast("string")))).first()[0] or 0
    s = F.col(id_col).cast("string")
    return ids.withColumn("formatted", F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0"))


def add_client_datasets(client_datasets: DataFrame, catalog: DataFrame, batch: DataFrame,
                        clients: DataFrame, now):
    """F16: link datasets to clients.

    ``batch``: client_id, dataset_id, dataset_type, hostname, domain_id,
    notes. Returns (warnings, catalog, new_links): a warning for each batch
    row whose dataset has any link already (active or not, of any client;
    the lowest client id is named), the catalog after the upsert (link path:
    type and hostname overwrite, active, stamped ``now``; a dataset given
    twice takes its last row by client id), and one link row per batch row.
    """
    held = dataset_assignment(client_datasets, clients).select(
        "dataset_id", F.col("client_id").alias("held_by"), F.col("client_name").alias("held_by_name"))
    warnings = batch.join(held, "dataset_id").select("dataset_id", "client_id", "held_by", "held_by_name")
    last = batch.groupBy("dataset_id").agg(F.max(F.struct("client_id", "dataset_type", "hostname")).alias("_l"))
    found = last.select(F.col("dataset_id").alias("dataset"), "_l.dataset_type", "_l.hostname")
    new_links = batch.select("client_id", "domain_id", "dataset_id", F.lit(True).alias("is_active"), "notes")
    return warnings, upsert_datasets(catalog, found, keep_hostname=False, now=now), new_links
