"""Schema alignment, backfill and reconciliation.

Migration work is a ``select`` built from two schemas; backfilled ids are a
deterministic function of (table, job, hour), so the id "mapping" needs no
join at all and a retried task writes the same ids; reconciliation is anti
joins and signed multiset counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions.domains import clean_domain_keep_path, normalize_domain_sql, strip
from searchlake.operators.ingest import UPLOAD_EVENT_SCHEMA
from searchlake.schemas import SENTINEL
from searchlake.session import cut_lineage


# ----------------------------------------------------------------- H1-H4
def align_schema(old: DataFrame, target: T.StructType) -> DataFrame:
    """H1: project ``old`` onto ``target``: missing column -> typed null;
    equal type -> as is; array/struct/map into string -> JSON text; other
    scalar mismatch -> ``try_cast`` (null when it does not convert);
    columns not in the target are dropped."""
    have = {f.name: f.dataType for f in old.schema.fields}
    cols = []
    for f in target.fields:
        src = have.get(f.name)
        c = F.col(f"`{f.name}`")
        if src is None:
            e = F.lit(None).cast(f.dataType)
        elif src == f.dataType:
            e = c
        elif isinstance(src, (T.ArrayType, T.StructType, T.MapType)) and isinstance(f.dataType, T.StringType):
            e = F.to_json(c)
        elif isinstance(src, T.StringType) and isinstance(f.dataType, T.BooleanType):
            # a warehouse safe cast takes only true / false (any case)
            low = F.lower(F.trim(c))
            e = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
        else:
            e = c.try_cast(f.dataType)
        cols.append(e.alias(f.name))
    return old.select(*cols)


def dropped_columns(old: DataFrame, target: T.StructType) -> list[str]:
    names = {f.name for f in target.fields}
    return [c for c in old.columns if c not in names]


def fill_metadata(df: DataFrame, keep_domain: bool, now=None) -> DataFrame:
    """H2: job_id / upload_id null -> sentinel; ingest time null -> ``now``;
    domain_id null; task_id kept when present; domain kept only for tables
    where it means the caller's domain; mode ``live``."""
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    cols = set(df.columns)

    def keep(name, typ):
        return F.col(name) if name in cols else F.lit(None).cast(typ)
    return df.withColumns({
        "job_id": F.coalesce(keep("job_id", "string"), F.lit(SENTINEL)),
        "upload_id": F.coalesce(keep("upload_id", "string"), F.lit(SENTINEL)),
        "ingest_timestamp": F.coalesce(keep("ingest_timestamp", "timestamp"), now_c),
        "domain_id": F.lit(None).cast("bigint"),
        "domain": keep("domain", "string") if keep_domain else F.lit(None).cast("string"),
        "task_id": keep("task_id", "string"),
        "endpoint_mode": F.lit("live"),
    })


RENAMES = {"local_search_volume": "search_volume", "local_location_code": "location_code"}


def rename_backfill(old: DataFrame, target: T.StructType) -> DataFrame:
    """H3: renamed columns copied into their new names; other new columns
    null; then aligned to ``target``."""
    df = old
    for src, dst in RENAMES.items():
        if src in df.columns:
            df = df.withColumn(dst, F.col(src)).drop(src)
    return align_schema(df, target)


def intents_to_json(s: Column) -> Column:
    """H4: ``a, b`` -> ``[{"label":"a"},{"label":"b"}]``; blank -> null."""
    parts = F.filter(F.split(s, ","), lambda x: F.trim(x) != "")
    js = F.to_json(F.transform(parts, lambda x: F.struct(F.trim(x).alias("label"))))
    return F.when(F.trim(F.coalesce(s, F.lit(""))) == "", F.lit(None)).otherwise(js)


# ----------------------------------------------------------------- H5
def verify_counts(pairs: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """H5: old and new row counts per table and whether they agree. Counts
    of all tables are unioned and folded by one grouped aggregate (no join)."""
    parts = []
    for name, old, new in pairs:
        parts.append(old.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("old").alias("side"), "n"))
        parts.append(new.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("new").alias("side"), "n"))
    u = reduce(DataFrame.unionByName, parts)
    out = u.groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "old", F.col("n"))).alias("old_rows"),
        F.sum(F.when(F.col("side") == "new", F.col("n"))).alias("new_rows"))
    return out.withColumn("equal", F.col("old_rows") == F.col("new_rows"))


# ----------------------------------------------------------------- H6-H8
def synthetic_id(*parts: Column) -> Column:
    """A UUID-shaped id from sha2 of the parts (deterministic: a retried or
    recomputed task yields the same id, unlike ``uuid()``)."""
    h = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def hour_bucket(ts: str = "ingest_timestamp") -> Column:
    return F.date_trunc("hour", F.col(ts))


def backfill_ids_by_hour(df: DataFrame, table: str) -> DataFrame:
    """H6: rows with the sentinel in job_id or upload_id get ids made per
    hour bucket; a real value in the other column is kept. Narrow: no join."""
    hb = F.date_format(hour_bucket(), "yyyy-MM-dd HH:mm:ss")
    job = synthetic_id(F.lit(table), F.lit("job"), hb)
    up = synthetic_id(F.lit(table), F.lit("upload"), hb)
    return df.withColumns({
        "job_id": F.when(F.col("job_id") == SENTINEL, job).otherwise(F.col("job_id")),
        "upload_id": F.when(F.col("upload_id") == SENTINEL, up).otherwise(F.col("upload_id")),
    })


def backfill_upload_by_job_hour(df: DataFrame, table: str) -> DataFrame:
    """H7: a sentinel upload_id becomes a new id per (job_id, hour); job_id
    never changes, also where it is the sentinel itself."""
    hb = F.date_format(hour_bucket(), "yyyy-MM-dd HH:mm:ss")
    up = synthetic_id(F.lit(table), F.col("job_id"), hb)
    return df.withColumn("upload_id", F.when(F.col("upload_id") == SENTINEL, up).otherwise(F.col("upload_id")))


def backfill_events(before: DataFrame, table: str, mode: str = "both",
                    dataset: str = "warehouse", now=None) -> DataFrame:
    """H8: one upload event per group of backfilled rows, with its row count
    and a note naming the hour.

    ``both`` (H6): one event per hour, under the hour's pair of synthetic
    ids, for all rows of the hour with either sentinel. ``upload`` (H7): one
    event per (job_id, hour). All columns of the upload log; the event's time
    is ``now`` (default: the current time).
    """
    hb = F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss")
    if mode == "both":
        marked = before.where((F.col("job_id") == SENTINEL) | (F.col("upload_id") == SENTINEL))
        g = marked.groupBy(hour_bucket().alias("hour_bucket")).agg(F.count(F.lit(1)).alias("row_count"))
        g = g.withColumns({"job_id": synthetic_id(F.lit(table), F.lit("job"), hb),
                           "upload_id": synthetic_id(F.lit(table), F.lit("upload"), hb)})
    else:
        marked = before.where(F.col("upload_id") == SENTINEL)
        g = marked.groupBy("job_id", hour_bucket().alias("hour_bucket")).agg(F.count(F.lit(1)).alias("row_count"))
        g = g.withColumn("upload_id", synthetic_id(F.lit(table), F.col("job_id"), hb))
    none = F.lit(None).cast("string")
    out = g.select(
        "job_id", "upload_id", F.lit("backfill").alias("source"),
        F.lit("migration").alias("source_program"), F.lit(dataset).alias("dataset"),
        F.lit(table).alias("table_name"), "row_count",
        (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")).alias("ingest_timestamp"),
        none.alias("client_id"), none.alias("project_id"),
        F.concat(F.lit("backfill of rows ingested in hour "),
                 F.date_format("hour_bucket", "yyyy-MM-dd HH:00")).alias("notes"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in UPLOAD_EVENT_SCHEMA.fields])


# ----------------------------------------------------------------- H9-H14
def domain_inventory(table: DataFrame, domains: DataFrame) -> DataFrame:
    """H9: distinct raw domains with row counts, matched after G3
    normalization to known domains; ``matched`` and ``exact_match``."""
    src = (table.where(F.col("domain").isNotNull())
           .groupBy(F.col("domain").alias("raw_domain"))
           .agg(F.count(F.lit(1)).alias("row_count"))
           .withColumn("norm_domain", normalize_domain_sql(F.col("raw_domain"))))
    meta = domains.select(F.col("domain").alias("meta_domain"),
                          normalize_domain_sql(F.col("domain")).alias("norm_domain")).distinct()
    j = src.join(meta, "norm_domain", "left")
    return j.select("raw_domain", "norm_domain", "row_count", "meta_domain",
                    F.col("meta_domain").isNotNull().alias("matched"),
                    (F.col("meta_domain") == F.col("raw_domain")).alias("exact_match"))


def inventory_summary(inv: DataFrame) -> DataFrame:
    """H9 summary: distinct domains and rows that match exactly, after
    normalization, or not at all."""
    exact = F.coalesce(F.col("exact_match"), F.lit(False))
    norm = F.col("matched") & ~exact
    return inv.agg(
        F.count(F.lit(1)).alias("total_distinct"),
        F.sum("row_count").alias("total_rows"),
        F.count_if(exact).alias("exact"),
        F.coalesce(F.sum(F.when(exact, F.col("row_count"))), F.lit(0)).alias("exact_rows"),
        F.count_if(norm).alias("normalized"),
        F.coalesce(F.sum(F.when(norm, F.col("row_count"))), F.lit(0)).alias("normalized_rows"),
        F.count_if(~F.col("matched")).alias("unknown"),
        F.coalesce(F.sum(F.when(~F.col("matched"), F.col("row_count"))), F.lit(0)).alias("unknown_rows"))


def top_unknown(inv: DataFrame, n: int = 20) -> DataFrame:
    """H9: the ``n`` unknown domains with most rows (a top-k report)."""
    return (inv.where(~F.col("matched"))
            .orderBy(F.col("row_count").desc(), F.col("raw_domain")).limit(n))


def domain_inventory_union(tables: dict[str, DataFrame], domains: DataFrame) -> DataFrame:
    """Union of the domain columns of several tables, counts per source
    and in total, matched after G3 normalization; MATCH or CREATE."""
    src = reduce(DataFrame.unionByName, [
        t.where(F.col("domain").isNotNull() & (F.col("domain") != ""))
         .select(F.col("domain").alias("raw_domain"), F.lit(name).alias("src_table"))
        for name, t in tables.items()])
    g = src.groupBy("raw_domain").agg(
        *[F.count_if(F.col("src_table") == name).alias(f"rows_{name}") for name in tables],
        F.count(F.lit(1)).alias("rows_total"))
    g = g.withColumn("normalized_domain", normalize_domain_sql(F.col("raw_domain")))
    meta = domains.select(F.col("domain_id").alias("meta_match_domain_id"),
                          F.col("domain").alias("meta_match_domain"),
                          normalize_domain_sql(F.col("domain")).alias("normalized_domain"))
    j = g.join(meta, "normalized_domain", "left")
    return j.withColumn("suggested", F.when(F.col("meta_match_domain_id").isNotNull(), F.lit("MATCH"))
                        .otherwise(F.lit("CREATE")))


def inventory_overlap(inv: DataFrame, a: str, b: str) -> DataFrame:
    """How many raw domains occur only in ``a``, only in ``b``, or both."""
    ra, rb = F.col(f"rows_{a}") > 0, F.col(f"rows_{b}") > 0
    return inv.agg(F.count_if(ra & ~rb).alias(f"only_{a}"), F.count_if(rb & ~ra).alias(f"only_{b}"),
                   F.count_if(ra & rb).alias("both"))


def parse_decisions(decisions: DataFrame) -> DataFrame:
    """Decision text -> action (MATCH / CREATE / SKIP), domain id for
    MATCH, provision target for CREATE (the raw domain for bare CREATE), or
    an error for blank and unreadable decisions. ``pos`` is kept if given."""
    d = strip(F.coalesce(F.col("decision"), F.lit("")))
    raw = strip(F.col("raw_domain").cast("string"))
    m_id = F.regexp_extract(d, r"^MATCH\s+(\d+)$", 1).try_cast("bigint")
    c_tgt = strip(F.regexp_extract(d, r"(?s)^CREATE\s+(.+)$", 1))
    action = (F.when(d == "", F.lit(None))
              .when(d == "SKIP", F.lit("SKIP"))
              .when(m_id.isNotNull(), F.lit("MATCH"))
              .when(d == "CREATE", F.lit("CREATE"))
              .when(c_tgt != "", F.lit("CREATE")))
    error = (F.when(d == "", F.concat(F.lit("no decision for "), raw))
             .when(action.isNull(), F.concat(F.lit("cannot read the decision for "), raw, F.lit(": "), d)))
    return decisions.select(
        *[F.col("pos")] * ("pos" in decisions.columns),
        raw.alias("raw_domain"), action.alias("action"),
        F.when(action == "MATCH", m_id).alias("domain_id"),
        F.when(action == "MATCH", F.col("meta_match_domain")).alias("canonical"),
        F.when(d == "CREATE", raw).when(action == "CREATE", c_tgt).alias("provision_target"),
        error.alias("error"))


def provision_list(parsed: DataFrame) -> DataFrame:
    """Unique CREATE targets in first-seen order (``pos``)."""
    return (parsed.where(F.col("action") == "CREATE").groupBy("provision_target")
            .agg(F.min("pos").alias("pos")))


def auto_decide(inventory: DataFrame) -> DataFrame:
    """An undecided row suggested MATCH with an id becomes ``MATCH id``."""
    undecided = strip(F.coalesce(F.col("decision"), F.lit(""))) == ""
    auto = undecided & (F.col("suggested") == "MATCH") & F.col("meta_match_domain_id").isNotNull()
    return inventory.withColumn("decision", F.when(auto, F.concat(
        F.lit("MATCH "), F.col("meta_match_domain_id").cast("string"))).otherwise(F.col("decision")))


def decision_progress(inventory: DataFrame) -> DataFrame:
    """H12 counts: total, already decided, auto-MATCH, left for review."""
    decided = strip(F.coalesce(F.col("decision"), F.lit(""))) != ""
    return inventory.agg(F.count(F.lit(1)).alias("total"), F.count_if(decided).alias("already_done"),
                         F.count_if(F.col("suggested") == "MATCH").alias("auto_matches")) \
        .withColumn("remaining_manual", F.col("total") - F.col("auto_matches") - F.col("already_done"))


def decision_map(parsed: DataFrame, added: DataFrame):
    """Raw -> (domain_id, canonical) for MATCH and CREATE rows. CREATE
    looks up the G2-cleaned target in ``added`` (domain, domain_id); a miss is
    an error. A raw domain decided more than once takes the last decision (by
    ``pos``, if given). Returns (mapping, errors)."""
    pos = F.col("pos") if "pos" in parsed.columns else F.lit(0)
    match = parsed.where(F.col("action") == "MATCH").select(pos.alias("pos"), "raw_domain", "domain_id", "canonical")
    create = (parsed.where(F.col("action") == "CREATE")
              .select(pos.alias("pos"), "raw_domain", clean_domain_keep_path(F.col("provision_target")).alias("domain")))
    found = create.join(added.select("domain", "domain_id"), "domain", "left")
    ok = found.where(F.col("domain_id").isNotNull()).select(
        "pos", "raw_domain", "domain_id", F.col("domain").alias("canonical"))
    errors = found.where(F.col("domain_id").isNull()).select("raw_domain", "domain")
    return _one_per_raw(match.unionByName(ok)), errors


def _one_per_raw(mapping: DataFrame) -> DataFrame:
    keys = [c for c in ("pos", "domain_id", "canonical") if c in mapping.columns]
    last = mapping.groupBy("raw_domain").agg(F.max(F.struct(*keys)).alias("_m"))
    return last.select("raw_domain", "_m.domain_id", "_m.canonical")


def apply_mapping(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Set domain_id and domain where domain equals a mapped raw value.
    A raw domain mapped more than once counts once (its last entry), so rows
    never multiply. The mapping is broadcast when AQE sees it is small, else
    shuffled."""
    m = _one_per_raw(mapping).select(F.col("raw_domain").alias("domain"), F.col("domain_id").alias("_id"),
                                     F.col("canonical").alias("_canon"))
    j = table.join(m, "domain", "left")
    hit = F.col("_id").isNotNull()
    return j.withColumns({"domain_id": F.when(hit, F.col("_id")).otherwise(F.col("domain_id")),
                          "domain": F.when(hit, F.col("_canon")).otherwise(F.col("domain"))}) \
            .drop("_id", "_canon").select(*table.columns)


def mapping_coverage(table: DataFrame) -> DataFrame:
    """Populated domain ids over all rows."""
    return table.agg(F.count("domain_id").alias("populated"), F.count(F.lit(1)).alias("total"))


# ----------------------------------------------------------------- H15-H19
def normalize_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of :func:`_normal_columns`: each value as text and its kind."""
    out = []
    for name, value, kind in _normal_columns(df, cols):
        out += [value.alias(name), kind.alias(f"_kind_{name}")]
    return df.select(*out)


def _normal_columns(df: DataFrame, cols: list[str]) -> list[tuple[str, Column, Column]]:
    """Drift normalization: whole doubles compare equal to integers, NaN is
    null. Next to each value as text stands its kind (``_kind_<column>``), so
    that the text ``1`` and the number 1 differ. A variant column holds values of
    several kinds; each row has its own."""
    out = []
    for f in df.select(*cols).schema.fields:
        c, kind = F.col(f"`{f.name}`"), "text"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            d = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            whole = (d == F.floor(d)) & (F.abs(d) < 2.0**63)
            c, kind = F.when(whole, F.floor(d).cast("string")).otherwise(d.cast("string")), "number"
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            c, kind = c.cast("bigint").cast("string"), "number"
        elif isinstance(f.dataType, T.VariantType):
            d, own = F.try_variant_get(c, "$", "double"), F.schema_of_variant(c)
            d = F.nanvl(d, F.lit(None).cast("double"))
            whole = (d == F.floor(d)) & (F.abs(d) < 2.0**63)
            real, text = own.rlike("^(DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(c, "$", "string")
            c = F.when(real & whole, F.floor(d).cast("string")).when(real, d.cast("string")).otherwise(text)
            mixed = F.when(real | (own == "BIGINT"), F.lit("number")).when(own == "STRING", F.lit("text")).otherwise(F.lower(own))
        elif not isinstance(f.dataType, T.StringType):
            c, kind = c.cast("string"), f.dataType.typeName()
        kind = mixed if isinstance(f.dataType, T.VariantType) else F.lit(kind)
        out.append((f.name, c, F.when(c.isNotNull(), kind)))
    return out


def drift(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Multiset difference both ways: rows (with multiplicity) only in
    ``a`` and only in ``b``. One union and one signed grouped count."""
    return _net_rows(normalize_values(a, cols), normalize_values(b, cols), cols)


def _net_rows(na: DataFrame, nb: DataFrame, cols: list[str]) -> DataFrame:
    both = na.withColumn("_s", F.lit(1)).unionByName(nb.withColumn("_s", F.lit(-1)))
    g = both.groupBy(*cols, *[f"_kind_{c}" for c in cols]).agg(F.sum("_s").alias("_net"))
    return g.where(F.col("_net") != 0).select(
        *cols, F.when(F.col("_net") > 0, F.lit("only_a")).otherwise(F.lit("only_b")).alias("side"),
        F.abs("_net").alias("n"))


def _row_hashes(df: DataFrame, cols: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of normalized values with kind and length, nulls marked, so no two different rows read alike."""
    parts = [F.coalesce(F.concat(kind, F.lit(":"), F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for _, c, kind in _normal_columns(df, cols)]
    row = F.concat_ws("|", *parts)
    return F.xxhash64(row), F.xxhash64(F.lit(1), row)


def unequal_buckets(a: DataFrame, b: DataFrame, cols: list[str], buckets: int = 65536) -> DataFrame:
    """Buckets of the row hash in which two tables differ in row count or hash sums.

    Each side is one scan with a partial aggregate: what is shuffled is at most
    one row a bucket and task, however many rows the tables have. Buckets that
    agree hold the same rows but with a probability of about 2^-100: the sums are
    those of 24-bit parts of both hashes, so they hold for 2^39 rows a bucket.
    """
    sides = []
    for df, sign in ((a, 1), (b, -1)):
        one, two = _row_hashes(df, cols)
        h = df.select(one.alias("_h1"), two.alias("_h2"))
        lanes = [F.shiftright(c, at).bitwiseAND(F.lit(0xFFFFFF)) for c in ("_h1", "_h2") for at in (0, 24, 40)]
        sides.append(h.select(F.pmod("_h1", F.lit(buckets)).alias("bucket"), F.lit(sign).cast("bigint").alias("rows"),
                              *[(lane * sign).alias(f"s{i}") for i, lane in enumerate(lanes)]))
    sums = ["rows", *[f"s{i}" for i in range(6)]]
    g = sides[0].unionByName(sides[1]).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums])
    return g.where(reduce(lambda x, y: x | y, [F.col(c) != 0 for c in sums])).select("bucket")


def drift_by_checksums(a: DataFrame, b: DataFrame, cols: list[str], buckets: int = 65536) -> DataFrame:
    """H15 for large tables that mostly agree: the result of :func:`drift`, but
    only rows of unequal buckets are shuffled.

    The unequal buckets (at most ``buckets`` numbers, so they are broadcast) cut
    both sides at a second scan, before the signed count. Equal tables shuffle
    checksums alone; ``d`` differing rows bring along ``d / buckets`` of the others.
    """
    differ = F.broadcast(cut_lineage(unequal_buckets(a, b, cols, buckets)))
    cut = []
    for df in (a, b):
        # the bucket is one expression over the stored columns; values are normalized after the cut
        rows = df.select(*cols, F.pmod(_row_hashes(df, cols)[0], F.lit(buckets)).alias("bucket"))
        cut.append(normalize_values(rows.join(differ, "bucket", "left_semi"), cols))
    return _net_rows(cut[0], cut[1], cols)


def drift_summary(a: DataFrame, b: DataFrame, cols: list[str], name: str) -> DataFrame:
    """How many rows (with multiplicity) only one side has. Rows are counted
    under their two 64-bit hashes, which alone are shuffled; two different ones of n
    rows share both with a probability of about n^2 / 2^129."""
    sides = []
    for df, sign in ((a, 1), (b, -1)):
        one, two = _row_hashes(df, cols)
        sides.append(df.select(one.alias("_h1"), two.alias("_h2"), F.lit(sign).cast("bigint").alias("_s")))
    net = F.col("_net")
    s = sides[0].unionByName(sides[1]).groupBy("_h1", "_h2").agg(F.sum("_s").alias("_net")).agg(
        F.coalesce(F.sum(F.when(net > 0, net)), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.when(net < 0, -net)), F.lit(0)).alias("only_b"))
    return s.select(F.lit(name).alias("table_name"), "only_a", "only_b",
                    F.when((F.col("only_a") == 0) & (F.col("only_b") == 0), F.lit("clean"))
                    .otherwise(F.lit("DRIFT")).alias("status"))


#: The compared columns of each entity table.
DRIFT_TABLES = {
    "clients": ["client_id", "client_name", "abbreviation", "is_active", "notes"],
    "domains": ["domain_id", "domain", "domain_name", "is_active", "notes"],
    "client_domains": ["client_id", "domain_id", "is_competitor", "priority", "notes"],
    "projects": ["project_id", "client_id", "project_type", "project_name", "status", "notes"],
    "project_domains": ["project_id", "domain_id", "role", "priority", "notes"],
    "dataset_catalog": ["dataset", "dataset_type", "hostname", "is_standardized", "owner", "active"],
    "client_datasets": ["client_id", "domain_id", "dataset_id", "is_active", "notes"],
    "table_catalog": ["dataset", "table_name", "row_count", "size_bytes", "is_active"],
}


def drift_report(a: dict[str, DataFrame], b: dict[str, DataFrame], split_ids: DataFrame | None = None) -> DataFrame:
    """One summary row per entity table. ``split_ids`` (project_id,
    old_id) maps ids given by a project split (H17) back before comparing."""
    parts = []
    for name, cols in DRIFT_TABLES.items():
        if name not in a:
            continue
        other = b[name]
        if split_ids is not None and "project_id" in cols:
            other = other.join(split_ids, "project_id", "left").withColumn(
                "project_id", F.coalesce("old_id", "project_id"))
        parts.append(drift_summary(a[name], other, cols, name))
    return reduce(DataFrame.unionByName, parts)


def orphans(checks: list[tuple[str, DataFrame, list[str], DataFrame, list[str]]]) -> DataFrame:
    """Child rows whose parent key is missing, one anti join per check.

    ``checks``: (name, child, child_keys, parent, parent_keys). A null child
    key is allowed (never an orphan). Output: check name and the values of
    the child's columns joined by ``,`` (project the child to its keys).
    """
    parts = []
    for name, child, ck, parent, pk in checks:
        p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, ck)]).distinct()
        nonnull = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in ck])
        bad = child.where(nonnull).join(p, ck, "left_anti")
        parts.append(bad.select(F.lit(name).alias("check"),
                                F.concat_ws(",", *[F.col(c).cast("string") for c in child.columns])
                                .alias("child_key")))
    return reduce(DataFrame.unionByName, parts)


def entity_orphans(clients: DataFrame, domains: DataFrame, client_domains: DataFrame, projects: DataFrame,
                   project_domains: DataFrame, client_datasets: DataFrame) -> DataFrame:
    """The seven foreign-key checks of the entity tables."""
    cd = client_domains.select("client_id", "domain_id")
    pd = project_domains.select("project_id", "domain_id")
    ds = client_datasets.select("client_id", "domain_id", "dataset_id")
    return orphans([
        ("client_domains_bad_client", cd, ["client_id"], clients, ["client_id"]),
        ("client_domains_bad_domain", cd, ["domain_id"], domains, ["domain_id"]),
        ("projects_bad_client", projects.select("project_id", "client_id"), ["client_id"], clients, ["client_id"]),
        ("project_domains_bad_project", pd, ["project_id"], projects, ["project_id"]),
        ("project_domains_bad_domain", pd, ["domain_id"], domains, ["domain_id"]),
        ("client_datasets_bad_client", ds, ["client_id"], clients, ["client_id"]),
        ("client_datasets_bad_domain", ds, ["domain_id"], domains, ["domain_id"]),
    ])


def split_collided(projects: DataFrame, links: DataFrame, domains: DataFrame,
                   keepers: DataFrame | None = None):
    """Project ids used by more than one row. The named keeper (else the
    first row by name) keeps the id; each other row gets its own new id above
    the maximum; links follow by (old id, domain).

    A project's domain is its name with a trailing ``_digits`` stripped. Rows
    are moved one by one, never joined back, so no row multiplies. Two rows
    of one id with the same domain cannot be told apart by their links; these
    pairs are reported, and their links stay with the kept row or go to the
    first new id. Returns (projects, links, remap, duplicates): remap has
    (project_id, old_id), duplicates (project_id, domain, n).
    """
    from searchlake.functions.domains import project_domain_name
    from searchlake.operators.ids import dense_index
    p = projects.withColumn("_dom", project_domain_name(F.col("project_name")))
    shared = p.groupBy("project_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("project_id")
    coll = p.join(shared, "project_id", "left_semi")
    if keepers is not None:
        coll = coll.join(keepers.select("project_id", F.col("domain").alias("_keep")), "project_id", "left")
    else:
        coll = coll.withColumn("_keep", F.lit(None).cast("string"))
    order = Window.partitionBy("project_id").orderBy(
        F.coalesce(F.col("_dom") == F.col("_keep"), F.lit(False)).desc(), "project_name",
        F.xxhash64(*[F.col(c) for c in projects.columns]))
    coll = coll.withColumn("_nth", F.row_number().over(order))
    maxid = projects.agg(F.max("project_id")).first()[0] or 0
    movers = dense_index(coll.where("_nth > 1"), ["project_id", "_nth"], start=maxid + 1, name="_new_id")
    kept = coll.where("_nth = 1")
    new_p = (p.join(shared, "project_id", "left_anti").select(*projects.columns)
             .unionByName(kept.select(*projects.columns))
             .unionByName(movers.withColumn("project_id", F.col("_new_id")).select(*projects.columns)))
    remap = movers.select(F.col("_new_id").alias("project_id"), F.col("project_id").alias("old_id"))
    target = (movers.join(kept.select("project_id", "_dom"), ["project_id", "_dom"], "left_anti")
              .groupBy("project_id", "_dom").agg(F.min("_new_id").alias("_new_id")))
    new_l = (links.join(domains.select("domain_id", F.col("domain").alias("_dom")), "domain_id", "left")
             .join(target, ["project_id", "_dom"], "left")
             .withColumn("project_id", F.coalesce("_new_id", "project_id")))
    duplicates = (coll.groupBy("project_id", F.col("_dom").alias("domain")).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > 1))
    return new_p, new_l.select(*links.columns), remap, duplicates


def project_to_schema(df: DataFrame, target_cols: list[str]):
    """Keep only the target columns (NaN -> null); also the list of
    dropped columns."""
    keep = [c for c in df.columns if c in target_cols]
    dropped = [c for c in df.columns if c not in target_cols]
    cols = []
    for f in df.select(*keep).schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols), dropped


def bad_timestamps(tables: dict[str, DataFrame], limit: str = "9999-12-31 23:59:59") -> DataFrame:
    """Per table and timestamp column, the count of values past
    9999-12-31."""
    parts = []
    for name, df in tables.items():
        ts_cols = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
        for c in ts_cols:
            parts.append(df.agg(F.count_if(F.col(c) > F.lit(limit).cast(df.schema[c].dataType))
                                .alias("bad")).select(F.lit(name).alias("table_name"),
                                                      F.lit(c).alias("column_name"), "bad"))
    return reduce(DataFrame.unionByName, parts)
