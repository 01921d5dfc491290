"""Write path and request side: stamps, appends, snapshots, exports (A2-A11),
dedupe, page assembly, request payloads and target batches (B16-B20).

Tables are Parquet directories. Appends partition by ingest day and sort
inside each file by (domain_id, job_id), the layout the warehouse used
(daily partitions, clustered on those keys), so day filters prune files and
domain / job filters skip row groups.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.operators.ids import dense_index
from searchlake.schemas import ENDPOINTS

# Columns of an upload event, and of one row of the attempt log.
UPLOAD_EVENT_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("upload_id", T.StringType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("source_program", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("ingest_timestamp", T.TimestampType(), False),
    T.StructField("client_id", T.StringType()),
    T.StructField("project_id", T.StringType()),
    T.StructField("notes", T.StringType()),
])

ATTEMPT_LOG_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("upload_id", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("is_terminal", T.BooleanType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("thread_name", T.StringType()),
    T.StructField("http_status", T.LongType()),
    T.StructField("task_status_code", T.LongType()),
    T.StructField("task_status_message", T.StringType()),
    T.StructField("task_cost", T.DoubleType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("ingest_timestamp", T.TimestampType()),
])


# ----------------------------------------------------------------- helpers
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _read_lines(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()


def _write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()


def validate_job_id(job_id: str) -> str:
    """A3: the job id must be a UUID."""
    try:
        uuid.UUID(str(job_id))
    except (ValueError, AttributeError, TypeError) as e:
        raise ValueError(f"job_id {job_id!r} is not a valid UUID") from e
    return str(job_id)


# ----------------------------------------------------------------- A2, A3
def stamp_fetch(df: DataFrame, domain_id: int | None, domain: str | None,
                mode: str = "live") -> DataFrame:
    """A2: caller context on every row: domain_id, domain, endpoint_mode."""
    if mode not in ("live", "standard"):
        raise ValueError(f"endpoint_mode must be live or standard, not {mode!r}")
    return df.withColumns({
        "domain_id": F.lit(domain_id).cast("bigint"),
        "domain": F.lit(domain).cast("string"),
        "endpoint_mode": F.lit(mode),
    })


def stamp_upload(df: DataFrame, job_id: str, upload_id: str | None = None,
                 ts=None) -> DataFrame:
    """A3: job_id (a UUID), one upload_id per batch and the ingest time.

    The ids are made on the driver and enter the plan as literals, so a task
    retry or a recomputation writes the same values (``uuid()`` in the plan
    would not)."""
    validate_job_id(job_id)
    upload_id = upload_id or str(uuid.uuid4())
    if ts is None:
        ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ts_c = F.lit(ts).cast("timestamp")
    return df.withColumns({"job_id": F.lit(job_id), "upload_id": F.lit(upload_id),
                           "ingest_timestamp": ts_c})


# ----------------------------------------------------------------- A4-A8
def to_table_layout(df: DataFrame, endpoint: str) -> DataFrame:
    """Order and type the columns as the endpoint table declares them."""
    schema = ENDPOINTS[endpoint].table_schema()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def create_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_col: str = "ingest_date") -> None:
    """Create an empty table so appends may go to it. A file without rows in
    the null partition carries the schema, so that the table can be read."""
    if path_exists(spark, path):
        raise FileExistsError(f"table {path} exists")
    empty = spark.createDataFrame([], schema).drop(partition_col)
    empty.coalesce(1).write.parquet(f"{path}/{partition_col}=__HIVE_DEFAULT_PARTITION__")


#: Ids that readers filter by; each row group carries a Bloom filter of them.
BLOOM_COLUMNS = ("job_id", "upload_id")


def _with_blooms(writer, columns, skip=()):
    for c in BLOOM_COLUMNS:
        if c in columns and c not in skip:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    # the size follows the distinct ids of the row group
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def append_batch(df: DataFrame, path: str, ts_col: str = "ingest_timestamp",
                 cluster=("domain_id", "job_id"), files_per_day: int | None = None) -> bool:
    """A4: append rows to an existing table.

    Empty input: skipped. Missing table: refused, not created. Rows are
    rebalanced by ingest day (or hashed into ``files_per_day`` buckets per
    day when given), sorted inside each file by ``cluster`` and written
    partitioned by day. Files carry Bloom filters of ``BLOOM_COLUMNS``, so a
    filter on one job or upload skips row groups on any day.
    Returns whether anything was written.
    """
    _must_exist(df.sparkSession, path)
    if df.isEmpty():
        return False
    _append_days(df, path, ts_col, cluster, files_per_day)
    return True


def _must_exist(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"table {path} does not exist; create it before appending")


def _append_days(df: DataFrame, path: str, ts_col: str = "ingest_timestamp",
                 cluster=("domain_id", "job_id"), files_per_day: int | None = None) -> None:
    """The write of :func:`append_batch`; computes ``df`` once and adds no file when it is empty."""
    out = df.withColumn("ingest_date", F.to_date(ts_col))
    if files_per_day:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in cluster]), F.lit(files_per_day))
        out = out.repartition("ingest_date", spread)
    else:
        # REBALANCE: AQE splits a skewed day into several tasks and merges
        # small days, so no single task writes a hot day
        out = out.hint("rebalance", "ingest_date")
    out = out.sortWithinPartitions("ingest_date", *cluster)
    _with_blooms(out.write.mode("append"), df.columns).partitionBy("ingest_date").parquet(path)


def replace_upload(df: DataFrame, path: str, upload_id: str, cluster=("domain_id", "job_id")) -> DataFrame | None:
    """A4 for streams: store the rows of one upload as its own partition.

    The table is partitioned by ``upload_id`` and written with Spark's dynamic
    partition overwrite, so a repeat with the same id (a micro-batch that is
    replayed) replaces that upload and nothing else; Spark commits the
    partition as a whole. Day filters are answered by the row-group statistics
    of ``ingest_timestamp``, of which an upload has one. Rows are written by the
    tasks that make them, with no shuffle: there is one partition to write to, and
    the reader of a landing has cut it evenly. Returns the stored rows, or None
    when the upload has none.
    """
    spark = df.sparkSession
    out = df.withColumn("upload_id", F.lit(upload_id))
    if cluster:
        out = out.sortWithinPartitions(*cluster)
    _with_blooms(out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic"), df.columns, skip=("upload_id",)) \
        .partitionBy("upload_id").parquet(path)
    part = f"{path}/upload_id={upload_id}"
    if not path_exists(spark, part):
        return None
    return spark.read.parquet(part).withColumn("upload_id", F.lit(upload_id))


def upload_event(df: DataFrame, source: str, source_program: str, dataset: str, table: str,
                 client_id=None, project_id=None, notes=None) -> DataFrame:
    """A5: one audit row per (job_id, upload_id) of a written batch: row
    count and ingest time, plus the caller's labels."""
    g = df.groupBy("job_id", "upload_id").agg(F.count(F.lit(1)).alias("row_count"),
                                              F.min("ingest_timestamp").alias("ingest_timestamp"))
    out = g.select(
        "job_id", "upload_id", F.lit(source).alias("source"),
        F.lit(source_program).alias("source_program"), F.lit(dataset).alias("dataset"),
        F.lit(table).alias("table_name"), F.col("row_count").cast("bigint"), "ingest_timestamp",
        F.lit(client_id).cast("string").alias("client_id"),
        F.lit(project_id).cast("string").alias("project_id"),
        F.lit(notes).cast("string").alias("notes"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in UPLOAD_EVENT_SCHEMA.fields])


def stored_uploads(rows: DataFrame, path: str) -> DataFrame:
    """The rows of a table that carry an upload id of ``rows``, which was stamped with one or a few."""
    ids = [r["upload_id"] for r in rows.select("upload_id").distinct().limit(MANY_UPLOADS + 1).collect()]
    stored = rows.sparkSession.read.parquet(path)
    if len(ids) > MANY_UPLOADS:
        return stored.join(rows.select("upload_id").distinct(), "upload_id", "left_semi")
    return stored.where(any_of("upload_id", ids))


#: Up to so many ids are equalities that Parquet readers test against Bloom filters; more are a semi join.
MANY_UPLOADS = 64


def any_of(column: str, values: list) -> Column:
    """``column`` equals one of a few values, as equalities (a long IN list is pushed down as a range only)."""
    out = F.lit(False)
    for i, v in enumerate(values):
        out = F.col(column) == F.lit(v) if i == 0 else out | (F.col(column) == F.lit(v))
    return out


def attempt_log_rows(records: DataFrame, job_id: str, upload_id: str | None = None, ts=None) -> DataFrame:
    """Rows of the 18-column attempt log: C1 records with ``is_terminal``
    (C3), stamped with the flush's job, upload and time."""
    rows = stamp_upload(records, job_id, upload_id, ts)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ATTEMPT_LOG_SCHEMA.fields])


def append_attempts(rows: DataFrame, path: str, events_path: str | None = None) -> None:
    """Append attempt rows to the shared attempt log (partitioned by day,
    sorted by (job_id, endpoint)) and write one upload event per flush, counted
    from the stored rows (the log's rows of the flush's uploads)."""
    if append_batch(rows, path, cluster=("job_id", "endpoint")) and events_path is not None:
        upload_event(stored_uploads(rows, path), "debug_log", "attempt_log", "logs", "debug_request_logs") \
            .write.mode("append").parquet(events_path)


def snapshot(spark: SparkSession, src: str, dst: str) -> None:
    """Copy a table as it is; refuses to overwrite an existing copy."""
    spark.read.parquet(src).write.mode("errorifexists").parquet(dst)


def _current_version(spark: SparkSession, base: str) -> int:
    lines = _read_lines(spark, f"{base}/_CURRENT")
    return int(lines[0]) if lines else 0


def reload(df: DataFrame, base: str) -> str:
    """Idempotent full reload: write a new version directory, then move
    the ``_CURRENT`` pointer to it. A failed write leaves the old version in
    place; readers use :func:`read_current`."""
    spark = df.sparkSession
    version = _current_version(spark, base) + 1
    target = f"{base}/v{version}"
    df.write.mode("overwrite").parquet(target)
    _write_lines(spark, f"{base}/_CURRENT", [str(version)])
    return target


def read_current(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/v{_current_version(spark, base)}")


# ----------------------------------------------------------------- A9-A11
MAPPING_CSV_SCHEMA = T.StructType([
    T.StructField("raw_domain", T.StringType()), T.StructField("normalized_domain", T.StringType()),
    T.StructField("rows_ranked_keywords", T.LongType()),
    T.StructField("rows_backlinks_backlinks", T.LongType()), T.StructField("rows_total", T.LongType()),
    T.StructField("meta_match_domain_id", T.LongType()), T.StructField("meta_match_domain", T.StringType()),
    T.StructField("suggested", T.StringType()), T.StructField("decision", T.StringType())])


def read_mapping_csv(spark: SparkSession, path: str, schema: T.StructType = MAPPING_CSV_SCHEMA) -> DataFrame:
    """The annotated mapping CSV with typed nullable ids; a null decision
    becomes the empty string."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("decision", F.coalesce(F.col("decision"), F.lit("")))


def write_inventory_csv(inventory: DataFrame, path: str) -> None:
    """A10: the domain inventory with an empty ``decision`` column."""
    inventory.withColumn("decision", F.lit("")).write.mode("overwrite").option("header", True).csv(path)


def prepare_export(df: DataFrame, order: list[str], max_cells: int = 500_000) -> DataFrame:
    """A sheet-ready table: every value as text, nulls in ``*_url``
    columns become ``Not ranking`` and other nulls the empty string; the
    header is sheet row 1, so data row i (0-based) is sheet row i + 2 and
    goes to batch (i + 1) div (max_cells div column count).

    The row number is a dense index over ``order`` computed without a
    single-task window (see :mod:`searchlake.operators.ids`)."""
    ncols = len(df.columns)
    rows_per_batch = max_cells // ncols
    cols = [F.coalesce(F.col(c).cast("string"),
                       F.lit("Not ranking" if c.endswith("_url") else "")).alias(c) for c in df.columns]
    idx = dense_index(df, order, start=0, name="_i")
    out = idx.select(*cols, (F.col("_i") + 2).alias("sheet_row"),
                     ((F.col("_i") + 1) / F.lit(rows_per_batch)).cast("bigint").alias("batch_no"))
    return out


# ----------------------------------------------------------------- B16-B20
def dedupe(df: DataFrame, key: list[str] | str, order_col: str = "ingest_timestamp") -> DataFrame:
    """B16 (opt-in): one row per natural key, the newest by ``order_col``;
    ties broken by the remaining columns in table order. ``key`` is a list of
    columns or an endpoint name (its declared key).

    A grouped ``max`` of a struct, combined in each task before the shuffle
    (as a sort aggregate: a task sorts its own rows), so a key repeated very
    often reaches the shuffle once per task.
    """
    if isinstance(key, str):
        key = [c for c in ENDPOINTS[key].key]
    rest = [c for c in df.columns if c not in key and c != order_col]
    best = F.max(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("_b")
    g = df.groupBy(*key).agg(best)
    return g.select(*[F.col(c) for c in key], F.col(f"_b.{order_col}").alias(order_col),
                    *[F.col(f"_b.{c}").alias(c) for c in rest]).select(*df.columns)


def dedupe_stream(df: DataFrame, key: list[str] | str, watermark_col: str = "ingest_timestamp",
                  delay: str = "1 hour") -> DataFrame:
    """B16 on a stream: drop rows whose natural key was already seen within
    the watermark delay (``dropDuplicatesWithinWatermark``; the first row
    seen is kept)."""
    if isinstance(key, str):
        key = [c for c in ENDPOINTS[key].key]
    return df.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(key)


def assemble_pages(pages: DataFrame, mode: str, page_size: int = 1000, limit: int | None = None,
                   cap: int = 20000, run: tuple[str, ...] = ()) -> DataFrame:
    """Which landed pages of each target the paging loop keeps.

    ``pages``: (target, offset, n_rows[, raw]). ``run`` names the columns that
    tell the fetches of one target apart (job or upload, and attempt); pages
    of different runs never mix. ``backlinks``: pages in offset order until
    the first empty page (dropped) or short page (kept), while offset <
    ``cap`` and fewer than ``limit`` rows were fetched; the requested size of
    a page is min(page_size, limit - fetched). ``ranked``: pages below
    ``limit`` until two empty pages in a row; empty pages are not kept.
    Pages past ``cap`` (``limit`` for ranked) go before the window, so a
    group has at most cap / page size pages of one run.
    """
    n, most = F.col("n_rows"), cap if mode == "backlinks" else limit
    w = Window.partitionBy(*run, "target").orderBy("offset")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    df = pages if most is None else pages.where(F.col("offset") < most)
    if mode == "backlinks":
        df = df.withColumn("_fetched", F.coalesce(F.sum(n).over(before), F.lit(0)))
        req = F.lit(page_size) if limit is None else F.least(F.lit(page_size), F.lit(limit) - F.col("_fetched"))
        df = df.withColumn("_req", req).withColumn("_stop", (n < F.col("_req")).cast("int"))
        df = df.withColumn("_stopped", F.coalesce(F.max("_stop").over(before), F.lit(0)) == 1)
        return df.where((~F.col("_stopped")) & (n > 0) & (F.col("_req") > 0)).drop("_fetched", "_req", "_stop", "_stopped")
    if mode == "ranked":
        df = df.withColumn("_two", ((F.lag(n).over(w) == 0) & (n == 0)).cast("int"))
        df = df.withColumn("_stopped", F.coalesce(F.max("_two").over(before), F.lit(0)) == 1)
        return df.where((~F.col("_stopped")) & (n > 0)).drop("_two", "_stopped")
    raise ValueError(mode)


# Request payload defaults per endpoint, the payload fields of
# targets, and batch sizes.
PAYLOAD_DEFAULTS = {
    "serp_organic": {"location_code": 2840, "language_code": "en"},
    "backlinks": {"limit": 1000, "offset": 0, "filters": [["dofollow", "=", True]]},
    "bulk_pages_summary": {},
    "backlinks_summary": {"internal_list_limit": 10, "include_subdomains": True,
                          "backlinks_status_type": "live"},
    "ranked_keywords": {"language_name": "English", "location_code": 2840, "limit": 1000, "offset": 0,
                        "load_rank_absolute": True,
                        "order_by": ["ranked_serp_element.serp_item.etv,desc"], "filters": None},
    "keyword_suggestions": {"location_code": 2840, "language_code": "en", "limit": 50,
                            "include_seed_keyword": False,
                            "filters": [["keyword_info.search_volume", ">", 10]],
                            "order_by": ["keyword_info.search_volume,desc"]},
    "related_keywords": {"location_code": 2840, "language_code": "en", "depth": 1, "limit": 20,
                         "include_seed_keyword": False,
                         "filters": [["keyword_data.keyword_info.search_volume", ">", 10]],
                         "order_by": ["keyword_data.keyword_info.search_volume,desc"]},
    "keyword_overview": {"location_code": 2840, "language_code": "en"},
    "search_intent": {"language_code": "en"},
    "domain_rank_overview": {"location_code": 2840, "language_code": "en"},
    "search_volume": {"language_name": "English", "location_code": 2840},
}
TARGET_FIELD = {"serp_organic": "keyword", "keyword_suggestions": "keyword", "related_keywords": "keyword",
                "backlinks": "target", "backlinks_summary": "target", "ranked_keywords": "target",
                "domain_rank_overview": "target"}
LIST_FIELD = {"bulk_pages_summary": "targets", "keyword_overview": "keywords", "search_intent": "keywords",
              "search_volume": "keywords"}
BATCH_SIZES = {"serp_organic": 100, "keyword_overview": 700, "search_intent": 1000,
               "search_volume": 1000, "bulk_pages_summary": 1000}


def _lit_json(v) -> Column:
    import json
    return F.lit(json.dumps(v, separators=(",", ":")))


def build_requests(targets: DataFrame, endpoint: str, overrides: dict | None = None,
                   target_col: str = "target") -> DataFrame:
    """One request payload (JSON text of a one-element list) per target,
    or per batch for list endpoints (``targets`` then has ``batch_no`` and
    ``targets`` array columns, see :func:`batch_targets`)."""
    opts = dict(PAYLOAD_DEFAULTS[endpoint])
    opts.update(overrides or {})
    if endpoint in LIST_FIELD:
        head = F.concat(F.lit('{"'), F.lit(LIST_FIELD[endpoint]), F.lit('":'), F.to_json(F.col("targets")))
    else:
        head = F.concat(F.lit('{"'), F.lit(TARGET_FIELD[endpoint]), F.lit('":'),
                        F.to_json(F.array(F.col(target_col))).substr(F.lit(2), F.length(
                            F.to_json(F.array(F.col(target_col)))) - 2))
    parts = [head] + [F.concat(F.lit(f',"{k}":'), _lit_json(v)) for k, v in opts.items()]
    payload = F.concat(F.lit("["), F.concat(*parts), F.lit("}]"))
    keep = [c for c in targets.columns if c != "targets"]
    return targets.select(*keep, payload.alias("payload"))


def batch_targets(targets: DataFrame, size: int | None, order: list[str], target_col: str = "target",
                  endpoint: str | None = None) -> DataFrame:
    """Cut an ordered target list into batches of ``size`` (default: the
    endpoint's batch size): a dense position (no single-task window),
    ``batch_no = pos div size``, then one list per batch. Each batch holds at
    most ``size`` targets."""
    if size is None:
        size = BATCH_SIZES[endpoint]
    idx = dense_index(targets, order, start=0, name="_pos")
    g = idx.groupBy((F.col("_pos") / size).cast("bigint").alias("batch_no")).agg(
        F.array_sort(F.collect_list(F.struct("_pos", target_col))).alias("_t"))
    return g.select("batch_no", F.transform("_t", lambda s: s[target_col]).alias("targets"),
                    F.size("_t").alias("n_targets"))


# ----------------------------------------------------------------- batch job
def ingest_responses(responses: DataFrame, endpoint: str, table: str, events: str, job_id: str,
                     domain_id: int | None = None, domain: str | None = None, mode: str = "live",
                     upload_id: str | None = None, source_program: str | None = None) -> str | None:
    """The batch ingest job: landed responses -> flatten ->
    type -> stamp (fetch and upload) -> append to the endpoint table -> one
    upload event. Returns the upload id, or None when nothing was written.

    The flatten, typing and stamping are one narrow stage, run once; the append
    rebalances by ingest day; the event is a small aggregate of the stored
    rows of this upload, found by its id (row groups of others are skipped).
    Whether there were any rows is asked of them, not of the responses.
    """
    from searchlake.operators.flatten import flatten
    validate_job_id(job_id)
    upload_id = upload_id or str(uuid.uuid4())
    rows = flatten(responses, endpoint)
    rows = stamp_fetch(rows, domain_id, domain, mode)
    rows = stamp_upload(rows, job_id, upload_id)
    _must_exist(responses.sparkSession, table)
    _append_days(to_table_layout(rows, endpoint), table)
    stored = responses.sparkSession.read.parquet(table).where(F.col("upload_id") == upload_id)
    if stored.isEmpty():
        return None
    upload_event(stored, "api", source_program or f"ingest_{endpoint}", "warehouse", endpoint) \
        .write.mode("append").parquet(events)
    return upload_id
