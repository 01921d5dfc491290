"""Upload log and data access (D1-D11): filters, semi joins, top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.ingest import MANY_UPLOADS, any_of


def _and(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def top_keywords(ranked: DataFrame, n: int = 50, domain: str | None = None,
                 job_id: str | None = None, domain_col: str = "main_domain") -> DataFrame:
    """Distinct keywords per domain by search volume (desc, nulls last).

    The per-keyword max is a partial (map-side) aggregate; the top-n filter on
    ``row_number`` is planned as a window group limit, so a hot domain ships at
    most ``n`` rows per map partition to its reducer.
    """
    df = ranked
    conds = []
    if domain is not None:
        conds.append(F.col(domain_col) == domain)
    if job_id is not None:
        conds.append(F.col("job_id") == job_id)
    if conds:
        df = df.where(_and(conds))
    per_kw = df.groupBy(F.col(domain_col).alias("domain"), "keyword").agg(
        F.max("search_volume").alias("search_volume"))
    w = Window.partitionBy("domain").orderBy(F.col("search_volume").desc_nulls_last(),
                                             F.col("keyword").asc())
    return (per_kw.withColumn("kw_rank", F.row_number().over(w))
            .where(F.col("kw_rank") <= n))


def _filters(**kw) -> list[Column]:
    conds = []
    for col, val in kw.items():
        if val is None:
            continue
        if col == "since":
            conds.append(F.col("ingest_timestamp") >= F.lit(val).cast("timestamp"))
        else:
            # the log's ids are text: the value is compared as text, the column is not cast
            conds.append(F.col(col) == F.lit(str(val)))
    return conds


def search_uploads(log: DataFrame, client_id=None, project_id=None, job_id=None,
                   upload_id=None, dataset=None, table=None, since=None,
                   limit: int | None = 50) -> DataFrame:
    """AND of the given filters, newest first, then ``limit``.

    Null client or project ids never match a filter (they are lower bounds).
    The order is total (timestamp, then upload id) so the limit is stable.
    """
    conds = _filters(client_id=client_id, project_id=project_id, job_id=job_id,
                     upload_id=upload_id, dataset=dataset, table_name=table, since=since)
    df = log.where(_and(conds)) if conds else log
    df = df.orderBy(F.col("ingest_timestamp").desc(), F.col("upload_id").asc())
    return df.limit(limit) if limit is not None else df


def upload_summary(log: DataFrame, client_id=None) -> DataFrame:
    """Per dataset and table: rows, uploads, latest upload; newest first."""
    df = log.where(F.col("client_id") == str(client_id)) if client_id is not None else log
    return (df.groupBy("dataset", "table_name")
            .agg(F.sum("row_count").alias("total_rows"),
                 F.count(F.lit(1)).alias("upload_count"),
                 F.max("ingest_timestamp").alias("latest_upload"))
            .orderBy(F.col("latest_upload").desc(), "dataset", "table_name"))


def preview_upload(log: DataFrame, data: DataFrame, upload_id: str | None = None,
                   limit: int | None = 100, order: list[str] | None = None) -> DataFrame:
    """D3: rows of the data table that carry a logged upload id; empty when
    the log does not know it. With ``upload_id`` one upload: a filter on the
    id, which Parquet readers get pushed down; without it every logged upload
    at once, each cut to ``limit`` rows in ``order`` (a window group limit,
    applied map-side). Days are not cut: the log names one time of an upload,
    its rows may lie on others."""
    if upload_id is not None:
        mine = log.where(F.col("upload_id") == upload_id)
        df = data.where(F.col("upload_id") == upload_id)
        df = df.join(mine.select("upload_id").distinct(), "upload_id", "left_semi")
        if limit is not None and order:
            df = df.orderBy(*order)
        return df.limit(limit) if limit is not None else df
    known = log.select("upload_id").distinct()
    df = data.join(known, "upload_id", "left_semi")
    if limit is None:
        return df
    order = order or [c for c in data.columns if c != "upload_id"]
    w = Window.partitionBy("upload_id").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def available_datasets(log: DataFrame, client_id=None) -> DataFrame:
    """Distinct datasets, sorted; empty and null left out."""
    df = log.where(F.col("client_id") == str(client_id)) if client_id is not None else log
    return (df.where(F.col("dataset").isNotNull() & (F.col("dataset") != ""))
            .select("dataset").distinct().orderBy("dataset"))


def available_tables(log: DataFrame, dataset=None, client_id=None,
                     per_dataset: bool = False) -> DataFrame:
    """Distinct tables (of a dataset), sorted; with ``per_dataset`` the
    distinct (dataset, table_name) pairs, answering every dataset at once."""
    conds = _filters(dataset=dataset, client_id=client_id)
    df = log.where(_and(conds)) if conds else log
    keys = ["dataset", "table_name"] if per_dataset else ["table_name"]
    return (df.where(F.col("table_name").isNotNull() & (F.col("table_name") != ""))
            .select(*keys).distinct().orderBy(*keys))


def client_job_ids(log: DataFrame, client_id=None, dataset=None, table=None) -> DataFrame:
    """Distinct job ids of a client, sorted; without ``client_id`` the
    distinct (client_id, job_id) pairs of all clients."""
    conds = _filters(client_id=client_id, dataset=dataset, table_name=table)
    df = log.where(_and(conds)) if conds else log
    df = df.where(F.col("job_id").isNotNull())
    if client_id is not None:
        return df.select("job_id").distinct().orderBy("job_id")
    return (df.where(F.col("client_id").isNotNull()).select("client_id", "job_id").distinct()
            .orderBy("client_id", "job_id"))


def _by_owner(data: DataFrame, log: DataFrame, owner: str, owner_id, table, limit,
              per_table: bool = False):
    conds = _filters(**{owner: owner_id}, table_name=table)
    jobs = log.where(_and(conds)) if conds else log
    if owner_id is not None:
        mine = jobs.where(F.col("job_id").isNotNull()).select("job_id").distinct()
        # by job alone: a job's rows may come from uploads logged for others, from
        # uploads without an event, and from other days than the log names. The ids of
        # an owner of few jobs become equalities, which Bloom filters answer
        ids = [r["job_id"] for r in mine.limit(MANY_UPLOADS + 1).collect()]
        df = data.where(any_of("job_id", ids)) if len(ids) <= MANY_UPLOADS else data.join(mine, "job_id", "left_semi")
    else:
        # every owner at once: (owner, job) pairs joined to the rows; with
        # per_table, (owner, table, job) triples answer every table as well
        keys = [owner, "table_name"] if per_table else [owner]
        pairs = (jobs.where(_and([F.col(k).isNotNull() for k in keys]))
                 .select(*keys, "job_id").distinct())
        df = data.join(pairs, "job_id")
    return df.limit(limit) if limit is not None else df


def client_data(data: DataFrame, log: DataFrame, client_id=None, table=None,
                limit: int | None = None, per_table: bool = False) -> DataFrame:
    """Data rows whose job id the log lists for the client (and table).

    One client: the rows of its job ids, as pushed-down equalities that skip
    row groups by Bloom filter, or a ``left_semi`` join when they are many. No client: the rows of all
    clients, each tagged with its ``client_id`` (join on distinct (client,
    job) pairs; with ``per_table`` also tagged with its ``table_name``).
    AQE broadcasts the log side when it is small, else shuffles, and splits
    a hot job id (skew join)."""
    return _by_owner(data, log, "client_id", client_id, table, limit, per_table)


def project_data(data: DataFrame, log: DataFrame, project_id=None, table=None,
                 limit: int | None = None) -> DataFrame:
    """As D7 by project."""
    return _by_owner(data, log, "project_id", project_id, table, limit)


def client_data_by_domain(data: DataFrame, client_domains: DataFrame, domains: DataFrame,
                          clients, limit: int | None = None) -> DataFrame:
    """Data rows whose domain is one of the client's own (non-competitor)
    domains, in one plan: links join domains, then a semi join.

    ``clients`` is one client id, or a frame of client ids: a batch is
    answered at once, each data row once per client of the batch that owns
    its domain, with a leading ``client_id`` (one equi join on the domain; a
    domain held by very many clients is a skewed key that AQE splits on the
    data side). A batch of all clients multiplies the data by the owners per
    domain; that is the caller's choice.
    """
    links = client_domains.where(~F.col("is_competitor"))
    batch = isinstance(clients, DataFrame)
    links = links.join(clients.select("client_id").distinct(), "client_id", "left_semi") if batch \
        else links.where(F.col("client_id") == clients)
    own = links.join(domains.select("domain_id", "domain"), "domain_id").select("client_id", "domain")
    if batch:
        df = data.join(own.distinct(), "domain").select("client_id", *data.columns)
    else:
        df = data.join(own.select("domain"), "domain", "left_semi")
    return df.limit(limit) if limit is not None else df


def html_ok_urls(crawl: DataFrame, job_id=None) -> DataFrame:
    """Addresses with an html content type and status 200, sorted."""
    df = crawl.where(F.col("job_id") == job_id) if job_id is not None else crawl
    return (df.where(F.lower(F.col("content_type").cast("string")).like("%html%")
                     & (F.col("status_code").cast("string") == "200")
                     & F.col("address").isNotNull() & (F.col("address") != ""))
            .select("address").orderBy("address"))
