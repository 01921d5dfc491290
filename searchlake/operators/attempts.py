"""Call attempts and task states (C1-C12) over landed attempt logs.

HTTP is not built; these operators read what the calls left behind. Per-target
"first"/"last" picks use ``min``/``max`` of a struct (combined in each task
before the shuffle), so a target with very many attempts never lands whole in
one task or one window buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.operators.windows import running_sums

# Task status codes of the remote API.
OK = 20000
SUBMITTED = 20100
NOT_READY = (40601, 40602, 40202)
NOT_READY_BULK = (40102, 40601, 40602, 40202)
NOT_FOUND = 40402
INVALID_FIELD = 40501

_T0_SCHEMA = T.StructType([T.StructField("tasks", T.ArrayType(T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("status_code", T.StringType()),
    T.StructField("status_message", T.StringType()),
    T.StructField("cost", T.StringType()),
    T.StructField("result", T.ArrayType(T.StructType([
        T.StructField("items", T.ArrayType(T.StringType()))]))),
])))])


def attempt_records(calls: DataFrame) -> DataFrame:
    """One log row per attempt from raw call records.

    Task status, message and cost come from ``tasks[0]`` of the response
    (cost 0.0 when absent or when there is no response); ``n_items`` is the
    item count of the first result; ``error`` defaults to the empty string.
    With the flush's stamps (see ``ingest.attempt_log_rows``) and
    ``is_terminal`` (:func:`mark_terminal`) these are the columns of the log.
    """
    r = F.from_json("response", _T0_SCHEMA)
    t0 = F.get(r["tasks"], 0)
    items = F.get(t0["result"], 0)["items"]
    return calls.select(
        "endpoint", "target", "attempt", "started_at", "duration_ms", "thread_name", "http_status",
        t0["status_code"].try_cast("bigint").alias("task_status_code"),
        t0["status_message"].alias("task_status_message"),
        F.coalesce(t0["cost"].try_cast("double"), F.lit(0.0)).alias("task_cost"),
        F.coalesce(F.size(items), F.lit(0)).cast("bigint").alias("n_items"),
        "payload", "response",
        F.coalesce(F.col("error"), F.lit("")).alias("error"),
    )


def mark_terminal(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """Terminal when rows came back or it is the last allowed attempt."""
    return attempts.withColumn(
        "is_terminal", (F.col("n_items") > 0) | (F.col("attempt") >= max_retries))


def _accepted(mode: str) -> Column:
    if mode == "rows":
        return F.col("n_items") > 0
    if mode == "parsed":
        return F.col("http_status") == 200
    if mode == "status":
        return F.col("task_status_code") == OK
    raise ValueError(mode)


def _picked(attempts: DataFrame, keys, pick, tie: tuple[str, ...], **extra: Column) -> DataFrame:
    """Per key the first (``F.min``) or last (``F.max``) attempt by attempt number, start, ``tie`` and
    then the remaining columns as the frame has them, so that equal starts have one order."""
    order = ["attempt", "started_at", *tie]
    rest = [c for c in attempts.columns if c not in keys and c not in order]
    out = attempts.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_b"), *[c.alias(n) for n, c in extra.items()])
    return out.select(*keys, *[F.col("_b." + c).alias(c) for c in order + rest], *extra)


def response_task_id(response: Column) -> Column:
    """The id of ``tasks[0]`` of a response; null without one."""
    return F.get(F.from_json(response, _T0_SCHEMA)["tasks"], 0)["id"]


def first_success(attempts: DataFrame, mode: str = "rows",
                  keys=("endpoint", "target"), tie: tuple[str, ...] = ()) -> DataFrame:
    """The first accepted attempt per target; none when none is accepted.

    ``mode``: ``rows`` (n_items > 0, most endpoints), ``parsed`` (the first
    answer that parses, backlinks) or ``status`` (status 20000, empty or not,
    search volume). Order: attempt, started_at, ``tie``, remaining columns.
    """
    return _picked(attempts.where(_accepted(mode)), keys, F.min, tie)


def classify_task(status: Column, has_task: Column, items_null: Column,
                  mode: str = "single") -> Column:
    """C4: ``ready`` / ``not_ready`` / ``failed`` / ``error``.

    Not ready: no task, a not-ready status (40102 too in ``bulk`` mode), or
    status 20000 with a null result or null items. 40402 fails; any other
    non-20000 status is an error.
    """
    waiting = NOT_READY_BULK if mode == "bulk" else NOT_READY
    return (F.when(~has_task, F.lit("not_ready"))
            .when(status.isin(*waiting), F.lit("not_ready"))
            .when(status == NOT_FOUND, F.lit("failed"))
            .when(status != OK, F.lit("error"))
            .when(items_null, F.lit("not_ready"))
            .otherwise(F.lit("ready")))


def last_attempt(attempts: DataFrame, keys=("endpoint", "target"), tie: tuple[str, ...] = (), **extra: Column) -> DataFrame:
    return _picked(attempts, keys, F.max, tie, **extra)


def failed_targets(attempts: DataFrame, max_error_retries: int = 3,
                   mode: str = "single", task_id: str | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """Keyword, task_id, reason for targets whose last state is a failure.

    Reasons: ``task_not_found (40402)``, ``status_S_after_N_retries``,
    ``exception_after_N_retries: <first 100 chars>`` for transport errors,
    ``timeout`` when still not ready at the end. The task id is that of the
    target's latest attempt that has one: the column ``task_id`` names, or
    ``tasks[0].id`` of the logged response.
    """
    known = F.col(task_id) if task_id else response_task_id(F.col("response"))
    latest = F.max(F.when(known.isNotNull(), F.struct("attempt", "started_at", *tie, known.alias("id"))))["id"]
    last = last_attempt(attempts, tie=tie, _task=latest)
    waiting = NOT_READY_BULK if mode == "bulk" else NOT_READY
    code = F.col("task_status_code")
    exc = F.coalesce(F.nullif(F.col("error"), F.lit("")),
                     F.concat(F.lit("http "), F.col("http_status").cast("string")))
    reason = (F.when(F.col("http_status") != 200,
                     F.concat(F.lit(f"exception_after_{max_error_retries}_retries: "),
                              F.substring(exc, 1, 100)))
              .when(code == NOT_FOUND, F.lit("task_not_found (40402)"))
              .when(code.isin(*waiting), F.lit("timeout"))
              .when(code != OK, F.concat(F.lit("status_"), code.cast("string"),
                                         F.lit(f"_after_{max_error_retries}_retries"))))
    return last.select(
        F.col("endpoint"), F.col("target").alias("keyword"),
        F.col("_task").alias("task_id"),
        reason.alias("reason"),
    ).where(F.col("reason").isNotNull())


def empties_vs_successes(attempts: DataFrame, job_id: str | None = None) -> DataFrame:
    """Exact median duration and count for empty vs non-empty answers.

    Durations are counted per millisecond value first (combined before the
    shuffle); the median is read off the running counts of these histograms,
    whose rows are distinct durations, not attempts.
    """
    df = attempts if job_id is None else attempts.where(F.col("job_id") == job_id)
    side = (F.col("n_items") == 0).alias("is_empty")
    bins = df.groupBy(side, "duration_ms").agg(F.count(F.lit(1)).alias("c"))
    total = bins.groupBy("is_empty").agg(F.sum("c").alias("n"),
                                         F.sum(F.when(F.col("duration_ms").isNotNull(), F.col("c"))).alias("known"))
    counted = running_sums(bins.where(F.col("duration_ms").isNotNull()), ["is_empty"], "duration_ms", {"upto": "c"})
    at = counted.join(F.broadcast(total), "is_empty")  # at most three rows
    # ranks are 1-based; an even count averages the two middle values
    low, high = F.floor((F.col("known") + 1) / 2), F.ceil((F.col("known") + 1) / 2)
    holds = lambda rank: (F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank)
    mid = at.groupBy("is_empty").agg(((F.max(F.when(holds(low), F.col("duration_ms")))
                                       + F.max(F.when(holds(high), F.col("duration_ms")))) / 2.0).alias("p50_ms"))
    return total.join(mid, "is_empty", "left").select("is_empty", "p50_ms", "n")


def cost_by_endpoint(attempts: DataFrame) -> DataFrame:
    """Cost sum and priced calls per endpoint plus a total row
    (``endpoint`` null); calls without a cost are not counted. Costs are
    added as decimals, so the sum does not depend on the order."""
    priced = attempts.where(F.col("task_cost").isNotNull())
    return priced.rollup("endpoint").agg(
        F.sum(F.col("task_cost").cast("decimal(18,9)")).cast("double").alias("total_cost"), F.count(F.lit(1)).alias("calls"),
        F.grouping("endpoint").alias("is_total"))


def task_progress(attempts: DataFrame, max_error_retries: int = 3, task_id: str | None = None,
                  tie: tuple[str, ...] = ()) -> DataFrame:
    """C11: per endpoint, targets collected, failed and remaining, rate per
    minute over the attempt span, and minutes left at that rate."""
    ok = first_success(attempts).groupBy("endpoint").agg(F.count(F.lit(1)).alias("collected"))
    bad = failed_targets(attempts, max_error_retries, task_id=task_id, tie=tie)
    failed = (bad.join(first_success(attempts).select("endpoint", F.col("target").alias("keyword")),
                       ["endpoint", "keyword"], "left_anti")
              .groupBy("endpoint").agg(F.count(F.lit(1)).alias("failed")))
    span = attempts.groupBy("endpoint").agg(
        F.countDistinct("target").alias("total_tasks"),
        ((F.max("started_at").cast("timestamp").cast("double")
          - F.min("started_at").cast("timestamp").cast("double")) / 60.0).alias("elapsed_min"))
    out = (span.join(ok, "endpoint", "left").join(failed, "endpoint", "left")
           .fillna(0, ["collected", "failed"]))
    rate = F.when(F.col("elapsed_min") > 0, F.col("collected") / F.col("elapsed_min")).otherwise(0.0)
    remaining = F.col("total_tasks") - F.col("collected") - F.col("failed")
    return out.select(
        "endpoint", "total_tasks", "collected", "failed", remaining.alias("remaining"),
        rate.alias("rate_per_min"),
        F.when(rate > 0, remaining / rate).otherwise(0.0).alias("minutes_left"))


def invalid_target(message: Column) -> Column:
    """The text inside ``'target' (...)`` of a 40501 message, else null."""
    strict = F.regexp_extract(message, r"'target' \((.+)\)\.$", 1)
    loose = F.regexp_extract(message, r"'target' \((.+)\)", 1)
    return F.coalesce(F.nullif(strict, F.lit("")), F.nullif(loose, F.lit("")))


def drop_invalid_targets(batch: DataFrame, responses: DataFrame,
                         target_col: str = "target") -> DataFrame:
    """Remove from a target batch those named invalid by 40501 answers."""
    bad = (responses.where(F.col("task_status_code") == INVALID_FIELD)
           .select(invalid_target(F.col("task_status_message")).alias(target_col))
           .where(F.col(target_col).isNotNull()))
    return batch.join(bad, target_col, "left_anti")


def accepted_tasks(posts: DataFrame, mode: str = "serp") -> DataFrame:
    """Explode the tasks of submit answers; SERP keeps status 20100 with
    a non-empty id and tag (the tag is the keyword), volume keeps any task
    with an id."""
    schema = T.StructType([T.StructField("tasks", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("status_code", T.StringType()),
        T.StructField("data", T.StructType([T.StructField("tag", T.StringType())]))])))])
    t = posts.select(F.explode(F.from_json("response", schema)["tasks"]).alias("t"))
    t = t.select(F.col("t.id").alias("task_id"),
                 F.col("t.status_code").try_cast("bigint").alias("status_code"),
                 F.col("t.data.tag").alias("tag"))
    cond = F.coalesce(F.col("task_id"), F.lit("")) != ""
    if mode == "serp":
        cond = cond & (F.col("status_code") == SUBMITTED) & (F.coalesce(F.col("tag"), F.lit("")) != "")
    return t.where(cond)


def ready_ids(responses: DataFrame) -> DataFrame:
    """Ids (with status and message) of every result of every task;
    entries without an id are skipped."""
    schema = T.StructType([T.StructField("tasks", T.ArrayType(T.StructType([
        T.StructField("result", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()), T.StructField("status_code", T.StringType()),
            T.StructField("status_message", T.StringType())])))])))])
    t = responses.select(F.explode(F.from_json("response", schema)["tasks"]).alias("t"))
    r = t.select(F.explode("t.result").alias("r"))
    return (r.select(F.col("r.id").alias("task_id"),
                     F.col("r.status_code").try_cast("bigint").alias("status_code"),
                     F.col("r.status_message").alias("status_message"))
            .where(F.coalesce(F.col("task_id"), F.lit("")) != ""))


def incomplete_tasks(submitted: DataFrame, ready: DataFrame) -> DataFrame:
    """Submitted ids not yet ready (anti join on task_id)."""
    return submitted.join(ready.select("task_id"), "task_id", "left_anti")
