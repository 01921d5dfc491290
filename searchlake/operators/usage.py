"""Model-usage tables: call cost, estimates, sessions, transcripts.

Prices are a fixed table of known size (a few dozen rows), so it is the one
side that is always broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.operators.windows import running_sums

# USD per million tokens (input, output), by provider and model,
# the per-provider default model price, the price for an unknown provider,
# and model-name aliases applied before the lookup.
PRICES = [
    ("openai", "gpt-4o", 2.50, 10.00),
    ("openai", "gpt-4o-mini", 0.15, 0.60),
    ("openai", "gpt-4.5-preview", 75.00, 150.00),
    ("openai", "gpt-4-turbo", 10.00, 30.00),
    ("openai", "gpt-3.5-turbo", 0.50, 1.50),
    ("openai", "gpt-5", 1.25, 10.00),
    ("openai", "gpt-5-mini", 0.50, 2.00),
    ("openai", "gpt-5-nano", 0.05, 0.40),
    ("openai", "gpt-5.1", 1.25, 10.00),
    ("openai", "gpt-5.2", 1.75, 14.00),
    ("openai", "gpt-5.2-pro", 21.00, 168.00),
    ("gemini", "gemini-2.5-flash", 0.30, 2.50),
    ("gemini", "gemini-2.5-pro", 1.25, 10.00),
    ("gemini", "gemini-3-flash-preview", 0.50, 3.00),
    ("gemini", "gemini-3-pro-preview", 2.00, 12.00),
    ("anthropic", "claude-opus-4-20250514", 15.00, 75.00),
    ("anthropic", "claude-sonnet-4-20250514", 3.00, 15.00),
    ("anthropic", "claude-haiku-3-5-20241022", 0.80, 4.00),
    ("grok", "grok-3", 3.00, 15.00),
    ("grok", "grok-3-mini", 0.30, 0.50),
    ("grok", "grok-3-fast", 5.00, 25.00),
    ("perplexity", "sonar", 1.00, 1.00),
    ("perplexity", "sonar-pro", 3.00, 15.00),
    ("perplexity", "sonar-reasoning-pro", 2.00, 8.00),
]
PROVIDER_DEFAULTS = [
    ("openai", 2.50, 10.00),
    ("gemini", 0.30, 2.50),
    ("perplexity", 1.00, 1.00),
    ("anthropic", 3.00, 15.00),
    ("grok", 3.00, 15.00),
]
UNKNOWN_PROVIDER_PRICE = (2.50, 10.00)
MODEL_ALIASES = [
    ("gemini", "gemini-3-pro", "gemini-3-pro-preview"),
    ("gemini", "gemini-3-deep-think", "gemini-3-pro-preview"),
]
STEP_MODELS = [  # the fixed three-step form: step, model, provider
    ("enrichment", "gpt-4o-mini", "openai"),
    ("answer", "gpt-4o", "openai"),
    ("fact_check", "sonar", "perplexity"),
]


def price_table(spark: SparkSession) -> DataFrame:
    schema = "provider string, model string, in_per_m double, out_per_m double"
    return spark.createDataFrame(PRICES, schema)


def _defaults(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROVIDER_DEFAULTS,
                                 "provider string, def_in double, def_out double")


def _aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_ALIASES, "provider string, model string, alias_of string")


def with_prices(usage: DataFrame) -> DataFrame:
    """Attach ``in_per_m`` / ``out_per_m`` to each usage row.

    Alias map first, then the (provider, model) price, else the provider's
    default, else the unknown-provider price. All three lookup tables are
    fixed and tiny: broadcast joins, no shuffle of the usage side.
    """
    spark = usage.sparkSession
    u = usage.join(F.broadcast(_aliases(spark)), ["provider", "model"], "left")
    u = u.withColumn("_model", F.coalesce("alias_of", "model")).drop("alias_of")
    p = price_table(spark).withColumnRenamed("model", "_model")
    u = u.join(F.broadcast(p), ["provider", "_model"], "left")
    u = u.join(F.broadcast(_defaults(spark)), "provider", "left")
    din, dout = UNKNOWN_PROVIDER_PRICE
    return (u.withColumn("in_per_m", F.coalesce("in_per_m", "def_in", F.lit(din)))
            .withColumn("out_per_m", F.coalesce("out_per_m", "def_out", F.lit(dout)))
            .drop("_model", "def_in", "def_out"))


def cost_units(in_tok: Column, out_tok: Column) -> Column:
    """Tokens x price as a decimal, in millionths of a USD. Prices have two
    places, so sums of units are exact in any order; a cost is the sum of
    units as a double divided by a million, rounded once."""
    price = lambda c: F.col(c).cast("decimal(9,4)")
    return in_tok.cast("decimal(18,0)") * price("in_per_m") + out_tok.cast("decimal(18,0)") * price("out_per_m")


def in_usd(units: Column) -> Column:
    return units.cast("double") / F.lit(1_000_000.0)


def call_cost(usage: DataFrame, in_col: str = "input_tokens",
              out_col: str = "output_tokens") -> DataFrame:
    """Cost in USD of each call."""
    priced = with_prices(usage)
    return priced.withColumn("cost", in_usd(cost_units(F.col(in_col), F.col(out_col)))).drop(
        "in_per_m", "out_per_m")


def batch_estimate(jobs: DataFrame) -> DataFrame:
    """questions = pages x questions per page (or items); token totals,
    total cost and cost per item (0 when there are none).

    Columns used: num_items, num_pages, questions_per_page, avg_input_tokens,
    avg_output_tokens, model, provider. A job with neither count is dropped
    into ``error`` (the reference raises).
    """
    q = F.when(F.col("num_pages").isNotNull(),
               F.col("num_pages") * F.coalesce(F.col("questions_per_page"), F.lit(1)))
    q = q.otherwise(F.col("num_items"))
    df = jobs.withColumn("total_questions", q)
    df = (df.withColumn("estimated_input_tokens", F.col("total_questions") * F.col("avg_input_tokens"))
          .withColumn("estimated_output_tokens", F.col("total_questions") * F.col("avg_output_tokens")))
    df = with_prices(df)
    df = df.withColumn("total_cost", in_usd(cost_units(F.col("estimated_input_tokens"),
                                                       F.col("estimated_output_tokens"))))
    df = df.withColumn("cost_per_item", F.when(F.col("total_questions") > 0,
                                               F.col("total_cost") / F.col("total_questions"))
                       .otherwise(F.lit(0.0)))
    return df.withColumn("error", F.when(F.col("total_questions").isNull(),
                                         F.lit("Either num_items or num_pages must be provided")))


def format_cost(c: Column) -> Column:
    """``$`` and 4 decimals below 0.01, 3 below 1, else 2 (Java rounds a
    decimal tie half up; Python would round the binary value)."""
    return (F.when(c < 0.01, F.format_string("$%.4f", c))
            .when(c < 1.0, F.format_string("$%.3f", c))
            .otherwise(F.format_string("$%.2f", c)))


def step_costs(usage: DataFrame, group: list[str] | None = None,
               step_models: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """I4: cost per step and total (``step`` null). A step without a model
    takes the default gpt-4o; ``step_models=STEP_MODELS`` is the fixed
    three-step form, in which the steps named there have their own models."""
    u = usage
    if step_models:
        steps = usage.sparkSession.createDataFrame(step_models, "step string, _sm string, _sp string")
        u = (u.join(F.broadcast(steps), "step", "left").withColumn("model", F.coalesce("model", "_sm"))
             .withColumn("provider", F.coalesce("provider", "_sp")).drop("_sm", "_sp"))
    u = u.withColumns({"model": F.coalesce("model", F.lit("gpt-4o")), "provider": F.coalesce("provider", F.lit("openai"))})
    units = with_prices(u).withColumn("_units", cost_units(F.col("input_tokens"), F.col("output_tokens")))
    keys = (group or []) + ["step"]
    out = units.rollup(*keys).agg(F.sum("_units").alias("_units"), F.grouping_id(*keys).alias("_gid"))
    # keep the per-step rows and the per-group totals, not partial group keys
    full, step_total = 0, 1
    out = out.where(F.col("_gid").isin(full, step_total) | (F.col("_gid") == (1 << len(keys)) - 1))
    return out.select(*keys, in_usd(F.col("_units")).alias("cost"))


def session_totals(turns: DataFrame, key: str = "conv_id", pos: str = "turn",
                   block: int = 4096) -> DataFrame:
    """Running input and output tokens and message count per conversation
    (skew-safe two-level running sums)."""
    df = turns.withColumn("_one", F.lit(1))
    out = running_sums(df, [key], pos, {"total_input_tokens": "input_tokens",
                                        "total_output_tokens": "output_tokens",
                                        "message_count": "_one"}, block)
    return out.drop("_one")


def compaction_points(sends: DataFrame, tokens: int | None = None,
                      messages: int | None = None, key: str = "conv_id",
                      pos: str = "turn", block: int = 4096) -> DataFrame:
    """The sends after which the history is replaced by one summary.

    Each send adds two messages; after a send the check is: total tokens so
    far >= ``tokens`` (never reset) or messages since the last summary >=
    ``messages``; a summary needs more than 2 messages and leaves 1.

    Closed form (no fold), with k the 1-based send number and cum_k the
    running token total:
      * the token rule fires at every k >= 2 from the first k with
        cum_k >= T (before any summary there are 2k messages, after one 3);
      * before that point the message rule fires at k1 = max(ceil(M/2), 2)
        and then every p = max(ceil((M-1)/2), 1) sends;
      * the last summary before k is then arithmetic, and
        ``messages_left`` = 1 after a summary, else 2k or 1 + 2(k - last).
    k and cum_k are skew-safe running sums (block sums + offsets); the first
    token hit per conversation is a grouped minimum. No per-conversation
    sort of all its sends.
    """
    df = sends.withColumn("_one", F.lit(1)).withColumn(
        "_tok", F.col("input_tokens") + F.col("output_tokens"))
    df = running_sums(df, [key], pos, {"send_no": "_one", "cum_tokens": "_tok"}, block)
    df = df.drop("_one", "_tok")
    k = F.col("send_no")
    if tokens is not None:
        hits = (df.where(F.col("cum_tokens") >= F.lit(tokens)).groupBy(key)
                .agg(F.min("send_no").alias("_first_tok")))
        df = df.join(hits, key, "left")
    else:
        df = df.withColumn("_first_tok", F.lit(None).cast("bigint"))
    ft = F.col("_first_tok")
    tok_from = F.when(ft.isNotNull(), F.greatest(ft, F.lit(2)))   # null when no token hit
    tok_fire = F.coalesce(k >= tok_from, F.lit(False))
    tok_last = F.when(k - 1 >= tok_from, k - 1)              # last token fire before k
    if messages is not None:
        k1 = max(-(-messages // 2), 2)
        p = max(-(-(messages - 1) // 2), 1)
        before = ft.isNull() | (k < ft)
        msg_fire = before & (k >= k1) & (((k - k1) % p) == 0)
        upto = F.least(k - 1, F.coalesce(ft - 1, k - 1))       # message fires happen below ft
        msg_last = F.when(upto >= k1, F.lit(k1) + F.floor((upto - k1) / p).cast("bigint") * p)
    else:
        msg_fire = F.lit(False)
        msg_last = F.lit(None).cast("bigint")
    last = F.greatest(tok_last, msg_last)
    fired = tok_fire | msg_fire
    return (df.withColumn("fired", fired)
            .withColumn("messages_left", F.when(fired, F.lit(1)).when(last.isNull(), 2 * k)
                        .otherwise(1 + 2 * (k - last)).cast("bigint"))
            .drop("_first_tok"))


def apply_summaries(turns: DataFrame, points: DataFrame, summarize_fn, key: str = "conv_id",
                    pos: str = "turn") -> DataFrame:
    """I6 hook (off unless called): replace each conversation's history up
    to its last compaction point by what ``summarize_fn`` returns.

    ``summarize_fn(pdf) -> pdf`` receives one conversation's turns up to the
    point (columns key, pos, role, text; ordered by ``pos``) and returns the
    replacement rows with the same columns. Runs as a grouped
    ``applyInPandas``; turns after the last point are kept as they are.
    """
    last = points.where(F.col("fired")).groupBy(key).agg(F.max(pos).alias("_upto"))
    t = turns.select(key, pos, "role", "text").join(last, key, "left")
    head = t.where(F.col("_upto").isNotNull() & (F.col(pos) <= F.col("_upto"))).drop("_upto")
    tail = t.where(F.col("_upto").isNull() | (F.col(pos) > F.col("_upto"))).drop("_upto")

    from searchlake.session import ship_package
    ship_package(turns.sparkSession)

    def run(pdf):
        return summarize_fn(pdf.sort_values(pos).reset_index(drop=True))
    summarized = head.groupBy(key).applyInPandas(run, schema=head.schema)
    return summarized.unionByName(tail)


def transcript(turns: DataFrame, key: str = "conv_id", pos: str = "turn", block: int = 1024) -> DataFrame:
    """``ROLE: content`` lines joined with newlines per conversation.

    Two levels: lines are joined per block of ``block`` turns, then the
    block texts per conversation, so no aggregation buffer holds more than
    one block of lines or one conversation's block list; the result string
    itself is one value per conversation."""
    line = F.concat(F.upper("role"), F.lit(": "), F.col("text"))
    blk = F.floor(F.col(pos) / F.lit(block)).cast("bigint")
    parts = turns.groupBy(key, blk.alias("_blk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), line.alias("l")))),
                                 lambda s: s["l"]), "\n").alias("_t"))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_blk", "_t"))),
                                 lambda s: s["_t"]), "\n").alias("transcript"))


def build_messages(turns: DataFrame, system: str | None = None, schema_hint: str | None = None,
                   key: str = "conv_id", pos: str = "turn") -> DataFrame:
    """I8: message rows per conversation: the session's system text first
    (position 0), then the turns in order (position turn + 1).

    With ``schema_hint`` every system message gets ``"\n\n" + hint``
    appended; a conversation with no system message at all gets the hint as
    a new system message at position 0. "Has a system message" is one
    grouped flag per conversation (no window). Output: key, position, role,
    content.
    """
    msgs = turns.select(key, (F.col(pos) + 1).cast("bigint").alias("position"), "role",
                        F.col("text").alias("content"))
    convs = turns.groupBy(key).agg(F.max((F.col("role") == "system").cast("int")).alias("_sys"))
    if system is not None:
        heads = convs.select(key, F.lit(0).cast("bigint").alias("position"), F.lit("system").alias("role"),
                             F.lit(system).alias("content"))
        msgs = heads.unionByName(msgs)
    if schema_hint is None:
        return msgs
    msgs = msgs.withColumn("content", F.when(F.col("role") == "system",
                                             F.concat(F.col("content"), F.lit("\n\n" + schema_hint)))
                           .otherwise(F.col("content")))
    if system is None:
        bare = convs.where(F.col("_sys") == 0).select(
            key, F.lit(0).cast("bigint").alias("position"), F.lit("system").alias("role"),
            F.lit(schema_hint).alias("content"))
        msgs = bare.unionByName(msgs)
    return msgs


def split_system(turns: DataFrame, key: str = "conv_id", pos: str = "turn") -> DataFrame:
    """The last system text of each conversation apart from the others.

    Output per conversation: system_prompt (null when none) and the number of
    remaining messages; ``split_system_rows`` gives the remaining rows."""
    sys_last = F.max_by("text", F.when(F.col("role") == "system", F.col(pos)))
    return turns.groupBy(key).agg(
        sys_last.alias("system_prompt"),
        F.count_if(F.col("role") != "system").alias("n_messages"))


def split_system_rows(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("role") != "system")


_FENCE_JSON = r"(?s)```json(.*?)(```|\z)"
_FENCE_ANY = r"(?s)```(.*?)(```|\z)"


def json_block_text(text: Column) -> Column:
    """Text between ```json and the next fence, else between the first
    two fences, else all of it; trimmed."""
    j = F.regexp_extract(text, _FENCE_JSON, 1)
    a = F.regexp_extract(text, _FENCE_ANY, 1)
    has_j = F.instr(text, "```json") > 0
    has_a = F.instr(text, "```") > 0
    body = F.when(has_j, j).when(has_a, a).otherwise(text)
    return F.regexp_replace(body, r"(?s)^\s+|\s+$", "")


def json_block(text: Column, schema: T.StructType | str) -> Column:
    """The block parsed to ``schema``; bad JSON gives null, not an error."""
    return F.from_json(json_block_text(text), schema, {"mode": "PERMISSIVE"})
