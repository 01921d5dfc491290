"""Checked queries for model usage (I) and location lookups (J)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.operators import locations as J
from searchlake.operators import usage as I
from searchlake.plans.checks import scalar_output
from searchlake.plans.oracle_views import with_views as W
from searchlake.plans.registry import register
from searchlake.sources import testviews as V
from searchlake.sources.tables import read_table


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(float(v))
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _units(tokens_in: str, tokens_out: str) -> str:
    return (f"(CAST({tokens_in} AS DECIMAL(18,0)) * CAST(in_per_m AS DECIMAL(9,4))"
            f" + CAST({tokens_out} AS DECIMAL(18,0)) * CAST(out_per_m AS DECIMAL(9,4)))")


def _usd(units: str) -> str:
    return f"CAST({units} AS DOUBLE) / 1000000.0"


PRICED = f"""
priced AS (
  SELECT u.*, coalesce(p.in_m, d.in_m, 2.5) AS in_per_m, coalesce(p.out_m, d.out_m, 10.0) AS out_per_m
  FROM (SELECT u0.*, coalesce(a.alias_of, u0.model) AS model2 FROM src u0
        LEFT JOIN (VALUES {_values(I.MODEL_ALIASES)}) a(provider, model, alias_of)
          ON a.provider = u0.provider AND a.model = u0.model) u
  LEFT JOIN (VALUES {_values(I.PRICES)}) p(provider, model, in_m, out_m)
    ON p.provider = u.provider AND p.model = u.model2
  LEFT JOIN (VALUES {_values(I.PROVIDER_DEFAULTS)}) d(provider, in_m, out_m)
    ON d.provider = u.provider)"""


@register("i1_call_cost", W(f"""
WITH src AS (SELECT * FROM v_usage), {PRICED}
SELECT conv_id, turn, provider, model, input_tokens, output_tokens,
       {_usd(_units('input_tokens', 'output_tokens'))} AS cost
FROM priced""", "v_usage"))
def q_i1(spark, d):
    u = V.usage(spark, d).select("conv_id", "turn", "provider", "model", "input_tokens",
                                 "output_tokens")
    return I.call_cost(u)


def _jobs(spark, d):
    docs = read_table(spark, d, "documents")
    g = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"),
                                           F.avg("n_chars").alias("avg_chars"))
    en = F.col("lang") == "en"
    return g.select(
        "source", "lang",
        F.when(en, F.col("n")).alias("num_items"),
        F.when(~en, F.col("n")).alias("num_pages"),
        F.lit(3).cast("bigint").alias("questions_per_page"),
        F.floor(F.col("avg_chars") / 4).cast("bigint").alias("avg_input_tokens"),
        F.lit(1000).cast("bigint").alias("avg_output_tokens"),
        F.when(en, F.lit("gpt-4o")).otherwise(F.lit("sonar")).alias("model"),
        F.when(en, F.lit("openai")).otherwise(F.lit("perplexity")).alias("provider"))


@register("i2_batch_estimate", f"""
WITH g AS (SELECT source, lang, count(*) AS n, avg(n_chars) AS avg_chars FROM documents GROUP BY 1, 2),
src AS (SELECT source, lang,
          CASE WHEN lang = 'en' THEN n * 1 ELSE n * 3 END AS total_questions,
          CAST(floor(avg_chars / 4) AS BIGINT) AS avg_in,
          CASE WHEN lang = 'en' THEN 'gpt-4o' ELSE 'sonar' END AS model,
          CASE WHEN lang = 'en' THEN 'openai' ELSE 'perplexity' END AS provider FROM g), {PRICED}
SELECT source, lang, total_questions, total_questions * avg_in AS estimated_input_tokens,
       total_questions * 1000 AS estimated_output_tokens,
       {_usd(_units('total_questions * avg_in', 'total_questions * 1000'))} AS total_cost,
       CASE WHEN total_questions > 0 THEN {_usd(_units('total_questions * avg_in', 'total_questions * 1000'))} / total_questions
            ELSE 0.0 END AS cost_per_item
FROM priced""")
def q_i2(spark, d):
    est = I.batch_estimate(_jobs(spark, d))
    return est.select("source", "lang", "total_questions", "estimated_input_tokens",
                      "estimated_output_tokens", "total_cost", "cost_per_item")


@register("i3_format_cost", W("""
SELECT conv_id, turn, CASE WHEN c < 0.01 THEN '$' || printf('%.4f', c)
                           WHEN c < 1.0 THEN '$' || printf('%.3f', c)
                           ELSE '$' || printf('%.2f', c) END AS cost_text
FROM (SELECT conv_id, turn, (input_tokens * 1234 + output_tokens * 56789) / 1000000.0 AS c FROM v_usage) x""",
                                "v_usage"))
def q_i3(spark, d):
    u = V.usage(spark, d)
    c = (F.col("input_tokens") * 1234 + F.col("output_tokens") * 56789) / F.lit(1_000_000.0)
    return u.select("conv_id", "turn", I.format_cost(c).alias("cost_text"))


def _i4_sql(provider: str, model: str) -> str:
    return W(f"""
WITH src AS (SELECT conv_id, step, input_tokens, output_tokens, {provider} AS provider, {model} AS model
             FROM v_usage), {PRICED}
SELECT conv_id, step, {_usd(f"sum({_units('input_tokens', 'output_tokens')})")} AS cost
FROM priced GROUP BY GROUPING SETS ((conv_id, step), (conv_id), ())""", "v_usage")


def _unmodelled(spark, d):
    return V.usage(spark, d).select("conv_id", "step", "input_tokens", "output_tokens",
                                    F.lit(None).cast("string").alias("model"),
                                    F.lit(None).cast("string").alias("provider"))


@register("i4_step_costs", _i4_sql(
    "CASE step WHEN 'enrichment' THEN 'openai' WHEN 'answer' THEN 'openai' ELSE 'perplexity' END",
    "CASE step WHEN 'enrichment' THEN 'gpt-4o-mini' WHEN 'answer' THEN 'gpt-4o' ELSE 'sonar' END"))
def q_i4(spark, d):
    return I.step_costs(_unmodelled(spark, d), group=["conv_id"], step_models=I.STEP_MODELS)


@register("i4_step_costs_default_model", _i4_sql("'openai'", "'gpt-4o'"))
def q_i4_default(spark, d):
    return I.step_costs(_unmodelled(spark, d), group=["conv_id"])


@register("i5_session_totals", W("""
SELECT conv_id, turn,
       CAST(sum(input_tokens) OVER w AS BIGINT) AS total_input_tokens,
       CAST(sum(output_tokens) OVER w AS BIGINT) AS total_output_tokens,
       CAST(count(*) OVER w AS BIGINT) AS message_count
FROM v_usage WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
                                   "v_usage"))
def q_i5(spark, d):
    u = V.usage(spark, d).select("conv_id", "turn", "input_tokens", "output_tokens")
    out = I.session_totals(u, block=4)
    return scalar_output(out.select("conv_id", "turn", "total_input_tokens",
                                    "total_output_tokens", "message_count"))


def compaction_sql(tokens, messages) -> str:
    """Oracle: a recursive fold over the sends of each conversation."""
    t = "NULL" if tokens is None else str(tokens)
    m = "NULL" if messages is None else str(messages)
    return W(f"""
WITH RECURSIVE s AS (
  SELECT conv_id, turn, input_tokens + output_tokens AS tok,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k
  FROM v_usage WHERE role = 'assistant'),
f(conv_id, k, turn, cum, msgs, fired) AS (
  SELECT conv_id, k, turn, tok,
         CASE WHEN ((({t}) IS NOT NULL AND tok >= {t}) OR (({m}) IS NOT NULL AND 2 >= {m})) AND 2 > 2 THEN 1 ELSE 2 END,
         ((({t}) IS NOT NULL AND tok >= {t}) OR (({m}) IS NOT NULL AND 2 >= {m})) AND 2 > 2
  FROM s WHERE k = 1
  UNION ALL
  SELECT s.conv_id, s.k, s.turn, f.cum + s.tok,
         CASE WHEN ((({t}) IS NOT NULL AND f.cum + s.tok >= {t}) OR (({m}) IS NOT NULL AND f.msgs + 2 >= {m}))
                   AND f.msgs + 2 > 2 THEN 1 ELSE f.msgs + 2 END,
         ((({t}) IS NOT NULL AND f.cum + s.tok >= {t}) OR (({m}) IS NOT NULL AND f.msgs + 2 >= {m}))
                   AND f.msgs + 2 > 2
  FROM f JOIN s ON s.conv_id = f.conv_id AND s.k = f.k + 1)
SELECT conv_id, turn, CAST(k AS BIGINT) AS send_no, CAST(cum AS BIGINT) AS cum_tokens, fired,
       CAST(msgs AS BIGINT) AS messages_left FROM f""", "v_usage")


def _compaction(spark, d, tokens, messages):
    sends = (V.usage(spark, d).where(F.col("role") == "assistant")
             .select("conv_id", "turn", "input_tokens", "output_tokens"))
    out = I.compaction_points(sends, tokens=tokens, messages=messages, block=2)
    return scalar_output(out.select("conv_id", "turn", "send_no", "cum_tokens", "fired",
                                    "messages_left"))


@register("i6_compaction_points_tokens", compaction_sql(1500, None))
def q_i6t(spark, d):
    return _compaction(spark, d, 1500, None)


@register("i6_compaction_points_messages", compaction_sql(None, 5))
def q_i6m(spark, d):
    return _compaction(spark, d, None, 5)


@register("i6_compaction_points_both", compaction_sql(2500, 4))
def q_i6b(spark, d):
    return _compaction(spark, d, 2500, 4)


@register("i7_transcript", """
SELECT conv_id, string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id""")
def q_i7(spark, d):
    return I.transcript(read_table(spark, d, "conversations"), block=2)


@register("i8_build_messages", """
SELECT conv_id, CAST(turn + 1 AS BIGINT) AS position, role,
       CASE WHEN role = 'system' THEN text || chr(10) || chr(10) || 'Reply as JSON.' ELSE text END AS content
FROM conversations
UNION ALL
SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'system', 'Answer briefly.' || chr(10) || chr(10) || 'Reply as JSON.'
FROM conversations""")
def q_i8(spark, d):
    return I.build_messages(read_table(spark, d, "conversations"), system="Answer briefly.",
                            schema_hint="Reply as JSON.")


@register("i8_build_messages_schema_only", """
SELECT conv_id, CAST(turn + 1 AS BIGINT) AS position, role,
       CASE WHEN role = 'system' THEN text || chr(10) || chr(10) || 'Reply as JSON.' ELSE text END AS content
FROM conversations
UNION ALL
SELECT conv_id, CAST(0 AS BIGINT), 'system', 'Reply as JSON.'
FROM conversations GROUP BY conv_id HAVING max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) = 0""")
def q_i8s(spark, d):
    return I.build_messages(read_table(spark, d, "conversations"), schema_hint="Reply as JSON.")


@register("i9_split_system", """
SELECT conv_id, max_by(CASE WHEN role = 'system' THEN text END,
                       CASE WHEN role = 'system' THEN turn END) AS system_prompt,
       count(*) FILTER (WHERE role <> 'system') AS n_messages
FROM conversations GROUP BY conv_id""")
def q_i9(spark, d):
    return I.split_system(read_table(spark, d, "conversations"))


@register("i9_split_system_rows", "SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system'")
def q_i9r(spark, d):
    return I.split_system_rows(read_table(spark, d, "conversations")).select("conv_id", "turn", "role", "text")


def _fenced(spark, d):
    c = read_table(spark, d, "conversations")
    k = F.col("turn") % 4
    body = F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit(', "role": "'),
                    F.col("role"), F.lit('"}'))
    text = (F.when(k == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nDone.")))
            .when(k == 1, F.concat(F.lit("```\n"), body, F.lit("\n```")))
            .when(k == 2, F.concat(F.lit("  "), body, F.lit("  ")))
            .otherwise(F.concat(F.lit("```json\n{broken "), F.col("role"))))
    return c.select("conv_id", "turn", text.alias("text"))


@register("i10_json_block", """
SELECT conv_id, turn,
       CASE WHEN turn % 4 = 3 THEN NULL ELSE turn END AS parsed_turn,
       CASE WHEN turn % 4 = 3 THEN NULL ELSE role END AS parsed_role
FROM conversations""")
def q_i10(spark, d):
    schema = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType())])
    f = _fenced(spark, d)
    j = I.json_block(F.col("text"), schema)
    return f.select("conv_id", "turn", j["turn"].alias("parsed_turn"), j["role"].alias("parsed_role"))


@register("j1_find_locations_city", W("""
SELECT * FROM v_locations WHERE location_type = 'City'
  AND contains(lower(split_part(location_name, ',', 1)), 'a')""", "v_locations"))
def q_j1c(spark, d):
    return J.find_locations(V.locations(spark, d), "A", "city")


@register("j1_find_locations_any", W("""
SELECT * FROM v_locations WHERE contains(lower(location_name), 'ia')""", "v_locations"))
def q_j1a(spark, d):
    return J.find_locations(V.locations(spark, d), "ia")


@register("j1_find_locations_country", W("""
SELECT * FROM v_locations WHERE location_type = 'Country' AND contains(lower(location_name), 'a')""",
                                         "v_locations"))
def q_j1n(spark, d):
    return J.find_locations(V.locations(spark, d), "a", "country")


@register("j1_find_locations_state", W("""
SELECT * FROM v_locations WHERE location_type = 'State' AND contains(lower(location_name), 'a')""", "v_locations"))
def q_j1s(spark, d):
    return J.find_locations(V.locations(spark, d), "a", "state")


@register("j1_find_locations_code", W("SELECT * FROM v_locations WHERE location_code = 2007", "v_locations"))
def q_j1code(spark, d):
    return J.find_locations(V.locations(spark, d), code=2007)
