"""Model-usage operators on the reference's cases."""

from pyspark.sql import functions as F

from searchlake.operators import usage as I


def usage(spark, rows):
    return spark.createDataFrame(rows, "provider string, model string, input_tokens bigint, output_tokens bigint")


def test_call_cost_defaults(spark):
    df = usage(spark, [("openai", "gpt-4o", 10**6, 10**6), ("perplexity", "sonar", 10**6, 10**6),
                       ("gemini", "gemini-2.5-flash", 10**6, 10**6), ("openai", "nope", 10**6, 10**6),
                       ("mystery", "x", 10**6, 10**6), ("openai", "gpt-4o", 0, 0),
                       ("gemini", "gemini-3-pro", 10**6, 0)])
    got = [round(r.cost, 6) for r in I.call_cost(df).orderBy("provider", "model", "input_tokens").collect()]
    by = {(r.provider, r.model, r.input_tokens): round(r.cost, 6) for r in I.call_cost(df).collect()}
    assert by[("openai", "gpt-4o", 10**6)] == 12.5
    assert by[("perplexity", "sonar", 10**6)] == 2.0
    assert by[("gemini", "gemini-2.5-flash", 10**6)] == 2.8
    assert by[("openai", "nope", 10**6)] == 12.5
    assert by[("mystery", "x", 10**6)] == 12.5
    assert by[("openai", "gpt-4o", 0)] == 0.0
    assert by[("gemini", "gemini-3-pro", 10**6)] == 2.0   # alias -> preview price
    assert len(got) == 7


def test_batch_estimate(spark):
    jobs = spark.createDataFrame(
        [(10, None, 1, 1000, 500, "gpt-4o", "openai"), (None, 5, 3, 2000, 1000, "gpt-4o", "openai"),
         (None, None, 1, 1, 1, "gpt-4o", "openai")],
        "num_items bigint, num_pages bigint, questions_per_page bigint, avg_input_tokens bigint, "
        "avg_output_tokens bigint, model string, provider string")
    rows = I.batch_estimate(jobs).collect()
    assert (rows[0].estimated_input_tokens, rows[0].estimated_output_tokens) == (10000, 5000)
    assert (rows[1].estimated_input_tokens, rows[1].estimated_output_tokens) == (30000, 15000)
    assert rows[2].error is not None


def test_format_cost(spark):
    df = spark.createDataFrame([(0.00123,), (0.5,), (12.345678,)], "c double")
    out = [r.t for r in df.select(I.format_cost(F.col("c")).alias("t")).collect()]
    assert out == ["$0.0012", "$0.500", "$12.35"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, input_tokens bigint, output_tokens bigint")


def test_session_totals(spark):
    out = I.session_totals(turns(spark, [(1, 1, 100, 50), (1, 2, 200, 80)]), block=1).orderBy("turn").collect()
    assert (out[-1].total_input_tokens, out[-1].total_output_tokens, out[-1].message_count) == (300, 130, 2)


def test_compaction_points(spark):
    t = I.compaction_points(turns(spark, [(1, 1, 100, 50), (1, 2, 200, 100)]), tokens=200) \
        .orderBy("turn").collect()
    assert [r.fired for r in t] == [False, True]
    m = I.compaction_points(turns(spark, [(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1)]), messages=4) \
        .orderBy("turn").collect()
    assert [r.fired for r in m] == [False, True, False]
    assert m[1].messages_left == 1 and m[2].messages_left == 3


def test_transcript_and_split_system(spark):
    c = spark.createDataFrame([(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo")],
                              "conv_id bigint, turn bigint, role string, text string")
    assert I.transcript(c).first().transcript == "SYSTEM: be brief\nUSER: hi\nASSISTANT: yo"
    s = I.split_system(c).first()
    assert (s.system_prompt, s.n_messages) == ("be brief", 2)


def test_json_block(spark):
    df = spark.createDataFrame([("x ```json\n{\"a\": 1}\n``` y",), ("```\n{\"a\": 2}\n```",),
                                ("{\"a\": 3}",), ("```json {bad",)], "t string")
    out = [r.a for r in df.select(I.json_block(F.col("t"), "a bigint")["a"].alias("a")).collect()]
    assert out == [1, 2, 3, None]


def test_apply_summaries_hook(spark):
    c = spark.createDataFrame([(1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"),
                               (2, 1, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    points = spark.createDataFrame([(1, 2, True), (2, 1, False)], "conv_id bigint, turn bigint, fired boolean")

    def summarize(pdf):
        import pandas as pd
        return pd.DataFrame({"conv_id": [pdf.conv_id.iloc[0]], "turn": [pdf.turn.max()],
                             "role": ["assistant"], "text": ["[Summary] " + " ".join(pdf.text)]})
    out = {(r.conv_id, r.turn): r.text for r in I.apply_summaries(c, points, summarize).collect()}
    assert out == {(1, 2): "[Summary] a b", (1, 3): "c", (2, 1): "x"}
