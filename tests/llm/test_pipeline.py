"""The pipeline's stages against the brute-force versions of their operators."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from searchlake.llm import queries as llm

from . import test_decontaminate, test_line_dedup, test_near_dedup
from .helpers import docs_frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        before = docs
        step(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, before, docs))
    return {name: (a, b) for name, a, b in out}


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(steps, spark):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.columns == columns, name


def test_language_stage_keeps_clean_documents(steps):
    before, after = steps["language_id"]
    assert after.count() >= 0.98 * before.count()


def test_line_stage(steps):
    before, after = steps["line_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert texts(after) == {i: t for i, t, _, _ in test_line_dedup.brute(rows)}
    assert after.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_near_stage(steps):
    before, after = steps["near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert set(texts(after)) == {i for i, _, _, kept in test_near_dedup.brute(rows, 5, 80) if kept}


def test_decontamination_stage(steps, spark):
    before, after = steps["decontaminate"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    # only items that share a shingle can match; the brute force is kept to them
    shingled = [(i, set(test_decontaminate.grams(test_decontaminate.WORDS.findall(test_decontaminate.lower(t)), 5))) for i, t in items]
    bad = set()
    for i, t in rows:
        mine = set(test_decontaminate.grams(test_decontaminate.WORDS.findall(test_decontaminate.lower(t or "")), 5))
        near = [items[q] for q, (_, s) in enumerate(shingled) if s & mine]
        if near and test_decontaminate.brute([(i, t)], near):
            bad.add(i)
    assert set(texts(after)) == {i for i, _ in rows if i not in bad}


def test_packing_stage(steps):
    before, after = steps["packing"]
    assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == set(texts(before))
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024


def test_odd_documents_pass_all_stages(spark, tmp_path):
    rows = [(None, None, None), (1, "", "en"), (2, None, "fr"), (3, "12 !!", None), (4, "the cat and the dog " * 20, "en"), (4, "the cat and the dog " * 20, "en"),
            (5, "the cat and the dog " * 20, "en"), (6, "le chat et la maison " * 5000, "fr"), (None, "the of and to in", "en")]
    docs = docs_frame(spark, rows, extra=True)
    columns = docs.columns
    for at, (name, step) in enumerate(P.STAGES):
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert at == 4 or docs.columns == columns
    assert docs.count() > 0


def test_empty_documents_pass_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, step in P.STAGES:
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0


def test_registered():
    names = {n.split("_")[0] for n in llm.QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} and set(llm.ORACLES) <= set(llm.QUERIES)
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry.queries()) and public_tokenizers.path("byte_bpe_50k.json")
