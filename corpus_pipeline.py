"""Training-corpus pipeline: documents to packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; each
stage works on every row its predecessor kept.

1. ``language_id``: documents whose language is rejected go (no letter, a
   calibrated score under the model's threshold, or n-grams untypical of every
   learned language). Without any labelled document all with a letter stay.
2. ``line_dedup``: repeated lines leave all but one of their documents.
3. ``near_dedup``: one document of each near-duplicate group stays (5-word
   shingles, similarity 0.8).
4. ``decontaminate``: documents that hold a benchmark passage go.
5. ``packing``: the rest is tokenized and packed; one row per piece.

Nulls, empty and repeated rows are handled as each operator's docstring says;
rows without a ``doc_id`` pass stages 2 to 5 unlinked. Texts of any length are read
whole by every stage. Ids must be numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.llm.common import stage
from searchlake.llm.decontaminate import drop_contaminated
from searchlake.llm.language_id import predict_language, train
from searchlake.llm.line_dedup import drop_repeated_lines
from searchlake.llm.near_dedup import near_duplicates
from searchlake.llm.packing import pack

#: Tokenizer file of the last stage; None takes the public 50k byte-level BPE.
TOKENIZER = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return predict_language(docs, train(docs)).filter("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = TOKENIZER
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, path)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: Training, near-duplicate components and tokenizing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
