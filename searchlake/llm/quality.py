"""Operator 5: quality selection by importance resampling.

Two generative models over hashed n-grams (tokens and pairs of tokens in
``buckets`` buckets) are counted: one of target text (documents labelled as good
quality), one of the raw text (all documents). A document's log importance
weight is the sum of log(target / raw) over its n-grams. With Gumbel noise added,
the ``k`` largest keys are a sample without replacement in proportion to the
weights; ``k`` is the labels' share of good documents times the number of
documents, or given by the caller.

The raw model counts every document. The target model takes at most
``target_docs`` labelled documents, those of smallest hash, so their ids (a few
hundred KB) can be broadcast and the texts are never shuffled. Counts are summed
per task, then per bucket. The k-th key is found by radix selection: four passes
over the written keys count 16 bits each, so nothing is sorted and at most 65,536
counts reach the driver.

Tokens are runs of letters, digits and non-ASCII bytes, or runs of punctuation;
case counts. The noise comes from a hash of the document, so a repeated task
gives the same keys.

Cases: null or empty text has no n-grams and weight 0. A null ``doc_id`` has no
label. Rows tied with the k-th key are all kept. Without target documents all
weights are 0 and the sample is uniform. Labels of unknown documents are
ignored, in the share as in the target model; a document with several labels is
good if one says so. Rows that repeat a labelled id all take its label; equal rows
have equal keys. Texts of any length are read whole; a text of over 4 MB is a
slice of its own. Ids must be numbers (a text id that is none is an error). Other
columns are not looked at. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .common import prepare, stage

#: 0 white space and control, 1 letters, digits and non-ASCII, 2 punctuation.
CLASS = np.full(256, 2, np.uint8)
CLASS[:33] = 0
CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """Bucket of every n-gram, and the n-gram offsets of documents."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = CLASS[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    change = np.concatenate([[True], kind[1:] != kind[:-1]]) | cut[:n]
    edges = np.append(np.flatnonzero(change), n)
    solid = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][solid], edges[1:][solid]
    docs = np.searchsorted(starts, offsets)
    h = tc.word_hashes(data, starts, ends)
    doc = tc.rows_of(docs)
    pair = tc.window_hashes(h, 2)
    # a document's n tokens and n - 1 pairs interleaved; the pair across documents is marked
    out = np.empty(2 * len(h), np.uint64)
    out[0::2] = h
    out[1:-1:2] = pair
    keep = np.ones(2 * len(h), bool)
    keep[1:-1:2] = doc[1:] == doc[:-1]
    keep[-1:] = False
    at = np.concatenate([[0], np.cumsum(keep)])[2 * docs]
    return (((out[keep] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64), at


def _counts(buckets: int):
    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = tc.buffers(batch.column(0))
            good = np.asarray(batch.column(1))
            for i, j in tc.slices(offsets, 4 << 20):
                f, at = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], buckets)
                raw += np.bincount(f, minlength=buckets)
                target += np.bincount(f[np.repeat(good[i:j], np.diff(at))], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])
    return run


def _weights(ratio: np.ndarray):
    buckets = len(ratio)

    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(1))
            total, count = [np.zeros(0)], [np.zeros(0, np.int64)]
            for i, j in tc.slices(offsets, 4 << 20):
                f, at = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], buckets)
                sums = np.concatenate([[0.0], np.cumsum(ratio[f])])
                total.append(sums[at[1:]] - sums[at[:-1]])
                count.append(np.diff(at))
            weight = np.round(np.concatenate(total), 6) + 0.0
            u = (np.asarray(batch.column(2)).view(np.uint64) >> np.uint64(11)) * 2.0**-53
            key = weight - np.log(-np.log(np.clip(u, 2.0**-53, 1 - 2.0**-53)))
            bits = key.view(np.int64)
            order = bits ^ ((bits >> 63) & np.int64(2**63 - 1))  # sorts as the key does
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(count)), pa.array(weight), pa.array(key), pa.array(order)],
                ["doc_id", "n_features", "log_weight", "key", "order"])
    return run


def kth_largest(df: DataFrame, column: str, k: int) -> int:
    """The k-th largest value of a long column, by four counting passes."""
    digits = [F.shiftright(column, 48) + 32768] + [F.shiftright(column, s).bitwiseAND(F.lit(0xFFFF)) for s in (32, 16, 0)]
    found: list[int] = []
    rest = df
    for digit in digits:
        counts = rest.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 65,536 rows
        for r in sorted(counts, key=lambda r: -r["d"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        found.append(r["d"])
        rest = rest.filter(digit == r["d"])
    high, *low = found
    value = (high - 32768) << 48
    for shift, part in zip((32, 16, 0), low):
        value |= part << shift
    return value


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = 10_000, target_docs: int = 20_000,
             smoothing: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_features, log_weight, key, kept.

    ``labels`` has doc_id and quality (1: good).
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    judged = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
              .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    # ids only, combined before the shuffle, so that a repeated id is one row of the join
    known = rows.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    judged = stage(judged.join(known, "doc_id", "left_semi"), "labels")
    good = (judged.filter("quality = 1").select("doc_id")
            .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(target_docs))
    marked = rows.join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left").select(
        "text", F.coalesce("good", F.lit(False)).cast("byte").cast("boolean").alias("good"))
    counts = (marked.mapInArrow(_counts(buckets), "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # ``buckets`` rows
    raw, target = np.full(buckets, smoothing), np.full(buckets, smoothing)
    for r in counts:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    if target.sum() == smoothing * buckets:
        ratio[:] = 0

    noise = F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("noise")
    keyed = stage(rows.select("doc_id", "text", noise).mapInArrow(
        _weights(ratio), "doc_id long, n_features long, log_weight double, key double, order long"), "weights")
    n = keyed.count()
    if k is None:
        share = judged.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]
        k = round(n * (1.0 if share is None else share))
    if not n or k <= 0:
        return keyed.withColumn("kept", F.lit(False)).drop("order")
    least = kth_largest(keyed, "order", min(k, n))
    return keyed.withColumn("kept", F.col("order") >= least).drop("order")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: weight and choice of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
