import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchlake.llm import quality as Q

from .helpers import corpus, docs_frame

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def grams(text):
    w = TOKEN.findall((text or "").encode())
    return [(x,) for x in w] + list(zip(w, w[1:]))


def labels_frame(spark, rows):
    return spark.createDataFrame([(i, q, 0) for i, q in rows], "doc_id long, quality int, toxic int")


def test_features_are_tokens_and_pairs():
    texts = [t or "" for _, t in corpus(2, n=20)] + ["a--b c!! d", "", "x"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got, at = Q.features(np.frombuffer(b"".join(raw), np.uint8), offsets, 1 << 30)
    for i, t in enumerate(texts):
        want = Counter(grams(t))
        have = Counter(got[at[i]:at[i + 1]].tolist())
        assert sorted(want.values()) == sorted(have.values())
        one, _ = Q.features(np.frombuffer(raw[i], np.uint8), np.array([0, len(raw[i])]), 1 << 30)
        assert Counter(one.tolist()) == have


def test_weights_match_brute_force(spark):
    rows = [(i, t) for i, t in corpus(4, n=40) if i is not None and len(t or "") < 5000]
    rows.append((7001, " ".join(f"word{n % 977}, next" for n in range(30_000))))  # one very long text
    good, buckets = {i for i, _ in rows if i % 3 == 0}, 500

    def hashed(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return Q.features(data, np.array([0, len(data)]), buckets)[0].tolist()

    got = {r["doc_id"]: r for r in Q.resample(docs_frame(spark, rows, extra=True), labels_frame(spark, [(i, int(i in good)) for i, _ in rows]),
                                              buckets=buckets, k=10).collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(hashed(t))
        if i in good:
            target.update(hashed(t))
    nr, nt = sum(raw.values()) + buckets, sum(target.values()) + buckets
    for i, t in rows:
        want = sum(math.log((target[g] + 1) / nt) - math.log((raw[g] + 1) / nr) for g in hashed(t))
        assert got[i]["n_features"] == len(grams(t)) and abs(got[i]["log_weight"] - want) < 1e-5
    keys = sorted((r["key"] for r in got.values()), reverse=True)
    assert {i for i, r in got.items() if r["kept"]} == {i for i, r in got.items() if r["key"] >= keys[9]} and sum(r["kept"] for r in got.values()) == 10


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_kth_largest(spark, k):
    df = spark.range(1000).select((F.xxhash64("id") / F.when(F.col("id") % 2 == 0, 1).otherwise(10**12)).cast("long").alias("v"))
    values = sorted((r["v"] for r in df.collect()), reverse=True)
    assert Q.kth_largest(df, "v", k) == values[k - 1]


def test_gumbel_sample_follows_the_weights(spark):
    """Equal weights give a uniform sample; keys do not change between runs."""
    rows = [(i, "") for i in range(2000)]
    df, none = docs_frame(spark, rows), labels_frame(spark, [(0, 0)])
    a = Q.resample(df, none, k=500, seed=1).select("doc_id", "key", "kept").collect()
    b = Q.resample(df, none, k=500, seed=1).select("doc_id", "key", "kept").collect()
    assert sorted(a) == sorted(b) and sum(r["kept"] for r in a) == 500
    assert abs(sum(r["key"] for r in a) / 2000 - 0.5772) < 0.1  # mean of the Gumbel distribution


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_separates_held_out_documents(spark, sf):
    """Trained on the labels of every second document by hash, judged on the others."""
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = Q.resample(docs, labels.filter("not held"))
    j = out.join(labels.filter("held"), "doc_id").select("quality", "log_weight", "kept").collect()
    good, bad = (np.sort([r["log_weight"] for r in j if r["quality"] == q]) for q in (1, 0))
    less, equal = np.searchsorted(bad, good, "left"), np.searchsorted(bad, good, "right")
    auc = (less + equal).sum() / 2 / (len(good) * len(bad))
    print(f"AUC {auc:.4f} on {len(j)} held-out labels")
    assert len(j) > 50 and auc > 0.95 and sum(r["kept"] for r in j if r["quality"] == 1) > 0.95 * len(good)


def test_labels_of_unknown_documents_change_nothing(spark):
    rows = [(i, f"word{i % 7} text{i % 3} more") for i in range(60)]
    known = [(i, int(i % 4 == 0)) for i in range(40)]
    a = Q.resample(docs_frame(spark, rows), labels_frame(spark, known), target_docs=10).collect()
    b = Q.resample(docs_frame(spark, rows), labels_frame(spark, known + [(1000 + i, 1) for i in range(500)]), target_docs=10).collect()
    assert sorted(a) == sorted(b) and sum(r["kept"] for r in a) == 15


def test_nulls_ties_and_empty(spark):
    rows = [(None, None), (None, None), (1, None), (2, "a b"), (2, "a b")]
    got = Q.resample(docs_frame(spark, rows), labels_frame(spark, [(2, 1), (None, 1), (99, 0)]), k=5).collect()
    assert len(got) == 5 and all(r["kept"] for r in got)
    assert Q.resample(docs_frame(spark, rows).limit(0), labels_frame(spark, [(2, 1)])).collect() == []
    assert Q.resample(docs_frame(spark, rows), labels_frame(spark, [(2, 1)]).limit(0)).count() == 5
