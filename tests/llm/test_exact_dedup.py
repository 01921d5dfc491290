import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from searchlake.llm import exact_dedup
from searchlake.llm.exact_dedup import directory, exact_groups

from .helpers import corpus, docs_frame


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append(i)
    out = []
    for i, text in rows:
        ids = [x for x in groups[norm(text)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm(text)]), i == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_matches_brute_force(spark, bits):
    rows = corpus(3) + [(500, "same  text"), (501, "same\n\ttext"), (500, "same text"), (None, "only null"), (None, "only null")]
    got = exact_groups(docs_frame(spark, rows, extra=True), hash_bits=bits, capacity=4).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_directory_covers_the_key_space(spark):
    entries = spark.range(5000).select(F.xxhash64("id").alias("h"))
    slots = directory(entries, capacity=100, max_depth=12).collect()
    top = slots[0]["global_depth"]
    assert sorted(r["slot"] for r in slots) == list(range(1 << top))
    buckets = {r["bucket"]: r for r in slots}
    assert all(r["n"] <= 100 for r in buckets.values()) and sum(r["n"] for r in buckets.values()) == 5000
    assert {r["depth"] for r in slots} > {top} or top > 0
    for r in slots:  # a bucket of depth d owns 2 ** (top - d) neighbouring slots
        assert r["slot"] >> (top - r["depth"]) == r["bucket"] >> (top - r["depth"])


def test_a_text_in_a_third_of_the_rows(spark):
    rows = [(i, "hot  copy" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    got = {r["doc_id"]: r for r in exact_groups(docs_frame(spark, rows)).collect()}
    assert all((got[i]["keep_id"], got[i]["group_size"]) == ((0, 1000) if i % 3 == 0 else (i, 1)) for i in range(3000))


def test_empty_table(spark):
    assert exact_groups(docs_frame(spark, [(1, "a")]).limit(0)).collect() == []


def test_plan_has_no_python(spark):
    plan = exact_dedup.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
