import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from searchlake.llm import fingerprints as fp

from .helpers import corpus, docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lanes(text):
    """Brute force: strong sums and signed sums of one text."""
    strong, signs = [0] * fp.STRONG, [0] * fp.LANES
    for p in (text or "").split("\n"):
        raw = hashlib.sha256(p.encode()).hexdigest()
        strong = [(x + int(raw[12 * i:12 * i + 12], 16)) % 2**48 for i, x in enumerate(strong)]
        words = WORD.findall(p)
        runs = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] * bool(words)
        for run, many in Counter(map(" ".join, runs)).items():
            m = hashlib.md5(run.encode()).hexdigest()
            bits = [int(m[16 * h:16 * h + 16], 16) >> j & 1 for h in (0, 1) for j in range(64)]
            signs = [x + many * (2 * b - 1) for x, b in zip(signs, bits)]
    return strong, [(x + 2**15) % 2**16 - 2**15 for x in signs]


def text_of(strong, signs):
    return "".join("%012x" % x for x in strong) + "".join("%04x" % (x % 2**16) for x in signs)


def near(a, b):
    apart = sum(((x - y + 2**15) % 2**16 - 2**15)**2 for x, y in zip(a, b))
    size = sum(x * x for x in a) + sum(y * y for y in b)
    return 1.0 if size == 0 else max(0.0, 1 - apart / size)


def brute(rows):
    """Rows with distinct (id, text), each given its next."""
    docs = sorted(set((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    nulls = [d for d in docs if d[0] is None]
    assert len(nulls) <= 1
    out = {}
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, b, c = lanes(text), lanes(edited), lanes(after)
        out[i, text] = (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(*a), text_of(*b), near(a[1], b[1]), near(a[1], c[1]))
    return sorted((out[i, t or ""] for i, t in rows), key=repr)


def test_matches_brute_force(spark):
    rows = [r for r in corpus(11, n=25) if r[0] is not None] + [(None, "no id é\U0001f600 text " * 5)] * 2
    got = fp.edited_fingerprints(docs_frame(spark, rows, extra=True)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_document_follows_itself_and_no_document_nothing(spark):
    rows = [(7, "one two three four five six")]
    assert [tuple(r) for r in fp.edited_fingerprints(docs_frame(spark, rows)).collect()] == brute(rows)
    assert fp.edited_fingerprints(docs_frame(spark, rows).limit(0)).collect() == []


def test_a_row_repeated_in_a_third_of_the_table(spark):
    rows = [(5, "hot row with words")] * 200 + [(i, f"text {i} of its own") for i in range(10, 410)]
    got = fp.edited_fingerprints(docs_frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_order_of_paragraphs_insertion_and_deletion(spark):
    a, b, c = "first paragraph of four words", "second one\n\nthird", "another paragraph that joins"
    rows = [(0, f"{a}\n{b}"), (1, f"{b}\n{a}"), (2, f"{a}\n{b}\n{c}"), (3, c), (4, f"{a} {b}"), (5, b), (6, f"{a}\n{c}")]
    got = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs_frame(spark, rows)).collect()}
    assert got[0] == got[1] and len({got[i] for i in range(1, 7)}) == 6
    f = spark.createDataFrame([tuple(got[i] for i in range(7))], [f"f{i}" for i in range(7)])
    row = f.select(fp.plus(F.col("f0"), F.col("f3")), fp.minus(F.col("f2"), F.col("f3")), fp.minus(F.col("f2"), F.col("f5")),
                   fp.likeness(F.col("f0"), F.col("f1")), fp.likeness(F.col("f3"), F.col("f5"))).first()
    assert row[:4] == (got[2], got[0], got[6], 1.0) and row[4] < 0.4


def test_likeness_tells_an_edit_from_another_text(spark):
    rows = [(i, " ".join(f"w{(i * 7919 + j * j) % 5003}" for j in range(300))) for i in range(40)]
    got = fp.edited_fingerprints(docs_frame(spark, rows)).collect()
    assert all(0.45 < r["near_edited"] < 0.9 and r["near_next"] < 0.4 for r in got)


def test_plan_has_no_python(spark):
    plan = fp.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
