import hashlib
from collections import defaultdict

import pytest

from searchlake.llm.line_dedup import drop_repeated_lines

from .helpers import CLASHING, corpus, docs_frame

STRIP = " \t\n\x0b\x0c\r"


def brute(rows, min_docs=3, min_chars=20):
    key = lambda x: x.strip(STRIP).translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    order = lambda i: (i is not None, i or 0)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs
                or i == max(holders[key(x)], key=order)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed) + [(900, "Ünïcode line of twenty\nx")] * 3
    got = drop_repeated_lines(docs_frame(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    assert any(r["n_dropped"] for r in got)


def test_length_counts_code_points(spark):
    short, long = "é" * 19, "é" * 20
    rows = [(i, f"{short}\n{long}") for i in range(4)]
    got = {r["doc_id"]: r["text"] for r in drop_repeated_lines(docs_frame(spark, rows)).collect()}
    assert got == {0: short, 1: short, 2: short, 3: f"{short}\n{long}"}


def test_a_line_in_most_documents(spark):
    line = "a line that nearly every document of the table holds"
    rows = [(i, f"{line}\nown {i}\n{line}") for i in range(3000)]
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in drop_repeated_lines(docs_frame(spark, rows)).collect()}
    assert got[2999] == (rows[2999][1], 0) and all(got[i] == (f"own {i}", 2) for i in range(2999))


def test_extra_columns_and_empty_table(spark):
    df = docs_frame(spark, [(1, "a" * 30), (2, "a" * 30), (3, "a" * 30)], extra=True)
    out = drop_repeated_lines(df)
    assert out.columns == df.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == "" and rows[3]["text"] == "a" * 30 and rows[1]["n_dropped"] == 1
    assert all(rows[1][c] == f"x-{c}" for c in CLASHING if c not in ("n_lines", "n_dropped"))
    assert drop_repeated_lines(df.limit(0)).collect() == []


def test_query_digest(spark):
    from searchlake.llm import line_dedup
    rows = line_dedup.query(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) and all(len(r["kept_sha256"]) == 64 for r in rows)
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
