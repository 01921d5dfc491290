import random

import pytest

from searchlake.llm.near_dedup import connect, half_keys, near_duplicates

from .helpers import WORD, corpus, docs_frame, lower


def shingles(text, k):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    nodes = {i for i, s in sets if i is not None}
    up = {i: i for i in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if i is not None and j is not None and x and y:
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((root(i), root(j)))
                    up[q] = p
    return [(i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets]


def key(row):
    return tuple((x is None, x) for x in row)


def near_copies(seed, n, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(200)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(10**6)}"
        out.append((1000 + i, " ".join(copy)))
    return out


@pytest.mark.parametrize("k,percent,edits", [(3, 85, 4), (5, 80, 4), (3, 85, 8)])
def test_matches_brute_force(spark, k, percent, edits):
    """With 8 edits some copies are under the threshold and chains link others."""
    rows = corpus(5) + near_copies(1, 50, edits)
    got = near_duplicates(docs_frame(spark, rows, extra=True), shingle=k, percent=percent).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, k, percent), key=key)


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(102)]  # 100 shingles of 3 words
    rows = [(1, " ".join(base)), (2, " ".join(base[:-15])), (3, " ".join([*base[:-16], "y"]))]
    # 85 of 100 shingles are shared by 1 and 2; 84 of 101 by 1 and 3
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs_frame(spark, rows), shingle=3, percent=85).collect()}
    expected = {r[0]: r[2] for r in brute(rows, 3, 85)}
    assert got == expected and got[2] == 1


def test_connect_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)]
    got = {r["id"]: r["component"] for r in connect(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == got[102] == 100


def test_recall_of_tables():
    for percent in (70, 80, 85, 95):
        s = (percent / 100) ** 2
        assert 1 - (1 - (1 - s) ** half_keys(percent)) ** 2 <= 1e-4


def test_empty_table(spark):
    assert near_duplicates(docs_frame(spark, [(1, "a")]).limit(0)).collect() == []
