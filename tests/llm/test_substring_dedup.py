import pytest

from searchlake.llm.substring_dedup import COVERS, period_for, remove_repeats

from .helpers import WORD, corpus, docs_frame


def brute(rows, length=13):
    first = {}
    split = [(i, WORD.findall(text or "")) for i, text in rows]
    for i, w in split:
        if i is not None:
            for s in range(len(w) - length + 1):
                k = tuple(w[s:s + length])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and first[tuple(w[s:s + length])] < i:
                gone.update(range(s, s + length))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("period", list(COVERS))
def test_every_difference_is_covered(period):
    cover = COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period)) and period_for(13) == 7


@pytest.mark.parametrize("seed,length,chunk", [(1, 13, 1 << 20), (2, 13, 2000), (3, 6, 500), (4, 2, 700)])
def test_matches_brute_force(spark, seed, length, chunk):
    rows = corpus(seed) + [(7, "x " * 40), (7, "x " * 40), (3, "a b " * 30)]
    got = remove_repeats(docs_frame(spark, rows, extra=True), length=length, chunk_bytes=chunk, range_bytes=4000).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got), key=key) == sorted(brute(rows, length), key=key)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
    assert any(r["n_removed"] for r in got)


def test_passage_in_most_documents(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(2000)]
    got = {r["doc_id"]: r for r in remove_repeats(docs_frame(spark, rows), chunk_bytes=20_000).collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["text"] == f"own{i} end{i}" for i in range(1, 2000))


def test_empty_table(spark):
    assert remove_repeats(docs_frame(spark, [(1, "a")]).limit(0)).collect() == []
