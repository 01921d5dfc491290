import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from searchlake.llm import merkle as m

from .helpers import corpus, docs_frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def raise_tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def way(levels, at, arity):
    """[(before, after)] of every level."""
    out = []
    for nodes in levels[:-1]:
        first = at // arity * arity
        out.append((nodes[first:at], nodes[at + 1:first + arity]))
        at //= arity
    return out


def brute(rows, arity=16):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = raise_tree([leaf(r) for r in groups[s]], arity)
    top = raise_tree([trees[s][-1][0] for s in names], arity)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = way(trees[s], i, arity) + way(top, k, arity)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)})))
            for before, after in path:
                node = h(*before, node, *after)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*[x for b, a in path for x in b + a]), node, node == top[-1][0]))
    return out


def run(spark, rows, arity=16, levels=3, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("id", "group", "node", "tree", "idx", "total", "block", "path", "part")})
    manifest = m.build(m.document_leaves(df), arity, levels)
    got = m.versions(manifest).collect()
    text = lambda b: bytes(b).hex()
    return [(r["id"], text(r["leaf"]), text(r["subroot"]), manifest.root.hex(), text(r["proof"]), text(r["folded"]), r["verified"]) for r in got], got


def table(n, sources=("a", "B", None, "é", "")):
    rows = [(i, sources[0] if i % 3 else sources[i % len(sources)], "en" if i % 4 else None, i * 3 if i % 7 else None,
             None if i % 11 == 5 else f"Text {i} É" * (i % 3)) for i in range(n)]
    return rows + [(n, "alone", "en", 4, "Long " * 50_000), (n + 1, "pair", None, None, None), (n + 2, "pair", "de", 0, "")]


@pytest.mark.parametrize("arity,levels,n", [(16, 3, 300), (2, 1, 60), (2, 2, 90), (3, 1, 100), (4, 2, 400)])
def test_matches_brute_force(spark, arity, levels, n):
    rows = table(n)
    got, _ = run(spark, rows, arity, levels, extra=True)
    assert sorted(got) == sorted(brute(rows, arity))


def test_many_groups_have_a_tree_of_several_rounds(spark):
    rows = [(i, f"s{i % 37}", "en", 1, f"T{i}") for i in range(120)]
    got, _ = run(spark, rows, 2, 2)
    assert sorted(got) == sorted(brute(rows, 2))


def test_repeated_and_null_ids(spark):
    rows = [(1, "a", "en", 1, "x"), (1, "a", "en", 1, "Y"), (None, "a", None, None, "Null Id"), (None, None, None, None, None), (2, "a", "en", 1, "z")]
    got, _ = run(spark, rows)
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    twice = [(7, "a", "en", 1, "x")] * 2 + [(8, "a", "en", 1, "y")]
    got, _ = run(spark, twice)
    assert sorted(got) == sorted(brute(twice))


def test_one_row_and_no_row(spark):
    got, raw = run(spark, [(5, "a", "en", 1, "Only")])
    assert got == brute([(5, "a", "en", 1, "Only")]) and raw[0]["copied"] == []
    assert m.versions(m.build(m.document_leaves(docs_frame(spark, [(1, "a")]).limit(0)))).collect() == []


def test_a_version_copies_only_its_ancestors(spark):
    rows = [(i, "a", "en", 1, f"Text {i}") for i in range(70)]
    _, got = run(spark, rows, 4, 2)
    original = {x for level in raise_tree([leaf(r) for r in sorted(rows)], 4)[1:] for x in level}
    for r in got:
        copied = [bytes(x).hex() for x in r["copied"]]
        assert len(copied) == 4  # 70 -> 18 -> 5 -> 2 -> 1
        assert set(copied) <= original if r["verified"] else not set(copied) & original


def test_a_leaf_changes_with_every_field(spark):
    rows = [r for r in corpus(3, n=20) if r[0] is not None]
    df = docs_frame(spark, rows)
    base = df.withColumn("text", F.coalesce("text", F.lit("")))
    leaves = m.document_leaves(df).collect()
    assert {bytes(r["node"]).hex() for r in leaves} == {leaf((i, "src0", "en", len(t or ""), t)) for i, t in rows}
    assert m.document_leaves(base).select("node").exceptAll(m.document_leaves(df).select("node")).count() == sum(t is None for _, t in rows)
