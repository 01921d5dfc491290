"""Operator 7: MinHash near-dedup with tensored banding.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document's set holds
its distinct ``shingle``-word shingles; with fewer words the whole sequence is
the one shingle; without words the set is empty and linked with nothing. Two
documents are linked when their Jaccard similarity is at least ``percent`` / 100,
checked as 100 * intersection >= percent * union on the full sets of 64-bit
shingle hashes. A component's smallest ``doc_id`` stays.

Tensored banding: two collections of ``m`` half keys, each of two minhashes,
give m * m table keys, every pair of one half key from either collection. With
4 m minhashes a document has the m * m tables of four rows that would
otherwise cost 4 m * m of them. ``m`` follows from the threshold: a pair on the
threshold is missed with a probability under ``MISS``.

Steps, all distributed:

1. one pass over the texts makes set size, a 128-bit set hash and half keys;
2. documents with equal sets form a class, represented by its smallest id, so
   exact copies take part once;
3. representatives are grouped by table key; each is paired with the smallest
   id of its table, and pairs that fit by size are verified on the full sets;
4. verified links are connected (min-label propagation with pointer jumping);
5. tables whose members are in several components are searched again: each
   member is paired with one pivot of its table, until that links nothing new;
   the rest by all pairs across components that share a prefix shingle (an exact
   filter, see ``_by_prefix``), each verified. So no link between documents that
   share a table is lost. Pairs inside one component change nothing and are not
   formed, which keeps large groups of near copies linear.

Hot tables: keys with more than 1/1000 of all rows are joined by broadcast.

Cases: rows with a null ``doc_id`` are linked with nothing and kept
(``component_id`` null). Rows that share a ``doc_id`` are one document for
linking. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .common import drop_staged, prepare, skew_join, stage

MISS = 1e-4
ROWS = 2
BLOCK = 256
SKETCH_BITS = 16


def half_keys(percent: int) -> int:
    """Half keys per collection so that a pair on the threshold shares a table."""
    s, m = (percent / 100) ** ROWS, 1
    while 1 - (1 - (1 - s) ** m) ** 2 > MISS:
        m += 1
    return m


def _signatures(shingle: int, m: int):
    mult, add = tc._odd(501, 2 * m * ROWS), tc._odd(502, 2 * m * ROWS)

    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(1))
            for i, j in tc.slices(offsets, 4 << 20):
                part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, docs = tc.words(part, off)
                sets, at = tc.distinct_shingles(tc.word_hashes(part, starts, ends, fold=tc.LOWER), docs, shingle)
                n = np.diff(at)
                some = np.flatnonzero(n)
                low = np.zeros((len(n), 2 * m * ROWS), np.uint64)
                sums = np.zeros((len(n), 2), np.uint64)
                if len(some):
                    for k in range(2 * m * ROWS):
                        low[some, k] = np.minimum.reduceat(tc.mix(sets * mult[k] + add[k]), at[some])
                    sums[some, 0] = np.add.reduceat(tc.mix(sets ^ mult[0]), at[some])
                    sums[some, 1] = np.add.reduceat(tc.mix(sets + add[1]), at[some])
                pairs = low.reshape(len(n), 2 * m, ROWS)
                half = tc.mix(pairs[:, :, 0] * mult[2] + tc.mix(pairs[:, :, 1] + add[3])).view(np.int64)
                halves = pa.FixedSizeListArray.from_arrays(pa.array(half.reshape(-1)), 2 * m).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), *(pa.array(sums[:, c].view(np.int64)) for c in (0, 1)), halves],
                    ["doc_id", "n", "set1", "set2", "half"])
    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(1))
            for i, j in tc.slices(offsets, 4 << 20):
                part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, docs = tc.words(part, off)
                sets, at = tc.distinct_shingles(tc.word_hashes(part, starts, ends, fold=tc.LOWER), docs, shingle)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], ["doc_id", "shingles"])
    return run


def connect(nodes_links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (a, b), for all linked ids.

    Alternates min-label propagation over the links with pointer jumping; every
    round is a join and a pre-aggregated minimum, written to the shared folder.
    """
    links = stage(nodes_links.select("a", "b").union(nodes_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    labels = stage(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                   .select("id", F.least("id", "b").alias("component")), "labels")
    while True:
        near = (links.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("best")))
        spread = labels.join(near, "id").select("id", F.least("component", "best").alias("hop"), F.col("component").alias("old"))
        up = labels.select(F.col("id").alias("hop"), F.col("component").alias("top"))
        new = stage(spread.join(up, "hop", "left").select(
            "id", F.least("hop", "top").alias("component"), "old"), "labels")
        moved = new.filter(F.col("component") != F.col("old")).limit(1).count()
        drop_staged(labels)
        labels = new.select("id", "component")
        if not moved:
            drop_staged(links)
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those similar on their full sets.

    ``b`` may be a hub of many pairs: its set is copied to blocks of about
    ``BLOCK`` pairs each, and no block is larger than a few times that.
    """
    hubs = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n_pairs"))
    blocks = hubs.withColumn("blocks", F.ceil(F.col("n_pairs") / BLOCK))
    total = pairs.count()
    placed = (skew_join(pairs, blocks, ["b"], total, "n_pairs")
              .withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")))
              .join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a"))
    right = (blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
             .select("b", "block", "set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (placed.join(right, ["b", "block"])
            .filter(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both))
            .select("a", "b").distinct())


def _fits(x: str, y: str, percent: int):
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _labelled(shared: DataFrame, component: DataFrame) -> DataFrame:
    return shared.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "label", F.coalesce("component", "doc_id")).drop("component")


def _with_pivot(shared: DataFrame, component: DataFrame, n_shared: int, percent: int):
    """(pairs, open documents): tables that several components share.

    Every member of such a table is paired with one member chosen by hash.
    """
    labelled = _labelled(shared.select("key", "doc_id", "n"), component)
    mixed = stage(labelled.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.min(F.struct(F.xxhash64("doc_id").alias("order"), "doc_id", "n", "label")).alias("pivot"))
        .filter(F.col("lo") < F.col("hi")), "mixed-tables")
    rows = stage(skew_join(labelled, mixed.drop("lo", "hi"), ["key"], n_shared, "size"), "open-rows")
    q, q_n = F.col("pivot.doc_id"), F.col("pivot.n")
    pairs = (rows.withColumn("q_n", q_n).filter((F.col("label") != F.col("pivot.label")) & _fits("n", "q_n", percent))
             .select(F.greatest("doc_id", q).alias("a"), F.least("doc_id", q).alias("b")).distinct())
    return pairs, rows.select("doc_id", "n").distinct()


def _prefixes(order: np.ndarray, percent: int):
    """Rows (token, doc_id, place, before) of each set's first shingles in a fixed
    order, rare ones first; ``before`` is the row's predecessor, or null."""
    def run(batches):
        none = np.zeros(0, np.int64)
        for batch in batches:
            ids, out = batch.column(0).to_numpy(), [(none, none, none, none)]
            lists = batch.column(1)
            at, values = lists.offsets.to_numpy(), np.asarray(lists.values).view(np.uint64)
            for i, doc in enumerate(ids):
                own = values[at[i]:at[i + 1]]
                count = order[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = np.lexsort((own, count))[:len(own) - -(-percent * len(own) // 100) + 1]
                place = np.flatnonzero(count[first] > 1)  # a shingle of one document is shared with none
                tokens = own[first[place]].view(np.int64)
                out.append((tokens, np.full(len(place), doc, np.int64), place, np.concatenate([tokens[:1], tokens[:-1]])))
            token, ids, place, before = (np.concatenate(c) for c in zip(*out))
            start = np.diff(ids, prepend=ids[:1] - 1) != 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(ids), pa.array(place), pa.array(before, mask=start)], ["token", "doc_id", "place", "before"])
    return run


def _sketch(batches):
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        values = np.asarray(batch.column(0).flatten()).view(np.uint64)
        total += np.bincount((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])


def _by_prefix(open_docs: DataFrame, sets: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of open documents across components that can be similar enough.

    Sets of x and y shingles with similarity t have at least
    w = t * (x + y) / (1 + t) in common. In any fixed order of shingles, the
    first common one then has w - 1 more behind it in either set, so it stands
    at a place of at most x - w and y - w (from 0); pairs without such a
    shingle cannot be linked. Rare shingles come first, by a sketch of
    2 ** SKETCH_BITS counts, so a near copy whose own edits fill its first
    places meets nobody. In the group of a shingle, only members outside its
    largest component are paired, with the members of other components. A row
    is skipped where both sets have the same shingle before this one: that one
    is common too, and the first common one is never skipped.
    """
    own = stage(sets.join(open_docs, "doc_id"), "open-sets")
    order = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in own.select("shingles").mapInArrow(_sketch, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        order[r["slot"]] = r["n"]
    tokens = own.select("doc_id", "shingles").mapInArrow(_prefixes(order, percent), "token long, doc_id long, place long, before long")
    rows = stage(_labelled(tokens.join(open_docs, "doc_id"), component), "prefixes")
    mixed = stage(rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n_rows")).groupBy("token").agg(
        F.max(F.struct("n_rows", "label")).alias("main"), F.sum("n_rows").alias("size"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1").select("token", F.col("main.label").alias("main"), "size"), "mixed-prefixes")
    met = stage(skew_join(rows, mixed, ["token"], rows.count(), "size"), "prefix-rows")
    rest = met.filter(F.col("label") != F.col("main")).select("token", "doc_id", "n", "label", "main", "place", "before")
    other = met.select("token", F.col("doc_id").alias("q"), F.col("n").alias("q_n"), F.col("label").alias("q_label"),
                       F.col("place").alias("q_place"), F.col("before").alias("q_before"))
    once = (F.col("q_label") == F.col("main")) | (F.col("doc_id") > F.col("q"))
    behind = F.least(F.col("n") - F.col("place"), F.col("q_n") - F.col("q_place"))
    enough = (100 + percent) * behind >= percent * (F.col("n") + F.col("q_n"))
    repeated = F.coalesce(F.col("before") == F.col("q_before"), F.lit(False))
    return (rest.join(other, "token").filter((F.col("label") != F.col("q_label")) & once & enough & ~repeated)
            .select(F.greatest("doc_id", "q").alias("a"), F.least("doc_id", "q").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept."""
    prepare(docs.sparkSession)
    m = half_keys(percent)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = stage(texts.mapInArrow(_signatures(shingle, m),
                                  "doc_id long, n long, set1 long, set2 long, half array<long>"), "signatures")
    n_rows = rows.count()

    known = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stage(known.groupBy("n", "set1", "set2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    members = stage(skew_join(known.drop("half"), classes, ["n", "set1", "set2"], n_rows, "copies")
                    .select("doc_id", "n", "rep"), "members")
    reps = known.join(classes.select("n", "set1", "set2", F.col("rep").alias("doc_id")), ["n", "set1", "set2", "doc_id"], "left_semi")

    # every table key of every representative; tables of one member are left out at once
    table = F.explode(F.sequence(F.lit(0), F.lit(m * m - 1))).alias("t")
    first, second = F.expr(f"half[t div {m}]"), F.expr(f"half[{m} + t % {m}]")
    keys = (reps.select("doc_id", "n", "half", table)
            .select(F.xxhash64("t", first, second).alias("key"), "doc_id", "n"))
    tables = stage(keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("size"))
                   .filter(F.col("hub") < F.col("last")), "tables")
    shared = stage(skew_join(keys, tables.drop("last"), ["key"], n_rows * m * m, "size"), "table-rows")
    n_shared = shared.count()

    wanted = shared.select("doc_id").distinct()
    sets = stage(texts.join(wanted, "doc_id", "left_semi").mapInArrow(
        _sets(shingle), "doc_id long, shingles array<long>"), "sets")
    sizes = shared.select("doc_id", "n").distinct()

    n_of = sizes.select(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"))
    star = shared.filter(F.col("doc_id") != F.col("hub")).select("doc_id", "hub", "n").distinct()
    pairs = stage(star.join(n_of, "hub").filter(_fits("n", "hub_n", percent))
                  .select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct(), "pairs")
    tried = pairs
    links = stage(_verified(pairs, sets, percent), "verified")

    component, used = connect(links), [classes, tables, shared, sets, pairs, links]
    while True:
        pairs, open_docs = _with_pivot(shared, component, n_shared, percent)
        pairs = stage(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        fresh = stage(_verified(pairs, sets, percent), "verified")
        tried = stage(tried.union(pairs), "tried")
        used += [pairs, fresh, tried]
        if not fresh.limit(1).count():
            break
        links = stage(links.union(fresh), "verified")
        component = connect(links)
        used.append(links)
    open_docs = stage(open_docs, "open")
    pairs = stage(_by_prefix(open_docs, sets, component, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    fresh = stage(_verified(pairs, sets, percent), "verified")
    if fresh.limit(1).count():
        component = connect(links.union(fresh))
    drop_staged(*used, open_docs, pairs, fresh)  # the result reads rows, members and component only

    smallest = members.join(component.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter(F.col("doc_id").isNull() | (F.col("n") == 0)).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return smallest.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: near-duplicate component of every document (3-word shingles, 0.85)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=3, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i : i + 2], ' ') FOR i IN range(1, len(ws) - 1)]) END AS sh
  FROM w WHERE len(ws) > 0),
x AS (SELECT doc_id, unnest(sh) AS h FROM s),
pairs AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n
  FROM x p JOIN x q ON p.h = q.h AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN s AS sa ON sa.doc_id = a JOIN s AS sb ON sb.doc_id = b
  WHERE 100 * n >= 85 * (len(sa.sh) + len(sb.sh) - n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(len(sh), 0)::BIGINT AS n_shingles,
       least(w.doc_id, coalesce(c, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(c, w.doc_id) AS kept
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN least ON least.a = w.doc_id
"""
