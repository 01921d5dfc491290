"""Operator 13: Merkle manifest of a dataset, with tampering as versions of a persistent tree.

H is the SHA-256 in hex of its inputs joined, digests as hex text. A row's leaf is H of
its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. In each
group (``source``) leaves are ordered by id, and while several nodes remain every
``ARITY`` consecutive ones (fewer in the last run) become their H; the one that remains
is the group's subroot. Subroots, ordered by group (null first, bytewise), give the root
in the same way.

* *Places.* One range sort by group, id and leaf numbers the leaves of a group; a group
  that fills many partitions gets its offsets from the counts of (partition, group).
* *Building.* ``BLOCK`` = ARITY**LEVELS consecutive nodes of a group are an aligned
  block: a complete subtree, raised by one task without looking at others. Roots of
  blocks are the nodes of the next round, so a group of any size is raised in
  log(size) / log(BLOCK) rounds, and no task holds more than a block. Each round is
  written to the shared folder. The subroots are raised by the same rounds.
* *Versions.* The tree is persistent: a changed leaf makes a version that shares all
  nodes but its own ancestors, which are copied. Inside an aligned block the copies are
  made from the block's nodes; above it a version goes on with the block's path, the
  untouched siblings on the way to the root. Paths are handed down round by round, from
  the root to the blocks of leaves, as one row a block; so versions stay where their
  leaves are, however many a block has, and upper levels are read, never rewritten.
* *Proofs.* A row's proof is the siblings on its way; every row, changed or not, is folded
  again to a root from its (changed) leaf and the original siblings.

Cases: a null id sorts first, null fields are ``-``, and a null id is never tampered
with. Rows that share group and id are ordered by leaf. Repeated rows are leaves of their
own; which of them has which place is not defined, and their proofs are each valid. Empty
and very long texts are hashed whole. Other columns are not looked at. An empty table has
no rows and the root of no nodes, which is null.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.ids import LOCAL_BITS, dense_index

from .common import prepare, stage

ARITY = 16
#: Levels raised by one task; a block has ARITY ** LEVELS nodes.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(fields: list[Column]) -> Column:
    """The digest (32 bytes) of a row's fields."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent(run: list[bytes]) -> bytes:
    """H of a run of nodes (digests are kept as bytes, hashed as hex)."""
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


class Block:
    """The nodes of one aligned block, level by level."""

    def __init__(self, nodes: list[bytes], total: int, block: int, arity: int, levels: int):
        """``total`` nodes of the group are raised; a group within one block is raised to its subroot."""
        self.arity, self.levels = arity, [nodes]
        while len(self.levels[-1]) > 1 or (total > block and len(self.levels) <= levels):
            last = self.levels[-1]
            self.levels.append([parent(last[i:i + arity]) for i in range(0, len(last), arity)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[list[bytes], list[bytes]]]:
        """For each level up to the block's root, the siblings before and after."""
        out = []
        for nodes in self.levels[:-1]:
            first = at // self.arity * self.arity
            out.append((nodes[first:at], nodes[at + 1:first + self.arity]))
            at //= self.arity
        return out


def copies(node: bytes, path: list[tuple[list[bytes], list[bytes]]]) -> list[bytes]:
    """The nodes that a version copies: the ancestors of ``node`` along a path of untouched siblings."""
    out = []
    for before, after in path:
        node = parent([*before, node, *after])
        out.append(node)
    return out


def pack_path(path) -> bytes:
    return b"".join(struct.pack(">HH", len(b), len(a)) + b"".join(b) + b"".join(a) for b, a in path)


def unpack_path(raw: bytes):
    out, at = [], 0
    while at < len(raw):
        n_before, n_after = struct.unpack_from(">HH", raw, at)
        at += 4
        nodes = [raw[i:i + 32] for i in range(at, at + 32 * (n_before + n_after), 32)]
        out.append((nodes[:n_before], nodes[n_before:]))
        at += 32 * len(nodes)
    return out


def _nodes(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    table = table.take(pc.sort_indices(table, [("idx", "ascending")]))
    return table, table["node"].to_pylist()


def _raise(arity: int, levels: int):
    size = arity ** levels

    def run(table: pa.Table) -> pa.Table:
        table, nodes = _nodes(table)
        total = table["total"][0].as_py()
        return pa.table({"tree": table["tree"].slice(0, 1).cast(pa.int64()), "idx": pa.array([table["idx"][0].as_py() // size], pa.int64()),
                         "total": pa.array([-(-total // size)], pa.int64()),
                         "node": pa.array([Block(nodes, total, size, arity, levels).root], pa.binary())})
    return run


def _hand_down(arity: int, levels: int):
    """Paths of a block's nodes: their own way to the block's root, then the block's path."""
    size = arity ** levels

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, nodes = _nodes(table)
        block = Block(nodes, table["total"][0].as_py(), size, arity, levels)
        upper = above["path"][0].as_py()
        return pa.table({"tree": table["tree"].cast(pa.int64()), "idx": table["idx"].cast(pa.int64()),
                         "path": pa.array([pack_path(block.path(i)) + upper for i in range(len(nodes))], pa.binary())})
    return run


NODES = "tree long, idx long, total long, node binary"
PATHS = "tree long, idx long, path binary"


@dataclass
class Forest:
    """Rounds of nodes of many trees; the last round has each tree's root."""
    rounds: list[DataFrame]
    arity: int
    levels: int

    @property
    def block(self) -> int:
        return self.arity ** self.levels

    @property
    def roots(self) -> DataFrame:
        """(tree, node)"""
        last = self.rounds[-1].select("tree", "node")
        for r in self.rounds[1:-1]:
            last = last.unionByName(r.filter(F.col("total") == 1).select("tree", "node"))
        return last

    def blocks(self, at: int) -> DataFrame:
        """The nodes of a round that a next round raises, with their block."""
        nodes = self.rounds[at] if at == 0 else self.rounds[at].filter(F.col("total") > 1)
        return nodes.withColumn("block", F.floor(F.col("idx") / self.block).cast("long"))

    def paths(self, at: int, above: DataFrame) -> DataFrame:
        """Paths (tree, idx, path) of the nodes of round ``at``, given those of the trees' roots (tree, path)."""
        last = len(self.rounds) - 1
        ends = lambda i: (self.rounds[i] if i == last else self.rounds[i].filter(F.col("total") == 1)).join(
            above, "tree").select("tree", "idx", "path")
        made = ends(last)
        for i in range(last - 1, at - 1, -1):
            below = stage(self.blocks(i).groupBy("tree", "block").cogroup(made.withColumnRenamed("idx", "block").groupBy("tree", "block"))
                          .applyInArrow(_hand_down(self.arity, self.levels), PATHS), "merkle-paths")
            made = below if i == 0 else below.unionByName(ends(i))
        return made


def grow(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> Forest:
    """Raise the nodes (tree, idx from 0, total of the tree, node) of all trees to their roots."""
    forest = Forest([nodes], arity, levels)
    while True:
        rising = forest.blocks(len(forest.rounds) - 1)
        forest.rounds.append(stage(rising.groupBy("tree", "block").applyInArrow(_raise(arity, levels), NODES), "merkle-round"))
        if not forest.rounds[-1].filter(F.col("total") > 1).limit(1).count():
            return forest


@dataclass
class Manifest:
    leaves: DataFrame  # id, group, tree, idx, total, node, changed
    groups: DataFrame  # group, tree: number of the group in order
    forest: Forest
    top: Forest
    root: bytes | None


def _leaves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of (id, group, node, changed) in the trees of their groups, and the groups' numbers."""
    ordered = rows.sort(F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), "node").withColumn("mono", F.monotonically_increasing_id())
    ordered = stage(ordered.withColumn("part", F.shiftright("mono", LOCAL_BITS)), "merkle-leaves")
    runs = stage(ordered.groupBy("part", "group").agg(F.count(F.lit(1)).alias("rows"), F.min("mono").alias("first")), "merkle-runs")
    groups = stage(dense_index(runs.select("group").distinct(), [F.col("group").asc_nulls_first()], start=0, name="tree"), "merkle-groups")
    same = F.col("runs.group").eqNullSafe(F.col("groups.group"))
    numbered = runs.alias("runs").join(groups.alias("groups"), same).select("part", F.col("runs.group"), "rows", "first", "tree")
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    numbered = numbered.select("part", "group", "tree", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                               F.sum("rows").over(tree).alias("total"))
    # a (partition, group) never holds more than a partition, so no key of this join is hot
    o, r = ordered.alias("o"), numbered.alias("r")
    placed = o.join(r, (F.col("o.part") == F.col("r.part")) & F.col("o.group").eqNullSafe(F.col("r.group"))).select(
        "id", F.col("o.group").alias("group"), "tree", (F.col("mono") + F.col("shift")).alias("idx"), "total", "node", "changed")
    return placed, groups


def build(rows: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """Manifest of (id, group, node: the leaf's digest, changed: that of a changed leaf, or null)."""
    prepare(rows.sparkSession)
    leaves, groups = _leaves(rows)
    leaves = stage(leaves, "merkle-places")
    forest = grow(leaves.select("tree", "idx", "total", "node"), arity, levels)
    n = groups.count()
    subroots = forest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n).cast("long").alias("total"), "node")
    top = grow(stage(subroots, "merkle-subroots"), arity, levels)
    root = top.roots.first()
    return Manifest(leaves, groups, forest, top, root["node"] if root else None)


def _versions(arity: int, levels: int, root: bytes):
    size = arity ** levels

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, nodes = _nodes(table)
        block = Block(nodes, table["total"][0].as_py(), size, arity, levels)
        upper = unpack_path(above["path"][0].as_py())
        upper_hex = b"".join(b"".join(b + a) for b, a in upper).hex().encode()
        proofs, ways, folded = [], [], []
        for i, (node, changed) in enumerate(zip(nodes, table["changed"].to_pylist())):
            path = block.path(i)
            made = copies(node if changed is None else changed, path)
            made += copies(made[-1] if made else (node if changed is None else changed), upper)
            proofs.append(hashlib.sha256(b"".join(b"".join(b + a) for b, a in path).hex().encode() + upper_hex).digest())
            ways.append(made)
            folded.append(made[-1] if made else (node if changed is None else changed))
        return pa.table({"id": table["id"], "group": table["group"], "idx": table["idx"], "leaf": table["node"],
                         "subroot": pa.array([above["subroot"][0].as_py()] * len(nodes), pa.binary()),
                         "proof": pa.array(proofs, pa.binary()), "copied": pa.array(ways, pa.list_(pa.binary())),
                         "folded": pa.array(folded, pa.binary()), "verified": pa.array([f == root for f in folded])})
    return run


def versions(manifest: Manifest) -> DataFrame:
    """One row per leaf: id, group, idx, leaf, subroot, proof, copied, folded, verified.

    ``copied`` are the ancestors of the (changed) leaf, from its parent to the version's
    root; all other nodes of the version are those of the manifest.
    """
    spark = manifest.leaves.sparkSession
    forest = manifest.forest
    top = manifest.top.paths(0, manifest.top.rounds[-1].select("tree", F.lit(b"").alias("path")))
    of_tree = top.select(F.col("idx").alias("tree"), "path")
    # paths of the blocks of leaves: the nodes of the first round
    paths = forest.paths(1, of_tree).join(forest.roots.select("tree", F.col("node").alias("subroot")), "tree")
    leaves = manifest.leaves.withColumn("block", F.floor(F.col("idx") / forest.block).cast("long"))
    schema = (f"id {leaves.schema['id'].dataType.simpleString()}, group {leaves.schema['group'].dataType.simpleString()}, idx long, "
              "leaf binary, subroot binary, proof binary, copied array<binary>, folded binary, verified boolean")
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    return (leaves.groupBy("tree", "block").cogroup(paths.withColumnRenamed("idx", "block").groupBy("tree", "block"))
            .applyInArrow(_versions(forest.arity, forest.levels, manifest.root), schema))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents; ids whose CRC-32 is a multiple of 5 have their text lower-cased."""
    fields = [F.col(c) for c in FIELDS]
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").isNotNull()
    changed = leaf_of([*fields[:-1], F.translate("text", UPPER, LOWER)])
    return docs.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), leaf_of(fields).alias("node"),
                       F.when(tampered, changed).alias("changed"))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: proof of every document, and the root that its tampered version folds to."""
    manifest = build(document_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)))
    text = lambda c: F.lower(F.hex(c))
    return versions(manifest).select(
        F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"),
        F.lit(manifest.root.hex() if manifest.root else None).cast("string").alias("root"), text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"), "verified")


def _sql(levels: int = 6, top: int = 4) -> str:
    """The same in DuckDB SQL, for sources of up to 16**levels rows and 16**top sources."""
    field = lambda c, v: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v} END"
    head = " || ".join(field(c, c) for c in FIELDS[:-1])
    parts = [f"""
d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         sha256({head} || {field('text', 'text')}) AS leaf,
         sha256({head} || {field('text', f"translate(text, '{UPPER}', '{LOWER}')")}) AS changed
  FROM documents),
l0 AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM d)"""]

    def rise(prefix: str, first: str, count: int, key: str):
        at = first
        for level in range(1, count + 1):
            parts.append(f"""
{prefix}{level} AS (
  SELECT {key}, i // 16 AS i, (any_value(n) + 15) // 16 AS n, any_value(n) AS below, list(h ORDER BY i) AS run,
         CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {at} GROUP BY {key}, i // 16)""")
            at = f"{prefix}{level}"
    rise("l", "l0", levels, "tree")
    parts.append(f"t0 AS (SELECT 0 AS one, tree AS i, count(*) OVER () AS n, h FROM l{levels})")
    rise("t", "t0", top, "one")
    joins, steps = [], []
    for prefix, count in (("l", levels), ("t", top)):
        at = "i" if prefix == "l" else "tree"
        for level in range(1, count + 1):
            up = f"{at} // {16 ** level}"
            match = f"{prefix}{level}.tree = d.tree AND " if prefix == "l" else ""
            joins.append(f"JOIN {prefix}{level} ON {match}{prefix}{level}.i = d.{up}")
            steps.append((f"{prefix}{level}", f"(d.{at} // {16 ** (level - 1)}) % 16"))
    run = lambda r, k, own: f"array_to_string({r}.run[:{k}] || {own} || {r}.run[{k} + 2:], '')"
    proof = " || ".join(f"CASE WHEN {r}.below = 1 THEN '' ELSE {run(r, k, '[]::VARCHAR[]')} END" for r, k in steps)
    # a version's way to the root, one step inside the other's result
    kept = ", ".join(f"{r}.below AS b{n}, {r}.run AS r{n}, {k} AS k{n}" for n, (r, k) in enumerate(steps))
    parts.append(f"""
joined AS (
  SELECT d.doc_id, d.leaf, l{levels}.h AS subroot, t{top}.h AS root, sha256({proof}) AS proof_sha256, {kept},
         CASE WHEN {_sql_crc('d.doc_id::VARCHAR')} % 5 = 0 THEN d.changed ELSE d.leaf END AS f0
  FROM l0 d {' '.join(joins)})""")
    for n in range(len(steps)):
        parts.append(f"""
f{n + 1} AS (
  SELECT *, CASE WHEN b{n} = 1 THEN f{n} ELSE sha256(array_to_string(r{n}[:k{n}] || [f{n}] || r{n}[k{n} + 2:], '')) END AS f{n + 1}
  FROM {f'f{n}' if n else 'joined'})""")
    return (f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(steps)} AS folded_root, "
            f"f{len(steps)} = root AS verified FROM f{len(steps)}")


def _sql_crc(value: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    byte = "list_reduce([xor(c, b)] || range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return (f"xor(list_reduce([4294967295]::BIGINT[] || [ascii(x)::BIGINT FOR x IN string_split({value}, '')], "
            f"lambda c, b: {byte}), 4294967295)")


SQL = _sql()
