"""Operator 3: exact dedup with an extendible-hash index (DataFrame functions only).

Texts (null: empty) are equal when they are identical after each run of
``[\\x20\\x09-\\x0D]`` is replaced by one space. Of equal texts the row with the
smallest ``doc_id`` stays.

1. *Keys.* One pass hashes every normalised text; the small key table
   ``(doc_id, hash, sha256)`` is written to the shared folder.
2. *Directory.* The distinct hashes are counted by their leading bits. A bucket
   with more than ``capacity`` hashes is split on its next bit; when that bucket
   is already as deep as the directory, the directory doubles. The directory
   table (slot, depth, bucket) is written to the shared folder.
3. *Index files.* One entry per distinct hash (rows and smallest id, combined
   before the shuffle) goes to its bucket's owner, a task that holds a range of
   consecutive buckets, and is written there as ``owner=N`` files.
4. *Chains.* The texts of rows whose hash has several rows meet at their owner;
   a bitmap of these hashes, of bounded size, keeps most others out of the shuffle.
   Copies are combined in salted groups first, so a text held by a third of all
   rows reaches its owner as a few rows. The owner compares bytes: unequal texts
   of one hash are entries of one chain, each with its smallest id and its size.
5. Every row looks its entry up by hash, and by sha256 within a chain of
   several entries; hashes with more than 1/1000 of the rows are broadcast.

Cases: null ``doc_id`` sorts after any number, so a null row is kept only if all
rows of its text have no id; ``keep_id`` is then null and all of them are kept.
Rows that share the kept ``doc_id`` and text are all kept. Other columns and
their names are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, skew_join, stage

SALTS = 32
#: The filter before the texts' shuffle has at most 2 ** FILTER_BITS bits, 64 a row.
FILTER_BITS = 26
#: Directory slots are at most 2 ** MAX_DEPTH; beyond it buckets overflow into chains of pages.
MAX_DEPTH = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def leading_bits(hash_: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit hash, as a number from 0."""
    return F.shiftrightunsigned(hash_, 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(slot, depth, bucket, n) of an extendible-hash directory over distinct hashes.

    ``slot`` is the leading ``global depth`` bits; a bucket of smaller depth
    holds several consecutive slots. ``bucket`` is the bucket's first slot, so
    bucket numbers follow the key order. The directory doubles while a bucket
    over capacity is as deep as it.
    """
    fine = stage(entries.groupBy(leading_bits(F.col("h"), max_depth).alias("bits"))
                 .agg(F.count(F.lit(1)).alias("n")), "leading-bits")
    fullest = (fine.select(F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"), "bits", "n")
               .groupBy("depth", F.expr(f"shiftright(bits, {max_depth} - depth)").alias("prefix"))
               .agg(F.sum("n").alias("n")).groupBy("depth").agg(F.max("n").alias("n")).collect())
    # max_depth + 1 rows: the directory doubles until no bucket is over capacity
    depth = min([r["depth"] for r in fullest if r["n"] <= capacity], default=max_depth if fullest else 0)

    per_depth = (fine.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"), "bits", "n")
                 .groupBy("depth", F.expr(f"shiftright(bits, {max_depth} - depth)").alias("prefix"))
                 .agg(F.sum("n").alias("n")))
    parent = per_depth.select((F.col("depth") + 1).alias("depth"),
                              F.col("prefix").alias("up"), F.col("n").alias("up_n"))
    buckets = (per_depth.withColumn("up", F.shiftright("prefix", 1)).join(parent, ["depth", "up"], "left")
               .filter((F.col("depth") == 0) | (F.col("up_n") > capacity))
               .filter((F.col("n") <= capacity) | (F.col("depth") == depth)))
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    return stage(buckets.select(
        F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {depth} - depth)") - 1)).alias("slot"),
        "depth", first.alias("bucket"), "n", F.lit(depth).alias("global_depth")), "directory")


def build_index(keys: DataFrame, capacity: int = 1 << 14, max_depth: int = MAX_DEPTH):
    """(directory, entries, number of owners) of a key table with the columns ``doc_id, h``.

    Entries are (owner, bucket, h, n_rows, head_id), written partitioned by owner.
    """
    heads = stage(keys.groupBy("h").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("head_id")), "hash-heads")
    n = heads.count()
    # a directory of 2 ** max_depth slots is small enough to broadcast at any input size
    slots = directory(heads, max(capacity, parts_for(2 * n, 1 << max_depth)), max_depth)
    top = slots.agg(F.max("global_depth")).first()[0] or 0
    owners = min(1 << top, parts_for(n, capacity))
    owned = slots.select("slot", "bucket", F.shiftrightunsigned(
        F.col("bucket") * owners, top).cast("int").alias("owner"))
    entries = heads.withColumn("slot", leading_bits(F.col("h"), top)).join(F.broadcast(owned), "slot").drop("slot")
    written = stage(entries.repartition(owners, "owner").sortWithinPartitions("owner", "bucket", "h"), "hash-index")
    return slots, written, owners


def shared_words(shared: DataFrame, n_shared: int) -> tuple[DataFrame, int]:
    """(word, mask) of a bitmap over the leading bits of the hashes in ``shared``, and its bits.

    Four bits or more a hash, up to ``2 ** FILTER_BITS``: at most a million rows of
    two numbers, whatever the input. Beyond that the bitmap fills up and lets more
    rows pass that need not; it never drops one of a shared hash.
    """
    bits = min(FILTER_BITS, max(6, (4 * n_shared).bit_length()))
    place = leading_bits(F.col("h"), bits)
    return (shared.groupBy(F.shiftright(place, 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("mask")), bits)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 1 << 14, hash_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``hash_bits`` under 64 clears the low bits of the hash, to test collisions.
    """
    hashed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("norm"))
    h = F.xxhash64("norm")
    if hash_bits < 64:
        h = F.shiftleft(F.shiftright(h, 64 - hash_bits), 64 - hash_bits)
    hashed = hashed.withColumn("h", h)
    sha = F.unhex(F.sha2("norm", 256))
    keys = stage(hashed.select("doc_id", "h", sha.alias("sha")), "text-keys")
    n_rows = keys.count()
    _, index, owners = build_index(keys, capacity)

    shared = index.filter(F.col("n_rows") > 1).select("h", "owner", "bucket", "n_rows")
    wanted = skew_join(keys, shared, ["h"], n_rows, "n_rows").select(
        "doc_id", "sha", "h", "owner", "bucket").dropDuplicates(["doc_id", "sha"])
    # only texts whose hash may be shared are shuffled
    words, bits = shared_words(shared, shared.count())
    place = leading_bits(F.col("h"), bits)
    bit = F.call_function("shiftright", F.col("mask"), place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    texts = (hashed.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(words), "word").filter(bit == 1)
             .select(F.col("doc_id").alias("text_id"), "norm", sha.alias("text_sha")))
    members = wanted.join(texts, F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.col("sha") == F.col("text_sha")))
    combined = (members.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"), "owner", "bucket", "h", "sha", "norm")
                .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")))
    chains = stage(combined.repartition(owners, "owner")
                   .groupBy("owner", "bucket", "h", "sha", "norm")
                   .agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size"))
                   .select("h", "sha", "keep_id", "size"), "chains")

    placed = skew_join(keys, chains, ["h", "sha"], n_rows, "size", "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return placed.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: group of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_groups(docs)


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
