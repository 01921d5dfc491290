"""Operator 2: line dedup.

Every document is split at ``\\n`` (null or empty text: one empty line). The
key of a line is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and
A-Z lower-cased. Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines, except in the largest ``doc_id``
that holds them; the other lines stay in order, joined by ``\\n``.

Distribution: a task explodes each document into one row per distinct key (a
128-bit hash with the key's positions), so that a plain count per hash counts
documents and is combined before the shuffle. Only hashes over the threshold
are joined back; keys with more than 1/1000 of all rows (fewer than 1000, by
counting) are broadcast and the others are shuffled. What returns to a document
is the list of its own dropped positions; the lines are reassembled by position.

Cases: documents are told apart by ``doc_id`` and text. A null ``doc_id`` counts
as smaller than any other, so such a document keeps a repeated line only if
every holder's id is null. Rows that share the largest ``doc_id`` all keep the
line, and each counts as a document. A null text becomes the empty text; an
empty table gives an empty result. Other columns pass through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, skew_join, stage, unwrap, wrap

STRIP = b" \t\n\x0b\x0c\r"


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars


def _line_keys(min_chars: int):
    """Arrow batches of (id, version, text) to one row per document and distinct key."""
    def run(batches):
        for batch in batches:
            ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary())
            out: list[list] = [[], [], [], []]
            for doc, version, text in zip(ids, versions, texts):
                held: dict[bytes, list[int]] = {}
                for at, line in enumerate((text.as_py() or b"").split(b"\n")):
                    key = line.strip(STRIP).lower()
                    if _long_enough(key, min_chars):
                        held.setdefault(key, []).append(at)
                for key, positions in held.items():
                    for column, value in zip(out, (doc, version, xxhash.xxh3_128_digest(key), positions)):
                        column.append(value)
            pair = np.frombuffer(b"".join(out[2]), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(out[3], pa.list_(pa.int32()))],
                ["id", "version", "h1", "h2", "positions"])
    return run


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with cleaned text, then ``n_lines`` and ``n_dropped`` (long).

    ``n_lines`` counts before dropping; input columns of these two names are replaced.
    """
    prepare(docs.sparkSession)
    source = wrap(docs, id=id_col, text=text_col).withColumns(
        {"id": F.col("id").cast("long"), "version": F.xxhash64("text")})
    held = stage(source.select("id", "version", "text").mapInArrow(
        _line_keys(min_chars), "id long, version long, h1 long, h2 long, positions array<int>"), "line-keys")
    repeated = stage(held.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs), "repeated-lines")
    gone = (skew_join(held, repeated, ["h1", "h2"], held.count(), "n_docs")
            .filter(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "version").agg(F.flatten(F.collect_list("positions")).alias("gone"))
            .select(F.col("id").alias("gone_id"), F.col("version").alias("gone_version"), "gone"))

    every = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    kept = F.when(F.col("gone").isNull(), F.col("every")).otherwise(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("every") - 1), "gone"),
        lambda at: F.get("every", at)))
    marked = (source.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version")), "left")
              .withColumn("every", every).withColumn("kept", kept))
    columns = [c for c in docs.columns if c != text_col]
    return unwrap(marked, docs.columns, **{
        text_col: F.array_join("kept", "\n"),
        "n_lines": F.size("every").cast("long"),
        "n_dropped": (F.size("every") - F.size("kept")).cast("long"),
    }).select(*[c for c in docs.columns if c in columns or c == text_col], *[
        c for c in ("n_lines", "n_dropped") if c not in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: digest of the cleaned documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM keyed l LEFT JOIN repeated r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
