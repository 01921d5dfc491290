"""Operator 6: best-fit packing planned over the length histogram.

A document's ids are those of the tokenizer file (no special tokens added)
followed by the end id. A document of more than ``size`` ids is cut into pieces
of ``size``; its first piece may be shorter. Pieces are packed into as few
sequences of at most ``size`` ids as best-fit decreasing finds.

1. One pass tokenizes the texts and writes the piece table (lengths and crc).
2. The pieces are counted per length: at most ``size`` rows reach the driver.
3. Best fit runs over counts: sequences with equal free space form runs, and all
   pieces of one length are placed run by run. The plan says, for each run of
   ranks within a length, the first sequence, pieces per sequence and offset. A
   length adds at most one run per free-space class, so the plan has fewer than
   ``size`` * ``size`` rows at any input size (a few thousand in practice).
4. Pieces are ranked within their length, by a salted rank: a length has a salt
   for every sqrt(pieces) of its pieces; salts are numbered apart and shifted by
   the counts of the salts before them, so a frequent length is never sorted in
   one task. A piece takes the slot of its rank.

Tokenizing is in ``bpe.py``.

Cases: null text is empty and has only the end id. Rows with a null or repeated
``doc_id`` are packed like others; ties between equal lengths are ordered by a
hash of the row. Other columns are not looked at. An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import prepare, stage

#: At least so many pieces of one length are ranked together.
LEAST_PER_SALT = 500
def _pieces(path: str, end_id: int, size: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = bpe.shared(path)
        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 512):
                out: list[list] = [[], [], [], [], [], []]
                for doc, text in zip(batch.column(0).slice(lo, 512).to_pylist(), texts.slice(lo, 512)):
                    ids = encoder.encode(text.as_py() or "").tobytes() + end
                    n = len(ids) // 4
                    head = n % size or size
                    cuts = [0, *range(head, n + 1, size)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = ids[4 * a:4 * b]
                        for column, value in zip(out, (doc, piece, a, b - a, zlib.crc32(part), part)):
                            column.append(value)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                keep = 5 + with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:keep], types)], names[:keep])
    return run


def plan_slots(counts: dict[int, int], size: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Best-fit decreasing over counts.

    For each length, runs (first rank, first sequence, pieces per sequence,
    offset): the pieces ranked from ``first rank`` on fill consecutive sequences
    from ``first sequence``, so many each, from ``offset`` on.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> runs of (sequence, count)
    opened, plan = 0, {}
    for length in sorted(counts, reverse=True):
        left, rank, runs = counts[length], 0, []
        while left:
            space = min((s for s, r in free.items() if s >= length and r), default=None)
            if space is None:
                space, first = size, opened
                number = -(-left // (size // length))
                opened += number
            else:
                first, number = free[space].pop()
            each = space // length
            full = min(number, left // each)
            if full:
                runs.append((rank, first, each, size - space))
                rank, left = rank + full * each, left - full * each
                if space - each * length:
                    free[space - each * length].append((first, full))
                first, number = first + full, number - full
            if number and left:  # fewer than ``each`` pieces are left for one more sequence
                runs.append((rank, first, left, size - space))
                free[space - left * length].append((first, 1))
                rank, left = rank + left, 0
                first, number = first + 1, number - 1
            if number:
                free[space].append((first, number))
        plan[length] = runs
    return plan


def _place(plan: dict[int, list[tuple[int, int, int, int]]]):
    tables = {k: np.array(v, np.int64) for k, v in plan.items()}

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            at = np.flatnonzero(np.diff(length[order], prepend=-1))
            for i, j in zip(at, [*at[1:], len(order)]):
                rows = order[i:j]
                n = int(length[rows[0]])
                runs = tables[n][np.searchsorted(tables[n][:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - runs[:, 0]
                sequence[rows] = runs[:, 1] + nth // runs[:, 2]
                offset[rows] = runs[:, 3] + nth % runs[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [*(c for c, name in zip(batch.columns, batch.schema.names) if name != "rank"), pa.array(sequence), pa.array(offset)],
                [*(x for x in batch.schema.names if x != "rank"), "sequence_id", "offset"])
    return run


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``, from 0 without gaps within each length."""
    # at most sqrt(pieces) pieces a salt, and at most about as many salts
    each = max(LEAST_PER_SALT, isqrt(sum(counts.values())))
    salts = pieces.sparkSession.createDataFrame(  # a row per length, at most ``size``
        [(k, -(-n // each)) for k, n in counts.items()], "length long, salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    lower = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return (salted.withColumn("own", own).join(shift, ["length", "salt"])
            .withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "salt"))


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    ``with_ids`` adds the piece's ids (binary, little-endian unsigned 32-bit),
    from which ``sequences`` builds the packed sequences.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    pieces = stage(texts.mapInArrow(_pieces(tokenizer, end_id, size, with_ids), schema), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    return _placed(ranked(pieces, counts), plan_slots(counts, size), schema)


def _placed(rows: DataFrame, plan, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.select(*names, F.col("rank").cast("long")).mapInArrow(
        _place(plan), schema + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences of ``pack(..., with_ids=True)``; one row each."""
    by_offset = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` pieces
    return packed.groupBy("sequence_id").agg(by_offset.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every piece with its place."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
