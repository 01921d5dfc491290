"""Dense, ordered row numbers without a single-partition window.

``row_number()`` over a global order moves every row into one task. Here
the rows are range-sorted (the one exchange of the data), and each row gets
its place inside its partition from ``monotonically_increasing_id``, which
counts within a partition without a shuffle. One small aggregate counts the
rows per partition; its running sums (one row per partition) are broadcast as
offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.session import cut_lineage

#: monotonically_increasing_id: the partition number stands above these bits.
LOCAL_BITS = 33


def dense_index(df: DataFrame, order: list[Column | str], start: int | Column = 1,
                name: str = "idx") -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (which must be a
    total order for a deterministic result)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = df.sort(*cols).withColumn("_mono", F.monotonically_increasing_id())
    # materialize once (reliable checkpoint in the shared folder) so the count
    # pass and the numbering pass see the same partitions
    tagged = cut_lineage(tagged).withColumn("_pid", F.shiftright("_mono", LOCAL_BITS))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    base = start if isinstance(start, Column) else F.lit(start)
    out = tagged.join(F.broadcast(offs), "_pid").withColumn(
        name, (base + F.col("_off") + F.col("_mono").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))).cast("bigint"))
    return out.drop("_pid", "_mono", "_off")
