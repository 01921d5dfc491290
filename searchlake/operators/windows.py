"""Skew-safe running sums.

A window ``partitionBy(key).orderBy(pos)`` sorts a whole key group in one
task. For a key that may hold a large share of all rows, the running sum is
split in two levels instead:

  1. rows are cut into blocks of ``block`` consecutive positions; one grouped
     aggregate gives the sum of each (key, block) -- a partial aggregate;
  2. a window over the block table (``rows / block`` times smaller) turns the
     block sums into offsets;
  3. a window over (key, block) -- bounded groups -- adds the running sum
     inside the block to the offset of its block.

The result equals the plain window for integer positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, key: list[str], pos: str, cols: dict[str, str],
                 block: int = 4096) -> DataFrame:
    """Add running sums ``{out_name: source_col}`` per ``key`` ordered by ``pos``
    (unbounded preceding .. current row, ties broken by nothing else: ``pos``
    must be unique within a key). Count a column of ones for a running count."""
    b = F.floor(F.col(pos) / F.lit(block)).cast("bigint")
    blocked = df.withColumn("_blk", b)
    sums = blocked.groupBy(*key, "_blk").agg(
        *[F.sum(src).alias(f"_bs_{out}") for out, src in cols.items()])
    wb = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*key, "_blk", *[
        F.coalesce(F.sum(f"_bs_{out}").over(wb), F.lit(0)).alias(f"_off_{out}")
        for out in cols])
    wi = Window.partitionBy(*key, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    inner = blocked.select("*", *[F.sum(src).over(wi).alias(f"_in_{out}")
                                  for out, src in cols.items()])
    joined = inner.join(offsets, [*key, "_blk"])
    out = joined.select(*df.columns, *[
        (F.col(f"_off_{o}") + F.col(f"_in_{o}")).alias(o) for o in cols])
    return out
