"""Spark helpers shared by the training-data operators.

Intermediate tables are written to the folder named by ``spark.checkpoint.dir``
(shared by all executors), so a lost executor costs a task, not a job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.session import scratch_path, ship_package

#: Keys holding more than 1/HOT_KEYS of the rows number fewer than HOT_KEYS.
HOT_KEYS = 1000


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of staged tables that no later step reads."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).first()[0]


def parts_for(total: int, per_part: int) -> int:
    return max(1, math.ceil(total / per_part))


def skew_join(left: DataFrame, groups: DataFrame, keys: list[str], n_rows: int,
              size: str, how: str = "inner") -> DataFrame:
    """Join rows with a table that has one row per key and the key's row count.

    ``groups[size]`` is the number of ``left`` rows of the key. Keys with more
    than ``n_rows / HOT_KEYS`` rows are fewer than ``HOT_KEYS``, so these few
    group rows are broadcast and their rows stay where they are; the other
    keys take a shuffled join in which no key is hot.
    """
    cut = max(1, n_rows // HOT_KEYS)
    hot = groups.filter(F.col(size) > cut)
    rest = groups.filter(F.col(size) <= cut)
    cold_rows = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return (left.join(F.broadcast(hot), keys)
            .unionByName(cold_rows.join(rest, keys, how)))


def wrap(docs: DataFrame, **columns: str) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, beside working copies.

    ``wrap(docs, id="doc_id", text="text")`` has the columns ``row, id, text``,
    so an operator's own column names never clash with those of its input.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[F.col(f"`{c}`").alias(k) for k, c in columns.items()])


def unwrap(df: DataFrame, columns: list[str], **new: object) -> DataFrame:
    """The input's columns again; ``new`` replaces or adds columns."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns if c not in new],
                     *[v.alias(k) for k, v in new.items()])
