"""Readers for the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def parts_for(table: DataFrame, size: int) -> int:
    """Partitions for work that follows ``table``: one for each ``size`` bytes of it, at least one a core."""
    held = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-held // size))


#: Bytes of the given lines that one task makes into responses and reads back: some 90 MB of JSON.
RESPONSE_BYTES = 2 << 20


def response_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for responses of lines. The lines shuffled are small and the JSON made of
    them is large: by the bytes shuffled, a few tasks would do all the parsing."""
    return parts_for(read_table(spark, sf_dir, "lineitem"), RESPONSE_BYTES)
