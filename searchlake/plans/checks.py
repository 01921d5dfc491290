"""Output conventions shared by checked queries.

Checked outputs hold scalars only: timestamps are made zone-less (the given
tables are), doubles are rounded, nested values are projected away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scalar_output(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name.lower()))
    return df.select(*cols)
