"""Typed projection of JSON leaves read as text.

Response leaves are parsed as STRING so one rule decides every cast:
  * integers: whole numbers and whole-valued decimals ("2.0") become bigint,
    a fraction or bad text becomes null;
  * doubles, booleans and timestamps: ``try_cast``, null when it does not parse;
  * JSON text: kept as the text the parser saw (objects and arrays stay JSON).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "json": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "csv": T.StringType(),
}


def to_bigint(c: Column) -> Column:
    """Text to bigint: exact integers, or whole-valued decimals; else null."""
    d = c.try_cast("double")
    return F.coalesce(
        c.try_cast("bigint"),
        F.when(d == F.floor(d), d.try_cast("bigint")),
    )


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def to_timestamp(c: Column) -> Column:
    """API time text such as ``2019-11-15 12:57:46 +00:00``; bad text -> null."""
    return c.try_cast("timestamp")


def join_labels(c: Column) -> Column:
    """A JSON list of labels as one comma string, nulls left out.

    Scalars pass through unchanged; a null stays null.
    """
    arr = F.from_json(c, T.ArrayType(T.StringType()))
    return F.when(F.trim(c).startswith("["), F.array_join(arr, ",")).otherwise(c)


def label_list(c: Column) -> Column:
    """The list whose comma string is that of :func:`join_labels`."""
    arr = F.from_json(c, T.ArrayType(T.StringType()))
    return F.when(F.trim(c).startswith("["), arr).when(c.isNotNull(), F.array(c))


def stringify_json(c: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Lists and objects as JSON text, scalars and null unchanged.

    ``data_type`` is the column's type. A nested column becomes JSON text. A
    leaf read as STRING by ``from_json`` already holds the JSON text of a
    nested value and stays as it is, like any scalar.
    """
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c


def stringify_nested(df):
    """B15 on a frame: every list or object column as JSON text."""
    return df.select(*[stringify_json(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def cast_leaf(c: Column, kind: str) -> Column:
    if kind == "bigint":
        return to_bigint(c)
    if kind == "double":
        return to_double(c)
    if kind == "boolean":
        return to_boolean(c)
    if kind == "timestamp":
        return to_timestamp(c)
    if kind == "csv":
        return join_labels(c)
    return c


def cast_types(df, spec: dict[str, str]):
    """Cast the named text columns to their kinds; others unchanged."""
    return df.withColumns({name: cast_leaf(F.col(name), kind)
                           for name, kind in spec.items() if name in df.columns})
