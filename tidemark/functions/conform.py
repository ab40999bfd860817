"""Casting landed columns to declared types."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import MONEY

# Whole words of a declaration; the first known one counts.
_TYPE_WORDS = {
    "int": T.IntegerType(), "integer": T.IntegerType(), "smallint": T.IntegerType(), "tinyint": T.IntegerType(),
    "bigint": T.LongType(), "long": T.LongType(), "decimal": MONEY, "numeric": MONEY,
    "string": T.StringType(), "varchar": T.StringType(), "char": T.StringType(), "text": T.StringType(),
    "timestamp": T.TimestampType(), "datetime": T.TimestampType(), "date": T.DateType(),
}


def declared_type(text: str) -> T.DataType:
    for word in re.findall(r"[a-z]+", text.lower()):
        if word in _TYPE_WORDS:
            return _TYPE_WORDS[word]
    raise ValueError(f"unknown declared type {text!r}")


def declared_types(metadata: DataFrame, table: str) -> dict[str, str]:
    """Column declarations of one table out of a (classname, columnname, columndatatype) frame."""
    rows = metadata.where(F.col("classname") == table).select("columnname", "columndatatype").collect()
    return {r[0]: r[1] for r in rows}


def conform_types(df: DataFrame, types: Mapping[str, str], failures: str | None = None) -> DataFrame:
    """Cast the named columns to their declared types; a bad value becomes null.

    ``failures`` adds a column listing, comma separated, the columns of the row
    whose value did not survive the cast.
    """
    casts = {c: F.col(c).try_cast(declared_type(t)) for c, t in types.items()}
    output = [casts[c].alias(c) if c in casts else F.col(c) for c in df.columns]
    if failures:
        lost = [F.when(F.col(c).isNotNull() & cast.isNull(), F.lit(c)) for c, cast in casts.items()]
        output.append(F.concat_ws(",", *lost).alias(failures))
    return df.select(*output)


def widen_decimals(df: DataFrame) -> DataFrame:
    """Every decimal column, nested ones included, as decimal(20,6)."""

    def wide(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.DecimalType):
            return MONEY
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, wide(f.dataType), f.nullable) for f in kind.fields])
        return kind

    def cast(field: T.StructField) -> Column:
        column, target = F.col(f"`{field.name}`"), wide(field.dataType)
        return column.cast(target).alias(field.name) if target != field.dataType else column

    return df.select(*[cast(f) for f in df.schema.fields])


def as_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in the table's order, each cast to its type; absent ones are null."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
