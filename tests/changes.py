"""Literal change envelopes for the tests."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import HEADERS, envelope

ROW = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
ENVELOPE = T.StructType([*envelope(ROW).fields, T.StructField("ingest_date", T.DateType())])


def seq(n: int) -> str:
    return f"2024010100{n:026d}"


def change(operation, n, key, name, before=None, day="2024-01-05"):
    headers = {"operation": operation, "changeSequence": seq(n), "timestamp": f"2024-01-01T00:{n // 60:02d}:{n % 60:02d}.123456"}
    return (
        (key, name),
        before,
        tuple(headers.get(f.name) for f in HEADERS.fields),
        datetime.strptime(day, "%Y-%m-%d").date(),
    )


def envelopes(spark, changes):
    return spark.createDataFrame([change(*c) if not isinstance(c[0], tuple) else c for c in changes], ENVELOPE)


def flat(spark, changes):
    """(id, name, operation, sequence number) rows in the flat change form."""
    from tidemark.operators.cdc import change_columns

    return change_columns(envelopes(spark, [(op, n, key, name) for key, name, op, n in changes]))


def keyed(spark, data, schema):
    return spark.createDataFrame(data, schema).withColumn("_", F.lit(0)).drop("_")
