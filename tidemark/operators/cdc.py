"""Change records to current rows: enrichment, history, latest state."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.conform import sql_text
from tidemark.functions.times import clock, date_key, time_key_minutes, time_key_seconds
from tidemark.schemas import HEADERS

# An initial-load row is dated so early that any later change beats it.
REFRESH_TIMESTAMP = "1970-01-01 00:00:00"
REFRESH_SEQUENCE = "1970010100000000"
# Fixed value: the time key of an initial-load row in the history view.
REFRESH_TIME_KEY = 120000
DEFAULT_USER = "DL User"

HEADER_COLUMNS = {"timestamp": "hdr_timestamp", "changeSequence": "changeSequence"}
ORDERING = ("changeSequence", "hdr_timestamp")
# Columns that stay behind the metadata columns of a flat row.
TRAILING = ("hdr_timestamp", "changeSequence", "change_sequence", "rec_row_hash", "rec_pk_hash")


def header_timestamp(operation: Column, timestamp: Column) -> Column:
    """The header's timestamp; initial-load rows get the floor date."""
    return F.when(operation == "REFRESH", F.lit(REFRESH_TIMESTAMP).cast("timestamp")).otherwise(
        timestamp.cast("timestamp")
    )


def header_sequence(operation: Column, sequence: Column) -> Column:
    return F.when(operation == "REFRESH", F.lit(REFRESH_SEQUENCE)).otherwise(sequence.cast("string"))


def meta_columns(operation: Column, now: Column, user: str) -> dict[str, Column]:
    """The ten metadata columns of a current-state row."""
    second = F.date_trunc("second", now)
    return {
        "rec_create_timestamp": second,
        "rec_create_user_name": F.lit(user),
        "rec_update_timestamp": second,
        "rec_update_user_name": F.when(operation == "UPDATE", F.lit(user)).otherwise(F.lit("")),
        "rec_create_date_key": date_key(now),
        "rec_create_time_key": time_key_seconds(now),
        "rec_crud_text": operation,
        "delete_ind": F.when(operation == "DELETE", 1).otherwise(0),
        "exception_ind": F.lit(0),
        "resolved_ind": F.lit(0),
    }


def enrich_cdc(df: DataFrame, user: str = DEFAULT_USER, now: Column | datetime | str | None = None) -> DataFrame:
    """Envelopes with the metadata columns inside ``data`` and normalised headers.

    The structs are rebuilt field by field, so timestamps keep their microseconds.
    """
    operation = F.col("headers.operation")
    data = [F.col(f"data.`{n}`").alias(n) for n in df.schema["data"].dataType.names]
    meta = [c.alias(n) for n, c in meta_columns(operation, clock(now), user).items()]
    replaced = {
        "timestamp": header_timestamp(operation, F.col("headers.timestamp")),
        "changeSequence": header_sequence(operation, F.col("headers.changeSequence")),
    }
    headers = [
        replaced.get(n, F.col(f"headers.`{n}`")).alias(n) for n in df.schema["headers"].dataType.names
    ]
    return df.select(F.struct(*headers).alias("headers"), F.struct(*data, *meta).alias("data"))


def history_sql(table: str, user: str = DEFAULT_USER) -> str:
    """``history_view`` as a query over a registered change table, for a lasting view."""
    meta = {
        "rec_create_timestamp": "stamp",
        "rec_create_user_name": sql_text(user),
        "rec_update_timestamp": "stamp",
        "rec_update_user_name": sql_text(user),
        "rec_create_date_key": "year(stamp) * 10000 + month(stamp) * 100 + day(stamp)",
        "rec_create_time_key": f"if(initial, {REFRESH_TIME_KEY}, hour(stamp) * 100 + minute(stamp))",
        "rec_crud_text": "operation",
        "delete_ind": "int(coalesce(operation = 'DELETE', false))",
        "exception_ind": "int(null)",
        "resolved_ind": "int(null)",
    }
    dated = f"""select data, headers.operation, headers.operation = 'REFRESH' as initial,
        if(headers.operation = 'REFRESH', timestamp(ingest_date), timestamp(headers.timestamp)) as stamp
        from {table}"""
    return f"select data.*, {', '.join(f'{v} as {n}' for n, v in meta.items())} from ({dated})"


def change_columns(df: DataFrame) -> DataFrame:
    """Flat change rows of envelopes: business columns, operation, normalised header order.

    The narrow form the ranking and the duplicate check work on; ``with_meta``
    adds the other metadata columns to the rows that remain.
    """
    operation = F.col("headers.operation")
    return df.select(
        "data.*",
        operation.alias("rec_crud_text"),
        header_timestamp(operation, F.col("headers.timestamp")).alias("hdr_timestamp"),
        header_sequence(operation, F.col("headers.changeSequence")).alias("changeSequence"),
    )


def with_meta(
    df: DataFrame, user: str = DEFAULT_USER, now: Column | datetime | str | None = None, flagged: bool = False
) -> DataFrame:
    """Flat change rows with all ten metadata columns in their place after the business columns.

    ``flagged`` keeps an ``exception_ind`` the rows already carry.
    """
    meta = meta_columns(F.col("rec_crud_text"), clock(now), user)
    if flagged:
        meta["exception_ind"] = F.col("exception_ind")
    trailing = [c for c in df.columns if c in TRAILING]
    business = [c for c in df.columns if c not in meta and c not in TRAILING]
    return df.select(*business, *[v.alias(n) for n, v in meta.items()], *trailing)


def history_view(ct: DataFrame, user: str = DEFAULT_USER) -> DataFrame:
    """One flat row per change, dated by its header or, for initial loads, by arrival.

    Time keys are minutes (HHmm) here and seconds (HHmmss) in the current table.
    """
    operation = F.col("headers.operation")
    initial = operation == "REFRESH"
    arrived = F.col("ingest_date").cast("timestamp")
    stamp = F.when(initial, arrived).otherwise(F.col("headers.timestamp").cast("timestamp"))
    return ct.select(
        "data.*",
        stamp.alias("rec_create_timestamp"),
        F.lit(user).alias("rec_create_user_name"),
        stamp.alias("rec_update_timestamp"),
        F.lit(user).alias("rec_update_user_name"),
        date_key(stamp).alias("rec_create_date_key"),
        F.when(initial, REFRESH_TIME_KEY).otherwise(time_key_minutes(stamp)).alias("rec_create_time_key"),
        operation.alias("rec_crud_text"),
        F.when(operation == "DELETE", 1).otherwise(0).alias("delete_ind"),
        F.lit(None).cast("int").alias("exception_ind"),
        F.lit(None).cast("int").alias("resolved_ind"),
    )


def tie_break(df: DataFrame) -> Column:
    """A hash of the row's content: a rerun task breaks ties as the lost one did."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def ordering(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Newest first, ties broken by content."""
    return [*[F.desc(c) for c in order], tie_break(df).desc()]


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDERING, name: str = "_rank") -> DataFrame:
    """1 for the newest row of each key, 2 for the next, and so on."""
    window = Window.partitionBy(*keys).orderBy(*ordering(df, order))
    return df.withColumn(name, F.row_number().over(window))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDERING) -> DataFrame:
    """The newest row of each key.

    Filtering the rank to 1 lets Spark keep one row per key in every map task
    before the exchange (WindowGroupLimit), so a hot key ships one row per task.
    """
    return ranked(df, keys, order).where("_rank = 1").drop("_rank")


def csv_to_cdc(df: DataFrame, flag: str = "flag", deleted: Iterable[str] = ("D",)) -> DataFrame:
    """A flat feed with a flag column as change rows: raw timestamp kept, deletes marked."""
    return df.withColumnRenamed("timestamp", "cdc_timestamp_raw").withColumn(
        "cdc_deleted", F.col(flag).isin(*deleted)
    )


def flat_to_envelope(df: DataFrame, flag: str = "flag") -> DataFrame:
    """A flat feed as change envelopes: the flag gives the operation, its timestamp the sequence."""
    marked = csv_to_cdc(df, flag)
    first = F.upper(F.substring(F.col(flag), 1, 1))
    operation = (
        F.when(F.col("cdc_deleted"), "DELETE").when(first == "I", "INSERT").when(first == "R", "REFRESH")
    ).otherwise("UPDATE")
    at = F.col("cdc_timestamp_raw").cast("timestamp")
    known = {
        "operation": operation,
        "changeSequence": F.date_format(at, "yyyyMMddHHmmssSSSSSS"),
        "timestamp": F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    }
    headers = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in HEADERS.fields]
    data = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in (flag, "timestamp")])
    return marked.select(
        data.alias("data"), F.lit(None).cast(marked.select(data.alias("d")).schema["d"].dataType).alias("beforeData"),
        F.struct(*headers).alias("headers"),
    )
