"""Daily store visits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import clock, load_stamp
from tidemark.operators.lookup import effective_join
from tidemark.operators.merge import merge_upsert
from tidemark.schemas import CREATE_COLUMNS

UNKNOWN_STORE = -1  # fixed value
KEYS = ("store_rhid", "visit_date")


def store_visits(
    traffic: DataFrame, store_hub: DataFrame, changed: Column | None = None, closed: str = "both"
) -> DataFrame:
    """Entries and exits per store version and day; unmapped stores share one row per day.

    Readings are first summed per store number and day, map-side, and only
    those sums are looked up.  With ``changed`` only days holding a changed
    reading are kept, each recomputed whole: several store numbers may share a
    row, and a number may have moved to another one since.
    """
    if changed is not None:
        days = traffic.where(changed).select(F.col("visit_date").alias("_day")).distinct()
        traffic = traffic.join(days, F.col("visit_date").eqNullSafe(F.col("_day")), "left_semi")
    daily = traffic.groupBy("store_number", "visit_date", "visit_date_key").agg(
        F.sum("entries").alias("entries"),
        F.sum("exits").alias("exits"),
    )
    found = effective_join(daily, store_hub, "store_number", "visit_date", ["store_rhid", "store_grpid"], closed)
    return found.groupBy(
        "visit_date_key",
        F.coalesce("store_rhid", F.lit(UNKNOWN_STORE)).alias("store_rhid"),
        "store_grpid",
        "visit_date",
    ).agg(F.sum("entries").alias("entry_count"), F.sum("exits").alias("exit_count"))


def stamped_visits(visits: DataFrame, job: str, now: Column | datetime | str | None = None) -> DataFrame:
    return visits.withColumns(load_stamp(clock(now), job))


def merge_visits(target: DataFrame, visits: DataFrame) -> DataFrame:
    """Replace the days of ``visits`` by (store, day); the create columns of known rows stay.

    A row of such a day whose store is no longer there goes: its readings belong
    to another store now.
    """
    days = visits.select(F.col("visit_date").alias("_day")).distinct()
    keys = visits.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    others = target.join(days, F.col("visit_date") == F.col("_day"), "left_anti")
    known = target.join(keys, [F.col(k) == F.col(f"_{k}") for k in KEYS], "left_semi")
    return merge_upsert(others.unionByName(known), visits, KEYS, preserve=CREATE_COLUMNS)
