"""Where the items and days of the sales fact lie: an index that spares a gold load the rest of the fact.

The fact lies by load date, its metrics by order day, and a changed order item
is a further row somewhere else. Two narrow tables lead from one to the other:

* ``items``: per online line its item, day, load date and time stamp, below
  the block of its order ids. Order numbers rise with time, so the items of a
  load, and those of a day, lie in few blocks.
* ``days``: per day the load dates that hold lines of it, and the blocks of
  their orders. It has a few rows per day, whatever the number of lines.

The load that reads the index extends it, from the index's own mark up to the
mark of the load, before it reads: fact and index cannot part, and a table
without an index gets one for all its rows. A piece of it is named by where it
starts, so repeating a torn one replaces it.

Only the load dates and blocks of touched days come to the driver, never rows
of the fact. A null day, order or load date is a value like any other. Lines
without a time stamp are in no load, and not in the index.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.targets import RETAIL_SALES
from tidemark.sources.tables import append_batch, read_or_empty

#: What an online order item is known by in the sales fact.
ITEM = ["order_id", "order_item_id"]
ONLINE = "order_channel_code = 'ECOM'"
DAY, FOLDER, STAMP, BLOCK = "order_date_key", "rec_create_date_key", "rec_update_timestamp", "order_block"
#: Order ids in a block.
ORDERS = 1_000_000

_fact = {f.name: f.dataType for f in RETAIL_SALES.schema.fields}
_block = T.StructField(BLOCK, T.LongType())
ITEMS_SCHEMA = T.StructType([*[T.StructField(c, _fact[c]) for c in (*ITEM, DAY, FOLDER, STAMP)], _block])
DAYS_SCHEMA = T.StructType([*[T.StructField(c, _fact[c]) for c in (DAY, FOLDER)], _block])
MARK_SCHEMA = "covered timestamp"


def among(column: str, values: Iterable) -> Column:
    """Whether the column has one of the values; null counts as a value."""
    values = set(values)
    found = F.col(column).isin(sorted(values - {None}))
    return found | F.col(column).isNull() if None in values else found


def newest_lines(lines: DataFrame, stamps: DataFrame, block: Column) -> DataFrame:
    """The ``lines`` of the fact without those that a later load replaced.

    A changed order item is a further row of the fact; only the rows of its
    newest load count. ``stamps`` holds the time stamps of online items, in any
    number of rows, with their block, which is ``block`` in the lines. Register
    lines have no line key and all count.

    What has the newest stamp of its block stands without a look at its item;
    the other lines alone meet the stamps that can be newer.
    """
    ends = stamps.groupBy(F.col(BLOCK).alias("_of")).agg(F.min(STAMP).alias("_least"), F.max(STAMP).alias("_most"))
    ends = F.broadcast(ends)  # a row per block
    bare = F.col(STAMP).isNull()
    placed = lines.withColumn("_block", block).join(ends, F.col("_block") == F.col("_of"), "left")
    doubtful = F.expr(ONLINE) & F.col("_most").isNotNull() & (bare | (F.col(STAMP) < F.col("_most")))
    doubtful = F.coalesce(doubtful, F.lit(False))
    newer = stamps
    if lines.where(F.expr(ONLINE) & bare).isEmpty():  # a line without a stamp is older than any
        newer = stamps.join(ends, F.col(BLOCK) == F.col("_of")).where(F.col(STAMP) > F.col("_least"))
    newest = newer.groupBy(*[F.col(c).alias(f"_{c}") for c in ITEM]).agg(F.max(STAMP).alias("_newest"))
    same = reduce(and_, [F.col(c) == F.col(f"_{c}") for c in ITEM], bare | (F.col(STAMP) < F.col("_newest")))
    kept = placed.where(doubtful).join(newest, same, "left_anti")
    return placed.where(~doubtful).select(*lines.columns).unionByName(kept.select(*lines.columns))


class Places:
    """The index of the sales ``fact``, kept at ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, fact: DataFrame, orders: int = ORDERS):
        self.spark, self.path, self.fact, self.orders = spark, path.rstrip("/"), fact, orders

    def _block(self) -> Column:
        return F.when(F.expr(ONLINE), F.floor(F.col("order_id") / F.lit(self.orders))).cast("bigint").alias(BLOCK)

    def items(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/items", ITEMS_SCHEMA)

    def days(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/days", DAYS_SCHEMA)

    def covered(self) -> datetime | None:
        """The time stamp up to which the fact is in the index."""
        return read_or_empty(self.spark, f"{self.path}/marks", T.StructType([T.StructField("covered", T.TimestampType())])).agg(F.max("covered")).first()[0]

    def since(self, low: datetime | None) -> Column:
        """A filter of load dates that can hold rows stamped after ``low``; a day is allowed for time zones."""
        day = F.date_sub(F.lit(low).cast("date"), 1)
        key = F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
        return F.lit(True) if low is None else (F.col(FOLDER) >= key) | F.col(FOLDER).isNull()

    def extend(self, high: datetime) -> None:
        """Bring the index up to the rows stamped ``high``."""
        low = self.covered()
        if low is not None and low >= high:
            return
        new = self.fact.where(F.col(STAMP) <= F.lit(high))
        if low is not None:
            new = new.where(self.since(low) & (F.col(STAMP) > F.lit(low)))
        name = "all" if low is None else f"{low:%Y%m%dT%H%M%S%f}"
        lines = new.select(*ITEM, DAY, FOLDER, STAMP, self._block(), F.expr(ONLINE).alias("_online"))
        items = lines.where("_online").drop("_online")
        append_batch(items, f"{self.path}/items", [BLOCK], name, balance=True)
        append_batch(lines.select(DAY, FOLDER, BLOCK).distinct(), f"{self.path}/days", [], name)
        mark = self.spark.range(1).select(F.lit(high).cast("timestamp").alias("covered"))
        append_batch(mark.coalesce(1), f"{self.path}/marks", [], name)

    def days_of_items(self, batch: DataFrame, low: datetime | None = None) -> DataFrame:
        """The days on which the online items of the batch stand or stood, in any load.

        With ``low``, the mark that the batch follows, the days of the batch's own lines are left out.
        """
        online = batch.where(ONLINE)
        blocks = [r[0] for r in online.select(self._block()).distinct().collect()]
        known = self.items().where(among(BLOCK, blocks))
        if low is not None:
            known = known.where((F.col(STAMP) <= F.lit(low)) | ~self.since(low))
            if known.isEmpty():
                return known.select(DAY)
        return known.join(online.select(*ITEM).distinct(), ITEM, "left_semi").select(DAY)

    def standing_lines(self, days: DataFrame) -> DataFrame:
        """All lines of the ``days`` (``_day``) that no later load replaced, from the load dates that hold some."""
        same_day = F.col(DAY).eqNullSafe(F.col("_day"))
        found = self.days().join(days, same_day, "left_semi").select(FOLDER, BLOCK).distinct().collect()
        lines = self.fact.where(among(FOLDER, {r[FOLDER] for r in found})).join(days, same_day, "left_semi")
        stamps = self.items().where(among(BLOCK, {r[BLOCK] for r in found})).select(*ITEM, STAMP, BLOCK)
        return newest_lines(lines, stamps, self._block())
