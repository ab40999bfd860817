"""Audited loads of the silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.conform import as_table
from tidemark.operators.audit import all_ready
from tidemark.operators.merge import KeyedTable
from tidemark.plans.jobs import LoadResult, Marks, logged_load, run_incremental
from tidemark.plans.metrics import GRAIN, metrics_table, store_metrics
from tidemark.plans.places import DAY, Places
from tidemark.plans.sales_ecom import ecom_sales
from tidemark.plans.sales_retail import retail_sales
from tidemark.plans.targets import MONTH, RETAIL_SALES, STORE_METRICS, STORE_VISITS, USECASE_AUDIT
from tidemark.plans.visits import KEYS, stamped_visits, store_visits
from tidemark.schemas import USECASE_AUDIT_LOGS
from tidemark.session import setting
from tidemark.sources.tables import append_batch, overwrite_stage, read_or_empty


def _batch_name(job: str, low: datetime) -> str:
    """A load is named by where it starts: repeating a failed one replaces what it left."""
    return f"{''.join(c if c.isalnum() else '-' for c in job)}-{low:%Y%m%dT%H%M%S%f}"


def _append(rows: DataFrame, path: str, partition_by: Iterable[str], batch: str) -> int:
    """Append the batch and count it on its way."""
    seen = Observation()
    append_batch(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by, batch)
    return seen.get.get("rows") or 0


def load_ecom_sales(
    spark: SparkSession, root: str, job: str, items: DataFrame, order_log: DataFrame, store_hub: DataFrame,
    currency_hub: DataFrame, product_hub: DataFrame, now: datetime | None = None,
) -> LoadResult:
    """Append the fact rows of the order items changed since the job's last load.

    ``items`` and ``order_log`` are tables: they are read more than once. If both
    are bucketed by ``order_id``, into as many buckets as there are shuffle
    partitions, the lines are written where they lie.
    """

    def load(batch: DataFrame, marks: Marks) -> int:
        with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            rows = ecom_sales(batch, order_log, store_hub, currency_hub, product_hub, job, now, lying=True)
            return _append(rows, RETAIL_SALES.path(root), RETAIL_SALES.partition_by, _batch_name(job, marks.low))

    return run_incremental(spark, job, USECASE_AUDIT.path(root), items, load, now=now)


def load_retail_sales(
    spark: SparkSession, root: str, job: str, sales: DataFrame, upcref: DataFrame, store_hub: DataFrame,
    product_hub: DataFrame, now: datetime | None = None, system: str | None = None, assembly: str = "line",
) -> LoadResult:
    """Append the fact rows of the register lines changed since the job's last load."""

    def load(batch: DataFrame, marks: Marks) -> int:
        rows = retail_sales(batch, upcref, store_hub, product_hub, job, now, system, assembly)
        return _append(rows, RETAIL_SALES.path(root), RETAIL_SALES.partition_by, _batch_name(job, marks.low))

    return run_incremental(spark, job, USECASE_AUDIT.path(root), sales, load, now=now)


def load_visits(
    spark: SparkSession, root: str, job: str, traffic: DataFrame, store_hub: DataFrame, now: datetime | None = None
) -> LoadResult:
    """Recompute the days with changed readings and replace them, day partition by day partition."""
    table = KeyedTable(spark, STORE_VISITS.path(root), STORE_VISITS.schema, KEYS, partition_by="visit_date_key")

    def load(batch: DataFrame, marks: Marks) -> int:
        stamp = F.col("rec_update_timestamp")
        changed = (stamp > F.lit(marks.low)) & (stamp <= F.lit(marks.high))
        # Two literals bound the touched days, so the scan of old readings is pruned.
        date = F.col("visit_date")
        first, last, undated = batch.agg(F.min(date), F.max(date), F.max(date.isNull())).first()
        span = date.between(F.lit(first), F.lit(last))
        days = traffic.where(span | date.isNull() if undated else span)
        rows = stamped_visits(store_visits(days, store_hub, changed), job, now)
        # Readings without a date are a day of their own, and a day that lost all its readings goes.
        touched = batch.select("visit_date", "visit_date_key")
        return table.merge(as_table(rows, STORE_VISITS.schema), seq=None, null_keys="match", whole="visit_date", retract=touched)

    return run_incremental(spark, job, USECASE_AUDIT.path(root), traffic, load, now=now)


def touched_days(batch: DataFrame, places: Places, visits: DataFrame, low: datetime) -> DataFrame:
    """The days whose metrics the batch changes: its own, those its items stood on before, those of newer visits."""
    seen = visits.where(F.col("rec_update_timestamp") > F.lit(low)).select("visit_date_key")
    return batch.select(DAY).union(places.days_of_items(batch, low)).union(seen).toDF("_day").distinct()


def load_metrics(
    spark: SparkSession, root: str, job: str, store: DataFrame, product: DataFrame, product_line: DataFrame,
    upstream: Iterable[str] = (), since: datetime | None = None, now: datetime | None = None,
    visits_grain: str = "day", mode: str = "merge",
) -> LoadResult | None:
    """Bring the metrics up to the sales loaded since the last run, once the upstream jobs are done.

    ``mode``:

    * ``merge``: every touched day is recomputed from all its sales and
      replaced, so a store-day has one row however many loads fed it. An
      index of items and days (``Places``) names the load dates to read.
    * ``insert``: the metrics of the new sales alone are appended; a store-day
      fed by two loads has two rows.

    The modes lay the table out differently: keep to one.  Returns None, and
    does nothing, while an upstream job has not completed since ``since``.
    """
    if mode not in ("merge", "insert"):
        raise ValueError(f"mode must be 'merge' or 'insert', not {mode!r}")
    upstream = list(upstream)
    audit = read_or_empty(spark, USECASE_AUDIT.path(root), USECASE_AUDIT_LOGS)
    if upstream and not all_ready(audit, upstream, since or datetime(1900, 1, 1)):
        return None
    sales = spark.read.schema(RETAIL_SALES.schema).parquet(RETAIL_SALES.path(root))
    visits = spark.read.schema(STORE_VISITS.schema).parquet(STORE_VISITS.path(root))
    places = Places(spark, f"{STORE_METRICS.path(root)}.places", sales)

    def measured(lines: DataFrame) -> DataFrame:
        return metrics_table(store_metrics(lines, store, visits, product, product_line, visits_grain), job, now)

    def insert(batch: DataFrame, marks: Marks) -> int:
        return _append(measured(batch), STORE_METRICS.path(root), ("rec_create_date_key",), _batch_name(job, marks.low))

    def merge(batch: DataFrame, marks: Marks) -> int:
        places.extend(marks.high)
        days = overwrite_stage(touched_days(batch, places, visits, marks.low), f"{places.path}.touched")
        month = F.expr("date_key div 100").cast("int")
        rows = measured(places.standing_lines(days)).withColumn(MONTH.name, month)
        table = KeyedTable(spark, STORE_METRICS.path(root), rows.schema, GRAIN, partition_by=MONTH.name)
        # Sales without an order day are a day of their own; a day whose sales all moved has no row here, and goes.
        touched = days.select(F.col("_day").alias("date_key")).withColumn(MONTH.name, month)
        return table.merge(rows, seq=None, null_keys="match", whole="date_key", retract=touched)

    load = merge if mode == "merge" else insert
    return run_incremental(spark, job, USECASE_AUDIT.path(root), sales, load, now=now, reach=places.since)


#: The loads by name, with the tables each one reads.
LOADS = {
    "ecom": (load_ecom_sales, ("items", "order_log", "store_hub", "currency_hub", "product_hub"), RETAIL_SALES),
    "retail": (load_retail_sales, ("sales", "upcref", "store_hub", "product_hub"), RETAIL_SALES),
    "visits": (load_visits, ("traffic", "store_hub"), STORE_VISITS),
    "metrics": (load_metrics, ("store", "product", "product_line"), STORE_METRICS),
}


def run_load(
    spark: SparkSession, name: str, root: str, job: str, inputs: Mapping[str, DataFrame], log_path: str,
    source: str = "", now: datetime | None = None, **options,
) -> LoadResult | None:
    """Run one of the loads by name, with a row in the run log; ``inputs`` are named as its arguments."""
    load, wanted, target = LOADS[name]
    missing = [n for n in wanted if n not in inputs]
    if missing:
        raise ValueError(f"load {name!r} needs the inputs {', '.join(missing)}")
    tables = {n: inputs[n] for n in wanted}
    return logged_load(
        spark, log_path, job, source or wanted[0], ("TABLE", target.table),
        lambda: load(spark, root, job, **tables, now=now, **options), now,
    )
