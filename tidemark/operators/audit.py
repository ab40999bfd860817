"""Load audit: open and close runs, watermarks, run logs, readiness, counts.

The usecase audit is a list of events.  A load appends an open row (status
null) and later a COMPLETED row for the same run; the state of a run is its
newest row.  No row is ever updated in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.conform import as_table
from tidemark.functions.times import clock

COMPLETED = "COMPLETED"
EPOCH = "1900-01-01 00:00:00"  # fixed value: the mark of a job that never completed
RUN_KEY = ("jobname", "rec_create_timestamp")


def watermark(audit: DataFrame, job: str) -> DataFrame:
    """One row: the newest source timestamp among the job's completed loads."""
    done = audit.where((F.col("jobname") == job) & (F.col("load_status") == COMPLETED))
    newest = F.max("src_last_upd_timestamp").cast("timestamp")
    return done.agg(F.coalesce(newest, F.lit(EPOCH).cast("timestamp")).alias("watermark"))


def watermarks(audit: DataFrame) -> DataFrame:
    """The same for every job in the audit table."""
    done = F.when(F.col("load_status") == COMPLETED, F.col("src_last_upd_timestamp")).cast("timestamp")
    return audit.groupBy("jobname").agg(
        F.coalesce(F.max(done), F.lit(EPOCH).cast("timestamp")).alias("watermark")
    )


def open_run(
    batch: DataFrame, job: str, now: Column | datetime | str | None = None, ts: str = "rec_update_timestamp"
) -> DataFrame:
    """The open audit row of a load: the newest source timestamp in the batch, status null."""
    row = batch.agg(F.max(ts).alias("src_last_upd_timestamp")).withColumns(
        {
            "jobname": F.lit(job),
            "rec_create_timestamp": clock(now),
            "rec_create_user_name": F.lit(job),
        }
    )
    return as_table(row, schemas.USECASE_AUDIT_LOGS)


def run_state(audit: DataFrame) -> DataFrame:
    """One row per run: closed when any of its rows is, else the open row."""
    rest = [c for c in audit.columns if c not in RUN_KEY]
    closed_first = F.struct(
        F.col("load_status").isNotNull().alias("_closed"), F.col("rec_update_timestamp").alias("_at")
    )
    state = audit.groupBy(*RUN_KEY).agg(F.max_by(F.struct(*rest), closed_first).alias("_s"))
    return state.select(*[F.col(c) if c in RUN_KEY else F.col(f"_s.{c}").alias(c) for c in audit.columns])


def _closing(state: DataFrame) -> DataFrame:
    """The run states with ``_closing`` true on each job's newest open run."""
    still_open = state.where(F.col("load_status").isNull())
    newest = still_open.groupBy(F.col("jobname").alias("_job")).agg(
        F.max("rec_create_timestamp").alias("_since")
    )
    same = (F.col("jobname") == F.col("_job")) & (F.col("rec_create_timestamp") == F.col("_since"))
    closing = F.col("_since").isNotNull() & F.col("load_status").isNull()
    return state.join(newest, same, "left").withColumn("_closing", closing).drop("_job", "_since")


def close_run(audit: DataFrame, job: str, now: Column | datetime | str | None = None) -> DataFrame:
    """The COMPLETED row to append for the job's newest open run; empty when none is open."""
    return complete_newest(audit.where(F.col("jobname") == job), now, only_closed=True)


def complete_newest(
    audit: DataFrame, now: Column | datetime | str | None = None, only_closed: bool = False
) -> DataFrame:
    """The audit state after every job closes its newest open run.

    Equal to updating those rows in place, without touching the stored ones.
    ``only_closed`` gives just the rows this changes.
    """
    marked = _closing(run_state(audit))
    if only_closed:
        marked = marked.where("_closing")
    closed = {
        "load_status": F.lit(COMPLETED),
        "rec_update_timestamp": clock(now),
        "rec_update_user_name": F.col("jobname"),
    }
    changes = {c: F.when(F.col("_closing"), v).otherwise(F.col(c)) for c, v in closed.items()}
    return marked.withColumns(changes).drop("_closing")


def run_log_row(
    spark: SparkSession,
    job_name: str,
    source: tuple[str | None, str | None],
    sink: tuple[str | None, str | None],
    input_rows: int,
    output_rows: int,
    error: BaseException | str | None = None,
    now: datetime | None = None,
    user: str = "DL User",
) -> DataFrame:
    """One run-audit row; an error sets the flag, the message and zero output rows."""
    failed = error is not None
    values = (
        job_name, *source, *sink, input_rows, 0 if failed else output_rows,
        int(failed), str(error).replace("'", "") if failed else "", None, user,
    )
    row = spark.createDataFrame([values], schemas.AUDIT_LOGS)
    return row.withColumn("rec_create_timestamp", F.date_trunc("second", clock(now)))


def job_run_row(
    spark: SparkSession,
    run_type: str,
    job_name: str,
    job_id: int,
    job_type: str,
    job_method: str,
    response: str,
    now: datetime | None = None,
) -> DataFrame:
    """One row of the job run log."""
    values = (run_type, job_name, job_id, job_type, job_method, None, response)
    row = spark.createDataFrame([values], schemas.JOB_RUN_LOGS)
    return row.withColumn("log_timestamp", F.date_trunc("second", clock(now)))


def upstream_ready(audit: DataFrame, since: Column | datetime | str) -> DataFrame:
    """Per job whether its newest run since the given time has completed."""
    recent = run_state(audit.where(F.col("rec_create_timestamp") >= clock(since)))
    newest = recent.groupBy("jobname").agg(F.max_by("load_status", "rec_create_timestamp").alias("_status"))
    return newest.select("jobname", F.coalesce(F.col("_status") == COMPLETED, F.lit(False)).alias("ready"))


def all_ready(audit: DataFrame, jobs: Iterable[str], since: Column | datetime | str) -> bool:
    """True when every named job has completed since the given time."""
    jobs = list(jobs)
    ready = upstream_ready(audit.where(F.col("jobname").isin(jobs)), since).where("ready")
    return ready.count() == len(set(jobs))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    source_groups: Sequence[str] = (),
    target_where: Column | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row with the input row (or group) count and the output row count.

    ``measures`` adds further aggregates over the target rows.
    """
    counted = source.select(*source_groups).distinct() if source_groups else source
    kept = target if target_where is None else target.where(target_where)
    extra = [c.alias(n) for n, c in (measures or {}).items()]
    inputs = counted.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = kept.agg(F.count(F.lit(1)).alias("output_row_count"), *extra)
    return counts.select(inputs.alias("input_row_count"), *counts.columns)
