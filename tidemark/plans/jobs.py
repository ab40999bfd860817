"""Batch jobs: audited incremental loads, SQL jobs, statement lists."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.audit import close_run, open_run, run_log_row, watermark
from tidemark.schemas import USECASE_AUDIT_LOGS
from tidemark.sources.tables import append_rows, read_or_empty, register_table


@dataclass(frozen=True)
class Marks:
    """A batch holds the source rows after ``low`` up to ``high`` (None: there are none)."""

    low: datetime
    high: datetime | None


@dataclass(frozen=True)
class LoadResult:
    marks: Marks
    input_rows: int
    output_rows: int = 0


def run_incremental(
    spark: SparkSession,
    job: str,
    audit_path: str,
    source: DataFrame,
    load: Callable[[DataFrame, Marks], int | None],
    ts: str = "rec_update_timestamp",
    now: Column | datetime | str | None = None,
    reach: Callable[[datetime], Column] | None = None,
) -> LoadResult:
    """Open an audit row, load the rows above the job's watermark, close the row.

    ``load`` gets the batch and the marks that bound it, and returns how many
    rows it wrote, if it knows.  The batch is fixed by
    two literals, the last completed mark and the newest source time, so both
    reach the file scan and a growing source cannot slip rows in between.  A
    load that fails leaves its row open: the mark stays, and the next run
    starts from it again.  ``reach`` gives, for the low mark, a filter that
    leaves out partitions in which nothing newer can lie.
    """

    def audit() -> DataFrame:
        return read_or_empty(spark, audit_path, USECASE_AUDIT_LOGS)

    low = watermark(audit(), job).first()[0]
    newer = source.where(F.col(ts) > F.lit(low))
    if reach is not None:
        newer = newer.where(reach(low))
    high, rows = newer.agg(F.max(ts), F.count(F.lit(1))).first()
    marks = Marks(low, high)
    newest = spark.createDataFrame([(high,)], f"`{ts}` timestamp")
    append_rows(open_run(newest, job, now, ts).coalesce(1), audit_path, USECASE_AUDIT_LOGS)
    written = load(newer.where(F.col(ts) <= F.lit(high)), marks) if high is not None else 0
    append_rows(close_run(audit(), job, now).coalesce(1), audit_path, USECASE_AUDIT_LOGS)
    return LoadResult(marks, rows, written or 0)


def logged_load(
    spark: SparkSession,
    log_path: str,
    job: str,
    source: str,
    sink: tuple[str, str],
    load: Callable[[], LoadResult | None],
    now: datetime | None = None,
) -> LoadResult | None:
    """Run a load and log its input and output counts, or its failure before raising it again.

    A load that had to wait for another job (None) leaves no row.
    """

    def log(rows_in: int, rows_out: int, error: Exception | None = None) -> None:
        row = run_log_row(spark, job, ("TABLE", source), sink, rows_in, rows_out, error, now)
        append_rows(row.coalesce(1), log_path)

    try:
        result = load()
    except Exception as error:
        log(0, 0, error)
        raise
    if result is not None:
        log(result.input_rows, result.output_rows)
    return result


def run_sql_job(
    spark: SparkSession,
    query: str,
    path: str | None = None,
    mode: str | None = "append",
    table: str | None = None,
    args: Mapping[str, object] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Run one query, write its result and register the table; unknown modes append."""
    result = spark.sql(query, args=dict(args or {}))
    mode = mode if mode in ("append", "overwrite") else "append"
    if path:
        result.write.format(fmt).mode(mode).save(path)
        if table:
            register_table(spark, table, path, fmt=fmt)
    return result


@dataclass(frozen=True)
class Step:
    """A named SQL statement; ``:name`` markers take their value from the arguments."""

    name: str
    sql: str


INPUT_COUNT, OUTPUT_COUNT = "input_count", "output_count"


def load_steps(spark: SparkSession, path: str) -> list[Step]:
    """The statements of a use case from a JSON list of {name, sql}."""
    rows = spark.read.schema("name string, sql string").json(path, multiLine=True).collect()
    return [Step(r["name"], r["sql"]) for r in rows]


def run_script(
    spark: SparkSession, steps: Sequence[Step], args: Mapping[str, object] | None = None
) -> dict[str, DataFrame]:
    """Run the statements in order; each result is a view under its step's name.

    The steps named ``input_count`` and ``output_count`` give the counts a run
    log stores (first column of the first row, see ``script_counts``).
    """
    given = dict(args or {})
    results = {}
    for step in steps:
        used = {k: v for k, v in given.items() if f":{k}" in step.sql}
        results[step.name] = spark.sql(step.sql, args=used)
        if results[step.name].columns:
            results[step.name].createOrReplaceTempView(step.name)
    return results


def script_counts(results: Mapping[str, DataFrame]) -> tuple[int, int]:
    return results[INPUT_COUNT].first()[0], results[OUTPUT_COUNT].first()[0]


def run_usecase(
    spark: SparkSession,
    job: str,
    steps: Sequence[Step],
    log_path: str,
    source: str,
    sink: tuple[str, str],
    args: Mapping[str, object] | None = None,
    now: datetime | None = None,
) -> tuple[int, int]:
    """Run a statement list and log its counts, or its failure before raising it again."""
    try:
        rows_in, rows_out = script_counts(run_script(spark, steps, {"job_name": job, **(args or {})}))
    except Exception as error:
        append_rows(run_log_row(spark, job, ("TABLE", source), sink, 0, 0, error, now).coalesce(1), log_path)
        raise
    append_rows(run_log_row(spark, job, ("TABLE", source), sink, rows_in, rows_out, None, now).coalesce(1), log_path)
    return rows_in, rows_out
