"""Command line: ``spark-submit … -m tidemark <job> --job-name NAME --config TABLE``.

Jobs: ``ingest`` (topic to change table), ``current`` (change table to current
table), ``load`` (one of the built loads: ecom, retail, visits, metrics),
``usecase`` (a statement list), ``sql`` (one query) and ``compact`` (closed
partitions of an appended table).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import JobConfig, split_list
from tidemark.plans.jobs import load_steps, run_sql_job, run_usecase
from tidemark.plans.loads import LOADS, run_load
from tidemark.schemas import load_schema, schema_from_avro
from tidemark.session import get_session
from tidemark.sources.streams import kafka_stream
from tidemark.sources.tables import compact_partition
from tidemark.streaming.jobs import Audit, current_stream, ingest_stream, wait
from tidemark.streaming.progress import ProgressLog


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("ingest", "current", "usecase"):
        job = jobs.add_parser(name)
        job.add_argument("--job-name", required=True)
        job.add_argument("--config", required=True, help="configuration table, or a CSV file with a header row")
        job.add_argument("--audit", help="folder of the run log")
    ingest = jobs.choices["ingest"]
    ingest.add_argument("--envelope", required=True, help="record schema: an Avro schema document or Spark JSON")
    ingest.add_argument("--format", choices=("json", "avro"), default="avro")
    ingest.add_argument("--source-folder", help="read (value, timestamp) Parquet files instead of the topic")
    for name in ("ingest", "current"):
        jobs.choices[name].add_argument("--progress", help="folder of the progress log")
    jobs.choices["current"].add_argument("--reload", action="store_true", help="initial-load rows replace stored ones")
    jobs.choices["current"].add_argument("--compatible", action="store_true", help="last batch wins, whatever its sequence")
    load = jobs.add_parser("load")
    load.add_argument("name", choices=tuple(LOADS))
    load.add_argument("--job-name", required=True)
    load.add_argument("--root", required=True, help="folder of the target tables")
    load.add_argument("--input", action="append", default=[], metavar="NAME=TABLE", help="a table, or a Parquet folder")
    load.add_argument("--upstream", help="jobs that metrics wait for, comma-separated")
    load.add_argument("--audit", help="folder of the run log")
    compact = jobs.add_parser("compact")
    compact.add_argument("--job-name")
    compact.add_argument("--path", required=True, help="folder of the change table")
    compact.add_argument("--column", default="ingest_date")
    compact.add_argument("--value", action="append", required=True, help="a closed partition; may be repeated")
    sql = jobs.add_parser("sql")
    sql.add_argument("--job-name")
    sql.add_argument("--sql-query", required=True)
    sql.add_argument("--output-location")
    sql.add_argument("--trgt-table-name")
    sql.add_argument("--write-mode")
    return top


def load_config(spark: SparkSession, source: str, job_name: str) -> JobConfig:
    table = spark.read.csv(source, header=True) if source.endswith(".csv") else spark.table(source)
    return JobConfig.from_table(table, job_name)


def read_input(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    named = dict(pair.split("=", 1) for pair in args.input)
    inputs = {name: read_input(spark, table) for name, table in named.items()}
    options = {"upstream": split_list(args.upstream)} if args.upstream else {}
    run_load(spark, args.name, args.root, args.job_name, inputs, args.audit or f"{args.root}/run_log", **options)


def logging_progress(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig, start) -> None:
    """Run a stream to its end, its progress reports going to the log where one is named."""
    if not args.progress:
        wait(start(), cfg)
        return
    with ProgressLog(spark, args.progress) as log:
        query = wait(start(), cfg)
        if not query.isActive:
            log.wait(query)


def ingest(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    document = spark.read.text(args.envelope, wholetext=True).first()[0]
    if args.envelope.endswith(".avsc"):
        envelope = document if args.format == "avro" else schema_from_avro(document)
    else:
        envelope = load_schema(spark, args.envelope)
    if args.source_folder:
        schema = spark.read.parquet(args.source_folder).schema
        messages = spark.readStream.schema(schema).parquet(args.source_folder)
    else:
        user = spark.conf.get("tidemark.kafka.user", None)
        messages = kafka_stream(spark, cfg, user, spark.conf.get("tidemark.kafka.password", None))
    logging_progress(
        spark, args, cfg, lambda: ingest_stream(spark, cfg, envelope, messages, args.format, Audit(args.audit), publish=True)
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(args.job_name or "tidemark-sql")
    if args.job == "sql":
        run_sql_job(spark, args.sql_query, args.output_location, args.write_mode, args.trgt_table_name)
        return
    if args.job == "load":
        load(spark, args)
        return
    if args.job == "compact":
        for value in args.value:
            compact_partition(spark, args.path, args.column, value)
        return
    cfg = load_config(spark, args.config, args.job_name)
    if args.job == "ingest":
        ingest(spark, args, cfg)
    elif args.job == "current":
        how = {"audit": Audit(args.audit), "guarded": not args.compatible, "reload": args.reload}
        logging_progress(spark, args, cfg, lambda: current_stream(spark, cfg, **how))
    else:
        steps = load_steps(spark, cfg.input_sql_stmt)
        sink = (cfg.dataset_name or "", cfg.trgt_table_name or "")
        run_usecase(spark, cfg.job_name, steps, args.audit or f"{cfg.output_location}.audit", cfg.source_type or "", sink)


if __name__ == "__main__":
    main()
