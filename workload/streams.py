"""The streaming and batch jobs as queries: each runs its job, then reads what it wrote."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JobConfig
from tidemark.operators import audit
from tidemark.operators.bucketed import BucketedTable
from tidemark.operators.merge import KeyedTable
from tidemark.plans import jobs as batch_jobs
from tidemark.plans import loads
from tidemark.plans.targets import STORE_METRICS, STORE_VISITS
from tidemark.plans.visits import stamped_visits
from tidemark.schemas import AUDIT_LOGS, USECASE_AUDIT_LOGS, load_schema, schema_from_avro
from tidemark.session import work_path
from tidemark.sources import streams, tables
from tidemark.streaming import jobs
from tidemark.streaming.progress import ProgressLog
from workload import queries as q
from workload.inputs import VIEWS, frame, landed_by_order
from workload.queries import ENVELOPE, NOW, query

def config(spark: SparkSession, name: str, **settings) -> JobConfig:
    root = work_path(spark, name)
    defaults = {
        "job_name": name, "output_location": f"{root}/curr", "checkpoint_location": f"{root}/checkpoint",
        "primary_keys": "user_id", "not_null_columns": "props", "load_type": "CDC",
        "trigger_processing_time": "once", "timeout": "-1", "merge_buckets": "8",
    }
    return JobConfig(**{**defaults, **settings})


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/events.parquet"
    table = spark.read.parquet(path)
    files = table.inputFiles()
    reader = spark.readStream.schema(table.schema)
    if len(files) == 1 and files[0].endswith("/events.parquet"):
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = spark.sql(VIEWS["v_cdc"], events=event_stream(spark, sf_dir))
    return q.as_envelopes(log)


@query
def stream_ingest_ct(spark, sf_dir):
    """Framed messages to the change table, user and props masked, read back flat."""
    cfg = config(spark, "ingest", columns_to_be_masked="user_id, props")
    frames = q.as_messages(change_stream(spark, sf_dir))
    jobs.wait(jobs.ingest_stream(spark, cfg, ENVELOPE, frames), cfg)
    landed = tables.read_appended(spark, cfg.output_location)
    return landed.select(
        "data.*",
        F.col("beforeData.props").alias("before_props"),
        F.col("headers.operation").alias("operation"),
        F.col("headers.changeSequence").alias("change_sequence"),
        "ingest_date",
    )


@query
def stream_ct_to_current(spark, sf_dir):
    """Change records to the current table."""
    cfg = config(spark, "current")
    jobs.wait(jobs.current_stream(spark, cfg, change_stream(spark, sf_dir), now=NOW), cfg)
    return spark.read.parquet(cfg.output_location).drop("pk_bucket")


@query
def stream_exceptions(spark, sf_dir):
    """The exception table the same job writes."""
    cfg = config(spark, "exceptions", primary_keys="user_id, event_type")
    jobs.wait(jobs.current_stream(spark, cfg, change_stream(spark, sf_dir), now=NOW), cfg)
    return spark.read.parquet(cfg.exception_location).drop("batch_id")


@query
def stream_append_current(spark, sf_dir):
    """The append load: every change kept, key hash without the operation."""
    cfg = config(spark, "append", load_type="APPEND")
    jobs.wait(jobs.current_stream(spark, cfg, change_stream(spark, sf_dir), now=NOW), cfg)
    return spark.read.parquet(cfg.output_location)


def _copied(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a source stream into files and read them back."""
    root = work_path(spark, name)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


FEED = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": n, "type": t, "nullable": True, "metadata": {}}
            for n, t in (("event_id", "long"), ("amount", "decimal(20,6)"), ("timestamp", "timestamp"), ("flag", "string"))
        ],
    }
)
FEED_CLOCK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _feed(spark, sf_dir) -> DataFrame:
    rows = frame(spark, sf_dir, "v_cdc")
    return rows.select(
        "event_id", "amount", F.col("event_ts").alias("timestamp"), F.substring("operation", 1, 1).alias("flag")
    )


@query
def stream_csv_source(spark, sf_dir):
    folder = work_path(spark, "csv")
    _feed(spark, sf_dir).write.option("timestampFormat", FEED_CLOCK).csv(folder)
    cfg = config(spark, "csv", source_type="FILES_CSV", input_location=folder, input_timestamp_format=FEED_CLOCK)
    return _copied(spark, streams.open_source(spark, cfg, FEED), "csv")


@query
def stream_json_source(spark, sf_dir):
    folder = work_path(spark, "json")
    _feed(spark, sf_dir).write.option("timestampFormat", FEED_CLOCK).json(folder)
    cfg = config(spark, "json", source_type="FILES_JSON", input_location=folder, input_timestamp_format=FEED_CLOCK)
    return _copied(spark, streams.open_source(spark, cfg, FEED), "json")


@query
def stream_table_source(spark, sf_dir):
    folder = work_path(spark, "table")
    q.changes(spark, sf_dir).write.partitionBy("ingest_date").parquet(folder)
    cfg = config(spark, "table", source_type="DELTA_AVRO", input_location=folder)
    copied = _copied(spark, streams.open_source(spark, cfg), "table")
    return copied.select("data.*", F.col("headers.operation").alias("operation"), "ingest_date")


@query
def stream_json_value_source(spark, sf_dir):
    folder = work_path(spark, "json-value")
    rows = q.changes(spark, sf_dir)
    rows.select(
        F.col("data.user_id").cast("string").alias("key"), q.payload_text().alias("value"), "ingest_date"
    ).write.parquet(folder)
    cfg = config(spark, "json-value", source_type="DELTA_JSON", input_location=folder)
    copied = _copied(spark, streams.open_source(spark, cfg, ENVELOPE), "json-value")
    return copied.select("data.*", F.col("headers.operation").alias("operation"), "ingest_date")


@query
def stream_flat_feed_to_current(spark, sf_dir):
    """A flat CSV feed with flags, wrapped into change records and merged."""
    folder = work_path(spark, "flat")
    feed = _feed(spark, sf_dir).join(frame(spark, sf_dir, "v_cdc").select("event_id", "user_id"), "event_id")
    schema = T.StructType([*FEED.fields, T.StructField("user_id", T.LongType())])
    feed.select(*schema.names).write.option("timestampFormat", FEED_CLOCK).csv(folder)
    cfg = config(
        spark, "flat", source_type="FILES_CSV", input_location=folder, input_timestamp_format=FEED_CLOCK,
        translation_type="CSV", not_null_columns=None,
    )
    jobs.wait(jobs.current_stream(spark, cfg, schema=schema, now=NOW), cfg)
    return spark.read.parquet(cfg.output_location).select("user_id", "event_id", "amount", "rec_crud_text", "delete_ind")


@query
def stream_progress_log(spark, sf_dir):
    """Rows read, per query name, out of the logged progress reports."""
    cfg = config(spark, "progress")
    frames = q.as_messages(change_stream(spark, sf_dir))
    with ProgressLog(spark, f"{cfg.output_location}.progress") as log:
        log.wait(jobs.wait(jobs.ingest_stream(spark, cfg, ENVELOPE, frames), cfg))
    return log.read().where(F.col("name") == cfg.job_name).groupBy("name").agg(F.sum("num_input_rows").alias("num_input_rows"))


@query
def stream_rule_counts(spark, sf_dir):
    """Rows per broken null rule, as the merge job's progress reports carry them."""
    cfg = config(spark, "rule_counts", not_null_columns="props, event_type")
    gaps = {"user_id": F.expr("if(user_id % 7 = 0, null, user_id)"), "props": F.expr("if(amount > 50, null, props)")}
    log_of = spark.sql(VIEWS["v_cdc"], events=event_stream(spark, sf_dir)).withColumns(gaps)
    with ProgressLog(spark, f"{cfg.output_location}.progress") as log:
        log.wait(jobs.wait(jobs.current_stream(spark, cfg, q.as_envelopes(log_of), now=NOW), cfg))
    return log.read_rules().where(F.col("name") == cfg.job_name).groupBy("rule_name").agg(F.sum("failures").alias("failures"))


@query
def audit_run_log(spark, sf_dir):
    """The run log of an ingest job, summed over its batches."""
    cfg = config(spark, "logged", kafka_topic="events")
    path = f"{cfg.output_location}.audit"
    frames = q.as_messages(change_stream(spark, sf_dir))
    jobs.wait(jobs.ingest_stream(spark, cfg, ENVELOPE, frames, audit=jobs.Audit(path)), cfg)
    log = tables.read_or_empty(spark, path, AUDIT_LOGS)
    return log.groupBy("job_name", "source_type", "source_name", "sink_type", "rec_create_user_name").agg(
        F.sum("input_row_count").alias("input_row_count"),
        F.sum("output_row_count").alias("output_row_count"),
        F.max("exception_ind").alias("exception_ind"),
    )


@query
def incremental_load(spark, sf_dir):
    """Two audited loads of a growing source; the second picks up where the first stopped."""
    root = work_path(spark, "incremental")
    rows = frame(spark, sf_dir, "v_cdc").select("event_id", "user_id", F.col("event_ts").alias("rec_update_timestamp"))
    grown = (rows.where(F.col("rec_update_timestamp") < q.MID), rows)
    for number, (source, now) in enumerate(zip(grown, ("2024-02-01 00:00:00", "2024-02-02 00:00:00"))):
        batch_jobs.run_incremental(
            spark, "loader", f"{root}/audit", source,
            lambda batch, marks, n=number: tables.append_rows(batch.withColumn("load", F.lit(n)), f"{root}/target"), now=now,
        )
    state = audit.run_state(tables.read_or_empty(spark, f"{root}/audit", USECASE_AUDIT_LOGS))
    counts = (
        spark.read.parquet(f"{root}/target")
        .groupBy("load")
        .agg(F.max("rec_update_timestamp").alias("high"), F.count(F.lit(1)).alias("loaded_rows"))
    )
    return state.join(counts, F.col("src_last_upd_timestamp") == F.col("high")).select(
        "jobname", "src_last_upd_timestamp", "load_status", "rec_create_timestamp", "loaded_rows"
    )


@query
def merge_keyed_table(spark, sf_dir):
    """The same two halves of a month merged into a bucketed table, late half first."""
    early, late = q.states(spark, sf_dir)
    table = KeyedTable(spark, work_path(spark, "keyed"), late.schema, ["user_id"], buckets=8)
    table.merge(late, preserve=["rec_create_timestamp"])
    table.merge(early, preserve=["rec_create_timestamp"])
    return table.read()


@query
def merge_bucketed_table(spark, sf_dir):
    """The two halves of a month merged into a catalog table that keeps its buckets, late half first."""
    early, late = q.states(spark, sf_dir)
    table = BucketedTable(spark, f"merged_{uuid.uuid4().hex}", late.schema, ["user_id"], buckets=8)
    table.merge(late, preserve=["rec_create_timestamp"], batch="late")
    table.merge(early, preserve=["rec_create_timestamp"], batch="early")
    return table.read()


@query
def merge_rebucket(spark, sf_dir):
    """The first half merged into few buckets, then the second into more."""
    early, late = q.states(spark, sf_dir)
    path = work_path(spark, "rebucket")
    table = KeyedTable(spark, path, late.schema, ["user_id"], buckets=3)
    table.merge(early, preserve=["rec_create_timestamp"])
    table.rebucket(8)
    table = KeyedTable(spark, path, late.schema, ["user_id"], buckets=8)
    table.merge(late, preserve=["rec_create_timestamp"])
    return table.read()


@query
def sql_job_append_overwrite(spark, sf_dir):
    """Overwrite, then append in a mode nobody knows: the rows of both runs."""
    path = work_path(spark, "sql-job")
    frame(spark, sf_dir, "events").createOrReplaceTempView("sql_job_events")
    text = "select event_type, count(*) as n, max(value) as top from sql_job_events where user_id >= :low group by event_type"
    batch_jobs.run_sql_job(spark, text, path, "overwrite", args={"low": 0})
    batch_jobs.run_sql_job(spark, text, path, "whatever", args={"low": 10})
    return spark.read.parquet(path)


@query
def sql_script_run(spark, sf_dir):
    """A list of statements with a job-name argument, its two counts beside each result row."""
    frame(spark, sf_dir, "v_traffic").createOrReplaceTempView("script_traffic")
    steps = [
        batch_jobs.Step(
            "script_daily",
            "select store_number, visit_date, cast(sum(entries) as bigint) as entries, :job_name as loaded_by"
            " from script_traffic group by store_number, visit_date",
        ),
        batch_jobs.Step("script_busy", "select * from script_daily where entries > 100"),
        batch_jobs.Step("input_count", "select count(*) as row_count from script_traffic"),
        batch_jobs.Step("output_count", "select count(*) as row_count from script_busy"),
    ]
    results = batch_jobs.run_script(spark, steps, {"job_name": q.JOB})
    rows_in, rows_out = batch_jobs.script_counts(results)
    return results["script_busy"].withColumns({"input_rows": F.lit(rows_in), "output_rows": F.lit(rows_out)})


@query
def load_store_visits(spark, sf_dir):
    """Two audited visit loads; the second recomputes every day with a late reading."""
    root = work_path(spark, "visits")
    traffic, hub = frame(spark, sf_dir, "v_late_traffic"), q.store_hub(spark, sf_dir)
    early = traffic.where(F.col("rec_update_timestamp") < q.LATE)
    loads.load_visits(spark, root, "visits", early, hub.where("store_grpid not like '%5'"), datetime(2024, 1, 16))
    loads.load_visits(spark, root, "visits", traffic, hub, datetime(2024, 2, 1))
    return spark.read.schema(STORE_VISITS.schema).parquet(STORE_VISITS.path(root))


@query
def gold_two_loads(spark, sf_dir):
    """Two loads of online sales, the second with changed and further items, the metrics brought up after each."""
    root = work_path(spark, "gold")
    hub = q.store_hub(spark, sf_dir)
    masters = [frame(spark, sf_dir, n) for n in ("v_mst_store", "v_mst_product", "v_mst_product_line")]
    loads.load_visits(spark, root, "visits", frame(spark, sf_dir, "v_traffic"), hub, datetime(2024, 2, 1))
    landed = landed_by_order(spark, sf_dir)
    first = landed["v_items"].where("id <> 1")
    for day, items in enumerate((first, frame(spark, sf_dir, "v_changed_items", landed)), 1):
        loads.load_ecom_sales(
            spark, root, "ecom", items, landed["v_order_log"], hub,
            q.currency_hub(spark, sf_dir), q.product_hub(spark, sf_dir), datetime(2024, 2, day),
        )
        loads.load_metrics(spark, root, "gold", *masters, now=datetime(2024, 2, day, 12))
    gold = spark.read.schema(STORE_METRICS.schema).parquet(STORE_METRICS.path(root))
    return gold.drop(*[c for c in gold.columns if c.startswith("rec_")], "month_key")


@query
def gold_moved_days(spark, sf_dir):
    """Orders without a day, then a correction that empties the first day of every month."""
    root = work_path(spark, "moved")
    hub = q.store_hub(spark, sf_dir)
    masters = [frame(spark, sf_dir, n) for n in ("v_mst_store", "v_mst_product", "v_mst_product_line")]
    loads.load_visits(spark, root, "visits", frame(spark, sf_dir, "v_traffic"), hub, datetime(2024, 2, 1))
    landed = landed_by_order(spark, sf_dir)
    for day, (items, log) in enumerate((("v_items", "v_undated_log"), ("v_resent_items", "v_moved_log")), 1):
        loads.load_ecom_sales(
            spark, root, "ecom", frame(spark, sf_dir, items, landed), frame(spark, sf_dir, log, landed), hub,
            q.currency_hub(spark, sf_dir), q.product_hub(spark, sf_dir), datetime(2024, 2, day),
        )
        loads.load_metrics(spark, root, "gold", *masters, now=datetime(2024, 2, day, 12))
    gold = spark.read.schema(STORE_METRICS.schema).parquet(STORE_METRICS.path(root))
    return gold.drop(*[c for c in gold.columns if c.startswith("rec_")], "month_key")


@query
def load_run_log(spark, sf_dir):
    """The run log of two visit loads by name; the second has nothing to do."""
    root = work_path(spark, "run-log")
    inputs = {"traffic": frame(spark, sf_dir, "v_traffic"), "store_hub": q.store_hub(spark, sf_dir)}
    for day in (1, 2):
        loads.run_load(spark, "visits", root, "visits", inputs, f"{root}/log", "events", datetime(2024, 2, day))
    log = tables.read_or_empty(spark, f"{root}/log", AUDIT_LOGS)
    return log.select(
        "job_name", "source_type", "source_name", "sink_name", "input_row_count", "output_row_count",
        "exception_ind", "rec_create_timestamp",
    )


def _schema_file(spark: SparkSession, name: str, text: str) -> str:
    folder = work_path(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return folder


@query
def schema_from_json(spark, sf_dir):
    """The feed read by a record type that is stored as Spark's JSON."""
    folder = work_path(spark, "typed")
    _feed(spark, sf_dir).write.option("timestampFormat", FEED_CLOCK).json(folder)
    schema = load_schema(spark, _schema_file(spark, "schema", FEED.json()))
    return spark.read.schema(schema).option("timestampFormat", FEED_CLOCK).json(folder)


@query
def schema_from_avro_document(spark, sf_dir):
    """The feed read by the record type of an Avro schema document."""
    optional = [("event_id", "long"), ("amount", {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 6}),
                ("timestamp", {"type": "long", "logicalType": "timestamp-micros"}), ("flag", "string")]
    document = {"type": "record", "name": "feed", "fields": [{"name": n, "type": ["null", t]} for n, t in optional]}
    folder = work_path(spark, "avro-typed")
    _feed(spark, sf_dir).write.option("timestampFormat", FEED_CLOCK).json(folder)
    return spark.read.schema(schema_from_avro(document)).option("timestampFormat", FEED_CLOCK).json(folder)


@query
def configured_job(spark, sf_dir):
    """The current-table job as a row of a configuration table describes it."""
    folder, root = work_path(spark, "configured"), work_path(spark, "configured-out")
    q.changes(spark, sf_dir).write.partitionBy("ingest_date").parquet(folder)
    row = {
        "JOB_NAME": "configured", "LOAD_TYPE": "CDC", "SOURCE_TYPE": "DELTA_AVRO", "INPUT_LOCATION": folder,
        "OUTPUT_LOCATION": f"{root}/curr/events", "CHECKPOINT_LOCATION": f"{root}/checkpoint", "TIMEOUT": "-1",
        "PRIMARY_KEYS": "user_id", "NOT_NULL_COLUMNS": "props", "TRIGGER_PROCESSING_TIME": "once", "MERGE_BUCKETS": "8",
    }
    table = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} string" for n in row))
    cfg = JobConfig.from_table(table, "configured")
    jobs.wait(jobs.current_stream(spark, cfg, now=NOW), cfg)
    return spark.read.parquet(cfg.output_location).drop("pk_bucket")


@query
def staged_overwrite(spark, sf_dir):
    """A staging table overwritten by a second, smaller content."""
    path = work_path(spark, "stage")
    rows = frame(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    tables.overwrite_stage(rows, path)
    return tables.overwrite_stage(rows.where("event_type <> 'view'"), path)


@query
def create_table_as_select(spark, sf_dir):
    """``CREATE TABLE IF NOT EXISTS … AS``: the second statement finds the table and leaves it."""
    path = work_path(spark, "ctas")
    name = f"ctas_{path.rsplit('-', 1)[1]}"
    daily = frame(spark, sf_dir, "v_traffic").groupBy("visit_date_key").agg(F.sum("entries").alias("entries"))
    tables.create_table_as(daily, name, path)
    tables.create_table_as(daily.where("false"), name, path)
    return spark.table(name)


@query
def typed_target_table(spark, sf_dir):
    """A target created and registered by its declared types, filled by name, read by its name."""
    path = work_path(spark, "target")
    name = f"target_{path.rsplit('-', 1)[1]}"
    tables.create_table(
        spark, path, STORE_VISITS.schema, STORE_VISITS.partition_by, name, properties={"layer": STORE_VISITS.layer}
    )
    daily = stamped_visits(q.store_visits_daily(spark, sf_dir), q.JOB, NOW)
    tables.append_rows(daily, path, STORE_VISITS.schema, STORE_VISITS.partition_by)
    spark.catalog.refreshTable(name)
    return spark.table(name).select("visit_date_key", "store_rhid", "visit_date", "entry_count", "exit_count", "rec_create_user_name")


def ingest_in_parts(spark: SparkSession, sf_dir: str, cfg: JobConfig, parts: tuple[str, ...]):
    """Land the messages in runs of one job, one for each condition and each one batch; the last run and its messages."""
    folder = work_path(spark, f"{cfg.job_name}-in")
    messages = q.as_messages(q.changes(spark, sf_dir))
    for number, condition in enumerate(parts):
        landed = f"{folder}/{number}"
        messages.where(condition).write.parquet(landed)
        source = spark.readStream.schema(messages.schema).parquet(f"{folder}/*")  # all files that are new
        query = jobs.wait(jobs.ingest_stream(spark, cfg, ENVELOPE, source), cfg)
    part = spark.read.schema(messages.schema).parquet(landed)  # as they were sent, not made anew
    return query, part


@query
def stream_restart(spark, sf_dir):
    """An ingest job stopped, started again when more messages are there, and its last batch replayed."""
    cfg = config(spark, "restart", max_files_per_trigger="1")
    query, part = ingest_in_parts(spark, sf_dir, cfg, ("timestamp < '2024-01-16'", "timestamp >= '2024-01-16'"))
    last = max(p.batchId for p in query.recentProgress if p.numInputRows)
    jobs.ingest_batch(part, last, cfg, ENVELOPE, "json", jobs.Audit())
    landed = tables.read_appended(spark, cfg.output_location)
    return landed.select("data.*", F.col("headers.operation").alias("operation"), "ingest_date")


@query
def compact_day(spark, sf_dir):
    """A change table landed in two batches that share their days; the batches of its first day made one."""
    cfg = config(spark, "compact", max_files_per_trigger="1")
    ingest_in_parts(spark, sf_dir, cfg, ("hour(timestamp) < 12", "hour(timestamp) >= 12"))
    first = tables.read_appended(spark, cfg.output_location).agg(F.min("ingest_date")).first()[0]
    tables.compact_partition(spark, cfg.output_location, "ingest_date", str(first))
    landed = spark.read.option("mergeSchema", "true").parquet(cfg.output_location)
    compacted = F.col("batch_id") == tables.COMPACTED
    return landed.select("data.*", F.col("headers.operation").alias("operation"), "ingest_date", compacted.alias("compacted"))


@query
def gold_end_to_end(spark, sf_dir):
    """Online sales and visits loaded into silver tables, then the gold table from those."""
    root = work_path(spark, "lake")
    now = datetime(2024, 2, 1, 10, 11, 12)
    hub = q.store_hub(spark, sf_dir)
    landed = landed_by_order(spark, sf_dir)
    loads.load_ecom_sales(
        spark, root, "ecom", landed["v_items"], landed["v_order_log"], hub,
        q.currency_hub(spark, sf_dir), q.product_hub(spark, sf_dir), now,
    )
    loads.load_visits(spark, root, "visits", frame(spark, sf_dir, "v_traffic"), hub, now)
    masters = [frame(spark, sf_dir, n) for n in ("v_mst_store", "v_mst_product", "v_mst_product_line")]
    loads.load_metrics(
        spark, root, "gold", *masters, upstream=["ecom", "visits"], since=now, now=now, visits_grain="store"
    )
    gold = spark.read.schema(STORE_METRICS.schema).parquet(STORE_METRICS.path(root))
    return gold.drop(*[c for c in gold.columns if c.startswith("rec_")], "month_key")
