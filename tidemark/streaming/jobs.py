"""The two streaming jobs: messages to the change table, changes to the current table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import JobConfig
from tidemark.functions.hashing import digest, mask_pii
from tidemark.functions.times import epoch_to_timestamp
from tidemark.operators import quality
from tidemark.operators.audit import run_log_row
from tidemark.operators.cdc import (
    DEFAULT_USER,
    TRAILING,
    change_columns,
    flat_to_envelope,
    history_sql,
    history_view,
    with_meta,
)
from tidemark.operators.envelope import decode_envelope
from tidemark.operators.merge import KeyedTable, delta_merge
from tidemark.schemas import META_FIELDS, current_schema
from tidemark.session import configure
from tidemark.sources.streams import framed_payloads, kafka_stream, open_source
from tidemark.sources.tables import append_batch, append_rows, create_table, create_view, register_table
from tidemark.streaming.progress import RULES

# Fixed value: the translation type whose records already are change envelopes.
NATIVE_TRANSLATION = "ATTUNITY"

META_NAMES = {f.name for f in META_FIELDS}


#: A record type, a schema document, or a function that returns the newest one.
Envelope = T.StructType | str | Callable[[], T.StructType | str]


@dataclass
class Audit:
    """Where a stream job records its batches; no path, no record."""

    path: str | None = None
    user: str = DEFAULT_USER

    def record(self, spark, cfg: JobConfig, source: tuple, rows_in: int, rows_out: int, error=None) -> None:
        if self.path:
            sink = ("TABLE", cfg.output_location)
            row = run_log_row(spark, cfg.job_name, source, sink, rows_in, rows_out, error, user=self.user)
            append_rows(row.coalesce(1), self.path)


def wait(query: StreamingQuery, cfg: JobConfig) -> StreamingQuery:
    """Wait the configured seconds, or until the query ends."""
    seconds = cfg.timeout_seconds
    query.awaitTermination(seconds) if seconds else query.awaitTermination()
    return query


def _counting(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while they pass: no extra scan for the audit."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def query_id(spark: SparkSession, cfg: JobConfig) -> str:
    """The id Spark keeps in the checkpoint: the same after a restart, another for a fresh checkpoint."""
    return spark.read.schema("id string").json(f"{cfg.checkpoint_location}/metadata").first()[0]


def batch_tag(spark: SparkSession, cfg: JobConfig, batch_id: int) -> str:
    """A name for the batch that a replay shares and no other batch has."""
    return f"{query_id(spark, cfg)}-{batch_id}"


def ingest_batch(
    batch: DataFrame, batch_id: int, cfg: JobConfig, envelope: T.StructType | str, fmt: str, audit: Audit
) -> None:
    """Decode, mask and append one batch of framed messages to the change table."""
    spark = configure(batch.sparkSession)
    source = ("KAFKA" if cfg.kafka_topic else "FILE", cfg.kafka_topic)
    try:
        changes = decode_envelope(framed_payloads(batch), envelope, fmt=fmt)
        if cfg.masked:
            changes = mask_pii(changes, cfg.masked)
        counted, seen = _counting(changes, f"ingest-{cfg.job_name}-{batch_id}")
        if cfg.table_format == "delta":
            writer = counted.write.format("delta").mode("append").option("mergeSchema", "true")
            writer = writer.option("txnAppId", query_id(spark, cfg)).option("txnVersion", batch_id)
            writer.partitionBy("ingest_date").save(cfg.output_location)
        else:
            append_batch(counted, cfg.output_location, ["ingest_date"], batch_tag(spark, cfg, batch_id), fixed=True)
        rows = seen.get["rows"]
    except Exception as error:
        audit.record(spark, cfg, source, 0, 0, error)
        raise
    audit.record(spark, cfg, source, rows, rows)


def ingest_stream(
    spark: SparkSession,
    cfg: JobConfig,
    envelope: Envelope,
    source: DataFrame | None = None,
    fmt: str = "json",
    audit: Audit | None = None,
    publish: bool = False,
) -> StreamingQuery:
    """Start the job that lands framed messages as change records by arrival date.

    ``source`` is any stream of (value, timestamp); the configured topic when
    not given.  ``envelope`` is the record's StructType, or for ``avro`` the
    schema document, or a function that returns it, which every batch calls
    anew.  ``publish`` puts the history view in place with the first batch, and
    again whenever the schema has changed.
    """
    messages = source if source is not None else kafka_stream(spark, cfg)
    audit = audit or Audit()
    published = []

    def land(batch: DataFrame, batch_id: int) -> None:
        known = envelope() if callable(envelope) else envelope
        ingest_batch(batch, batch_id, cfg, known, fmt, audit)
        if publish and known not in published:
            publish_history(batch.sparkSession, cfg, audit.user)
            published[:] = [known]

    return _start(messages, cfg, land)


def publish_history(spark: SparkSession, cfg: JobConfig, user: str = DEFAULT_USER) -> str:
    """(Re)create the flat history view over the change table; returns its name.

    With a target table name the change table is registered and the view lasts
    in the catalog; without one it is a view of this session.
    """
    if cfg.trgt_table_name:
        register_table(spark, cfg.trgt_table_name, cfg.output_location, fmt=cfg.table_format)
        spark.sql(f"CREATE OR REPLACE VIEW {cfg.history_view} AS {history_sql(cfg.trgt_table_name, user)}")
        return cfg.history_view
    name = "".join(c if c.isalnum() else "_" for c in f"{cfg.job_name}_hist")
    reader = spark.read.option("mergeSchema", "true").format(cfg.table_format)
    create_view(history_view(reader.load(cfg.output_location), user), name)
    return name


def change_rows(source: DataFrame, cfg: JobConfig) -> DataFrame:
    """Flat change rows: business columns, operation, header timestamp and sequence.

    A translation type other than the native one marks a flat feed with
    ``flag`` and ``timestamp`` columns, which is wrapped into envelopes first.
    """
    if (cfg.translation_type or NATIVE_TRANSLATION).strip().upper() != NATIVE_TRANSLATION:
        source = flat_to_envelope(source)
    rows = change_columns(source)
    return epoch_to_timestamp(rows, cfg.epochs) if cfg.epochs else rows


def business_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in META_NAMES and c not in TRAILING]


def current_rows(rows: DataFrame, cfg: JobConfig, user: str = DEFAULT_USER, now=None) -> DataFrame:
    """The rows a batch contributes to the current table, one per key."""
    newest = quality.valid_rows(rows, cfg.keys, cfg.not_null, business_columns(rows))
    named = newest.withColumnRenamed("changeSequence", "change_sequence").drop("hdr_timestamp")
    return with_meta(named, user, now, flagged=True)


def exception_rows(rows: DataFrame, cfg: JobConfig, user: str = DEFAULT_USER, now=None) -> DataFrame:
    """The rows a batch contributes to the exception table."""
    bad = quality.exceptions(rows, cfg.keys, cfg.not_null, business_columns(rows))
    return with_meta(bad, user, now, flagged=True)


def current_table_schema(rows: DataFrame) -> T.StructType:
    data = T.StructType([rows.schema[c] for c in business_columns(rows)])
    return current_schema(data)


def publish_current(spark: SparkSession, cfg: JobConfig, rows: DataFrame) -> None:
    """Register the current and the exception table of a job under their configured names."""
    append = (cfg.load_type or "").strip().upper() == "APPEND"
    if cfg.table_format != "parquet":
        register_table(spark, cfg.trgt_table_name, cfg.output_location, fmt=cfg.table_format)
        return
    if append:
        schema, parts = append_hashes(with_meta(rows), cfg.keys).schema, ["rec_create_date_key"]
        create_table(spark, cfg.output_location, schema, parts)
    else:
        table = KeyedTable(spark, cfg.output_location, current_table_schema(rows), cfg.keys, cfg.buckets)
        table.create()
        schema, parts = table.stored, [table.part]
        bad = T.StructType(
            [T.StructField("rule_name", T.StringType()), *current_table_schema(rows).fields[:-1],
             T.StructField("batch_id", T.StringType())]
        )
        create_table(
            spark, cfg.exception_location, bad, ["batch_id", "rec_create_date_key"], cfg.exception_table
        )
    register_table(spark, cfg.trgt_table_name, cfg.output_location, schema, parts)


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    cfg: JobConfig,
    audit: Audit,
    guarded: bool = True,
    null_keys: str = "quarantine",
    now: Column | datetime | str | None = None,
    reload: bool = False,
) -> None:
    """Validate one batch of change rows, store its exceptions and merge its newest rows.

    ``guarded`` ignores changes older than the stored row; without it the last
    batch wins, whatever its sequence.  With ``reload`` initial-load rows
    replace what is stored.  The run log's output count has the rows that took
    effect.
    """
    spark = configure(batch.sparkSession)
    source = ("KAFKA" if cfg.kafka_topic else "TABLE", cfg.input_location)
    rows_in = 0
    rows = batch.persist()
    try:
        # Filling the cache is the count; everything below reads the cache.
        rows_in = rows.count()
        tag = batch_tag(spark, cfg, batch_id)
        bad = exception_rows(rows, cfg, audit.user, now)
        if cfg.table_format == "delta":
            writer = bad.write.format("delta").mode("append").option("mergeSchema", "true")
            writer = writer.option("txnAppId", query_id(spark, cfg)).option("txnVersion", batch_id)
            writer.partitionBy("rec_create_date_key").save(cfg.exception_location)
        else:
            append_batch(bad, cfg.exception_location, ["rec_create_date_key"], tag, balance=True)
        newest = current_rows(rows, cfg, audit.user, now)
        seq = "change_sequence" if guarded else None
        if cfg.table_format == "delta":
            rows_out = newest.count()
            delta_merge(spark, cfg.output_location, newest, cfg.keys, seq=seq, null_keys=null_keys, reload=reload)
        else:
            schema = current_table_schema(rows)
            table = KeyedTable(spark, cfg.output_location, schema, cfg.keys, cfg.buckets)
            rows_out = table.merge(newest, seq=seq, null_keys=null_keys, batch=tag, reload=reload)
    except Exception as error:
        audit.record(spark, cfg, source, rows_in, 0, error)
        raise
    finally:
        rows.unpersist()
    audit.record(spark, cfg, source, rows_in, rows_out)


def append_hashes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the append load: hashes without the operation in the key hash."""
    data = rows.drop(*TRAILING)
    return data.withColumns({"rec_row_hash": digest(business_columns(rows)), "rec_pk_hash": digest(keys)})


def current_stream(
    spark: SparkSession,
    cfg: JobConfig,
    source: DataFrame | None = None,
    schema: T.StructType | None = None,
    audit: Audit | None = None,
    guarded: bool = True,
    null_keys: str = "quarantine",
    user: str = DEFAULT_USER,
    now: Column | datetime | str | None = None,
    reload: bool = False,
) -> StreamingQuery:
    """Start the job that turns change records into the current table.

    Load type CDC merges by key, APPEND writes every row.  ``source`` is any
    stream of change envelopes; the configured source when not given.  The CDC
    load reports its rows per broken null rule with its progress.
    """
    audit = audit or Audit(user=user)
    changes = source if source is not None else open_source(spark, cfg, schema)
    rows = change_rows(changes, cfg)
    if cfg.trgt_table_name:
        publish_current(spark, cfg, rows)
    load = (cfg.load_type or "").strip().upper()
    if load == "CDC":

        def merge(batch: DataFrame, batch_id: int) -> None:
            merge_batch(batch, batch_id, cfg, audit, guarded, null_keys, now, reload)

        # The batch is computed once, into the cache of ``merge_batch``, and its failures are counted on the way.
        try:
            observed = rows.observe(RULES, *quality.rule_counts([*cfg.keys, quality.CRUD], cfg.not_null))
        except Exception as error:  # a configured column that the rows lack: no batch would be there to log it
            audit.record(spark, cfg, ("KAFKA" if cfg.kafka_topic else "TABLE", cfg.input_location), 0, 0, error)
            raise
        return _start(observed, cfg, merge, mode="update")
    if load == "APPEND":
        hashed = append_hashes(with_meta(rows, user, now), cfg.keys)
        create_table(spark, cfg.output_location, hashed.schema, ["rec_create_date_key"], fmt=cfg.table_format)
        writer = hashed.writeStream.format(cfg.table_format).outputMode("append")
        if cfg.table_format == "delta":
            writer = writer.option("mergeSchema", "true")
        writer = writer.partitionBy("rec_create_date_key").trigger(**cfg.trigger)
        return writer.option("checkpointLocation", cfg.checkpoint_location).start(cfg.output_location)
    raise ValueError(f"load type {load!r} is not implemented")


def _start(
    stream: DataFrame, cfg: JobConfig, each: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    writer = stream.writeStream.queryName(cfg.job_name).outputMode(mode).trigger(**cfg.trigger)
    return writer.option("checkpointLocation", cfg.checkpoint_location).foreachBatch(each).start()
