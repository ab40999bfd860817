"""Streaming sources: Kafka frames, CSV and JSON folders, landed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JobConfig
from tidemark.operators.envelope import json_value, strip_wire_header
from tidemark.schemas import load_schema

Source = Callable[[SparkSession, JobConfig, T.StructType | None], DataFrame]


def kafka_stream(
    spark: SparkSession,
    cfg: JobConfig,
    user: str | None = None,
    password: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One topic from its earliest offset as (value, timestamp); needs Spark's Kafka module.

    Credentials switch on SASL over TLS.  ``max_offsets_per_trigger`` of the job
    bounds a batch; without it the first one holds the whole topic.  ``options``
    go to the source as they are.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", cfg.kafka_server)
        .option("subscribe", cfg.kafka_topic)
        .option("startingOffsets", "earliest")
    )
    if user is not None:
        module = "org.apache.kafka.common.security.plain.PlainLoginModule"
        reader = reader.options(
            **{
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.ssl.endpoint.identification.algorithm": "https",
                "kafka.sasl.jaas.config": f'{module} required username="{user}" password="{password}";',
            }
        )
    if cfg.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(cfg.max_offsets_per_trigger))
    return reader.options(**(options or {})).load().select("value", "timestamp")


def framed_payloads(messages: DataFrame) -> DataFrame:
    """(value, timestamp) messages as schema id, bare payload and arrival date."""
    dated = messages.withColumn("ingest_date", F.to_date(F.col("timestamp").cast("timestamp")))
    return strip_wire_header(dated).select("schema_id", "payload", "ingest_date")


def _folder_reader(spark: SparkSession, cfg: JobConfig):
    reader = spark.readStream
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(cfg.max_files_per_trigger))
    if cfg.input_timestamp_format:
        reader = reader.option("timestampFormat", cfg.input_timestamp_format)
    return reader


def _declared(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None) -> T.StructType:
    return schema if schema is not None else load_schema(spark, cfg.input_schema)


def csv_stream(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None = None) -> DataFrame:
    """A folder of headerless CSV files."""
    return _folder_reader(spark, cfg).schema(_declared(spark, cfg, schema)).csv(cfg.input_location, header=False)


def json_stream(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None = None) -> DataFrame:
    """A folder of JSON-lines files."""
    return _folder_reader(spark, cfg).schema(_declared(spark, cfg, schema)).json(cfg.input_location)


def table_stream(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None = None) -> DataFrame:
    """A landed change table: Delta when configured so, else a Parquet folder."""
    if cfg.table_format == "delta":
        return _folder_reader(spark, cfg).format("delta").load(cfg.input_location)
    if schema is None:
        schema = spark.read.parquet(cfg.input_location).schema
    return _folder_reader(spark, cfg).schema(schema).parquet(cfg.input_location)


def json_value_stream(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None = None) -> DataFrame:
    """A landed table whose ``value`` column is the change record as JSON text."""
    return json_value(table_stream(spark, cfg), _declared(spark, cfg, schema))


# The configured source types.
SOURCES: dict[str, Source] = {
    "FILES_CSV": csv_stream,
    "FILES_JSON": json_stream,
    "DELTA_JSON": json_value_stream,
    "DELTA_AVRO": table_stream,
}


def open_source(spark: SparkSession, cfg: JobConfig, schema: T.StructType | None = None) -> DataFrame:
    """The stream of the configured source type."""
    kind = (cfg.source_type or "").strip().upper()
    if kind not in SOURCES:
        raise ValueError(f"unknown source type {kind!r}, expected one of {sorted(SOURCES)}")
    return SOURCES[kind](spark, cfg, schema)
