"""Writing and registering tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.contents import ContentMismatch, digest_of, same_digest, watched
from tidemark.functions.conform import as_table, sql_text
from tidemark.session import setting

COMPACTED = "compacted"  #: the batch id of a compacted partition


def create_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    fmt: str = "parquet",
    properties: Mapping[str, str] | None = None,
) -> None:
    """An empty partitioned table at ``path`` unless data is there, registered as ``name``."""
    empty = spark.createDataFrame([], schema)
    empty.write.format(fmt).mode("ignore").partitionBy(*partition_by).save(path)
    if name:
        register_table(spark, name, path, schema, partition_by, fmt, properties)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    properties: Mapping[str, str] | None = None,
    track_partitions: bool = False,
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over the files at ``path``.

    Partitions are found in the files, so what a job writes is there at once.
    ``track_partitions`` keeps them in the catalog instead, which prunes without
    listing files but needs ``MSCK REPAIR TABLE`` after a load.
    """
    columns = ""
    if schema is not None:
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if schema is not None and partition_by else ""
    props = ""
    if properties:
        pairs = (f"{sql_text(k)}={sql_text(v)}" for k, v in properties.items())
        props = f" TBLPROPERTIES ({', '.join(pairs)})"
    with setting(spark, "spark.sql.hive.manageFilesourcePartitions", str(track_partitions).lower()):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING {fmt}{parts} LOCATION {sql_text(path)}{props}")


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table_as(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS … AS SELECT``."""
    writer = df.write.format("parquet").mode("ignore").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_view(df: DataFrame, name: str) -> None:
    """Create or replace a session view of a lazily evaluated frame."""
    df.createOrReplaceTempView(name)


def append_batch(
    df: DataFrame, path: str, partition_by: Sequence[str], batch_id: int | str, balance: bool = False,
    fixed: bool = False,
) -> None:
    """Append one batch so that repeating it leaves the same table.

    Files land in ``batch_id=<id>/<partition>`` and a repeat replaces that
    folder.  New columns simply appear in later files.  ``balance`` first evens
    out the file sizes, splitting large partitions.

    ``fixed`` says that the rows alone, and no clock, decide their partition.
    The folders are then ``<partition>/batch_id=<id>``: a filter on the
    partition lists its own folders only.
    """
    if balance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if fixed:
        named = df.withColumn("batch_id", F.lit(str(batch_id)))
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by, "batch_id").parquet(path)
        return
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def append_verified(
    df: DataFrame, path: str, partition_by: Sequence[str], batch_id: int | str, balance: bool = False
) -> int:
    """``append_batch``, then read the batch again and compare contents; returns its rows.

    The digest of what was to be written is observed on its way, so the rows are
    computed once. A difference raises ``ContentMismatch`` and leaves the batch
    where it is: repeating the load replaces it.
    """
    rows, seen = watched(df)
    append_batch(rows, path, partition_by, batch_id, balance)
    wanted = dict(seen.get)
    try:
        found = digest_of(df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch_id={batch_id}"), df.columns)
    except AnalysisException:
        found = {"rows": 0}
    if not same_digest(wanted, found):
        raise ContentMismatch(f"batch {batch_id} of {path} holds {found['rows']} rows that are not the {wanted.get('rows', 0)} written")
    return found["rows"]


def read_appended(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The appended rows under one merged schema; columns missing in a file are null."""
    reader = spark.read.option("mergeSchema", "true")
    return (reader.schema(schema) if schema is not None else reader).parquet(path).drop("batch_id")


def compact_partition(spark: SparkSession, path: str, column: str, value: str) -> int:
    """Rewrite the batches of one closed partition as one, of few files; returns its rows.

    For tables appended with ``fixed``: the folders below ``<column>=<value>``
    become ``batch_id=compacted`` under their merged schema.  The rows are
    staged at ``<path>.compacting`` and noted there as complete before the
    partition is replaced, so a run that broke off is finished by the next one.
    Compact only what gets no more batches and replays, with one writer, while
    nobody reads that partition.  Other partitions are neither read nor written.
    """
    folder, staged = f"{path}/{column}={value}", f"{path}.compacting/{column}={value}"
    note = f"{staged}.complete"

    def complete(rows: int | None) -> None:
        spark.range(1).select(F.lit(rows).cast("bigint").alias("rows")).coalesce(1).write.mode("overwrite").parquet(note)

    noted = read_or_empty(spark, note, T.StructType([T.StructField("rows", T.LongType())])).first()
    if noted is None or noted["rows"] is None:
        batches = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(folder)
        batches.drop(column, "batch_id").hint("rebalance").write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged).count()
        complete(rows)
    else:
        rows = noted["rows"]
    named = spark.read.parquet(staged).withColumn("batch_id", F.lit(COMPACTED))
    named.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(folder)
    complete(None)
    return rows


def overwrite_stage(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a staging table and read it back, with exact sizes for the planner."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append by name in the table's column order and types."""
    rows = as_table(df, schema) if schema is not None else df
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
