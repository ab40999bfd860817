"""Keyed upsert: the functional merge and the bucketed Parquet table it maintains."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cdc import latest_by_key
from tidemark.schemas import CREATE_COLUMNS
from tidemark.session import setting

BUCKET = "pk_bucket"
SLICE = "_slice"
STAGED = "batch string, ignored bigint"
LAYOUT = "keys string, part string, buckets int"
OPERATION, REFRESH = "rec_crud_text", "REFRESH"
NULL_KEY_MODES = ("quarantine", "match", "insert")
# How Spark names the folder of a null partition, and the characters it writes as their code in folder names.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = (),
    seq: str | None = None,
    null_keys: str = "quarantine",
    also: Sequence[str] = (),
    reload: bool = False,
    ignored: Observation | None = None,
    null_also: bool = False,
) -> DataFrame:
    """The target after updating matched keys from the source and inserting the others.

    * every column comes from the source on a match, nulls included, except
      ``preserve``, which keep the target's value;
    * with ``seq`` an older source row (smaller sequence) leaves the target alone;
    * ``null_keys``: ``quarantine`` drops source rows with a null key, ``match``
      lets nulls match each other, ``insert`` adds such rows unmatched.

    The source must hold one row per key.  ``also`` names further columns equal
    on both sides of a match (a bucket column) to join on; with ``null_also``
    they may be null on both sides.

    Initial-load rows carry the lowest sequence, so the guard ignores them where
    a change is stored.  With ``reload`` they win: the source was loaded anew,
    and its later changes build on that.  ``ignored`` observes, as ``rows``, how
    many source rows the guard left out.
    """
    if null_keys not in NULL_KEY_MODES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_MODES}")
    columns = target.columns
    aside = []
    if null_keys == "insert":
        # Rows that cannot match need no join, and would all meet in one task there.
        aside = [side.where(any_null(keys)).select(*columns) for side in (target, source)]
        target = target.where(~any_null(keys))
    if null_keys != "match":
        source = source.where(~any_null(keys))
    old = target.select(*[F.col(f"`{c}`").alias(f"_t_{c}") for c in columns], F.lit(True).alias("_t"))
    new = source.select(*[F.col(f"`{c}`").alias(f"_s_{c}") for c in columns], F.lit(True).alias("_s"))

    def same(key: str) -> Column:
        left, right = F.col(f"_t_{key}"), F.col(f"_s_{key}")
        null_safe = null_also and key in also or null_keys == "match" and key in keys
        return left.eqNullSafe(right) if null_safe else left == right

    joined = old.join(new, reduce(and_, [same(k) for k in [*also, *keys]]), "full")
    wins = F.col("_s").isNotNull()
    if seq is not None:
        newer = F.coalesce(F.col(f"_s_{seq}") >= F.col(f"_t_{seq}"), F.lit(True))
        if reload:
            newer = newer | F.coalesce(F.col(f"_s_{OPERATION}") == REFRESH, F.lit(False))
        wins = wins & (F.col("_t").isNull() | newer)
    if ignored is not None:
        joined = joined.observe(ignored, F.count_if(F.col("_s") & ~wins).alias("rows"))
    kept = set(preserve)

    def merged(name: str) -> Column:
        takes_source = F.col("_t").isNull() if name in kept else wins
        return F.when(takes_source, F.col(f"_s_{name}")).otherwise(F.col(f"_t_{name}")).alias(name)

    return reduce(DataFrame.unionByName, aside, joined.select(*[merged(c) for c in columns]))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key, from its text so that int and bigint keys agree."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def escaped(value: str) -> str:
    """A partition value as it stands in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


class KeyedTable:
    """A table in Parquet with one row per key, maintained by merges.

    It is partitioned by a hash bucket of the key, or by ``partition_by``, a
    column that the key determines.  A merge reads and rewrites only the
    partitions its source touches.  Both sides are exchanged once, by that
    partition and a slice of the key; the join and the write reuse the layout.
    The slices spread a large partition over several tasks, and adaptive
    execution puts small ones together again.  One writer at a time.

    The merged partitions are written to ``<path>.staged`` first and then
    replace the old ones, so a job that dies in the replacement is finished by
    repeating the batch.  Readers may see a mix of old and new partitions
    meanwhile; use a transactional format where that matters (``delta_merge``).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 256,
        partition_by: str | None = None,
    ):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema, self.part = schema, partition_by or BUCKET
        hidden = [] if partition_by else [T.StructField(BUCKET, T.IntegerType())]
        self.stored = T.StructType([*schema.fields, *hidden])

    def _load(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(self.stored).parquet(path)

    def create(self) -> None:
        """Write an empty table unless one is there; one laid out otherwise is an error."""
        empty = self.spark.createDataFrame([], self.stored)
        empty.write.mode("ignore").partitionBy(self.part).parquet(self.path)
        wanted = (",".join(self.keys), self.part, self.buckets if self.part == BUCKET else 0)
        try:
            found = self.spark.read.schema(LAYOUT).parquet(f"{self.path}.layout").first()
        except AnalysisException:
            found = None
        if found is None:
            self._note_layout(wanted)
        elif tuple(found) != wanted:
            raise ValueError(f"{self.path} is laid out by {tuple(found)}, not {wanted}; rebucket() changes the number of buckets")

    def _note_layout(self, layout: tuple) -> None:
        self.spark.createDataFrame([layout], LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{self.path}.layout")

    def rebucket(self, buckets: int) -> None:
        """Deal the rows out anew; a job that dies on the way is repaired by repeating it."""
        spark = self.spark
        rows = self.read().withColumn(BUCKET, bucket_of(self.keys, buckets))
        rows.repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}.rebucketed")
        dealt = self._load(spark, f"{self.path}.rebucketed")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(self.path)
        self.buckets = buckets
        self._note_layout((",".join(self.keys), BUCKET, buckets))

    def read(self) -> DataFrame:
        return self._load(self.spark, self.path).select(*self.schema.names)

    def merge(
        self,
        source: DataFrame,
        preserve: Sequence[str] = CREATE_COLUMNS,
        seq: str | None = "change_sequence",
        null_keys: str = "quarantine",
        batch: str | None = None,
        whole: str | None = None,
        reload: bool = False,
        retract: DataFrame | None = None,
    ) -> int:
        """Merge the source rows (one per key) into the table; returns how many took effect.

        The others were older than the stored row (see ``merge_upsert``).  A key
        that the source holds twice is an error.  ``whole`` names a column that
        decides the partition: of each of its values that the source has, the
        table keeps only keys that the source holds.  ``retract`` lists more such
        values, with their partition: rows of a value that the source no longer
        has at all go too.  Null is a value, and a partition, like any other.
        ``batch`` identifies the source, so that a repeated batch whose staging was complete is only put
        in place again.
        """
        self.create()
        spark = source.sparkSession
        batch = batch or uuid.uuid4().hex
        source = source.select(*self.schema.names)
        if self.part == BUCKET:
            source = source.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        if null_keys == "quarantine":
            source = source.where(~any_null(self.keys))
        # Computed once: the touched partitions are counted, then the rows merged.
        source = source.persist()
        try:
            per_key = source.groupBy(self.part, *[k for k in self.keys if k != self.part]).agg(F.count("*").alias("_n"))
            most = F.max(F.when(~any_null(self.keys), F.col("_n")))
            touched = per_key.groupBy(self.part).agg(F.sum("_n"), most).collect()
            if any((r[2] or 0) > 1 for r in touched):
                raise ValueError(f"the source of {self.path} holds a key more than once")
            touched = {r[0]: r[1] for r in touched}
            if retract is not None:
                if whole is None:
                    raise ValueError("retract needs whole, the column whose values it lists")
                retract = retract.select(whole, *[c for c in [self.part] if c != whole]).distinct().persist()
                for r in retract.select(self.part).distinct().collect():
                    touched.setdefault(r[0], 0)
            if not touched:
                return 0
            staged = self._staged_batch(spark)
            if staged is None or staged[0] != batch:
                staged = batch, self._stage(source, list(touched), preserve, seq, null_keys, batch, whole, reload, retract)
        finally:
            source.unpersist()
            if retract is not None:
                retract.unpersist()
        merged = self._load(spark, f"{self.path}.staged")
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.part).parquet(self.path)
        self._empty(spark, set(touched) - {r[0] for r in merged.select(self.part).distinct().collect()} if retract is not None else set())
        return sum(touched.values()) - staged[1]

    def _empty(self, spark: SparkSession, parts: set) -> None:
        """Leave no row in the partitions: the dynamic overwrite passes over those for which nothing is staged."""
        columns = T.StructType([f for f in self.stored if f.name != self.part])
        for value in parts:
            folder = NULL_PARTITION if value is None else escaped(str(value))
            spark.createDataFrame([], columns).write.mode("overwrite").parquet(f"{self.path}/{self.part}={folder}")

    def _stage(
        self, source: DataFrame, touched: list, preserve: Sequence[str], seq: str | None, null_keys: str, batch: str,
        whole: str | None = None, reload: bool = False, retract: DataFrame | None = None,
    ) -> int:
        spark = source.sparkSession
        null_part = None in touched
        wanted = F.col(self.part).isin([t for t in touched if t is not None])
        old = self._load(spark, self.path).where(wanted | F.col(self.part).isNull() if null_part else wanted)
        if whole:
            named = source.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.lit(True).alias("_held"))
            groups = source.select(F.col(whole).alias("_group"))
            if retract is not None:
                groups = groups.union(retract.select(whole))
            groups = groups.distinct().withColumn("_sent", F.lit(True))
            same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys]
            marked = old.join(groups, F.col(whole).eqNullSafe(F.col("_group")), "left").join(named, same, "left")
            old = marked.where("_sent is null or _held").select(*old.columns)
        # As many slices as give every shuffle task work; one exchange per side,
        # since the join accepts a partitioning by these two columns alone.
        slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // len(touched)))
        cut = bucket_of(self.keys, slices * self.buckets)
        cut = F.floor(cut / self.buckets) if self.part == BUCKET else cut % slices
        seen = Observation()
        with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            merged = merge_upsert(
                *[side.withColumn(SLICE, cut).repartition(self.part, SLICE) for side in (old, source)],
                self.keys, preserve, seq, null_keys, [self.part, SLICE], reload, seen, null_part,
            )
            merged.drop(SLICE).write.mode("overwrite").partitionBy(self.part).parquet(f"{self.path}.staged")
        ignored = seen.get.get("rows") or 0
        marker = spark.createDataFrame([(batch, ignored)], STAGED)
        marker.coalesce(1).write.mode("overwrite").parquet(f"{self.path}.staged_batch")
        return ignored

    def _staged_batch(self, spark: SparkSession) -> tuple[str, int] | None:
        """The batch whose staging is known to be complete, if any, and how many of its rows were ignored."""
        try:
            row = spark.read.schema(STAGED).parquet(f"{self.path}.staged_batch").first()
        except AnalysisException:
            return None
        return row and tuple(row)


def delta_merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = CREATE_COLUMNS,
    seq: str | None = "change_sequence",
    null_keys: str = "quarantine",
    reload: bool = False,
) -> None:
    """The same merge on a Delta table, created first where there is none; needs the delta-spark package."""
    from delta.tables import DeltaTable

    if null_keys not in NULL_KEY_MODES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_MODES}")
    DeltaTable.createIfNotExists(spark).location(path).addColumns(source.schema).execute()
    if null_keys == "quarantine":
        source = source.where(~any_null(keys))
    equals = "<=>" if null_keys == "match" else "="
    condition = " AND ".join(f"t.`{k}` {equals} s.`{k}`" for k in keys)
    guard = f"coalesce(s.`{seq}` >= t.`{seq}`, true)" if seq else None
    if guard and reload:
        guard += f" OR s.`{OPERATION}` = '{REFRESH}'"
    values = {c: f"s.`{c}`" for c in source.columns}
    updates = {c: v for c, v in values.items() if c not in set(preserve)}
    (
        DeltaTable.forPath(spark, path)
        .alias("t")
        .merge(source.alias("s"), condition)
        .whenMatchedUpdate(condition=guard, set=updates)
        .whenNotMatchedInsert(values=values)
        .execute()
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preserve: Sequence[str] = (),
    seq: str | None = None,
    null_keys: str = "quarantine",
) -> DataFrame:
    """Reduce a change log to its newest row per key and merge that into the target."""
    return merge_upsert(target, latest_by_key(changes, keys, order), keys, preserve, seq, null_keys)
