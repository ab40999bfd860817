"""A keyed table in the catalog, bucketed and sorted by its key, that merges without moving its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import any_null, merge_upsert
from tidemark.schemas import CREATE_COLUMNS
from tidemark.session import setting

GENERATION, BATCH = "tidemark.generation", "tidemark.batch"


class BucketedTable:
    """A view over the newest of the table's generations, each bucketed by the key.

    A merge reads the current generation bucket by bucket: its rows are already
    dealt by the key, so only the source is exchanged, into as many
    partitions as there are buckets. Each task of the join then holds one bucket
    and writes it as one file of the next generation. The view turns to that
    generation once it is complete; the one before stays for readers that still
    hold it, older ones are dropped.

    A merge rewrites the whole table: choose this for tables of which a batch
    touches most buckets, and ``KeyedTable``, which rewrites the touched
    partitions alone, for others. ``batch`` names the source: a batch
    that is already in place is not merged again, and one that died on the way is
    begun anew under the same generation. One writer at a time.

    Rows with a null in the key are left out of the source; the key must be
    unique in it.
    """

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str], buckets: int = 256):
        self.spark, self.name, self.schema, self.keys, self.buckets = spark, name, schema, list(keys), buckets

    def _generation(self, number: int) -> str:
        return f"{self.name}__g{number}"

    def state(self) -> tuple[int, str]:
        """The current generation (0: there is none) and the batch that made it."""
        if not self.spark.catalog.tableExists(self.name):
            return 0, ""
        found = dict(tuple(r) for r in self.spark.sql(f"show tblproperties {self.name}").collect())
        return int(found[GENERATION]), found[BATCH]

    def read(self) -> DataFrame:
        """The rows, with the key's buckets and order as Spark knows them from the catalog."""
        number, _ = self.state()
        return self.spark.table(self._generation(number)) if number else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, number: int, batch: str) -> None:
        writer = rows.write.mode("overwrite").format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.saveAsTable(self._generation(number))
        quoted = batch.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"create or replace view {self.name} tblproperties ('{GENERATION}' = '{number}', '{BATCH}' = '{quoted}')"
            f" as select * from {self._generation(number)}"
        )
        if number > 2:
            self.spark.sql(f"drop table if exists {self._generation(number - 2)}")

    def merged(self, source: DataFrame, preserve: Sequence[str] = CREATE_COLUMNS, seq: str | None = None, reload: bool = False) -> DataFrame:
        """What the table holds after the merge; its plan exchanges the source alone."""
        source = source.select(*self.schema.names).where(~any_null(self.keys))
        return merge_upsert(self.read(), source, self.keys, preserve, seq, reload=reload)

    def merge(
        self, source: DataFrame, preserve: Sequence[str] = CREATE_COLUMNS, seq: str | None = "change_sequence",
        batch: str = "", reload: bool = False,
    ) -> int:
        """Merge the source rows (one per key); returns the generation that holds them."""
        number, done = self.state()
        if number and batch and batch == done:
            return number
        source = source.select(*self.schema.names).where(~any_null(self.keys)).persist()
        try:
            if not source.groupBy(*self.keys).agg(F.count("*").alias("_n")).where("_n > 1").isEmpty():
                raise ValueError(f"the source of {self.name} holds a key more than once")
            # With as many shuffle partitions as buckets the source comes to the buckets, not both to a third layout.
            with setting(self.spark, "spark.sql.shuffle.partitions", str(self.buckets)):
                rows = self.merged(source, preserve, seq, reload) if number else source.repartition(self.buckets, *self.keys)
                self._write(rows, number + 1, batch)
        finally:
            source.unpersist()
        return number + 1

    def drop(self) -> None:
        """Remove the view and every generation that is left."""
        number, _ = self.state()
        self.spark.sql(f"drop view if exists {self.name}")
        for n in range(max(1, number - 2), number + 2):
            self.spark.sql(f"drop table if exists {self._generation(n)}")
