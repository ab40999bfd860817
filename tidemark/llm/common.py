"""What the operators of this package share: Arrow maps, staging, word hashes, runs, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import configure, work_path

#: Rows of an Arrow batch: bounds a Python worker's memory where texts are long.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session settings, and Arrow batches small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and safe when executors are lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def map_batches(df: DataFrame, columns: Sequence[str], setup: Callable[[], Callable], ddl: str) -> DataFrame:
    """Map Arrow batches; ``setup`` runs once per task and returns the function from lists to lists.

    The function gets the named columns of a batch as lists and returns a dict
    of output columns, of any one length.
    """
    schema = as_schema(ddl)
    arrow = to_arrow_schema(schema)
    columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = setup()
        for batch in batches:
            out = function(*[batch.column(c).to_pylist() for c in columns])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def id_remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# --- words -------------------------------------------------------------------

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_POLY = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash by word (bytes), kept for words seen before; cleared when it grows past a bound."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words; empty when there are fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, width):
        out *= _POLY
        out += hashes[i : i + n]
    return mix(out)


def split_words(text: str | None) -> list[bytes]:
    """Words as UTF-8: maximal runs without space, tab, newline, vertical tab, form feed, carriage return."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


# --- runs of sorted rows --------------------------------------------------------


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Record batches of one key each, from batches sorted by the key columns (integers, no nulls)."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        if kept:
            change[0] = any(kept[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys)
        starts = np.flatnonzero(change)
        edges = [0, *(s for s in starts if s), n]
        if kept and change[0]:
            yield _joined(kept)
            kept = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            kept.append(batch.slice(a, b - a))
            if b < n:
                yield _joined(kept)
                kept = []
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def in_blocks(postings: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Deal each posting list out in pairs of blocks, so that no task ever holds a long list.

    Adds ``_count`` (length of the list), ``_own`` (the member's block) and
    ``_i <= _j`` (the pair of blocks a row was dealt to). A list of at most
    ``block`` members is one block. Two members of a list meet in exactly one
    pair of blocks if their blocks differ; members of one block meet in each
    pair with that block, and belong to the pair (block, block).
    """
    counts = postings.groupBy(key).agg(F.count("*").alias("_count")).filter("_count > 1")
    n = F.ceil(F.col("_count") / block).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(11)), n.cast("bigint")).cast("int")
    dealt = (
        postings.join(counts, key)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other")
    )
    return dealt


# --- components -----------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id that each node of the edges (a, b) can reach.

    Alternates large and small stars until the edges stand still. Each step is
    an aggregation with map-side minima and a join whose hot keys adaptive
    execution splits; only a count and a checksum come to the driver. No edges
    give no rows; loops and repeated edges do no harm.
    """
    current = stage(edges.select("a", "b").filter("a <> b").distinct(), name)
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small_least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(small_least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*")
        )
        current = stage(small.filter("a <> b").distinct(), name)
    ends = current.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)
