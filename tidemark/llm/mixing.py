"""Mixing sources to target weights by nested hash thresholds, without sorting documents.

A source's target is its share of all words by weight; it stops at ``MOST``
times the source's own words, and the excess is shared anew by weight until
none is above. A target of q whole passes and a rest takes every document q
times, and once more those whose hash lies below the source's threshold.

The threshold comes from histograms: words by source and the top ``BITS`` bits
of the hash show the bucket in which the rest is used up; only documents of
that bucket are counted again by the next bits, until the bucket holds one hash
value. That last document goes in if this brings the sum nearer to the target.

Null texts have size 0, a null source is a source of its own (last in order).
Documents without a word go with the whole passes only: they use up no rest.
Rows of one doc_id share a hash and are taken or left together. Reruns agree.
An empty table gives no rows; extra columns are ignored, or kept by ``take_mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, stage

WEIGHTS = (5, 2, 1)
MOST = 3
BITS, LEVELS = 12, 5  #: 60 bits of hash in five nested histograms
WORD = r"[^\x20\x09-\x0D]+"


def mix_hash(doc_id):
    """60 bits of the digest of an id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) of rows (source, size): a few numbers per source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    by_cap = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    level = (
        sources.withColumn("weight", weight)
        .withColumn("ratio", F.lit(MOST) * F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", MOST * (F.sum("source_size").over(by_cap.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("source_size")))
        .withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("rest"))
        .withColumn("first", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    )
    target = F.least((F.lit(MOST) * F.col("source_size")).cast("double"), F.col("first") * F.col("weight"))
    return level.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, passes, threshold): documents with a hash below the threshold go once more."""
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint")
    state = targets(sizes, weights).withColumn("passes", passes)
    state = state.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * size))
    # The prefix of hash bits that is still open, the words below it, and whether several hashes remain.
    state = stage(state.withColumn("prefix", F.lit(0).cast("bigint")).withColumn("below", F.lit(0).cast("bigint")).withColumn("held", F.lit(0).cast("bigint")), "mix-targets")
    for level in range(1, LEVELS + 1):
        shift = 60 - BITS * level
        rows = sizes.alias("d").join(state.select(F.col("source").alias("s"), "prefix"), F.col("d.source").eqNullSafe(F.col("s")))
        rows = rows.filter(F.shiftright("h", shift + BITS) == F.col("prefix"))
        counts = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        order = W.partitionBy("source").orderBy("bucket")
        before = F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("before", before).join(
            state.select(F.col("source").alias("s"), "budget", F.col("below").alias("under")), F.col("source").eqNullSafe(F.col("s"))
        )
        edge = counts.filter(F.col("under") + F.col("before") + F.col("words") > F.col("budget"))
        edge = edge.groupBy("source").agg(F.min(F.struct("bucket", (F.col("under") + F.col("before")).alias("below"), "words")).alias("e"))
        edge = edge.select(F.col("source").alias("s"), "e.*")
        state = state.select("source", "source_size", "target", "passes", "budget").join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        state = state.select(
            "source", "source_size", "target", "passes", "budget",
            F.coalesce("bucket", F.lit(-1)).cast("bigint").alias("prefix"), F.coalesce("below", F.lit(0)).cast("bigint").alias("below"), F.coalesce("words", F.lit(0)).cast("bigint").alias("held"),
        )
        state = stage(state, "mix-level")
    nearer = F.col("below") + F.col("held") - F.col("budget") < F.col("budget") - F.col("below")
    return state.select("source", "source_size", "target", "passes", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("threshold"))


def _counted(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"), mix_hash(F.col("doc_id")).alias("h"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row of ``docs`` (doc_id, text, source)."""
    prepare(docs.sparkSession)
    sizes = stage(_counted(docs), "mix-sizes")
    cut = thresholds(sizes, weights).withColumnRenamed("source", "s")
    copies = F.col("passes") + ((F.col("h") < F.col("threshold")) & (F.col("size") > 0)).cast("bigint")
    joined = sizes.join(cut, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", copies)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def take_mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns."""
    prepare(docs.sparkSession)
    cut = thresholds(stage(_counted(docs), "mix-sizes"), weights)
    cut = cut.select(F.col("source").alias("_mix_source"), F.col("passes").alias("_mix_passes"), F.col("threshold").alias("_mix_threshold"))
    worded = F.coalesce(docs["text"].rlike(WORD), F.lit(False))
    copies = F.col("_mix_passes") + ((mix_hash(docs["doc_id"]) < F.col("_mix_threshold")) & worded).cast("bigint")
    names = docs.columns
    joined = docs.join(cut, docs["source"].eqNullSafe(F.col("_mix_source"))).withColumn("_mix_copies", copies.cast("int"))
    often = F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy")
    return joined.filter("_mix_copies > 0").select("*", often).select(*[f"`{n}`" for n in names])


ORACLE = """
with sizes as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
    cast(concat('0x', substr(md5(concat('mix:', coalesce(cast(doc_id as varchar), ''))), 1, 15)) as bigint) as h
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as place from sizes group by source),
weighed as (select *, [5, 2, 1][place % 3 + 1] as weight from sources),
ratios as (select *, 3 * source_size / weight as ratio, cast(sum(source_size) over () as bigint) as total from weighed),
levels as (
  select *, (total - 3 * (sum(source_size) over (order by ratio, source nulls last rows unbounded preceding) - source_size))::double
    / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as level
  from ratios),
aims as (
  select source, source_size, least(cast(3 * source_size as double), weight * (select level from levels where ratio >= level order by ratio, level limit 1)) as target from levels),
budgets as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as passes,
    target - (case when source_size > 0 then floor(target / source_size) else 0 end) * source_size as budget from aims),
ranked as (
  select s.*, b.source_size, b.target, b.passes, b.budget,
    sum(size) over (partition by s.source order by h) as upto,
    sum(size) over (partition by s.source, h) as tied
  from sizes s join budgets b on s.source is not distinct from b.source)
select doc_id, size, source_size, target, cast(copies * size as bigint) as taken, cast(copies as bigint) as copies from (
  select *, passes + case when size = 0 then 0 when upto <= budget then 1 when upto - tied <= budget and upto - budget < budget - (upto - tied) then 1 else 0 end as copies from ranked)
"""
