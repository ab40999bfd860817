"""Plans that have to hold when one key carries a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tests.test_lookup import HUB, VERSIONS
from tidemark.operators import cdc, lookup, quality

SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, tmp_path, rows=60_000):
    """Change rows of which a third belong to one key, in several files."""
    path = str(tmp_path / "hot")
    ids = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10)
    spark.range(rows).select(
        ids.cast("int").alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.when(F.col("id") % 3 == 0, "A").otherwise(F.concat(F.lit("X"), F.col("id"))).alias("code"),
        F.lit("2020-03-01").cast("timestamp").alias("at"),
        F.when(F.col("id") % 2 == 0, "UPDATE").otherwise("INSERT").alias("rec_crud_text"),
        F.lpad(F.col("id").cast("string"), 9, "0").alias("changeSequence"),
        F.timestamp_seconds("id").alias("hdr_timestamp"),
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_code_is_split_when_the_hub_is_too_large_to_broadcast(spark, small_partitions, tmp_path):
    hub = spark.createDataFrame(VERSIONS, HUB).withColumn("hub_code", lookup.hub_code())
    joined = lookup.effective_join(hot(spark, tmp_path), hub, "code", "at", ["store_rhid"], limit=0)
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan
    assert joined.where("store_rhid = 1").count() == 20_000


def test_null_codes_do_not_meet_in_one_task(spark, small_partitions, tmp_path):
    hub = spark.createDataFrame(VERSIONS, HUB).withColumn("hub_code", lookup.hub_code())
    fact = hot(spark, tmp_path).withColumn("code", F.when(F.col("code") != "A", F.col("code")))
    joined = lookup.effective_join(fact, hub, "code", "at", ["store_rhid"], limit=0)
    assert "SortMergeJoin(skew=true)" in final_plan(joined)


def test_hot_key_is_split_in_the_duplicate_join(spark, small_partitions, tmp_path):
    rows = hot(spark, tmp_path)
    bad = quality.exceptions(rows, ["key"], [], ["key", "name"])
    assert "SortMergeJoin(skew=true)" in final_plan(bad)
    assert bad.count() == 20_000


def test_latest_ships_one_row_per_key_and_task(spark, small_partitions, tmp_path):
    newest = cdc.latest_by_key(hot(spark, tmp_path), ["key"])
    plan = final_plan(newest)
    partial = plan.index("Partial", plan.index("Exchange hashpartitioning"))
    assert "WindowGroupLimit" in plan[:partial]
    assert newest.count() == 40_001


def test_duplicate_groups_are_counted_before_the_exchange(spark, small_partitions, tmp_path):
    plan = quality.superseded_groups(hot(spark, tmp_path), ["key"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(key", plan.index("rec_crud_text"))
    assert "partial_count" in plan[exchange:] and "partial_max" in plan[exchange:]
