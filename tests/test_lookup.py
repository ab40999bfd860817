import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.operators.sizing import broadcast_if_small, measured_bytes


def ts(text):
    return dt.datetime.fromisoformat(text)


HUB = (
    "source_system_id int, source_system_name string, source_system_natural_key string, store_rhid int,"
    " effective_start_timestamp timestamp, effective_end_timestamp timestamp"
)
VERSIONS = [
    (3, "POS", "A_3", 1, ts("2020-01-01"), ts("2020-06-30")),
    (3, "POS", "A_3", 2, ts("2020-06-30"), ts("2021-01-01")),
    (3, "POS", "A_1_3", 5, ts("2020-01-01"), ts("2022-01-01")),
    (4, "WEB", "B_4", 7, ts("2020-01-01"), ts("2022-01-01")),
    (3, "POS", "C_4", 9, ts("2020-01-01"), ts("2022-01-01")),
]


@pytest.fixture
def hub(spark):
    return spark.createDataFrame(VERSIONS, HUB).withColumn("hub_code", lookup.hub_code())


def test_hub_code_is_the_key_without_its_system(hub, rows):
    got = dict(rows(hub, "store_rhid", "hub_code"))
    assert got == {1: "A", 2: "A", 5: "A_1", 7: "B", 9: None}


def matches(spark, hub, code, at, **how):
    fact = spark.createDataFrame([(code, ts(at))], "code string, at timestamp")
    joined = lookup.effective_join(fact, hub, "code", "at", ["store_rhid"], **how)
    return sorted((r["store_rhid"] for r in joined.collect()), key=str)


@pytest.mark.parametrize(
    "code,at,closed,left",
    [
        ("A", "2020-01-01", [1], [1]),
        ("A", "2020-06-30", [1, 2], [2]),
        ("A", "2021-01-01", [2], [None]),
        ("A", "2021-01-02", [None], [None]),
        ("A", "2019-12-31", [None], [None]),
        ("A_1", "2021-01-01", [5], [5]),
        ("C", "2021-01-01", [None], [None]),
        (None, "2021-01-01", [None], [None]),
    ],
)
def test_effective_join_edges(spark, hub, code, at, closed, left):
    assert matches(spark, hub, code, at) == closed
    assert matches(spark, hub, code, at, closed="left") == left


def test_effective_join_of_one_source_system(spark, hub):
    assert matches(spark, hub, "B", "2021-01-01", system="WEB") == [7]
    assert matches(spark, hub, "B", "2021-01-01", system="POS") == [None]


def test_effective_join_equals_the_concatenated_condition(spark, hub, rows):
    days = [f"2020-{m:02d}-{d:02d}" for m in range(1, 13) for d in (1, 30) if (m, d) != (2, 30)]
    codes = ["A", "A_1", "B", "C", "A_", "1", None]
    fact = spark.createDataFrame([(c, ts(d)) for c in codes for d in days], "code string, at timestamp")
    fast = lookup.effective_join(fact, hub, "code", "at", ["store_rhid"])
    h = hub.alias("h")
    slow = fact.join(
        h,
        (F.concat("code", F.lit("_"), F.col("h.source_system_id").cast("string")) == F.col("h.source_system_natural_key"))
        & F.col("at").between(F.col("h.effective_start_timestamp"), F.col("h.effective_end_timestamp")),
        "left",
    ).select("code", "at", "h.store_rhid")
    assert rows(fast) == rows(slow)


def test_effective_join_is_an_equi_join_with_and_without_broadcast(spark, hub):
    fact = spark.createDataFrame([("A", ts("2020-02-02"))], "code string, at timestamp")
    small = lookup.effective_join(fact, hub, "code", "at", ["store_rhid"])
    large = lookup.effective_join(fact, hub, "code", "at", ["store_rhid"], limit=0)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (small, large)]
    assert "rightHint=(strategy=broadcast)" in plans[0] and "broadcast" not in plans[1]
    for df in (small, large):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert small.collect() == large.collect()


def test_touching_versions_are_reported(hub, rows):
    assert rows(lookup.hub_overlaps(hub), "store_rhid") == [(1,)]


def test_null_safe_join_matches_nulls_of_nullable_keys_only(spark, rows):
    left = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (None, None, "c")], "k int, s int, x string")
    right = spark.createDataFrame([(1, None, "p"), (1, 5, "q"), (None, None, "r")], "k int, s int, y string")
    got = lookup.null_safe_join(left, right, ["k"], ["s"])
    assert got.columns == ["k", "s", "x", "y"]
    assert rows(got, "x", "y") == [("a", "p"), ("b", "q")]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_null_safe_join_of_a_frame_with_itself(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 3)], "k int, s int")
    totals = df.groupBy("k", "s").agg(F.count("*").alias("n"))
    assert rows(lookup.null_safe_join(df, totals, ["k"], ["s"])) == [(1, None, 1), (2, 3, 1)]


def test_flattened_columns_are_prefixed_and_unmatched_rows_kept(spark, rows):
    fact = spark.createDataFrame([(1, 10), (2, 99)], "id int, a_id int")
    a = spark.createDataFrame([(10, "x", 7)], "a_id int, name string, b_id int")
    b = spark.createDataFrame([(7, "deep")], "b_id int, name string")
    got = lookup.flatten_dimensions(
        fact, [lookup.Dimension(a, "a_id", "a_id", "a"), lookup.Dimension(b, "a_b_id", "b_id", "b")]
    )
    assert got.columns == ["id", "a_id", "a_name", "a_b_id", "b_name"]
    assert rows(got) == [(1, 10, "x", 7, "deep"), (2, 99, None, None, None)]


def test_branches_are_joined_on_the_fact_key(spark, rows):
    base = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "o int, i int, x string")
    left = spark.createDataFrame([(1, 1, 5)], "o int, i int, s int")
    right = spark.createDataFrame([(1, 1, 6), (1, 2, 7)], "o int, i int, t int")
    assert rows(lookup.assemble_branches(base, [left, right], ["o", "i"])) == [(1, 1, "a", 5, 6)]


def test_broadcast_follows_the_measured_size(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    size = measured_bytes(df)
    assert 100_000 <= size < 120_000
    hinted = [broadcast_if_small(df, limit)._jdf.queryExecution().logical().toString() for limit in (size, size - 1)]
    assert "broadcast" in hinted[0] and "broadcast" not in hinted[1]
    assert measured_bytes(df.where("false")) == 0
    assert measured_bytes(df.select(F.struct("text").alias("s"))) > 100_000
