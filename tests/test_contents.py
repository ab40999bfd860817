import pytest
from pyspark.sql import functions as F

from tidemark.operators import contents
from tidemark.sources import tables

SCHEMA = "g string, a int, b string"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_order_partitions_and_types_do_not_matter(spark):
    one = frame(spark, ("x", 1, None), ("x", None, "1"), (None, 2, "é"), (None, 2, "é"))
    other = frame(spark, (None, 2, "é"), ("x", None, "1"), (None, 2, "é"), ("x", 1, None), schema="g string, a bigint, b string").repartition(3)
    assert contents.differing_groups(one, other.select("b", "g", "a"), ["g"]).count() == 0
    assert contents.same_digest(contents.digest_of(one), contents.digest_of(other.select("g", F.col("a").cast("int"), "b")))


@pytest.mark.parametrize(
    "left,right",
    [
        ([("x", 1, None)], [("x", None, "1")]),
        ([("x", None, "a")], [("x", None, None)]),
        ([("x", 1, "a"), ("x", 1, "a"), ("x", 2, "b")], [("x", 1, "a"), ("x", 2, "b"), ("x", 2, "b")]),
        ([("x", 1, "a")] * 2, [("x", 2, "b")] * 2),
        ([("x", 1, "ab")], [("x", 1, "ba")]),
        ([("x", 1, "a")], []),
        ([], [("x", 1, "a")]),
    ],
)
def test_what_counts_hide_is_found(spark, left, right):
    """Nulls that change places, a lost row beside a doubled one, pairs that cancel in an exclusive or, one side alone."""
    same = [(None, 5, "same"), ("y", 6, None)]
    source, target = frame(spark, *left, *same), frame(spark, *right, *same)
    assert [tuple(r) for r in contents.differing_groups(source, target, ["g"]).collect()] == [("x", len(left), len(right))]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in contents.differing_rows(source, target, ["g"]).collect()}
    every = set(left) | set(right)
    assert found == {r: (left.count(r), right.count(r)) for r in every if left.count(r) != right.count(r)}


def test_null_groups_empty_tables_and_maps(spark):
    none = frame(spark)
    assert contents.differing_groups(none, none, ["g"]).count() == 0
    got = contents.differing_groups(frame(spark, (None, 1, "a")), frame(spark, (None, 2, "a")), ["g"]).collect()
    assert [tuple(r) for r in got] == [(None, 1, 1)]
    assert contents.differing_groups(frame(spark, ("x", 1, "a")), frame(spark, ("x", 1, "b")), ["g"], ["a"]).count() == 0
    with pytest.raises(ValueError, match="map"):
        contents.digest(spark.sql("select map(1, 2) as m"))


def test_groups_are_combined_before_the_exchange(spark):
    plan = contents.differing_groups(spark.range(10).selectExpr("id % 2 as g", "id"), spark.range(10).selectExpr("id % 2 as g", "id"), ["g"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count_if" in text.replace("partial_count(", "partial_count_if(")


def test_a_verified_append_is_compared_with_what_was_written(spark, tmp_path, monkeypatch):
    rows = frame(spark, ("x", 1, None), ("y", 2, "b"), (None, 3, "c"))
    assert tables.append_verified(rows, str(tmp_path / "t"), ["g"], 1) == 3
    assert tables.append_verified(rows.limit(0), str(tmp_path / "t"), ["g"], 2) == 0
    real = tables.append_batch
    # The rows pass by the observation, and others land.
    monkeypatch.setattr(tables, "append_batch", lambda df, *a, **k: real(df.withColumn("a", F.col("a") + F.when(F.col("b") == "b", 1).otherwise(0)), *a, **k))
    with pytest.raises(contents.ContentMismatch, match="batch 3"):
        tables.append_verified(rows, str(tmp_path / "t"), ["g"], 3)
