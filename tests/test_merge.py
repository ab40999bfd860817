import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.operators.merge import KeyedTable, apply_changes, bucket_of, merge_upsert

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("value", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("change_sequence", T.IntegerType()),
    ]
)


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_update_insert_and_untouched(spark, rows):
    target = table(spark, (1, "a", "t0", 1), (2, "b", "t0", 2))
    source = table(spark, (2, "B", "t1", 3), (3, "c", "t1", 4))
    got = merge_upsert(target, source, ["id"], ["created"], "change_sequence")
    assert rows(got) == [(1, "a", "t0", 1), (2, "B", "t0", 3), (3, "c", "t1", 4)]
    assert got.schema.names == SCHEMA.names


def test_an_update_to_null_wins(spark, rows):
    got = merge_upsert(table(spark, (1, "a", "t0", 1)), table(spark, (1, None, None, 2)), ["id"], ["created"])
    assert rows(got) == [(1, None, "t0", 2)]


def test_older_change_is_ignored_only_with_the_guard(spark, rows):
    target, source = table(spark, (1, "new", "t0", 9)), table(spark, (1, "old", "t1", 3))
    assert rows(merge_upsert(target, source, ["id"], ["created"], "change_sequence")) == [(1, "new", "t0", 9)]
    assert rows(merge_upsert(target, source, ["id"], ["created"])) == [(1, "old", "t0", 3)]


def test_null_keys_quarantined_matched_or_inserted(spark, rows):
    target, source = table(spark, (None, "a", "t0", 1), (1, "x", "t0", 1)), table(spark, (None, "b", "t1", 2))
    kept = (1, "x", "t0", 1)
    assert rows(merge_upsert(target, source, ["id"])) == sorted([kept, (None, "a", "t0", 1)], key=repr)
    assert rows(merge_upsert(target, source, ["id"], null_keys="match")) == sorted([kept, (None, "b", "t1", 2)], key=repr)
    inserted = merge_upsert(target, source, ["id"], null_keys="insert")
    assert rows(inserted) == sorted([kept, (None, "a", "t0", 1), (None, "b", "t1", 2)], key=repr)
    with pytest.raises(ValueError):
        merge_upsert(target, source, ["id"], null_keys="maybe")


def test_composite_keys(spark, rows):
    schema = "a int, b string, v int"
    target = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], schema)
    source = spark.createDataFrame([(1, "y", 3), (2, "x", 4)], schema)
    assert rows(merge_upsert(target, source, ["a", "b"])) == [(1, "x", 1), (1, "y", 3), (2, "x", 4)]


changes_strategy = st.lists(
    st.tuples(st.integers(1, 4), st.one_of(st.none(), st.sampled_from("abc"))), min_size=1, max_size=12
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=changes_strategy, cuts=st.sets(st.integers(1, 11), max_size=2), shuffle=st.booleans())
def test_any_batching_equals_one_batch(spark, rows, changes, cuts, shuffle):
    log = [(key, value, f"t{n}", n) for n, (key, value) in enumerate(changes)]
    edges = [0, *sorted(c for c in cuts if c < len(log)), len(log)]
    batches = [log[a:b] for a, b in zip(edges, edges[1:])]
    if shuffle:
        random.Random(len(log)).shuffle(batches)
    state = spark.createDataFrame([], SCHEMA)
    for batch in batches:
        state = apply_changes(state, table(spark, *batch), ["id"], ["change_sequence"], [], "change_sequence")
    whole = cdc.latest_by_key(table(spark, *log), ["id"], ["change_sequence"])
    assert rows(state) == rows(whole)


def test_keyed_table_merges_touched_buckets_only(spark, rows, tmp_path):
    path = str(tmp_path / "curr")
    keyed = KeyedTable(spark, path, SCHEMA, ["id"], buckets=4)
    keyed.merge(table(spark, *[(i, "a", "t0", 1) for i in range(40)]), ["created"])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "curr").glob("pk_bucket=*/*.parquet")}
    keyed.merge(table(spark, (7, "b", "t1", 2)), ["created"])
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "curr").glob("pk_bucket=*/*.parquet")}
    changed = {f.parent.name for f in before.keys() ^ after.keys()}
    assert len(changed) == 1
    assert (7, "b", "t0", 2) in rows(keyed.read()) and keyed.read().count() == 40


def test_keyed_table_replay_and_empty_batch(spark, rows, tmp_path):
    keyed = KeyedTable(spark, str(tmp_path / "curr"), SCHEMA, ["id"], buckets=4)
    batch = table(spark, (1, "a", "t0", 1), (2, "b", "t0", 2))
    keyed.merge(batch, ["created"], batch="q-0")
    once = rows(keyed.read())
    keyed.merge(batch, ["created"], batch="q-0")
    keyed.merge(batch.where("false"), ["created"], batch="q-1")
    assert rows(keyed.read()) == once


def test_keyed_table_finishes_a_half_replaced_batch(spark, rows, tmp_path):
    """A replacement that died after dropping a bucket is repaired from the staged copy."""
    keyed = KeyedTable(spark, str(tmp_path / "curr"), SCHEMA, ["id"], buckets=4)
    keyed.merge(table(spark, *[(i, "a", "t0", 1) for i in range(20)]), ["created"], batch="q-0")
    second = table(spark, *[(i, "b", "t1", 2) for i in range(20)])
    keyed.merge(second, ["created"], batch="q-1")
    want = rows(keyed.read())
    lost = next((tmp_path / "curr").glob("pk_bucket=*"))
    for file in lost.iterdir():
        file.unlink()
    assert keyed.read().count() < 20
    keyed.merge(second, ["created"], batch="q-1")
    assert rows(keyed.read()) == want


def test_keyed_table_partitioned_by_its_own_column(spark, rows, tmp_path):
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("store", "day", "n", "day_key")])
    keyed = KeyedTable(spark, str(tmp_path / "visits"), schema, ["store", "day"], partition_by="day_key")
    keyed.merge(spark.createDataFrame([(1, 1, 5, 101), (2, 2, 6, 102)], schema), [], None)
    keyed.merge(spark.createDataFrame([(1, 1, 9, 101)], schema), [], None)
    assert rows(keyed.read()) == [(1, 1, 9, 101), (2, 2, 6, 102)]


def test_int_and_bigint_keys_share_buckets(spark):
    df = spark.range(50).select(F.col("id"), F.col("id").cast("int").alias("small"))
    assert df.where(bucket_of(["id"], 8) != bucket_of(["small"], 8)).count() == 0


def test_keyed_merge_needs_one_exchange_per_side(spark, tmp_path):
    from tidemark.session import setting

    left = table(spark, (1, "a", "t", 1)).withColumn("pk_bucket", bucket_of(["id"], 8))
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"), setting(
        spark, "spark.sql.autoBroadcastJoinThreshold", "-1"
    ):
        merged = merge_upsert(left.repartition(8, "pk_bucket"), left.repartition(8, "pk_bucket"), ["id"], also=["pk_bucket"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_repeated_source_key_is_refused(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, value string, rec_create_timestamp timestamp, change_sequence string")
    keyed = KeyedTable(spark, str(tmp_path / "twice"), schema, ["id"], buckets=4)
    twice = spark.sql("select id % 3 as id, 'x' as value, now() as rec_create_timestamp, '1' as change_sequence from range(4)")
    with pytest.raises(ValueError, match="more than once"):
        keyed.merge(twice)
    assert keyed.read().count() == 0


def test_another_bucket_count_is_refused_until_the_table_is_rebucketed(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, value string, rec_create_timestamp timestamp, change_sequence string")
    source = spark.sql("select id, 'x' as value, now() as rec_create_timestamp, '1' as change_sequence from range(20)")
    path = str(tmp_path / "dealt")
    keyed = KeyedTable(spark, path, schema, ["id"], buckets=4)
    keyed.merge(source)
    with pytest.raises(ValueError, match="rebucket"):
        KeyedTable(spark, path, schema, ["id"], buckets=8).merge(source)
    keyed.rebucket(8)
    again = KeyedTable(spark, path, schema, ["id"], buckets=8)
    again.merge(source)
    assert again.read().count() == 20 and again.read().select("id").distinct().count() == 20


def test_delta_merge_creates_the_table_and_keeps_null_keys_out(spark, monkeypatch):
    """The module is not here: a stand-in records what is asked of it."""
    import sys
    import types

    from tidemark.operators.merge import delta_merge

    calls = []

    class Recorder:
        def __getattr__(self, name):
            def call(*args, **how):
                calls.append((name, args, how))
                return self

            return call

    module = types.ModuleType("delta.tables")
    module.DeltaTable = Recorder()
    monkeypatch.setitem(sys.modules, "delta", types.ModuleType("delta"))
    monkeypatch.setitem(sys.modules, "delta.tables", module)
    delta_merge(spark, "/t", table(spark, (1, "a", "t0", 1), (None, "b", "t0", 2)), ["id"], ["created"])
    names = [c[0] for c in calls]
    assert names.index("createIfNotExists") < names.index("forPath") < names.index("merge")
    source, condition = next(c[1] for c in calls if c[0] == "merge")
    assert condition == "t.`id` = s.`id`" and source.count() == 1
    update = next(c[2] for c in calls if c[0] == "whenMatchedUpdate")
    assert "created" not in update["set"] and update["condition"] == "coalesce(s.`change_sequence` >= t.`change_sequence`, true)"


def by_day(spark, path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("value", T.StringType()), T.StructField("day", T.IntegerType())])
    return KeyedTable(spark, path, schema, ["id"], partition_by="day"), lambda *data: spark.createDataFrame(list(data), schema)


def test_rows_of_the_null_partition_stay(spark, tmp_path, rows):
    keyed, frame = by_day(spark, str(tmp_path / "null"))
    keyed.merge(frame((1, "a", None), (2, "b", None), (3, "c", 7)), (), None)
    keyed.merge(frame((4, "d", None)), (), None)
    assert rows(keyed.read()) == [(1, "a", None), (2, "b", None), (3, "c", 7), (4, "d", None)]
    keyed.merge(frame((1, "A", None), (3, "C", 7)), (), None)  # known keys are met there, not added again
    assert rows(keyed.read()) == [(1, "A", None), (2, "b", None), (3, "C", 7), (4, "d", None)]


def test_retracted_groups_go(spark, tmp_path, rows):
    keyed, frame = by_day(spark, str(tmp_path / "retract"))
    keyed.merge(frame((1, "a", 5), (2, "b", 5), (3, "c", 6), (4, "d", None)), (), None)
    gone = spark.createDataFrame([(5,), (5,), (9,)], "day int")
    keyed.merge(frame((3, "C", 6)), (), None, whole="day", retract=gone)
    assert rows(keyed.read()) == [(3, "C", 6), (4, "d", None)]
    keyed.merge(frame(), (), None, whole="day", retract=spark.createDataFrame([(None,)], "day int"))
    assert rows(keyed.read()) == [(3, "C", 6)]
    with pytest.raises(ValueError):
        keyed.merge(frame(), (), None, retract=gone)
