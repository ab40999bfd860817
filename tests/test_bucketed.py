"""Bucketed tables, the interval sweep and decoding by writer schema."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import envelope, lookup
from tidemark.operators.bucketed import BucketedTable
from tidemark.session import setting

SCHEMA = T.StructType().add("id", T.LongType()).add("value", T.StringType()).add("created", T.StringType()).add("seq", T.IntegerType())


@pytest.fixture
def bucketed(spark):
    table = BucketedTable(spark, "kept_by_bucket", SCHEMA, ["id"], buckets=5)
    table.drop()
    yield table, lambda *data: spark.createDataFrame(list(data), SCHEMA)
    table.drop()


def test_generations_batches_and_the_view(spark, bucketed, rows):
    table, frame = bucketed
    assert table.read().count() == 0
    assert table.merge(frame((1, "a", "t0", 1), (2, "b", "t0", 5), (None, "x", "t0", 1)), ["created"], "seq", "one") == 1
    source = frame((2, "old", "t1", 4), (1, None, "t1", 2), (3, "c", "t1", 1))
    assert table.merge(source, ["created"], "seq", "it's two") == 2
    want = [(1, None, "t0", 2), (2, "b", "t0", 5), (3, "c", "t1", 1)]
    assert rows(table.read()) == rows(spark.table("kept_by_bucket")) == want
    assert table.merge(source, ["created"], "seq", "it's two") == 2  # in place already
    with pytest.raises(ValueError):
        table.merge(frame((4, "d", "t2", 1), (4, "e", "t2", 1)), ["created"], "seq", "three")
    assert table.merge(frame((4, "d", "t2", 1)), ["created"], "seq", "three") == 3
    assert not spark.catalog.tableExists("kept_by_bucket__g1") and spark.catalog.tableExists("kept_by_bucket__g2")
    assert rows(spark.table("kept_by_bucket")) == [*want, (4, "d", "t2", 1)]


def test_a_merge_exchanges_the_source_alone(spark, bucketed):
    table, frame = bucketed
    table.merge(spark.range(200).select("id", F.lit("v").alias("value"), F.lit("t").alias("created"), F.lit(1).alias("seq")), (), "seq", "one")
    with setting(spark, "spark.sql.shuffle.partitions", "5"), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = table.merged(frame((1, "w", "t", 2)), (), "seq")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 1
    scan = plan[: plan.index("FileScan parquet")].splitlines()
    above = [line for line in scan[scan.index(next(x for x in scan if "SortMergeJoin" in x)) :]]
    assert not any("Exchange" in line for line in above), plan  # the target is the join's first child
    files = table.read().select(F.input_file_name().alias("f"), F.expr("pmod(hash(id), 5)").alias("b")).distinct().groupBy("f").count()
    assert files.where("count > 1").isEmpty()


HUB = "hub_code string, effective_start_timestamp timestamp, effective_end_timestamp timestamp, rhid int"


def versions(spark, text):
    data = [tuple(line.split()) for line in text.strip().splitlines()]
    return spark.createDataFrame(data, "c string, s string, e string, r string").selectExpr(
        "c as hub_code", "cast(s as timestamp) as effective_start_timestamp", "cast(e as timestamp) as effective_end_timestamp", "cast(r as int) as rhid"
    )


@pytest.mark.parametrize("slices", [[], ["2020-01-01", "2020-01-15", "2021-01-01"]])
@pytest.mark.parametrize("closed", ["both", "left"])
def test_sweep_is_the_range_join(spark, rows, closed, slices):
    """Gaps, ends that are met exactly, versions over several slices, unknown codes, repeated facts."""
    hub = versions(spark, "a 2019-01-01 2020-01-10 1\na 2020-02-01 2020-02-10 2\na 2020-02-11 2099-01-01 3\nb 2020-01-15 2020-01-15 4\nc 2021-01-01 2020-01-01 5")
    facts = [(i, c, f"2020-{m:02d}-{d:02d}") for i, (c, m, d) in enumerate([(c, m, d) for c in "abcd" for m in (1, 2) for d in (1, 10, 11, 15, 20)])]
    fact = spark.createDataFrame([*facts, facts[0], (90, None, "2020-01-01"), (91, "a", None), (92, "a", "2018-01-01"), (93, "a", "2099-01-01")], "id int, code string, t string")
    fact = fact.withColumn("t", F.col("t").cast("timestamp"))
    got = lookup.interval_sweep(fact, hub, "code", "t", {"rhid": "found"}, closed, slices)
    assert rows(got) == rows(lookup.effective_join(fact, hub, "code", "t", {"rhid": "found"}, closed))
    with pytest.raises(ValueError):
        lookup.interval_sweep(fact, hub, "code", "t", ["rhid"], "right")


def test_sweep_of_a_hot_code_is_linear_and_has_no_join(spark):
    """3,000 versions and 30,000 facts of one code: each fact meets one version, in slices of their own tasks."""
    day = F.expr("timestamp '2000-01-01' + make_dt_interval(cast(id as int))")
    hub = spark.range(3000).select(F.lit("hot").alias("hub_code"), day.alias(lookup.START), F.expr("timestamp '2000-01-01 23:59:59' + make_dt_interval(cast(id as int))").alias(lookup.END), F.col("id").alias("rhid"))
    fact = spark.range(30_000).select("id", F.lit("hot").alias("code"), F.expr("timestamp '2000-01-01 12:00:00' + make_dt_interval(cast(id % 3000 as int))").alias("t"))
    got = lookup.interval_sweep(fact, hub, "code", "t", ["rhid"], slices=["2002-01-01", "2004-01-01", "2006-01-01"])
    assert got.where("rhid = id % 3000").count() == 30_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(_code" in plan and "_slice" in plan


def test_decoding_by_writer_keeps_everything(spark):
    inner = T.StructType().add("a", T.IntegerType())
    reader = T.StructType().add("id", T.LongType()).add("amount", T.DecimalType(10, 2)).add("data", inner)
    writers = {1: T.StructType().add("id", T.StringType()).add("amount", T.StringType()), 2: T.StructType().add("id", T.LongType()).add("data", T.StructType().add("a", T.LongType()))}

    def sent(number, text):
        return b"\x00" + number.to_bytes(4, "big") + (text if isinstance(text, bytes) else text.encode())

    frames = [
        sent(1, '{"id": "5", "amount": "1.50"}'), sent(2, '{"id": 6, "data": {"a": 7, "b": [1]}, "amount": "2"}'), sent(1, '{"id": "x", "amount": null}'),
        sent(2, '{"id": 8, "data": 3}'), sent(2, '{"id": 9, "data": {"a": 99999999999}}'), sent(3, "{}"), sent(1, '{"id": '), sent(1, "[1]"), sent(1, b'{"id": "\xff"}'), b"\x00\x01", None, b"\x01\x00\x00\x00\x01{}",
    ]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(frames)], "n int, value binary")
    got = envelope.decode_by_writer(df, writers, reader, keep=("n",)).orderBy("n").select("data.id", "data.amount", "data.data.a", "rescued", "error", "raw").collect()
    text = lambda r: (r["id"], None if r["amount"] is None else str(r["amount"]), r["a"], r["rescued"])
    assert [text(r) for r in got[:5]] == [
        (5, "1.50", None, None), (6, None, 7, '{"amount":"\\"2\\"","data.b":"[1]"}'), (None, None, None, '{"id":"\\"x\\""}'),
        (8, None, None, '{"data":"3"}'), (9, None, None, '{"data.a":"99999999999"}'),
    ]
    assert [r["error"] for r in got] == [None] * 5 + ["schema", "payload", "payload", "payload", "frame", "frame", "frame"]
    assert [r["raw"] for r in got[:5]] == [None] * 5 and [None if r["raw"] is None else bytes(r["raw"]) for r in got[5:]] == frames[5:]
