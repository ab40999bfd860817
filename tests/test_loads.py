import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_plans import TRAFFIC, ecom_inputs, hub, reading, retail_inputs
from tidemark.plans import loads, targets
from tidemark.plans import places as placing
from tidemark.plans.places import Places
from tidemark.session import setting


def at(day):
    return dt.datetime(2024, 1, day)


@pytest.fixture
def root(spark, tmp_path):
    targets.create_targets(spark, str(tmp_path / "lake"))
    yield str(tmp_path / "lake")
    for target in targets.TARGETS:
        spark.sql(f"drop table if exists {target.table}")


def test_targets_are_registered_with_layer_and_partitions(spark, root):
    for target in targets.TARGETS:
        assert spark.table(target.table).count() == 0
        shown = {r[0]: r[1] for r in spark.sql(f"show tblproperties {target.table}").collect()}
        assert shown["layer"] == target.layer
    parts = [c.name for c in spark.catalog.listColumns("slv_retail_sales.dtl_retail_sales") if c.isPartition]
    assert parts == ["batch_id", "rec_create_date_key"]
    assert [c.name for c in spark.catalog.listColumns(targets.STORE_METRICS.table) if c.isPartition] == ["month_key"]


def test_silver_to_gold(spark, root, rows, monkeypatch):
    """Two sales loads and the visits feed the gold table, which waits for them."""
    items, order_log, stores, currency, product = ecom_inputs(spark)
    items = items.withColumn("rec_update_timestamp", F.lit(at(1)).cast("timestamp"))
    sales, upcref, *_ = retail_inputs(spark, [(9, 1, "S1"), (9, 2, "S2")])
    sales = sales.withColumns({"rec_update_timestamp": F.lit(at(2)).cast("timestamp"), "sl_price": F.lit(Decimal("3")).cast("decimal(20,6)")})
    store = spark.createDataFrame([(1, None, None), (2, None, None)], "store_rhid int, store_open_date date, store_close_date date")
    masters = store, spark.createDataFrame([(7, 1)], "product_rhid int, product_line_rhid int"), spark.createDataFrame(
        [(1, "FOOTWEAR", "4")], "product_line_rhid int, product_line_desc string, product_line_code string"
    )
    upstream = ["ecom", "retail", "visits"]

    loads.load_ecom_sales(spark, root, "ecom", items, order_log, stores, currency, product, now=at(5))
    assert loads.load_metrics(spark, root, "gold", *masters, upstream=upstream, now=at(6)) is None
    # A failing load leaves its folder half done and its row open; the repeat replaces it.
    real = loads.append_batch

    def torn(df, *args, **kwargs):
        real(df.limit(1), *args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "append_batch", torn)
    with pytest.raises(RuntimeError):
        loads.load_retail_sales(spark, root, "retail", sales, upcref, stores, product, now=at(5))
    monkeypatch.setattr(loads, "append_batch", real)
    loads.load_retail_sales(spark, root, "retail", sales, upcref, stores, product, now=at(6))
    spark.catalog.refreshTable(targets.RETAIL_SALES.table)
    fact = spark.table(targets.RETAIL_SALES.table)
    assert rows(fact, "order_channel_code", "order_id", "order_item_id") == [
        ("ECOM", 1, 1), ("ECOM", 1, 2), ("RETAIL", 9, 1), ("RETAIL", 9, 2),
    ]

    traffic = spark.createDataFrame([("S1", dt.date(2021, 5, 1), 20210501, 40, 1, at(2))], TRAFFIC)
    loads.load_visits(spark, root, "visits", traffic, stores, now=at(6))
    done = loads.load_metrics(spark, root, "gold", *masters, upstream=upstream, now=at(7))
    assert done.input_rows == 4
    spark.catalog.refreshTable(targets.STORE_METRICS.table)
    gold = spark.table(targets.STORE_METRICS.table)
    got = rows(gold, "date_key", "store_rhid", "total_visit_count", "total_transaction_count", "footwear_transaction_count")
    assert got == [(20210501, 1, 40, 3, 2), (20210501, 2, None, 1, 1)]
    again = loads.load_metrics(spark, root, "gold", *masters, upstream=upstream, now=at(8))
    assert again.input_rows == 0 and spark.table(targets.STORE_METRICS.table).count() == 2


def sold(spark, order, item, store, day, loaded, qty, channel="ECOM"):
    """One row of the sales fact."""
    values = {
        "order_id": order, "order_item_id": item, "order_channel_code": channel, "store_rhid": store,
        "order_date_key": day, "product_rhid": 7, "sales_qty": qty, "rec_update_timestamp": at(loaded),
    }
    return spark.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in targets.RETAIL_SALES.schema.fields if f.name != "rec_create_date_key"],
        F.lit(20240100 + loaded).alias("rec_create_date_key"),
    )


def test_gold_has_one_row_per_store_day(spark, root, rows):
    """Two loads feed one store-day; a changed item counts once, and on its new day and store only."""
    store = spark.createDataFrame([(1, None, None), (2, None, None)], "store_rhid int, store_open_date date, store_close_date date")
    masters = store, spark.createDataFrame([(7, 1)], "product_rhid int, product_line_rhid int"), spark.createDataFrame(
        [(1, "FOOTWEAR", "4")], "product_line_rhid int, product_line_desc string, product_line_code string"
    )
    target = targets.RETAIL_SALES

    def land(*facts):
        for n, fact in enumerate(facts):
            fact.write.mode("append").partitionBy("rec_create_date_key").parquet(f"{target.path(root)}/batch_id={n}")

    def gold(now):
        loads.load_metrics(spark, root, "gold", *masters, now=at(now))
        table = spark.read.schema(targets.STORE_METRICS.schema).parquet(targets.STORE_METRICS.path(root))
        return rows(table, "date_key", "store_rhid", "total_transaction_count", "total_sales_quantity")

    land(sold(spark, 1, 1, 1, 20240101, 3, 5), sold(spark, 2, 1, 1, 20240102, 3, 1), sold(spark, 3, 1, 2, 20240102, 3, 4))
    land(sold(spark, 9, 1, 1, 20240101, 3, 2, "RETAIL"), sold(spark, 9, 1, 1, 20240101, 3, 2, "RETAIL"))
    assert gold(4) == [(20240101, 1, 3, 9), (20240102, 1, 1, 1), (20240102, 2, 1, 4)]
    land(sold(spark, 4, 1, 1, 20240101, 5, 10), sold(spark, 2, 1, 2, 20240103, 5, 7))
    assert gold(6) == [(20240101, 1, 4, 19), (20240102, 2, 1, 4), (20240103, 2, 1, 7)]
    assert gold(7) == gold(8)


def test_visit_days_are_recomputed_whole(spark, root, rows):
    stores = hub(spark, {"S1": 1}, "store")
    first = [reading("S1", 1, 5, 1), reading("S1", 2, 4, 2)]
    loads.load_visits(spark, root, "visits", spark.createDataFrame(first, TRAFFIC), stores, now=at(3))
    late = [*first, reading("S1", 1, 6, 9)]
    loads.load_visits(spark, root, "visits", spark.createDataFrame(late, TRAFFIC), stores, now=at(10))
    spark.catalog.refreshTable(targets.STORE_VISITS.table)
    got = rows(spark.table(targets.STORE_VISITS.table), "visit_date_key", "entry_count", "rec_create_date_key")
    assert got == [(20240101, 11, 20240103), (20240102, 4, 20240103)]


def test_gold_opens_only_the_load_dates_of_touched_days(spark, root, rows):
    """A load is right though the folder of every other load date holds no readable file."""
    store = spark.createDataFrame([(1, None, None), (2, None, None)], "store_rhid int, store_open_date date, store_close_date date")
    masters = store, spark.createDataFrame([(7, 1)], "product_rhid int, product_line_rhid int"), spark.createDataFrame(
        [(1, "FOOTWEAR", "4")], "product_line_rhid int, product_line_desc string, product_line_code string"
    )
    path = targets.RETAIL_SALES.path(root)

    def land(n, *facts):
        for fact in facts:
            fact.write.mode("append").partitionBy("rec_create_date_key").parquet(f"{path}/batch_id={n}")

    def gold(now):
        loads.load_metrics(spark, root, "gold", *masters, now=at(now))
        table = spark.read.schema(targets.STORE_METRICS.schema).parquet(targets.STORE_METRICS.path(root))
        return rows(table, "date_key", "store_rhid", "total_transaction_count", "total_sales_quantity")

    land(0, sold(spark, 1, 1, 1, 20240101, 3, 5))
    land(1, sold(spark, 5_000_000, 1, 2, 20240102, 5, 4), sold(spark, 9, 1, 2, 20240102, 5, 1, "RETAIL"))
    land(2, sold(spark, 3, 1, 1, None, 7, 3))
    assert gold(8) == [(20240101, 1, 1, 5), (20240102, 2, 2, 5), (None, 1, 1, 3)]
    # What the next load does not need can no longer be read.
    for file in Path(path, "batch_id=1").rglob("*.parquet"):
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    # An item moves off its day, and one without a day gets another quantity.
    land(3, sold(spark, 1, 1, 2, 20240110, 10, 6), sold(spark, 3, 1, 1, None, 10, 8))
    assert gold(11) == [(20240102, 2, 2, 5), (20240110, 2, 1, 6), (None, 1, 1, 8)]
    places = Places(spark, f"{targets.STORE_METRICS.path(root)}.places", spark.createDataFrame([], targets.RETAIL_SALES.schema))
    assert rows(places.days(), "order_date_key", "rec_create_date_key", "order_block") == [
        (20240101, 20240103, 0), (20240102, 20240105, 5), (20240102, 20240105, None), (20240110, 20240110, 0), (None, 20240107, 0), (None, 20240110, 0),
    ]
    assert rows(places.items(), "order_id", "rec_create_date_key") == [(1, 20240103), (1, 20240110), (3, 20240107), (3, 20240110), (5_000_000, 20240105)]


def test_places_prune_partitions_and_repair_a_torn_piece(spark, tmp_path, monkeypatch):
    """The lines and stamps of a day come from its load dates and blocks; a piece that broke off is written again."""
    fact = sold(spark, 1, 1, 1, 20240101, 3, 5).union(sold(spark, 2_000_000, 1, 1, 20240102, 4, 5)).union(sold(spark, 1, 1, 1, 20240103, 5, 5))
    fact.write.partitionBy("rec_create_date_key").parquet(str(tmp_path / "fact"))
    fact = spark.read.schema(targets.RETAIL_SALES.schema).parquet(str(tmp_path / "fact"))
    places = Places(spark, str(tmp_path / "places"), fact)
    real = placing.append_batch

    def torn(df, path, *args, **kwargs):
        real(df.limit(1), path, *args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(placing, "append_batch", torn)
    with pytest.raises(RuntimeError):
        places.extend(at(9))
    monkeypatch.setattr(placing, "append_batch", real)
    assert places.covered() is None
    places.extend(at(9))
    assert places.items().count() == 3 and places.covered() == at(9)
    moved = places.standing_lines(spark.createDataFrame([(20240101,)], "_day int"))
    assert moved.count() == 0  # the item stands on the third by now
    lines = places.standing_lines(spark.createDataFrame([(20240102,)], "_day int"))
    assert lines.count() == 1
    plan = lines._jdf.queryExecution().toString()
    assert "rec_create_date_key" in plan and "20240104" in plan.split("PartitionFilters")[1]
    assert all("PartitionFilters: []" not in line for line in plan.splitlines() if "FileScan" in line)


def test_lines_with_the_newest_stamp_of_their_block_are_not_exchanged(spark, rows, tmp_path):
    """Lines meet the stamps of their items only where a newer load is in their block; all forms of lines are judged as before."""
    none = spark.createDataFrame([], targets.RETAIL_SALES.schema)
    first = [sold(spark, 1, 1, 1, 20240101, 3, 5), sold(spark, 2, 1, 1, 20240101, 3, 6), sold(spark, 2_000_000, 1, 1, 20240101, 3, 7)]
    later = [sold(spark, 1, 1, 1, 20240101, 5, 8), sold(spark, 1, 1, 1, 20240101, 5, 8), sold(spark, 9, 1, 1, 20240101, 3, 2, "RETAIL")]
    fact = none
    for line in (*first, *later):
        fact = fact.union(line)
    unstamped = sold(spark, 2, 1, 1, 20240101, 3, 9).withColumn("rec_update_timestamp", F.lit(None).cast("timestamp"))
    stranger = unstamped.withColumn("order_item_id", F.lit(5).cast(fact.schema["order_item_id"].dataType))
    wanted = [("ECOM", 1, 8), ("ECOM", 1, 8), ("ECOM", 2, 6), ("ECOM", 2_000_000, 7), ("RETAIL", 9, 2)]
    for name, table, more in (("some", fact, []), ("bare", fact.union(unstamped).union(stranger), [("ECOM", 2, 9)])):
        table.write.partitionBy("rec_create_date_key").parquet(str(tmp_path / name))
        stored = spark.read.schema(targets.RETAIL_SALES.schema).parquet(str(tmp_path / name))
        places = Places(spark, str(tmp_path / f"{name}.places"), stored)
        places.extend(at(9))
        lines = places.standing_lines(spark.createDataFrame([(20240101,)], "_day int"))
        assert rows(lines, "order_channel_code", "order_id", "sales_qty") == sorted([*wanted, *more])
    moved = places.days_of_items(stored.where("rec_update_timestamp > timestamp '2024-01-04'"), at(4))
    assert moved.distinct().count() == 1
    assert places.days_of_items(stored, at(2)).isEmpty()
    # One load alone: no line is in doubt, none goes to another task.
    table = spark.range(5000).selectExpr("cast(id as int) order_id", "1 order_item_id", "id % 2 = 0 as even").join(
        sold(spark, 1, 1, 1, 20240101, 3, 5).drop("order_id", "order_item_id")
    ).drop("even")
    names = targets.RETAIL_SALES.schema.names
    table.select(*names).write.partitionBy("rec_create_date_key").parquet(str(tmp_path / "one"))
    stored = spark.read.schema(targets.RETAIL_SALES.schema).parquet(str(tmp_path / "one"))
    places = Places(spark, str(tmp_path / "one.places"), stored)
    places.extend(at(9))
    lines = places.standing_lines(spark.createDataFrame([(20240101,)], "_day int"))
    assert lines.count() == 5000
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = lines._jdf.queryExecution().executedPlan().toString()
    kept = plan[: plan.index("LeftAnti")]
    assert "Exchange hashpartitioning(order_id" not in kept
