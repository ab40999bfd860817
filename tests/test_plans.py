import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.lookup import hub_code, lookup_hub
from tidemark.plans import hierarchy, metrics, sales_ecom, sales_retail, visits
from tidemark.schemas import AGG_STORE_METRICS_DAILY, DTL_RETAIL_SALES, PRODUCT_LINES
from tidemark.session import setting

NOW = "2024-02-01 10:11:12"
FOREVER = (dt.datetime(1900, 1, 1), dt.datetime(9999, 1, 1))
SPAN = "effective_start_timestamp timestamp, effective_end_timestamp timestamp"


def day(text):
    return dt.date.fromisoformat(text)


def hub(spark, keys, name, versions=()):
    """keys: {code: rhid}; versions: (code, rhid, start, end)."""
    listed = [(3, "POS", f"{c}_3", r, f"{name[0]}{r}", *FOREVER) for c, r in keys.items()]
    listed += [(3, "POS", f"{c}_3", r, f"{name[0]}{r}", s, e) for c, r, s, e in versions]
    schema = (
        "source_system_id int, source_system_name string, source_system_natural_key string,"
        f" {name}_rhid int, {name}_grpid string, {SPAN}"
    )
    return spark.createDataFrame(listed, schema).withColumn("hub_code", hub_code())


def test_hub_lookup_filters_by_table_and_system(spark, rows):
    src = spark.createDataFrame(
        [(3, "A_3", "G1", "MST_STORE"), (4, "A_4", "G1", "MST_STORE"), (3, "P_3", "G1", "MST_PRODUCT")],
        "source_system_id int, source_system_natural_key string, grpid string, ref_hub_table_name string",
    )
    systems = spark.createDataFrame([(3, "POS"), (4, "WEB")], "source_system_id int, source_system_name string")
    master = spark.createDataFrame([(1, "G1", *FOREVER), (2, "G1", *FOREVER)], f"store_rhid int, store_grpid string, {SPAN}")
    got = lookup_hub(src, systems, master, "MST_STORE", "store_grpid", ["store_rhid"], "POS")
    assert rows(got, "hub_code", "store_rhid") == [("A", 1), ("A", 2)]
    every = lookup_hub(src, systems, master, "MST_STORE", "store_grpid", ["store_rhid"])
    assert every.count() == 4


def ecom_inputs(spark, items=((1, 1, "sku", "S2"), (1, 2, "nope", None))):
    lines = spark.createDataFrame(
        [(o, i, sku, ship, 2, Decimal("9.5"), dt.datetime(2021, 7, 1, 12)) for o, i, sku, ship in items],
        "order_id int, id int, sku_number string, ship_store_num string, quantity int, unit_price decimal(20,6),"
        " charge_timestamp timestamp",
    )
    log = spark.createDataFrame(
        [(1, "S1", "USD", dt.datetime(2021, 5, 1))],
        "order_id int, store_num string, currency_code string, order_timestamp timestamp",
    )
    return lines, log, hub(spark, {"S1": 1, "S2": 2}, "store"), hub(spark, {"USD": 5}, "currency"), hub(spark, {"sku": 7}, "product")


def test_ecom_fact_has_the_table_type_and_lookups(spark):
    got = sales_ecom.ecom_sales(*ecom_inputs(spark), "job", NOW)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in DTL_RETAIL_SALES]
    first, second = got.orderBy("order_item_id").collect()
    assert (first["store_rhid"], first["ship_store_rhid"], first["currency_rhid"], first["product_rhid"]) == (1, 2, 5, 7)
    assert (second["ship_store_rhid"], second["product_rhid"]) == (None, None)
    assert first["order_channel_code"] == "ECOM" and first["tax_type3_code"] == "VAT"
    assert first["charge_timestamp"] == dt.datetime(2021, 7, 1, 19)
    assert (first["order_date_key"], first["rec_create_date_key"], first["rec_create_time_key"]) == (20210501, 20240201, 1011)


def test_ecom_by_branch_equals_the_single_pass(spark, rows):
    inputs = ecom_inputs(spark, [(1, i, "sku" if i % 2 else None, f"S{i % 3}") for i in range(12)])
    assert rows(sales_ecom.ecom_sales(*inputs, "j", NOW)) == rows(sales_ecom.ecom_sales_by_branch(*inputs, "j", NOW))


@pytest.mark.parametrize("closed", ["both", "left"])
def test_large_hubs_are_carried_with_the_same_rows_and_lines_move_once_after_their_header(spark, rows, closed):
    middle = dt.datetime(2021, 5, 1)
    lines, log, stores, currency, _ = ecom_inputs(spark, [(1, i, f"sku{i % 4}" if i % 3 else None, f"S{i % 3}") for i in range(24)])
    gone = [("sku1", 1, FOREVER[0], middle), ("sku1", 2, middle, FOREVER[1]), ("sku2", 3, FOREVER[0], dt.datetime(2020, 1, 1))]
    many = [("sku3", 10 + n, dt.datetime(2000 + n, 1, 1), dt.datetime(2001 + n, 1, 1)) for n in range(30)]
    products = hub(spark, {"sku0": 9}, "product", gone + many)
    inputs = lines, log.union(log.selectExpr("2", "null", "null", "null")), stores, currency, products
    wanted = rows(sales_ecom.ecom_sales(*inputs, "j", NOW, closed))
    assert rows(sales_ecom.ecom_sales(*inputs, "j", NOW, closed, limit=0)) == wanted
    assert rows(sales_ecom.ecom_sales_by_branch(*inputs, "j", NOW, closed, limit=0)) == wanted
    few = hub(spark, {"sku": 7}, "product")
    plan = sales_ecom.ecom_sales(*inputs[:4], few, "j", NOW, limit=0)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("SortMergeJoin [order_id")]
    assert "Exchange" not in above
    plan = sales_ecom.ecom_sales_by_branch(*inputs[:4], few, "j", NOW)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(order_id#" in plan and not re.search(r"Exchange hashpartitioning\(order_id#\d+, order_item_id", plan)


def test_touching_store_versions_fan_out_unless_half_open(spark):
    lines, log, _, currency, product = ecom_inputs(spark, [(1, 1, "sku", None)])
    middle = dt.datetime(2021, 5, 1)
    stores = hub(spark, {}, "store", [("S1", 1, FOREVER[0], middle), ("S1", 2, middle, FOREVER[1])])
    closed = sales_ecom.ecom_sales(lines, log, stores, currency, product, "j", NOW)
    half_open = sales_ecom.ecom_sales(lines, log, stores, currency, product, "j", NOW, closed="left")
    assert sorted(r["store_rhid"] for r in closed.collect()) == [1, 2]
    assert [r["store_rhid"] for r in half_open.collect()] == [2]


def retail_inputs(spark, sales):
    schema = (
        "sl_inv_num int, sl_tran int, sl_store string, sl_date date, sl_time string, sl_seq int, sl_size_id string,"
        " sl_qty int"
    )
    frame = spark.createDataFrame([(*s, day("2021-05-01"), "12:30 pm", 1, "M", 2) for s in sales], schema)
    upcref = spark.createDataFrame([(1, "M", "sku")], "up_seq int, up_size string, up_code string")
    return frame, upcref, hub(spark, {"S1": 1, "S2": 2}, "store"), hub(spark, {"sku": 7}, "product")


def retail(spark, sales, **how):
    return sales_retail.retail_sales(*retail_inputs(spark, sales), "job", NOW, **how)


def test_retail_line_with_product_store_and_clock(spark):
    row = retail(spark, [(1, 1, "S1")], system="POS").first()
    assert (row["store_rhid"], row["product_rhid"], row["order_channel_code"]) == (1, 7, "RETAIL")
    assert row["order_timestamp"] == dt.datetime(2021, 5, 1, 19, 30)
    assert retail(spark, [(1, 1, "S1")], system="WEB").first()["product_rhid"] is None


def test_retail_products_beyond_the_limit_meet_the_size_codes(spark, rows):
    sales, upcref, stores, _ = retail_inputs(spark, [(1, 1, "S1"), (2, 1, "S2"), (3, 1, None)])
    at = dt.datetime(2021, 5, 1)
    gone = ("old", 3, FOREVER[0], dt.datetime(2020, 1, 1))
    products = hub(spark, {}, "product", [("sku", 1, FOREVER[0], at), ("sku", 2, at, FOREVER[1]), gone])
    codes = upcref.union(upcref.selectExpr("1", "'M'", "'old'")).union(upcref.selectExpr("1", "'M'", "null"))
    for how in ("keyed", "line"):
        found = [sales_retail.retail_sales(sales, codes, stores, products, "j", NOW, "POS", how, limit=n) for n in (1 << 20, 0)]
        assert rows(found[0]) == rows(found[1]) and found[1].where("product_rhid = 2").count() == 3
    joins = re.findall("Join LeftOuter, (.*)", found[1]._jdf.queryExecution().optimizedPlan().toString())
    lines, codes = ([i for i, on in enumerate(joins) if c in on] for c in ("up_seq", "up_code"))
    assert max(lines) < min(codes)  # the plan is written from its last join to its first


def test_retail_exact_duplicates_collapse(spark):
    for how in ("keyed", "line"):
        assert retail(spark, [(1, 1, "S1")] * 3, assembly=how).count() == 1


def test_retail_shared_invoices_pair_up_only_when_keyed(spark, rows):
    sales = [(1, 1, "S1"), (1, 1, "S2"), (2, 1, "S1")]
    keyed = retail(spark, sales)
    line = retail(spark, sales, assembly="line")
    assert rows(keyed, "order_id", "store_rhid") == [(1, 1), (1, 2), (2, 1)]
    assert rows(line, "order_id", "store_rhid") == [(1, 1), (1, 2), (2, 1)]
    sales = retail_inputs(spark, sales)
    priced = sales[0].withColumn("sl_price", F.when(F.col("sl_store") == "S1", 1).otherwise(2).cast("decimal(20,6)"))
    counts = [
        sales_retail.retail_sales(priced, *sales[1:], "job", NOW, assembly=a).count() for a in ("keyed", "line")
    ]
    assert counts == [5, 3]


def test_retail_null_invoice_survives_only_per_line(spark):
    sales = [(None, 1, "S1"), (1, 1, None)]
    assert retail(spark, sales, assembly="keyed").count() == 1
    assert retail(spark, sales, assembly="line").count() == 2
    with pytest.raises(ValueError):
        retail(spark, sales, assembly="other")


TRAFFIC = "store_number string, visit_date date, visit_date_key int, entries int, exits int, rec_update_timestamp timestamp"


def reading(store, d, entries, updated):
    return (store, day(f"2024-01-{d:02d}"), 20240100 + d, entries, 1, dt.datetime(2024, 1, updated))


def test_visits_sum_per_store_and_unmapped_share_a_row(spark, rows):
    traffic = spark.createDataFrame(
        [reading("S1", 1, 5, 1), reading("S1", 1, 6, 1), reading("X", 1, 7, 1), reading("Y", 1, 8, 1)], TRAFFIC
    )
    got = visits.store_visits(traffic, hub(spark, {"S1": 1}, "store"))
    assert rows(got, "store_rhid", "store_grpid", "entry_count", "exit_count") == [(-1, None, 15, 2), (1, "s1", 11, 2)]


def test_a_day_sent_again_in_part_keeps_its_full_total(spark, rows):
    first = [reading("S1", 1, 5, 1), reading("S1", 2, 4, 2)]
    late = [*first, reading("S1", 1, 6, 9)]
    hubs = hub(spark, {"S1": 1}, "store")
    target = visits.stamped_visits(visits.store_visits(spark.createDataFrame(first, TRAFFIC), hubs), "one", "2024-01-03")
    changed = F.col("rec_update_timestamp") >= F.lit("2024-01-09").cast("timestamp")
    again = visits.store_visits(spark.createDataFrame(late, TRAFFIC), hubs, changed)
    assert rows(again, "visit_date_key", "entry_count") == [(20240101, 11)]
    merged = visits.merge_visits(target, visits.stamped_visits(again, "two", "2024-01-09"))
    got = {r["visit_date_key"]: r for r in merged.collect()}
    assert [got[k]["entry_count"] for k in (20240101, 20240102)] == [11, 4]
    assert (got[20240101]["rec_create_user_name"], got[20240101]["rec_update_user_name"]) == ("one", "two")
    assert got[20240101]["rec_create_date_key"] == 20240103


def gold_inputs(spark):
    sales = spark.createDataFrame(
        [(1, 1, 20240101, 7, 2, 10), (2, 1, 20240101, 8, 3, 20), (3, None, 20240101, None, 1, 5), (None, 2, 20240102, 9, 4, 1)],
        "order_id int, store_rhid int, order_date_key int, product_rhid int, sales_qty int, p int",
    ).withColumn("unit_price_amt", F.col("p").cast("decimal(20,6)")).drop("p")
    for tax in metrics.TAXES:
        sales = sales.withColumn(tax, F.lit(None if tax.endswith("4_amt") else 1).cast("decimal(20,6)"))
    store = spark.createDataFrame(
        [(1, day("2000-01-01"), None), (2, day("2001-01-01"), day("2002-01-01"))],
        "store_rhid int, store_open_date date, store_close_date date",
    )
    seen = spark.createDataFrame(
        [(1, 20240101, 100), (1, 20240102, 50), (-1, 20240101, 9)], "store_rhid int, visit_date_key int, entry_count int"
    )
    product = spark.createDataFrame([(7, 1), (8, 2), (8, 2), (9, 4)], "product_rhid int, product_line_rhid int")
    lines = spark.createDataFrame(
        [(1, "FOOTWEAR", "4"), (2, "APPAREL", "2"), (3, "ACCESSORIES", "x"), (4, "OTHER", "1")],
        "product_line_rhid int, product_line_desc string, product_line_code string",
    )
    return sales, store, seen, product, lines


def fanned_out(sales, store, seen, product, lines):
    """The metrics computed over the really multiplied lines."""
    known = lines.where(F.col("product_line_desc").isin(*PRODUCT_LINES) & F.col("product_line_code").isin("1", "2", "4"))
    wide = (
        sales.withColumn("key", F.coalesce("store_rhid", F.lit(-1)))
        .join(store.withColumnRenamed("store_rhid", "s"), F.col("key") == F.col("s"), "left")
        .join(seen.withColumnRenamed("store_rhid", "v"), F.col("s") == F.col("v"), "left")
        .join(product, "product_rhid", "left")
        .join(known, "product_line_rhid", "left")
    )
    shoes = (F.col("product_line_desc") == "FOOTWEAR") & (F.col("product_line_code") == "4")
    return wide.groupBy(F.col("order_date_key").alias("date_key"), F.col("key").alias("store_rhid")).agg(
        F.sum("entry_count").alias("total_visit_count"),
        F.count("order_id").alias("total_transaction_count"),
        F.sum("sales_qty").alias("total_sales_quantity"),
        F.sum("unit_price_amt").cast("decimal(20,6)").alias("total_sales_usd_amount"),
        F.count(F.when(shoes, 1)).alias("footwear_transaction_count"),
        F.max("store_close_date").alias("latest_close_date"),
    )


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_metrics_by_store_equal_the_real_fan_out(spark, rows, limit):
    inputs = gold_inputs(spark)
    want = fanned_out(*inputs)
    got = metrics.store_metrics(*inputs, visits_grain="store", limit=limit)
    assert rows(got, *want.columns) == rows(want)


def test_lines_without_a_product_are_dealt_out_and_still_meet_the_unknown_one(spark, rows):
    """Products too many to broadcast, the unknown one among them twice: same sums, and no task has all lines without one."""
    sales, store, seen, product, lines = gold_inputs(spark)
    listed = product.unionByName(spark.createDataFrame([(-1, 1), (-1, 2)], product.schema))
    wanted = metrics.store_metrics(sales, store, seen, listed, lines)
    assert rows(metrics.store_metrics(sales, store, seen, listed, lines, limit=0)) == rows(wanted)
    many = spark.range(4000).select(
        F.lit(1).alias("store_rhid"), F.col("id").alias("date_key"), F.lit(-1).alias("product_rhid"), F.lit(1).alias("_lines")
    )
    products = metrics._product_lines(listed, lines)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        met = metrics._with_line(many, products)
        tasks = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(tasks) == 8000 and max(tasks) < 4000


def test_the_wide_form_of_the_metrics_is_not_held_for_all_store_days_of_a_task(spark):
    """One aggregation of the sales, by store, day and line; what is wide comes from a sort, and no wide row is sorted again."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = metrics.store_metrics(*gold_inputs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"HashAggregate\(keys=\[store_rhid#\d+, date_key#\d+\w*\]", plan)
    assert "ShuffledHashJoin" in plan and "Window" in plan


def test_metrics_by_day_count_a_day_once(spark):
    got = metrics.store_metrics(*gold_inputs(spark))
    by = {(r["store_rhid"], r["date_key"]): r for r in got.collect()}
    row = by[1, 20240101]
    assert (row["total_visit_count"], row["total_sales_quantity"], row["footwear_transaction_count"]) == (100, 8, 1)
    assert row["apparel_transaction_count"] == 2  # the product is listed twice
    assert row["total_tax_usd_amount"] == Decimal("9.000000")
    assert by[-1, 20240101]["total_visit_count"] is None
    assert by[2, 20240102]["total_transaction_count"] == 0
    with pytest.raises(ValueError):
        metrics.store_metrics(*gold_inputs(spark), visits_grain="week")


def test_metrics_table_type(spark):
    table = metrics.metrics_table(metrics.store_metrics(*gold_inputs(spark)), "job", NOW)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in AGG_STORE_METRICS_DAILY]
    assert table.count() == 3


def test_hierarchy_joins_all_seventeen_dimensions(spark):
    pointers = {on: i for i, on in enumerate(dict.fromkeys(on for _, on, _ in hierarchy.STORE_DIMENSIONS)) if on != "customer_currency_rhid"}
    store = spark.createDataFrame([(1, *pointers.values())], ["store_rhid", *pointers])
    tables = {
        name: spark.createDataFrame([(pointers.get(on, 77), name.upper())], [key, "name"])
        for name, on, key in hierarchy.STORE_DIMENSIONS
    }
    tables["customer"] = tables["customer"].withColumn("currency_rhid", F.lit(77))
    got = hierarchy.store_hierarchy(store, tables)
    assert len(hierarchy.STORE_DIMENSIONS) == 17
    assert len(set(got.columns)) == len(got.columns)
    row = got.first()
    assert all(row[f"{name}_name"] == name.upper() for name in tables)


def test_a_late_reading_of_one_unmapped_number_keeps_the_others(spark, rows):
    hubs = hub(spark, {"S1": 1}, "store")
    on, key = dt.date(2024, 1, 2), 20240102
    first = [("X", on, key, 40, 0, dt.datetime(2024, 1, 2)), ("Y", on, key, 60, 0, dt.datetime(2024, 1, 2))]
    late = [*first, ("X", on, key, 1, 0, dt.datetime(2024, 1, 9))]
    changed = F.col("rec_update_timestamp") > F.lit(dt.datetime(2024, 1, 5))
    target = visits.stamped_visits(visits.store_visits(spark.createDataFrame(first, TRAFFIC), hubs), "one", "2024-01-03")
    again = visits.stamped_visits(visits.store_visits(spark.createDataFrame(late, TRAFFIC), hubs, changed), "two", "2024-01-09")
    assert rows(visits.merge_visits(target, again), "store_rhid", "entry_count") == [(-1, 101)]
    mapped = hub(spark, {"S1": 1, "X": 2, "Y": 2}, "store")
    moved = visits.stamped_visits(visits.store_visits(spark.createDataFrame(late, TRAFFIC), mapped, changed), "two", "2024-01-09")
    assert rows(visits.merge_visits(target, moved), "store_rhid", "entry_count") == [(2, 101)]


def test_lines_that_lie_by_order_stay_there_whatever_the_hubs(spark, rows):
    """Bucketed items and headers: large hubs get codes, orders and times, and the wide lines are not exchanged."""
    lines, log, stores, currency, _ = ecom_inputs(spark, [(1, i % 9, f"sku{i % 4}" if i % 3 else None, f"S{i % 3}") for i in range(24)])
    middle = dt.datetime(2021, 5, 1)
    products = hub(spark, {"sku0": 9}, "product", [("sku1", 1, FOREVER[0], middle), ("sku1", 2, middle, FOREVER[1])])
    wanted = rows(sales_ecom.ecom_sales(lines, log, stores, currency, products, "j", NOW))
    landed = []
    for name, table in (("lines", lines), ("log", log)):
        table.write.format("parquet").mode("overwrite").bucketBy(4, "order_id").sortBy("order_id").saveAsTable(f"lying_{name}")
        landed.append(spark.table(f"lying_{name}"))
    try:
        for limit in (0, 64 << 20):
            with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
                found = sales_ecom.ecom_sales(*landed, stores, currency, products, "j", NOW, limit=limit, lying=True)
                plan = found._jdf.queryExecution().executedPlan().toString()
                assert rows(found) == wanted
            exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert not any("order_item_id" in line for line in exchanges)
            assert not re.search(r"Exchange hashpartitioning\(order_id#", plan)
    finally:
        for name in ("lines", "log"):
            spark.sql(f"drop table if exists lying_{name}")
