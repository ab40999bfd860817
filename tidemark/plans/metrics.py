"""Daily store metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.conform import as_table
from tidemark.functions.times import clock, load_stamp
from tidemark.operators.sizing import BROADCAST_LIMIT, measured_bytes
from tidemark.plans.visits import UNKNOWN_STORE
from tidemark.schemas import AGG_STORE_METRICS_DAILY, MONEY, PRODUCT_LINES

TAXES = ("tax_type1_amt", "tax_type2_amt", "tax_type3_amt", "tax_type4_amt")
GRAIN = ("store_rhid", "date_key")
UNKNOWN_PRODUCT = -1  # fixed value
ABSENT = ("return_quantity", "discount_usd_amount", "promo_usd_amount", "shipping_usd_amount")


def _zero(column: str, kind: str = "int") -> Column:
    return F.coalesce(F.col(column).cast(kind), F.lit(0).cast(kind))


def _measures(sales: DataFrame) -> DataFrame:
    """One row per sales line with the five quantities every metric sums."""
    tax = sum((_zero(t, "decimal(20,6)") for t in TAXES[1:]), _zero(TAXES[0], "decimal(20,6)"))
    return sales.select(
        F.coalesce("store_rhid", F.lit(UNKNOWN_STORE)).alias("store_rhid"),
        F.col("order_date_key").alias("date_key"),
        F.coalesce("product_rhid", F.lit(UNKNOWN_PRODUCT)).alias("product_rhid"),
        F.lit(1).cast("bigint").alias("_lines"),
        F.col("order_id").isNotNull().cast("bigint").alias("_orders"),
        _zero("sales_qty").cast("bigint").alias("_qty"),
        _zero("unit_price_amt", "decimal(20,6)").alias("_price"),
        tax.cast(MONEY).alias("_tax"),
    )


MEASURES = ("_lines", "_orders", "_qty", "_price", "_tax")


def _product_lines(product: DataFrame, product_line: DataFrame) -> DataFrame:
    """Each product with the reported line it belongs to, or null."""
    code = F.col("product_line_code").cast("string")
    reported = product_line.where(
        F.col("product_line_desc").isin(*PRODUCT_LINES) & code.isin(*PRODUCT_LINES.values())
    )
    line = F.when(F.lit(False), F.lit(""))
    for name, wanted in PRODUCT_LINES.items():
        line = line.when((F.col("product_line_desc") == name) & (code == wanted), F.lit(name))
    lines = reported.select(F.col("product_line_rhid").alias("_line_rhid"), line.alias("_line"))
    return product.join(lines, F.col("product_line_rhid") == F.col("_line_rhid"), "left").select(
        F.col("product_rhid").alias("_product"), "_line"
    )


def _sums(prefix: str, day: WindowSpec, line: str | None = None) -> list[Column]:
    """The four sums of one product line (or of all) over the rows of a store and day, which are sums per line already."""

    def total(column: str) -> Column:
        if line is None:
            return F.sum(column).over(day)
        return F.coalesce(F.sum(F.when(F.col("_line") == line, F.col(column))).over(day), F.lit(0))

    counted = "_orders" if line is None else "_lines"
    return [
        total(counted).alias(f"{prefix}_transaction_count"),
        total("_qty").alias(f"{prefix}_sales_quantity"),
        total("_price").alias(f"{prefix}_sales_usd_amount"),
        total("_tax").alias(f"{prefix}_tax_usd_amount"),
    ]


def _with_line(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The product line of each line, for products that are too many to broadcast.

    Lines without a product would all meet in one task: they are dealt by store
    and day, and what is listed under the unknown product comes to them.
    """
    product = F.col("product_rhid")
    unknown = product == UNKNOWN_PRODUCT
    dealt = lines.withColumn("_key", F.when(unknown, F.xxhash64(*GRAIN)).otherwise(product.cast("bigint")))
    listed = products.where(F.col("_product") != UNKNOWN_PRODUCT).withColumnRenamed("_line", "_known_line")
    same = (F.col("_key") == F.col("_product").cast("bigint")) & (product == F.col("_product"))
    others = products.where(F.col("_product") == UNKNOWN_PRODUCT).select(F.col("_product").alias("_other"), F.col("_line").alias("_other_line"))
    joined = dealt.join(listed, same, "left").join(F.broadcast(others), product == F.col("_other"), "left")
    # No line meets both, so the first that is there counts.
    return joined.select(*lines.columns, F.coalesce("_known_line", "_other_line").alias("_line"))


def _per_store_day(sales: DataFrame, product: DataFrame, product_line: DataFrame, limit: int) -> DataFrame:
    lines = _measures(sales)
    products = _product_lines(product, product_line)
    if measured_bytes(products) <= limit:
        joined = lines.join(F.broadcast(products), F.col("product_rhid") == F.col("_product"), "left")
    else:
        # Too many products to broadcast: sum per product first, so the join
        # moves sums and a hot product is one row per store and day.
        lines = lines.groupBy(*GRAIN, "product_rhid").agg(*[F.sum(m).alias(m) for m in MEASURES])
        joined = _with_line(lines, products)
    # Five plain sums per sales line; the wide conditional form is taken over
    # at most one row per store, day and product line. These few lie side by
    # side after a sort: no task holds the wide form of all its store-days.
    by_line = joined.groupBy(*GRAIN, "_line").agg(*[F.sum(m).alias(m) for m in MEASURES])
    in_order = Window.partitionBy(*GRAIN).orderBy("_line")
    day = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wide = [c for name in PRODUCT_LINES for c in _sums(name.lower(), day, name)]
    sums = [F.sum("_lines").over(day).alias("_all_lines"), *_sums("total", day), *wide]
    daily = by_line.select(*GRAIN, *sums, F.row_number().over(in_order).alias("_nth")).where("_nth = 1")
    return daily.drop("_nth").withColumnRenamed("_all_lines", "_lines")


def store_metrics(
    sales: DataFrame,
    store: DataFrame,
    visits: DataFrame,
    product: DataFrame,
    product_line: DataFrame,
    visits_grain: str = "day",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Visits, transactions, quantities and amounts per store and day, in total and per product line.

    ``visits_grain``:

    * ``day``: a store-day has the visits of that day.
    * ``store``: every sales line meets every visit row of its store, which
      multiplies all counts and sums by the store's number of visit rows.

    Both are computed from sums per store and day: the multiplication is
    applied to the sums, the lines are never multiplied.
    """
    if visits_grain not in ("day", "store"):
        raise ValueError(f"visits_grain must be 'day' or 'store', not {visits_grain!r}")
    daily = _per_store_day(sales, product, product_line, limit)
    stores = store.groupBy(F.col("store_rhid").alias("_store")).agg(
        F.count(F.lit(1)).alias("_versions"),
        F.max("store_open_date").alias("latest_open_date"),
        F.max("store_close_date").alias("latest_close_date"),
    )
    joined = daily.join(stores, F.col("store_rhid") == F.col("_store"), "left")
    # Visits count only for known stores; the key is the one already exchanged on.
    of_store = (F.col("store_rhid") == F.col("_vs")) & F.col("_store").isNotNull()
    seen = [F.count(F.lit(1)).alias("_visits"), F.sum("entry_count").alias("_entries")]
    if visits_grain == "day":
        per = visits.groupBy(F.col("store_rhid").alias("_vs"), F.col("visit_date_key").alias("_vd")).agg(*seen)
        # One narrow row per store and day: hashed, so the wide rows need not be sorted.
        joined = joined.join(per.hint("shuffle_hash"), of_store & (F.col("date_key") == F.col("_vd")), "left")
        factor = F.lit(1).cast("bigint")
        visit_count = F.col("_entries")
    else:
        per = visits.groupBy(F.col("store_rhid").alias("_vs")).agg(*seen)
        joined = joined.join(per, of_store, "left")
        versions = F.coalesce("_versions", F.lit(1))
        factor = versions * F.coalesce("_visits", F.lit(1))
        visit_count = F.col("_lines") * versions * F.col("_entries")

    def scaled(name: str) -> Column:
        if name.endswith("_usd_amount"):
            return (F.col(name) * factor.cast("decimal(20,0)")).cast(MONEY).alias(name)
        return (F.col(name) * factor).cast("bigint").alias(name)

    metrics = []
    for prefix in ("total", *(n.lower() for n in PRODUCT_LINES)):
        metrics += [
            scaled(f"{prefix}_transaction_count"),
            scaled(f"{prefix}_sales_quantity"),
            scaled(f"{prefix}_sales_usd_amount"),
            scaled(f"{prefix}_tax_usd_amount"),
        ]
        for name in ABSENT:
            kind = MONEY if name.endswith("amount") else "bigint"
            metrics.append(F.lit(None).cast(kind).alias(f"{prefix}_{name}"))
    return joined.select(
        "date_key",
        "store_rhid",
        "latest_open_date",
        "latest_close_date",
        visit_count.cast("bigint").alias("total_visit_count"),
        *metrics,
    )


def metrics_table(metrics: DataFrame, job: str, now: Column | datetime | str | None = None) -> DataFrame:
    """The rows in the gold table's column order and types."""
    return as_table(metrics.withColumns(load_stamp(clock(now), job)), AGG_STORE_METRICS_DAILY)
