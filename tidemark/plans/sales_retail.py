"""In-store sales: register lines to the sales fact."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.conform import as_table
from tidemark.functions.times import clock, date_key, load_stamp, to_utc, twelve_hour
from tidemark.operators.lookup import CarriedVersions, effective_join, hub_side
from tidemark.operators.sizing import BROADCAST_LIMIT, are_small
from tidemark.plans.sales_ecom import PRODUCT
from tidemark.schemas import DTL_RETAIL_SALES

# Fact column <- register line column.
SALE_COLUMNS = {
    "order_id": "sl_inv_num",
    "order_item_id": "sl_tran",
    "transaction_type_code": "sl_trantype",
    "catalog_item_code": "sl_eitem",
    "unit_price_amt": "sl_price",
    "sales_qty": "sl_qty",
    "tax_type1_code": "sl_taxmode",
    "tax_type1_amt": "sl_taxamt1",
    "tax_type2_amt": "sl_taxamt2",
    "tax_type3_amt": "sl_taxamt3",
    "tax_type4_amt": "sl_taxamt4",
    "discount1_reason_code": "sl_disreason",
}
STORE = {
    "store_rhid": "store_rhid",
    "store_grpid": "store_grpid",
    "primary_store_currency_rhid": "currency_rhid",
    "primary_store_currency_grpid": "currency_grpid",
}
# Fixed value: columns that are the same on every in-store row.
CONSTANTS = {"order_channel_code": "RETAIL"}

LINE_KEY = ("order_id", "order_item_id", "order_date_key")


def sale_time(day: str = "sl_date", text: str = "sl_time") -> Column:
    """The register's local 12-hour clock as a UTC timestamp."""
    return to_utc(twelve_hour(F.col(day), F.col(text)))


def _sale_lines(sales: DataFrame) -> DataFrame:
    present = {f: s for f, s in SALE_COLUMNS.items() if s in sales.columns}
    return sales.select(
        *[F.col(s).alias(f) for f, s in present.items()],
        sale_time().alias("order_timestamp"),
        date_key(F.col("sl_date")).alias("order_date_key"),
        "sl_date", "sl_store", "sl_seq", "sl_size_id",
    )


def _with_product(
    lines: DataFrame, upcref: DataFrame, product_hub: DataFrame, system: str | None, closed: str, small: bool
) -> DataFrame:
    columns = _known(product_hub, PRODUCT)
    codes = upcref.select("up_seq", "up_size", "up_code")
    carried = CarriedVersions(product_hub, "up_code", columns, closed, system)
    if not small:
        codes = carried.attach(codes)
    crossed = lines.join(
        codes, (F.col("sl_seq") == F.col("up_seq")) & (F.col("sl_size_id") == F.col("up_size")), "left"
    )
    if not small:
        return carried.pick(crossed, "sl_date")
    return effective_join(crossed, F.broadcast(product_hub), "up_code", "sl_date", columns, closed, system, limit=None)


def _known(hub: DataFrame, columns: Mapping[str, str]) -> dict[str, str]:
    return {c: out for c, out in columns.items() if c in hub.columns}


def _with_store(lines: DataFrame, store_hub: DataFrame, closed: str) -> DataFrame:
    return effective_join(lines, store_hub, "sl_store", "sl_date", _known(store_hub, STORE), closed, limit=None)


def retail_sales(
    sales: DataFrame,
    upcref: DataFrame,
    store_hub: DataFrame,
    product_hub: DataFrame,
    job: str,
    now: Column | datetime | str | None = None,
    system: str | None = None,
    assembly: str = "line",
    closed: str = "both",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The sales fact rows of a set of register lines, without duplicates.

    ``assembly`` says how a line meets its store:

    * ``keyed``: through (invoice, transaction, date), as the two halves are
      keyed in storage.  Lines of different stores that share such a key pair
      up, and lines with a null key part drop out.
    * ``line``: each line with its own store.

    ``system`` restricts the product codes to one source system.  The keyed
    store half is made distinct first, so a key repeated n times costs n rows
    and not n squared.  Products beyond ``limit`` bytes are met by the size codes,
    of which there are fewer than lines, and not by the lines themselves.
    """
    sides = hub_side(store_hub, _known(store_hub, STORE)), hub_side(product_hub, _known(product_hub, PRODUCT), system)
    few_stores, few_products = are_small(sides, limit)
    store_hub = F.broadcast(store_hub) if few_stores else store_hub
    lines = _sale_lines(sales)
    found = _with_product(lines, upcref, product_hub, system, closed, few_products)
    helpers = ("sl_date", "sl_seq", "sl_size_id", "up_seq", "up_size", "up_code")
    if assembly == "line":
        rows = _with_store(found, store_hub, closed).drop(*helpers, "sl_store")
    elif assembly == "keyed":
        half = _with_store(lines.select(*LINE_KEY, "sl_date", "sl_store"), store_hub, closed)
        stores = half.drop("sl_date", "sl_store").distinct()
        rows = found.drop(*helpers, "sl_store").join(stores, list(LINE_KEY), "inner")
    else:
        raise ValueError(f"assembly must be 'keyed' or 'line', not {assembly!r}")
    constants = {n: F.lit(v) for n, v in CONSTANTS.items()}
    stamped = rows.distinct().withColumns({**constants, **load_stamp(clock(now), job)})
    return as_table(stamped, DTL_RETAIL_SALES)
