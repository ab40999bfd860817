"""Online sales: order items and their order headers to the sales fact."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.conform import as_table
from tidemark.functions.times import clock, date_key, load_stamp, to_utc
from tidemark.operators.lookup import CarriedVersions, assemble_branches, effective_join, effective_join_lying, hub_side
from tidemark.operators.sizing import BROADCAST_LIMIT, are_small
from tidemark.schemas import DTL_RETAIL_SALES

KEYS = ("order_id", "order_item_id")
HEADER_CODES = ("store_num", "currency_code")  # the others are codes of the item

# Fact column <- order item column.
ITEM_COLUMNS = {
    "order_status_code": "order_status",
    "item_type_desc": "item_type",
    "unit_price_amt": "unit_price",
    "sales_qty": "quantity",
    "tax_type1_code": "tax_type",
    "tax_type1_amt": "tax",
    "tax_type2_code": "tax_type2",
    "tax_type2_amt": "tax2",
    "tax_type3_amt": "vat",
    "cancel_date": "cancel_date",
    "return_date": "return_date",
    "version_nbr": "version",
    "carrier_name": "carrier",
    "shipping_vendor_name": "shipping_vendor",
    "tracking_code": "tracking_number",
    "charge_ind": "charge_ok",
    "pick_code": "pick_ok",
    "available_date": "available_date",
    "pick_date": "pick_date",
    "email_notified_ind": "email_notified",
    "order_failed_notified_ind": "order_failed_notified",
    "order_failed_notified_date": "order_failed_last_notified",
    "order_notes_text": "order_notes",
    "review_notified_ind": "review_notified",
    "credited_ind": "credited",
    "comments_text": "comments",
    "shipping_method_code": "shipping_method",
    "ship_date": "ship_date",
}

STORE = {"store_rhid": "store_rhid", "store_grpid": "store_grpid"}
SHIP_STORE = {"store_rhid": "ship_store_rhid", "store_grpid": "ship_store_grpid"}
CURRENCY = {"currency_rhid": "currency_rhid", "currency_grpid": "currency_grpid"}
PRODUCT = {
    f"{part}_{kind}": f"{part}_{kind}"
    for part in ("color", "product", "size", "style", "division")
    for kind in ("rhid", "grpid")
}


def order_lines(items: DataFrame, order_log: DataFrame) -> DataFrame:
    """Each order item with its order's store, currency and time: the one large join."""
    carried = [c for c in order_log.columns if c.startswith("_versions_")]
    header = order_log.select("order_id", *HEADER_CODES, "order_timestamp", *carried)
    lines = items.drop(*[c for c in header.columns if c != "order_id" and c in items.columns])
    return lines.withColumnRenamed("id", "order_item_id").join(header, "order_id")


def fact_columns(lines: DataFrame) -> dict[str, Column]:
    """Fact columns that come from the order line itself."""
    present = set(lines.columns)
    values = {fact: F.col(item) for fact, item in ITEM_COLUMNS.items() if item in present}
    if "charge_timestamp" in present:
        values["charge_timestamp"] = to_utc(F.col("charge_timestamp").cast("timestamp"))
    return {
        **values,
        "order_timestamp": F.col("order_timestamp"),
        "order_date_key": date_key(F.col("order_timestamp")),
    }


# Columns that are the same on every online row.
CONSTANTS = {"order_channel_code": "ECOM", "tax_type3_code": "VAT"}


def ecom_sales(
    items: DataFrame,
    order_log: DataFrame,
    store_hub: DataFrame,
    currency_hub: DataFrame,
    product_hub: DataFrame,
    job: str,
    now: Column | datetime | str | None = None,
    closed: str = "both",
    limit: int = BROADCAST_LIMIT,
    lying: bool = False,
) -> DataFrame:
    """The sales fact rows of a set of order items.

    Items meet their headers once and then pass four effective-dated lookups.
    Hubs within ``limit`` bytes are broadcast. A larger one is met by the side
    that has its code, items or headers, before these two meet, and the version
    is picked after: the distinct always finds the lines where that meeting
    left them, by order.

    With ``lying`` items and headers are tables, cheap to read again: the lines
    stay where they met, and only their codes, with order and time, go to a
    large hub (``effective_join_lying``, which says what setting that needs).
    """
    lookups = _lookups(store_hub, currency_hub, product_hub)
    small = are_small([hub_side(hub, columns) for hub, _, columns in lookups], limit)
    carried = {}
    for (hub, code, columns), fits in zip(lookups, small, strict=True):
        if not fits and not lying:
            carried[code] = CarriedVersions(hub, code, columns, closed)
            if code in HEADER_CODES:
                order_log = carried[code].attach(order_log)
            else:
                items = carried[code].attach(items)
    lines = met = order_lines(items, order_log)
    for (hub, code, columns), fits in zip(lookups, small, strict=True):
        if code in carried:
            lines = carried[code].pick(lines, "order_timestamp")
        elif not fits:
            lines = effective_join_lying(lines, hub, code, "order_timestamp", columns, "order_id", closed, met)
        else:
            lines = effective_join(lines, F.broadcast(hub), code, "order_timestamp", columns, closed, limit=None)
    looked_up = [*STORE, *SHIP_STORE.values(), *CURRENCY, *PRODUCT]
    kept = [F.col(c) for c in (*KEYS, *looked_up) if c in lines.columns]
    rows = lines.select(*kept, *[v.alias(n) for n, v in fact_columns(lines).items()]).distinct()
    return _stamped(rows, job, now)


def _lookups(store_hub: DataFrame, currency_hub: DataFrame, product_hub: DataFrame) -> list[tuple[DataFrame, str, dict[str, str]]]:
    """The four lookups: hub, code, columns."""
    found = ((store_hub, "store_num", STORE), (store_hub, "ship_store_num", SHIP_STORE), (currency_hub, "currency_code", CURRENCY), (product_hub, "sku_number", PRODUCT))
    return [(hub, code, _known(hub, columns)) for hub, code, columns in found]


def _known(hub: DataFrame, columns: Mapping[str, str]) -> dict[str, str]:
    return {c: out for c, out in columns.items() if c in hub.columns}


def _stamped(rows: DataFrame, job: str, now: Column | datetime | str | None) -> DataFrame:
    constants = {n: F.lit(v) for n, v in CONSTANTS.items()}
    return as_table(rows.withColumns({**constants, **load_stamp(clock(now), job)}), DTL_RETAIL_SALES)


def ecom_sales_by_branch(
    items: DataFrame,
    order_log: DataFrame,
    store_hub: DataFrame,
    currency_hub: DataFrame,
    product_hub: DataFrame,
    job: str,
    now: Column | datetime | str | None = None,
    closed: str = "both",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The same fact put together from four separately looked-up branches.

    It equals ``ecom_sales`` while (order, item) is unique among the items, and
    is there for staging the branches one by one.
    """
    lookups = _lookups(store_hub, currency_hub, product_hub)
    small = are_small([hub_side(hub, columns) for hub, _, columns in lookups], limit)

    def branch(hub: DataFrame, code: str, columns: Mapping[str, str], fits: bool) -> DataFrame:
        if fits:
            lines = order_lines(items, order_log)
            found = effective_join(lines, F.broadcast(hub), code, "order_timestamp", columns, closed, limit=None)
        else:
            carried = CarriedVersions(hub, code, columns, closed)
            sides = (items, carried.attach(order_log)) if code in HEADER_CODES else (carried.attach(items), order_log)
            lines = order_lines(*sides)
            found = carried.pick(lines, "order_timestamp")
        extra = fact_columns(lines) if code == "sku_number" else {}
        return found.select(*KEYS, *columns.values(), *[v.alias(n) for n, v in extra.items()]).distinct()

    # Every branch lies by order, and stays there for the assembly.
    items.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    *others, product = [branch(*one, fits) for one, fits in zip(lookups, small, strict=True)]
    return _stamped(assemble_branches(product, others, KEYS).distinct(), job, now)
