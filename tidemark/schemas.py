"""Row types of the change envelope, the metadata columns and the target tables."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

OPERATIONS = ("INSERT", "UPDATE", "DELETE", "REFRESH")

HEADERS = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("changeSequence", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("streamPosition", T.StringType()),
        T.StructField("transactionId", T.StringType()),
        T.StructField("changeMask", T.BinaryType()),
        T.StructField("columnMask", T.BinaryType()),
        T.StructField("transactionEventCounter", T.LongType()),
        T.StructField("transactionLastEvent", T.BooleanType()),
    ]
)

# Columns every current-state row carries after the business columns.
META_FIELDS = [
    T.StructField("rec_create_timestamp", T.TimestampType()),
    T.StructField("rec_create_user_name", T.StringType()),
    T.StructField("rec_update_timestamp", T.TimestampType()),
    T.StructField("rec_update_user_name", T.StringType()),
    T.StructField("rec_create_date_key", T.IntegerType()),
    T.StructField("rec_create_time_key", T.IntegerType()),
    T.StructField("rec_crud_text", T.StringType()),
    T.StructField("delete_ind", T.IntegerType()),
    T.StructField("exception_ind", T.IntegerType()),
    T.StructField("resolved_ind", T.IntegerType()),
]
HASH_FIELDS = [
    T.StructField("rec_row_hash", T.StringType()),
    T.StructField("rec_pk_hash", T.StringType()),
]

# Set when a key is first inserted and kept by every later update.
CREATE_COLUMNS = (
    "rec_create_timestamp",
    "rec_create_user_name",
    "rec_create_date_key",
    "rec_create_time_key",
)

MONEY = T.DecimalType(20, 6)


def envelope(data: T.StructType, headers: T.StructType = HEADERS) -> T.StructType:
    """The three-part change record around a table's row type."""
    return T.StructType(
        [
            T.StructField("data", data),
            T.StructField("beforeData", data),
            T.StructField("headers", headers),
        ]
    )


def current_schema(data: T.StructType) -> T.StructType:
    """Row type of the current-state table of a source table."""
    return T.StructType(
        data.fields + META_FIELDS + HASH_FIELDS + [T.StructField("change_sequence", T.StringType())]
    )


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """A StructType from a file in Spark's own JSON schema format."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))


_AVRO_PRIMITIVES = {
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "enum": T.StringType(),
}


def schema_from_avro(document: str | dict) -> T.StructType:
    """The Spark row type of an Avro record schema document."""
    named: dict[str, dict] = {}

    def convert(node) -> T.DataType:
        if isinstance(node, list):
            branches = [b for b in node if b != "null"]
            if len(branches) != 1:
                raise ValueError(f"only nullable unions are supported: {node}")
            return convert(branches[0])
        if isinstance(node, str):
            if node in named:
                return convert(named[node])
            return _AVRO_PRIMITIVES[node]
        kind, logical = node["type"], node.get("logicalType")
        if "name" in node:
            named[node["name"]] = node
        if logical == "decimal":
            return T.DecimalType(node["precision"], node.get("scale", 0))
        if logical == "date":
            return T.DateType()
        if logical in ("timestamp-micros", "timestamp-millis"):
            return T.TimestampType()
        if kind == "record":
            return T.StructType([T.StructField(f["name"], convert(f["type"])) for f in node["fields"]])
        return convert(kind)

    return convert(json.loads(document) if isinstance(document, str) else document)


_WORDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": MONEY,
}


def _table(text: str) -> T.StructType:
    """A row type from 'name word, name word, …'; needs no session, unlike DDL parsing."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _WORDS[word]) for name, word in pairs])


# The target tables, column by column.
USECASE_AUDIT_LOGS = _table("""
    jobname string, src_last_upd_timestamp timestamp, load_status string,
    rec_create_timestamp timestamp, rec_create_user_name string,
    rec_update_timestamp timestamp, rec_update_user_name string
""")

AUDIT_LOGS = _table("""
    job_name string, source_type string, source_name string, sink_type string, sink_name string,
    input_row_count bigint, output_row_count bigint, exception_ind int, exception_dtl string,
    rec_create_timestamp timestamp, rec_create_user_name string
""")

STREAMING_AUDITS = _table("""
    id string, run_id string, batch_id bigint, name string, source string, sink string,
    num_input_rows bigint, num_output_rows bigint, progress_timestamp string
""")

RULE_COUNTS = _table("""
    id string, run_id string, batch_id bigint, name string, rule_name string, failures bigint
""")

JOB_RUN_LOGS = _table("""
    run_type string, job_name string, job_id bigint, job_type string, job_method string,
    log_timestamp timestamp, response string
""")

AGG_STORE_VISITS_DAILY = _table("""
    visit_date_key int, store_rhid int, store_grpid string, visit_date date,
    entry_count int, exit_count int,
    rec_create_timestamp timestamp, rec_create_user_name string,
    rec_update_timestamp timestamp, rec_update_user_name string,
    rec_create_date_key int, rec_create_time_key int
""")

DTL_RETAIL_SALES = _table("""
    order_id int, order_item_id int, order_status_code string, order_channel_code string,
    transaction_type_code string, order_timestamp timestamp, order_date_key int,
    color_rhid int, color_grpid string, product_rhid int, product_grpid string,
    size_rhid int, size_grpid string, style_rhid int, style_grpid string,
    division_rhid int, division_grpid string, catalog_item_code string,
    store_rhid int, store_grpid string, ship_store_rhid int, ship_store_grpid string,
    item_type_desc string, unit_price_amt money, sales_qty int,
    tax_type1_code string, tax_type1_amt money,
    tax_type2_code string, tax_type2_amt money,
    tax_type3_code string, tax_type3_amt money,
    tax_type4_code string, tax_type4_amt money,
    discount1_reason_code string, cancel_date date, return_date date, version_nbr int,
    carrier_name string, shipping_vendor_name string, tracking_code string, charge_ind int,
    pick_code string, available_date date, pick_date date, email_notified_ind int,
    order_failed_notified_ind int, order_failed_notified_date date, order_notes_text string,
    review_notified_ind int, credited_ind int, comments_text string, shipping_method_code string,
    ship_date date, charge_timestamp timestamp, currency_rhid int, currency_grpid string,
    rec_create_timestamp timestamp, rec_create_user_name string,
    rec_update_timestamp timestamp, rec_update_user_name string,
    rec_create_date_key int, rec_create_time_key int
""")

# The product lines of the daily store metrics, with their codes.
PRODUCT_LINES = {"FOOTWEAR": "4", "APPAREL": "2", "ACCESSORIES": "1"}


def _metric_fields(prefix: str) -> str:
    counts = ("transaction_count", "sales_quantity", "return_quantity")
    amounts = ("sales", "tax", "discount", "promo", "shipping")
    return ", ".join(
        [f"{prefix}_{c} int" for c in counts] + [f"{prefix}_{a}_usd_amount money" for a in amounts]
    )


AGG_STORE_METRICS_DAILY = _table(
    "date_key int, store_rhid int, latest_open_date date, latest_close_date date, "
    "total_visit_count int, "
    + ", ".join(_metric_fields(p) for p in ("total", *(line.lower() for line in PRODUCT_LINES)))
    + ", rec_create_timestamp timestamp, rec_create_user_name string, "
    "rec_update_timestamp timestamp, rec_update_user_name string, "
    "rec_create_date_key int, rec_create_time_key int"
)
