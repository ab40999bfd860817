"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import conform, hashing, times
from tidemark.operators import audit, cdc, contents, envelope, incremental, lookup, merge, quality
from tidemark.plans import hierarchy, metrics, sales_ecom, sales_retail, visits
from tidemark.schemas import MONEY, envelope as envelope_type
from tidemark.session import configure
from workload.inputs import frame

NOW = "2024-02-01 10:11:12.345678"
JOB = "nightly"
MID = "2024-01-16 00:00:00"
LATE = "2024-02-15 00:00:00"  # readings after it arrived late

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name; the session gets its settings first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    run.__name__ = function.__name__
    QUERIES[function.__name__] = run
    return function


# --- envelopes -------------------------------------------------------------

EVENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("props", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)
ENVELOPE = envelope_type(EVENT)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as change envelopes; updates and deletes carry a before image."""
    return as_envelopes(frame(spark, sf_dir, "v_cdc"))


def as_envelopes(log: DataFrame) -> DataFrame:
    image = {n: F.col(n) for n in EVENT.names}
    before = image | {"amount": (F.col("amount") + 1).cast(MONEY)}
    headers = {
        "operation": F.col("operation"),
        "changeSequence": F.col("change_sequence"),
        "timestamp": F.date_format("hdr_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "streamPosition": F.col("change_sequence"),
        "transactionId": F.col("event_id").cast("string"),
        "transactionEventCounter": F.col("event_id"),
    }
    types = {f.name: f.dataType for f in ENVELOPE["headers"].dataType.fields}
    return log.select(
        F.struct(*[c.alias(n) for n, c in image.items()]).alias("data"),
        F.when(
            F.col("operation").isin("UPDATE", "DELETE"), F.struct(*[c.alias(n) for n, c in before.items()])
        ).alias("beforeData"),
        F.struct(*[headers.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()]).alias("headers"),
        "ingest_date",
    )


def payload_text() -> Column:
    """The envelope as JSON, timestamps to the microsecond."""
    record = F.struct("data", "beforeData", "headers")
    return F.to_json(record, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def as_messages(envelopes: DataFrame) -> DataFrame:
    """Framed payloads as (value, timestamp); the frame's schema id is the user id."""
    return envelopes.select(framed(F.col("data.user_id"), payload_text()).alias("value"),
                         F.col("data.event_ts").alias("timestamp"))


def framed(schema_id: Column, text: Column) -> Column:
    header = F.unhex(F.lpad(F.hex(schema_id), 10, "0"))
    return F.concat(header, F.encode(text, "UTF-8"))


def flat_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.flatten(cdc.enrich_cdc(changes(spark, sf_dir), now=NOW), cdc.HEADER_COLUMNS)


@query
def wire_header_strip(spark, sf_dir):
    events = frame(spark, sf_dir, "v_cdc")
    framed_rows = events.select("event_id", framed(F.col("user_id"), F.col("props")).alias("value"))
    stripped = envelope.strip_wire_header(framed_rows)
    return stripped.select("event_id", "schema_id", F.decode("payload", "UTF-8").alias("payload"))


@query
def decode_by_writer(spark, sf_dir):
    """Frames of two schemas, of an unknown one, cut short, and without a header, each decoded as its writer declared it."""
    events = frame(spark, sf_dir, "v_cdc")
    first = F.to_json(F.struct("event_id", F.col("amount").cast("string").alias("amount"), "event_type"))
    priced = F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    second = F.to_json(F.struct(F.struct("event_id", priced.alias("amount"), F.col("user_id").alias("visitor")).alias("data"), "event_type"))
    text = F.when(F.col("event_type") == "signup", F.substring(first, F.lit(1), F.length(first) - 1)).when(F.col("event_id") % 2 == 0, second).otherwise(first)
    number = F.when(F.col("event_type") == "error", 9).when((F.col("event_id") % 2 == 0) & (F.col("event_type") != "signup"), 2).otherwise(1)
    value = F.when(F.col("event_id") % 7 == 0, F.encode(F.lit("{}"), "UTF-8")).otherwise(framed(number, text))
    data = T.StructType().add("event_id", T.LongType()).add("amount", T.StringType())
    writers = {1: T.StructType([*data.fields]).add("event_type", T.StringType()), 2: T.StructType().add("data", data).add("event_type", T.StringType())}
    inner = T.StructType().add("event_id", T.IntegerType()).add("amount", MONEY)
    reader = T.StructType([*inner.fields]).add("data", inner).add("event_type", T.StringType())
    out = envelope.decode_by_writer(events.select(value.alias("value"), F.col("event_id").alias("sent")), writers, reader, keep=("sent",))
    return out.select(
        "sent", "schema_id", "data.event_id", "data.amount", F.col("data.data.event_id").alias("inner_id"), F.col("data.data.amount").alias("inner_amount"),
        "data.event_type", "rescued", "error", F.length("raw").alias("raw_bytes"),
    )


@query
def envelope_decode(spark, sf_dir):
    """Payloads of error events arrive cut short and decode to nulls."""
    text = payload_text()
    cut = F.substring(text, F.lit(1), F.length(text) - 9)
    sent = changes(spark, sf_dir).select(
        F.when(F.col("data.event_type") == "error", cut).otherwise(text).alias("payload"), "ingest_date"
    )
    decoded = envelope.decode_envelope(sent, ENVELOPE)
    return decoded.select(
        "data.*",
        F.col("beforeData.amount").alias("before_amount"),
        F.col("headers.operation").alias("operation"),
        F.col("headers.changeSequence").alias("change_sequence"),
        "ingest_date",
    )


@query
def json_value_source(spark, sf_dir):
    rows = frame(spark, sf_dir, "v_cdc")
    landed = rows.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "amount", "event_type")).alias("value"),
        "ingest_date",
    )
    return envelope.json_value(
        landed, T.StructType.fromDDL("event_id bigint, user_id bigint, amount decimal(20,6), event_type string")
    )


@query
def cdc_flatten(spark, sf_dir):
    return envelope.flatten(
        changes(spark, sf_dir), {"operation": "operation", "changeSequence": "change_sequence"}
    )


@query
def cdc_enrich(spark, sf_dir):
    enriched = cdc.enrich_cdc(changes(spark, sf_dir), now=NOW)
    return envelope.flatten(enriched, {**cdc.HEADER_COLUMNS, "transactionId": "transaction_id"})


@query
def cdc_history(spark, sf_dir):
    return cdc.history_view(changes(spark, sf_dir))


@query
def pii_mask(spark, sf_dir):
    masked = hashing.mask_pii(changes(spark, sf_dir), ["user_id", "props"])
    before = [F.col(f"beforeData.{n}").alias(f"before_{n}") for n in ("user_id", "props", "amount")]
    return masked.select("data.*", *before)


@query
def epoch_to_timestamp(spark, sf_dir):
    rows = frame(spark, sf_dir, "v_cdc").select("event_id", F.unix_millis("event_ts").alias("happened"))
    return times.epoch_to_timestamp(rows, ["happened"])


def hashable(spark, sf_dir):
    rows = frame(spark, sf_dir, "v_cdc")
    code = F.when(F.col("event_type") != "view", F.col("event_type")).alias("code")
    return rows.select("event_id", "user_id", code, "amount", "ingest_date", "operation")


@query
def row_hash(spark, sf_dir):
    columns = ["user_id", "code", "amount", "ingest_date"]
    rows = hashing.with_hash(hashable(spark, sf_dir), "rec_row_hash", columns)
    rows = hashing.with_hash(rows, "rec_row_hash_null_safe", columns, null_safe=True)
    return rows.select("event_id", "rec_row_hash", "rec_row_hash_null_safe")


@query
def pk_hash(spark, sf_dir):
    rows = hashable(spark, sf_dir)
    rows = hashing.with_hash(rows, "rec_pk_hash", ["user_id", "code", "operation"])
    rows = hashing.with_hash(rows, "rec_pk_hash_append", ["user_id", "code"])
    return rows.select("event_id", "rec_pk_hash", "rec_pk_hash_append")


@query
def csv_to_cdc(spark, sf_dir):
    rows = frame(spark, sf_dir, "v_cdc")
    feed = rows.select(
        "event_id", F.col("event_ts").alias("timestamp"), F.substring("operation", 1, 1).alias("flag")
    )
    return cdc.csv_to_cdc(feed)


@query
def conform_types(spark, sf_dir):
    landed = frame(spark, sf_dir, "v_cdc").select(
        (F.col("event_id") + F.lit(3_000_000_000)).cast("string").alias("event_id"),
        F.col("amount").cast("string"),
        F.col("event_ts").cast("string"),
        F.col("ingest_date").cast("string"),
        F.when(F.col("event_type") == "click", F.col("props"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        "event_type",
    )
    declared = {
        "event_id": "bigint", "amount": "decimal(18,2)", "event_ts": "datetime",
        "ingest_date": "date", "user_id": "int", "event_type": "string",
    }
    return conform.conform_types(landed, declared, failures="failed_columns")


@query
def widen_decimals(spark, sf_dir):
    rows = frame(spark, sf_dir, "v_cdc").select(
        "event_id",
        F.col("amount").cast("decimal(10,2)").alias("amount"),
        F.struct(F.col("amount").cast("decimal(18,4)").alias("half")).alias("nested"),
    )
    return conform.widen_decimals(rows).select("event_id", "amount", F.col("nested.half").alias("half"))


@query
def scalar_functions(spark, sf_dir):
    """The scalar surface in one projection."""
    rows = frame(spark, sf_dir, "v_cdc")
    at, code = F.col("event_ts"), F.when(F.col("event_type") != "view", F.col("event_type"))
    return rows.select(
        "event_id",
        F.coalesce(code, F.lit("none")).alias("nvl_text"),
        F.when(F.col("amount") > 100, "high").when(F.col("amount") > 10, "middle").otherwise("low").alias("band"),
        F.concat(code, F.lit("_"), F.col("user_id").cast("string")).alias("joined"),
        F.concat_ws("||", code, F.col("props")).alias("joined_ws"),
        F.substring("event_type", 2, 3).alias("middle_text"),
        F.left("event_type", F.lit(3)).alias("left_text"),
        F.replace(F.col("ingest_date").cast("string"), F.lit("-"), F.lit("")).cast("int").alias("day_digits"),
        F.length(F.encode("props", "UTF-8")).alias("bytes"),
        F.sha2("props", 256).alias("digest"),
        times.date_key(at).alias("date_key"),
        times.time_key_minutes(at).alias("minute_key"),
        times.time_key_seconds(at).alias("second_key"),
        F.to_date(F.col("event_ts").cast("string")).alias("day"),
        F.to_date(F.lit("1900-01-01"), "yyyy-MM-dd").alias("first_day"),
        times.to_utc(at).alias("utc"),
        times.twelve_hour(at.cast("date"), F.lower(F.date_format(at, "hh:mm a"))).alias("half_day_clock"),
        times.epoch_millis(F.unix_millis(at)).alias("from_millis"),
        (F.col("amount") + F.lit(1)).cast(MONEY).alias("plus"),
        F.col("amount").cast("decimal(20,2)").alias("cents"),
        F.floor("amount").cast("int").alias("whole"),
        F.lit(None).cast("int").alias("nothing"),
        F.get_json_object(F.to_json(F.struct(F.struct(F.col("user_id").alias("u")).alias("s"))), "$.s.u")
        .cast("bigint")
        .alias("nested_user"),
        F.from_json("props", "k int")["k"].alias("k"),
    )


# --- latest state, quality, merge -------------------------------------------

@query
def cdc_latest(spark, sf_dir):
    """Flagship: the current state of every user."""
    rows = cdc.change_columns(changes(spark, sf_dir))
    newest = quality.valid_rows(rows, ["user_id"], ["props"], EVENT.names[:5])
    return cdc.with_meta(newest, now=NOW, flagged=True).drop("hdr_timestamp")


def incomplete(spark, sf_dir):
    """Change rows with holes: null keys, empty texts."""
    return flat_changes(spark, sf_dir).select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        "event_id",
        F.when(F.col("event_type") == "click", "").otherwise(F.col("props")).alias("props"),
        F.when(F.col("event_type") != "view", F.col("amount")).alias("amount"),
        "rec_create_date_key",
        "rec_crud_text",
        "exception_ind",
        "changeSequence",
        "hdr_timestamp",
    )


@query
def dq_null_check(spark, sf_dir):
    return quality.null_check(incomplete(spark, sf_dir), ["user_id"], ["props", "amount"])


@query
def dq_duplicates(spark, sf_dir):
    rows = cdc.change_columns(changes(spark, sf_dir)).withColumn("slot", F.to_date("event_ts"))
    return quality.duplicate_check(rows, ["user_id", "slot"]).select("event_id", "user_id", "slot", "rec_crud_text")


@query
def dq_exceptions(spark, sf_dir):
    rows = incomplete(spark, sf_dir).withColumn("slot", F.to_date("hdr_timestamp"))
    return quality.exceptions(rows, ["user_id", "slot"], ["props", "amount"], ["user_id", "event_id", "props"])


def states(spark, sf_dir):
    """Change rows of the first and the second half of the month, newest per user each."""
    rows = flat_changes(spark, sf_dir).withColumnRenamed("changeSequence", "change_sequence")
    order = ["change_sequence", "hdr_timestamp"]
    early, late = rows.where(F.col("event_ts") < MID), rows.where(F.col("event_ts") >= MID)
    stamped = late.withColumns(
        {
            "rec_create_timestamp": F.lit("2024-03-01 00:00:00").cast("timestamp"),
            "rec_update_timestamp": F.lit("2024-03-01 00:00:00").cast("timestamp"),
            "props": F.when(F.col("event_type") != "view", F.col("props")),
        }
    )
    return cdc.latest_by_key(early, ["user_id"], order), cdc.latest_by_key(stamped, ["user_id"], order)


@query
def merge_upsert(spark, sf_dir):
    """The second half of the month onto the first: updates set nulls, create columns stay."""
    target, source = states(spark, sf_dir)
    return merge.merge_upsert(target, source, ["user_id"], ["rec_create_timestamp"], "change_sequence")


@query
def merge_out_of_order(spark, sf_dir):
    """The first half arriving after the second changes nothing but missing users."""
    source, target = states(spark, sf_dir)
    return merge.merge_upsert(target, source, ["user_id"], ["rec_create_timestamp"], "change_sequence")


@query
def merge_unguarded(spark, sf_dir):
    """Without the guard the batch that arrives last wins."""
    source, target = states(spark, sf_dir)
    return merge.merge_upsert(target, source, ["user_id"], ["rec_create_timestamp"])


@query
def merge_reload(spark, sf_dir):
    """The first half of the month sent anew as an initial load: it wins over the second half."""
    source, target = states(spark, sf_dir)
    load = source.withColumns({"rec_crud_text": F.lit("REFRESH"), "change_sequence": F.lit(cdc.REFRESH_SEQUENCE)})
    return merge.merge_upsert(target, load, ["user_id"], ["rec_create_timestamp"], "change_sequence", reload=True)


@query
def distinct_lines(spark, sf_dir):
    return frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


# --- audit ------------------------------------------------------------------


@query
def incremental_filter(spark, sf_dir):
    rows = frame(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").alias("rec_update_timestamp"))
    return incremental.incremental(rows, frame(spark, sf_dir, "v_audit"), "load purchase")


@query
def audit_watermark(spark, sf_dir):
    return audit.watermarks(frame(spark, sf_dir, "v_audit"))


@query
def audit_complete(spark, sf_dir):
    return audit.complete_newest(frame(spark, sf_dir, "v_audit"), NOW)


@query
def upstream_ready(spark, sf_dir):
    runs = frame(spark, sf_dir, "v_audit")
    per_user = frame(spark, sf_dir, "v_cdc").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("jobname"),
        F.col("event_ts").alias("src_last_upd_timestamp"),
        F.when(F.col("operation") == "UPDATE", "COMPLETED").alias("load_status"),
        F.col("event_ts").alias("rec_create_timestamp"),
        F.col("event_type").alias("rec_create_user_name"),
        F.when(F.col("operation") == "UPDATE", F.col("event_ts")).alias("rec_update_timestamp"),
        F.lit(None).cast("string").alias("rec_update_user_name"),
    )
    return audit.upstream_ready(runs.unionByName(per_user), "2024-01-10 00:00:00")


@query
def reconcile_counts(spark, sf_dir):
    traffic, daily = frame(spark, sf_dir, "v_traffic"), store_visits_daily(spark, sf_dir)
    measures = {"last_visit_date": F.max("visit_date")}
    return audit.reconcile(traffic, daily, ["store_number", "visit_date"], F.col("store_rhid") > 0, measures)


def _as_sent(spark, sf_dir):
    """The order lines and what arrived of them: quantities changed, lines lost, lines doubled, often in one supplier month."""
    sent = frame(spark, sf_dir, "lineitem").withColumn("month", F.date_trunc("month", "l_shipdate").cast("date"))
    changed = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    lost = (F.col("l_quantity") == 13) & (F.col("l_tax") < 0.02)
    doubled = F.when((F.col("l_quantity") == 14) & (F.col("l_tax") < 0.02), 2).otherwise(1)
    arrived = sent.where(~lost).withColumn("_times", F.explode(F.array_repeat(F.lit(0), doubled))).drop("_times")
    return sent, arrived.withColumn("l_quantity", changed)


@query
def reconcile_contents(spark, sf_dir):
    """The supplier months whose lines differ from what was sent, equal counts or not."""
    return contents.differing_groups(*_as_sent(spark, sf_dir), ["l_suppkey", "month"])


@query
def reconcile_rows(spark, sf_dir):
    """The very lines that differ, found in the supplier months that do."""
    return contents.differing_rows(*_as_sent(spark, sf_dir), ["l_suppkey", "month"])


# --- lookups ------------------------------------------------------------------


def store_hub(spark, sf_dir, system: str | None = "POS"):
    columns = ["store_rhid", "store_grpid", "primary_store_currency_rhid", "primary_store_currency_grpid"]
    return lookup.lookup_hub(
        frame(spark, sf_dir, "v_src_hub"), frame(spark, sf_dir, "v_src_sys"),
        frame(spark, sf_dir, "v_mst_store"), "MST_STORE", "store_grpid", columns, system,
    )


def product_hub(spark, sf_dir):
    columns = ["product_rhid", "product_grpid", "product_line_rhid", "size_rhid", "style_grpid"]
    return lookup.lookup_hub(
        frame(spark, sf_dir, "v_src_hub"), frame(spark, sf_dir, "v_src_sys"),
        frame(spark, sf_dir, "v_mst_product"), "MST_PRODUCT", "product_grpid", columns,
    )


def currency_hub(spark, sf_dir):
    return lookup.lookup_hub(
        frame(spark, sf_dir, "v_src_hub"), frame(spark, sf_dir, "v_src_sys"),
        frame(spark, sf_dir, "v_mst_currency"), "MST_CURRENCY", "currency_grpid",
        ["currency_rhid", "currency_grpid"], "POS",
    )


@query
def hub_lookup_store(spark, sf_dir):
    return store_hub(spark, sf_dir)


@query
def hub_lookup_product(spark, sf_dir):
    return product_hub(spark, sf_dir)


@query
def hub_lookup_currency(spark, sf_dir):
    return currency_hub(spark, sf_dir)


@query
def hub_overlap_check(spark, sf_dir):
    """Store versions that touch or overlap the next one, the end rounded up to the day."""
    rounded = F.date_add(F.col(lookup.END).cast("date"), 1).cast("timestamp")
    hub = store_hub(spark, sf_dir).where(F.col("store_rhid").isNotNull())
    ends = F.when(F.year(lookup.END) < 2099, rounded).otherwise(F.col(lookup.END))
    return lookup.hub_overlaps(hub.withColumn(lookup.END, ends)).select(
        "source_system_natural_key", "store_rhid", lookup.END, "next_start_timestamp"
    )


def order_lines(spark, sf_dir):
    return sales_ecom.order_lines(frame(spark, sf_dir, "v_lines"), frame(spark, sf_dir, "v_order_log"))


def asof(spark, sf_dir, hub, code, columns, closed="both"):
    lines = order_lines(spark, sf_dir).select("order_id", "order_item_id", code, "order_timestamp")
    return lookup.effective_join(lines, hub, code, "order_timestamp", columns, closed)


@query
def asof_store_join(spark, sf_dir):
    return asof(spark, sf_dir, store_hub(spark, sf_dir), "store_num", sales_ecom.STORE)


@query
def asof_store_sweep(spark, sf_dir):
    """The store in force at each order, from one pass over orders and versions, cut at two instants."""
    lines = order_lines(spark, sf_dir).select("order_id", "order_item_id", "store_num", "order_timestamp")
    cuts = ["1995-01-01 00:00:00", "1998-01-01 00:00:00"]
    return lookup.interval_sweep(lines, store_hub(spark, sf_dir), "store_num", "order_timestamp", sales_ecom.STORE, slices=cuts)


@query
def asof_ship_store_join(spark, sf_dir):
    return asof(spark, sf_dir, store_hub(spark, sf_dir), "ship_store_num", sales_ecom.SHIP_STORE)


@query
def asof_currency_join(spark, sf_dir):
    return asof(spark, sf_dir, currency_hub(spark, sf_dir), "currency_code", sales_ecom.CURRENCY)


@query
def asof_product_join(spark, sf_dir):
    return asof(spark, sf_dir, product_hub(spark, sf_dir), "sku_number", ["product_rhid", "product_grpid"], "left")


@query
def null_safe_join(spark, sf_dir):
    """Lines to the daily totals of their store, unmapped stores included."""
    lines = frame(spark, sf_dir, "v_fact").select("order_id", "store_rhid", "order_date_key", "sales_qty")
    totals = lines.groupBy("store_rhid", "order_date_key").agg(F.sum("sales_qty").alias("store_day_qty"))
    return lookup.null_safe_join(lines, totals, ["order_date_key"], ["store_rhid"])


@query
def dimension_flatten(spark, sf_dir):
    nation = frame(spark, sf_dir, "nation")
    dims = [
        lookup.Dimension(nation, "s_nationkey", "n_nationkey", "nation"),
        lookup.Dimension(frame(spark, sf_dir, "region"), "nation_n_regionkey", "r_regionkey", "region"),
        lookup.Dimension(
            frame(spark, sf_dir, "v_mst_currency"), "s_nationkey", "currency_rhid", "currency",
            {"currency_grpid": "currency_code"},
        ),
    ]
    return lookup.flatten_dimensions(frame(spark, sf_dir, "supplier").drop("s_acctbal"), dims)


def hierarchy_tables(spark, sf_dir):
    """A table for each of the seventeen dimensions, made of nations, regions and customers."""
    nation, region = frame(spark, sf_dir, "nation"), frame(spark, sf_dir, "region")
    tables = {}
    for name, _, key in hierarchy.STORE_DIMENSIONS:
        source, number, text = (region, "r_regionkey", "r_name") if name == "region" else (nation, "n_nationkey", "n_name")
        label = F.concat(F.lit(f"{name} "), F.col(text)).alias("label")
        tables[name] = source.select(F.col(number).cast("int").alias(key), label)
    customer = frame(spark, sf_dir, "customer")
    tables["customer"] = customer.select(
        F.col("c_custkey").cast("int").alias("customer_rhid"), F.col("c_name").alias("label"),
        F.col("c_nationkey").cast("int").alias("currency_rhid"),
    )
    return tables


@query
def store_hierarchy(spark, sf_dir):
    """Stores with all seventeen dimensions: the currency through the customer, the address through the location."""
    return hierarchy.store_hierarchy(frame(spark, sf_dir, "v_store_links"), hierarchy_tables(spark, sf_dir))


# --- use cases ----------------------------------------------------------------


def ecom(spark, sf_dir, plan):
    return plan(
        frame(spark, sf_dir, "v_items"), frame(spark, sf_dir, "v_order_log"), store_hub(spark, sf_dir),
        currency_hub(spark, sf_dir), product_hub(spark, sf_dir), JOB, NOW,
    )


@query
def ecom_sales_detail(spark, sf_dir):
    return ecom(spark, sf_dir, sales_ecom.ecom_sales)


@query
def ecom_sales_by_branch(spark, sf_dir):
    return ecom(spark, sf_dir, sales_ecom.ecom_sales_by_branch)


def retail(spark, sf_dir, assembly):
    return sales_retail.retail_sales(
        frame(spark, sf_dir, "v_sales"), frame(spark, sf_dir, "v_upcref"), store_hub(spark, sf_dir),
        product_hub(spark, sf_dir), JOB, NOW, "POS", assembly,
    )


@query
def retail_sales_detail(spark, sf_dir):
    return retail(spark, sf_dir, "keyed")


@query
def retail_sales_per_line(spark, sf_dir):
    return retail(spark, sf_dir, "line")


@query
def store_visits_daily(spark, sf_dir):
    return visits.store_visits(frame(spark, sf_dir, "v_traffic"), store_hub(spark, sf_dir))


@query
def store_visits_merge(spark, sf_dir):
    """Days with late readings, recomputed whole over the first load, before which some stores were not mapped."""
    traffic, hub = frame(spark, sf_dir, "v_late_traffic"), store_hub(spark, sf_dir)
    late = F.col("rec_update_timestamp") >= F.lit(LATE).cast("timestamp")
    first_hub = hub.where("store_grpid not like '%5'")
    first = visits.stamped_visits(visits.store_visits(traffic.where(~late), first_hub), "first", "2024-01-16 00:00:00")
    again = visits.stamped_visits(visits.store_visits(traffic, hub, changed=late), "second", "2024-02-01 00:00:00")
    return visits.merge_visits(first, again)


def gold(spark, sf_dir, grain):
    return metrics.store_metrics(
        frame(spark, sf_dir, "v_fact"), frame(spark, sf_dir, "v_mst_store"), frame(spark, sf_dir, "v_visits"),
        frame(spark, sf_dir, "v_mst_product"), frame(spark, sf_dir, "v_mst_product_line"), grain,
    )


@query
def gold_store_metrics_as_written(spark, sf_dir):
    return gold(spark, sf_dir, "store")


@query
def gold_store_metrics_per_day(spark, sf_dir):
    return gold(spark, sf_dir, "day")
