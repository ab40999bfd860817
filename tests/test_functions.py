import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.changes import envelopes
from tidemark.config import JobConfig, split_list
from tidemark.functions import conform, hashing, times
from tidemark.schemas import (
    AGG_STORE_METRICS_DAILY,
    AGG_STORE_VISITS_DAILY,
    DTL_RETAIL_SALES,
    HEADERS,
    load_schema,
    schema_from_avro,
)


def test_hash_skips_nulls_unless_null_safe(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = hashing.with_hash(df, "h", df.columns).select("h").distinct()
    safe = hashing.with_hash(df, "h", df.columns, null_safe=True).select("h").distinct()
    assert plain.count() == 1
    assert safe.count() == 2


def test_masking_covers_both_images_and_makes_strings(spark):
    df = envelopes(spark, [("UPDATE", 1, 7, "ann", (7, "anna")), ("INSERT", 2, None, "bob")])
    masked = hashing.mask_pii(df, ["id", "name"])
    assert masked.schema["data"].dataType["id"].dataType == T.StringType()
    got = masked.select("data.id", "data.name", "beforeData.id", "beforeData.name", "beforeData").collect()
    digest = spark.range(1).select(F.sha2(F.lit("7"), 256)).first()[0]
    assert got[0][0] == digest and got[0][2] == digest
    assert got[0][3] != got[0][1] and len(got[0][3]) == 64
    assert got[1][0] is None and got[1][4] is None


def test_masking_keeps_other_columns_and_rejects_unknown_ones(spark):
    df = envelopes(spark, [("INSERT", 1, 7, "ann")])
    assert hashing.mask_pii(df, ["name"]).select("data.id").first()[0] == 7
    with pytest.raises(ValueError):
        hashing.mask_pii(df, ["nmae"])


@pytest.mark.parametrize(
    "text,hour,minute",
    [("12:30 pm", 12, 30), ("12:30 am", 0, 30), ("01:05 pm", 13, 5), ("11:59 PM", 23, 59)],
)
def test_twelve_hour_clock(spark, text, hour, minute):
    day = F.lit("2021-05-03").cast("date")
    got = spark.range(1).select(times.twelve_hour(day, F.lit(text))).first()[0]
    assert got == dt.datetime(2021, 5, 3, hour, minute)


def test_twelve_hour_clock_of_bad_text_is_null(spark):
    day = F.lit("2021-05-03").cast("date")
    got = spark.range(1).select(
        times.twelve_hour(day, F.lit("25:00 pm")), times.twelve_hour(day, F.lit(None).cast("string"))
    )
    assert got.first() == (None, None)


@pytest.mark.parametrize(
    "local,utc",
    [("2021-07-01 12:00:00", 19), ("2021-01-01 12:00:00", 20), ("2021-11-07 01:30:00", 8), ("2021-03-14 02:30:00", 10)],
)
def test_store_time_to_utc_follows_daylight_saving(spark, local, utc):
    got = spark.range(1).select(times.to_utc(F.lit(local).cast("timestamp"))).first()[0]
    assert got.hour == utc


def test_epoch_millis_past_2038(spark):
    df = spark.createDataFrame([(2208988800000,), (1500,), (None,)], "at bigint")
    got = [r[0] for r in times.epoch_to_timestamp(df, ["at"]).collect()]
    assert got == [dt.datetime(2040, 1, 1), dt.datetime(1970, 1, 1, 0, 0, 1), None]


def test_conform_reports_values_that_did_not_fit(spark):
    df = spark.createDataFrame(
        [("1", "2.5", "2020-01-02", "x"), ("one", "2.5", None, "y")], "a string, b string, c string, d string"
    )
    got = conform.conform_types(df, {"a": "bigint", "b": "decimal(9,2)", "c": "date"}, "failed").collect()
    assert got[0] == (1, Decimal("2.500000"), dt.date(2020, 1, 2), "x", "")
    assert got[1] == (None, Decimal("2.500000"), None, "y", "a")


def test_declared_types_come_from_a_metadata_frame(spark):
    meta = spark.createDataFrame(
        [("t", "a", "bigint"), ("t", "b", "varchar string"), ("u", "a", "date")],
        "classname string, columnname string, columndatatype string",
    )
    assert conform.declared_types(meta, "t") == {"a": "bigint", "b": "varchar string"}
    assert conform.declared_type("bigint") == T.LongType()
    assert conform.declared_type("datetime not null") == T.TimestampType() and conform.declared_type("int(11)") == T.IntegerType()
    with pytest.raises(ValueError):
        conform.declared_type("blob")


def test_widen_decimals_reaches_nested_fields(spark):
    df = spark.sql("select cast(1.5 as decimal(5,1)) a, named_struct('x', cast(2 as decimal(9,0)), 'y', 'z') s, 1 k")
    wide = conform.widen_decimals(df)
    assert wide.schema["a"].dataType == T.DecimalType(20, 6)
    assert wide.schema["s"].dataType["x"].dataType == T.DecimalType(20, 6)
    assert wide.schema["s"].dataType["y"].dataType == T.StringType()
    assert wide.schema["k"].dataType == T.IntegerType()


def test_as_table_orders_casts_and_fills(spark):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    got = conform.as_table(spark.sql("select 1 as A, 2 as extra"), schema)
    assert got.schema.names == ["b", "a"] and got.first() == (None, 1)


def test_target_tables_have_their_widths():
    assert len(DTL_RETAIL_SALES) == 62
    assert len(AGG_STORE_METRICS_DAILY) == 43
    assert len(AGG_STORE_VISITS_DAILY) == 12


AVRO = """{"type": "record", "name": "R", "fields": [
  {"name": "data", "type": {"type": "record", "name": "Data", "fields": [
    {"name": "id", "type": ["null", "int"], "default": null},
    {"name": "price", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 6}]},
    {"name": "day", "type": ["null", {"type": "int", "logicalType": "date"}]},
    {"name": "at", "type": ["null", {"type": "long", "logicalType": "timestamp-micros"}]},
    {"name": "raw", "type": ["null", "bytes"]}, {"name": "ratio", "type": ["null", "double"]}]}},
  {"name": "beforeData", "type": ["null", "Data"], "default": null},
  {"name": "headers", "type": {"type": "record", "name": "H", "fields": [
    {"name": "operation", "type": {"type": "enum", "name": "op", "symbols": ["INSERT", "UPDATE"]}},
    {"name": "changeMask", "type": ["null", "bytes"]}, {"name": "last", "type": ["null", "boolean"]}]}}]}"""


def test_avro_schema_document_to_struct():
    schema = schema_from_avro(AVRO)
    data = schema["data"].dataType
    assert [f.dataType for f in data] == [
        T.IntegerType(), T.DecimalType(20, 6), T.DateType(), T.TimestampType(), T.BinaryType(), T.DoubleType(),
    ]
    assert schema["beforeData"].dataType == data
    assert schema["headers"].dataType["operation"].dataType == T.StringType()


def test_schema_from_spark_json_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(HEADERS.json())
    assert load_schema(spark, str(path)) == HEADERS


def test_job_config_is_one_row_with_typed_properties(spark):
    table = spark.createDataFrame(
        [("j1", "a, b ,c", "once", "60", "x/curr", "brz_curr_t"), ("j2", "a", "30 seconds", "-1", "y", None), ("j2", "a", "once", "0", "z", None)],
        "JOB_NAME string, PRIMARY_KEYS string, TRIGGER_PROCESSING_TIME string, TIMEOUT string, OUTPUT_LOCATION string, TRGT_TABLE_NAME string",
    )
    cfg = JobConfig.from_table(table, "j1")
    assert cfg.keys == ["a", "b", "c"]
    assert cfg.trigger == {"availableNow": True}
    assert cfg.timeout_seconds == 60
    assert (cfg.exception_location, cfg.exception_table) == ("x/excp", "brz_excp_t")
    for name in ("missing", "j2"):
        with pytest.raises(ValueError):
            JobConfig.from_table(table, name)


def test_sibling_names_never_equal_the_table():
    cfg = JobConfig("j", output_location="lake/orders/", trgt_table_name="orders")
    assert (cfg.exception_location, cfg.exception_table, cfg.history_view) == (
        "lake/orders_excp", "orders_excp", "orders_hist",
    )
    cfg = JobConfig("j", output_location="lake/curr/orders", trgt_table_name="brz_ct_x.orders")
    assert (cfg.exception_location, cfg.history_view) == ("lake/excp/orders", "brz_hist_x.orders")


def test_job_config_defaults():
    cfg = JobConfig("j", trigger_processing_time="10 seconds", timeout="0")
    assert cfg.trigger == {"processingTime": "10 seconds"}
    assert cfg.timeout_seconds is None
    assert split_list(None) == [] and split_list(" a ,, b") == ["a", "b"]
