import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.changes import ENVELOPE, ROW, envelopes, flat, seq
from tidemark.operators import cdc, envelope, quality
from tidemark.schemas import envelope as envelope_type

NOW = "2024-02-01 10:11:12.345678"


def test_wire_header_is_stripped_and_its_id_kept(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02payload"),)], "value binary")
    got = envelope.strip_wire_header(df).first()
    assert (got["schema_id"], bytes(got["payload"])) == (258, b"payload")


@pytest.mark.parametrize("text", ["{", "not json", '{"data": ', ""])
def test_corrupt_payload_gives_nulls(spark, text):
    good = '{"data":{"id":1,"name":"a"},"headers":{"operation":"INSERT"}}'
    df = spark.createDataFrame([(text,), (good,)], "payload string").withColumn("ingest_date", F.current_date())
    got = envelope.decode_envelope(df, envelope_type(ROW)).select("data", "beforeData", "headers.operation").collect()
    assert got[0] == (None, None, None)
    assert got[1]["data"] == (1, "a") and got[1]["operation"] == "INSERT" and got[1]["beforeData"] is None


def test_payload_cut_anywhere_gives_nulls_and_a_wrong_type_one_null(spark):
    good = '{"data":{"id":1,"name":"a"},"headers":{"operation":"INSERT","transactionEventCounter":112165}}'
    odd = good.replace("112165", '"x"').replace('"id":1', '"id":"y"')
    df = spark.createDataFrame([*[(good[:n],) for n in range(len(good))], (None,), (odd,)], "payload string").withColumn("ingest_date", F.current_date())
    got = envelope.decode_envelope(df, envelope_type(ROW)).select("data", "headers").collect()
    assert all(tuple(r) == (None, None) for r in got[:-1])
    assert got[-1]["data"] == (None, "a") and got[-1]["headers"]["operation"] == "INSERT"
    landed = spark.createDataFrame([('{"a": 5, "b": ',), ('{"a": 5, "b": "x"}',)], "value string")
    assert [tuple(r) for r in envelope.json_value(landed, T.StructType.fromDDL("a int, b int")).collect()] == [(None, None), (5, None)]


def test_avro_needs_its_module_and_other_formats_fail(spark):
    with pytest.raises(ValueError):
        envelope.decode_payload(F.lit("x"), ROW, "xml")


def test_json_value_drops_key_and_value(spark):
    df = spark.createDataFrame([("k", '{"a": 5}', 1)], "key string, value string, part int")
    got = envelope.json_value(df, T.StructType([T.StructField("a", T.IntegerType())]))
    assert got.columns == ["a", "part"] and got.first() == (5, 1)


def test_enrichment_metadata(spark):
    df = envelopes(spark, [("UPDATE", 1, 1, "a"), ("DELETE", 2, 2, "b"), ("REFRESH", 3, 3, "c")])
    got = cdc.enrich_cdc(df, "me", NOW).select("data.*", "headers.*").orderBy("id").collect()
    update, delete, refresh = got
    assert update["rec_create_timestamp"] == dt.datetime(2024, 2, 1, 10, 11, 12)
    assert (update["rec_create_date_key"], update["rec_create_time_key"]) == (20240201, 101112)
    assert (update["rec_update_user_name"], delete["rec_update_user_name"]) == ("me", "")
    assert (update["delete_ind"], delete["delete_ind"]) == (0, 1)
    assert update["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 1, 123456)
    assert refresh["timestamp"] == dt.datetime(1970, 1, 1)
    assert refresh["changeSequence"] == "1970010100000000"
    assert refresh["rec_crud_text"] == "REFRESH" and refresh["exception_ind"] == refresh["resolved_ind"] == 0


def test_struct_and_flat_enrichment_agree(spark, rows):
    df = envelopes(spark, [("UPDATE", 1, 1, "a"), ("DELETE", 2, 2, "b"), ("REFRESH", 3, 3, "c")])
    nested = envelope.flatten(cdc.enrich_cdc(df, "me", NOW), cdc.HEADER_COLUMNS)
    narrow = cdc.with_meta(cdc.change_columns(df), "me", NOW)
    assert nested.columns == narrow.columns
    assert rows(nested) == rows(narrow)


def test_history_dates_initial_loads_by_arrival(spark):
    df = envelopes(spark, [("REFRESH", 1, 1, "a"), ("INSERT", 61, 2, "b")])
    first, second = cdc.history_view(df, "me").orderBy("id").collect()
    assert first["rec_create_timestamp"] == dt.datetime(2024, 1, 5)
    assert (first["rec_create_date_key"], first["rec_create_time_key"]) == (20240105, 120000)
    assert second["rec_update_timestamp"] == dt.datetime(2024, 1, 1, 0, 1, 1, 123456)
    assert (second["rec_create_date_key"], second["rec_create_time_key"]) == (20240101, 1)
    assert second["exception_ind"] is None


def test_history_query_equals_the_view(spark, rows):
    df = envelopes(spark, [("REFRESH", 1, 1, "a"), ("INSERT", 61, 2, "b"), ("DELETE", 62, 2, "b"), (None, 5, 3, "c")])
    df.createOrReplaceTempView("history_input")
    view, query = cdc.history_view(df, "me"), spark.sql(cdc.history_sql("history_input", "me"))
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in query.schema]
    assert rows(view) == rows(query)


def test_latest_orders_by_sequence_before_timestamp(spark):
    df = spark.createDataFrame(
        [(1, "002", 1, "late sequence"), (1, "001", 9, "late clock"), (1, "002", 2, "tie, later clock")],
        "id int, changeSequence string, hdr_timestamp int, name string",
    )
    assert cdc.latest_by_key(df, ["id"]).first()["name"] == "tie, later clock"


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_any_change_beats_the_initial_load(spark, order):
    changes = [(1, "initial", "REFRESH", 50), (1, "changed", "UPDATE", 3)]
    df = flat(spark, [changes[i] for i in order])
    assert cdc.latest_by_key(df, ["id"]).first()["name"] == "changed"


def test_latest_keeps_deletes(spark):
    got = quality.valid_rows(flat(spark, [(1, "a", "INSERT", 1), (1, "a", "DELETE", 2)]), ["id"])
    assert cdc.with_meta(got, flagged=True).select("rec_crud_text", "delete_ind").collect() == [("DELETE", 1)]


def test_latest_prunes_before_the_exchange(spark):
    plan = cdc.latest_by_key(flat(spark, [(1, "a", "INSERT", 1)]), ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_csv_feed_marks_deletes(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "D"), (2, "2024-01-02", "U")], "id int, timestamp string, flag string")
    got = cdc.csv_to_cdc(df).orderBy("id").collect()
    assert [r["cdc_deleted"] for r in got] == [True, False]
    assert got[0]["cdc_timestamp_raw"] == "2024-01-01"


def test_flat_feed_becomes_envelopes(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", "D"), (2, "2024-01-02 10:00:00", "I"), (3, "2024-01-03 10:00:00", None)],
        "id int, timestamp string, flag string",
    )
    got = cdc.change_columns(cdc.flat_to_envelope(df)).orderBy("id").collect()
    assert [r["rec_crud_text"] for r in got] == ["DELETE", "INSERT", "UPDATE"]
    assert got[0]["changeSequence"] == "20240101100000000000"


# --- quality -----------------------------------------------------------------


def checked(spark, data, schema, keys, not_null=()):
    df = spark.createDataFrame(data, schema + ", rec_crud_text string")
    return quality.null_check(df, keys, not_null)


def test_null_rules_first_failing_rule_wins(spark):
    data = [(None, None, "U"), ("", "x", "U"), (" ", "", "U"), ("k", "x", "U"), ("k", "x", None)]
    got = checked(spark, data, "k string, v string", ["k"], ["v"]).select("rule_name", "exception_ind").collect()
    pk, nn = "NullCheckForPKs", "NullCheckForNotNullCols"
    assert got == [(pk, 1), (pk, 1), (nn, 1), (None, None), (pk, 1)]


def test_null_rules_on_int_and_date_columns_under_ansi(spark):
    data = [(1, None, "U"), (None, dt.date(2024, 1, 1), "U"), (1, dt.date(2024, 1, 1), "U")]
    got = checked(spark, data, "k int, d date", ["k"], ["d"]).select("rule_name").collect()
    assert [r[0] for r in got] == ["NullCheckForNotNullCols", "NullCheckForPKs", None]


def names(df):
    return sorted(r["name"] for r in df.select("name").collect())


def test_same_operation_twice_reports_both(spark):
    df = flat(spark, [(1, "old", "UPDATE", 1), (1, "new", "UPDATE", 2), (2, "alone", "UPDATE", 3)])
    assert names(quality.duplicate_check(df, ["id"])) == ["new", "old"]


def test_superseded_other_operation_reports_only_itself(spark):
    df = flat(spark, [(1, "inserted", "INSERT", 1), (1, "updated", "UPDATE", 2)])
    assert names(quality.duplicate_check(df, ["id"])) == ["inserted"]


def test_duplicates_equal_the_rank_and_join_form(spark, rows):
    import random

    random.seed(7)
    data = [
        (random.choice([None, 1, 2, 3, 4]), f"n{i}", random.choice(["INSERT", "UPDATE", "DELETE"]), i) for i in range(60)
    ]
    df = flat(spark, data)
    ranked = cdc.ranked(df, ["id"])
    superseded = ranked.where("_rank > 1").select(F.col("id").alias("i"), F.col("rec_crud_text").alias("c")).distinct()
    want = ranked.join(superseded, F.col("id").eqNullSafe(F.col("i")) & (F.col("rec_crud_text") == F.col("c")))
    assert names(quality.duplicate_check(df, ["id"])) == names(want)


def test_exceptions_report_each_reason_and_put_hashes_last(spark):
    df = flat(spark, [(None, "a", "UPDATE", 1), (None, "b", "UPDATE", 2), (3, "c", "UPDATE", 3)])
    got = quality.exceptions(df, ["id"], ["name"], ["id", "name"])
    assert sorted(r[0] for r in got.select("rule_name").collect()) == ["DuplicateCheck"] * 2 + ["NullCheckForPKs"] * 2
    assert got.columns[0] == "rule_name" and got.columns[-2:] == ["rec_row_hash", "rec_pk_hash"]
    assert "changeSequence" not in got.columns
    assert {r[0] for r in got.select("exception_ind").collect()} == {1}


def test_row_hash_covers_business_columns_only(spark):
    one = quality.valid_rows(flat(spark, [(1, "a", "UPDATE", 1)]), ["id"], row=["id", "name"]).first()
    two = quality.valid_rows(flat(spark, [(1, "a", "UPDATE", 9)]), ["id"], row=["id", "name"]).first()
    assert one["changeSequence"] == seq(1) != two["changeSequence"]
    assert one["rec_row_hash"] == two["rec_row_hash"]


def test_rows_breaking_a_rule_still_reach_the_current_table(spark):
    got = quality.valid_rows(flat(spark, [(1, "", "UPDATE", 1), (2, "x", "UPDATE", 2)]), ["id"], ["name"])
    assert sorted(got.select("id", "exception_ind").collect()) == [(1, 1), (2, 0)]


def test_envelope_type_matches_the_fixture():
    assert ENVELOPE["data"].dataType == ROW
