import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.changes import ENVELOPE, ROW, envelopes, seq
from tidemark.config import JobConfig
from tidemark.operators.merge import KeyedTable
from tidemark.schemas import AUDIT_LOGS, STREAMING_AUDITS, envelope
from tidemark.sources import streams, tables
from tidemark.streaming import jobs
from tidemark.streaming.progress import ProgressLog

NOW = "2024-02-01 10:11:12"


def config(tmp_path, **settings):
    base = {
        "job_name": "job", "output_location": str(tmp_path / "curr" / "t"), "checkpoint_location": str(tmp_path / "cp"),
        "primary_keys": "id", "load_type": "CDC", "merge_buckets": "4", "max_files_per_trigger": "1",
        "input_location": str(tmp_path / "in"), "source_type": "DELTA_AVRO",
    }
    return JobConfig(**{**base, **settings})


def land(spark, cfg, *changes):
    """One file of change records in the input folder."""
    envelopes(spark, [(op, n, key, name) for key, name, op, n in changes]).coalesce(1).write.mode("append").parquet(
        cfg.input_location
    )


def run(spark, cfg, **how):
    return jobs.wait(jobs.current_stream(spark, cfg, now=NOW, **how), cfg)


def current(spark, cfg):
    df = spark.read.parquet(cfg.output_location)
    return sorted(tuple(r) for r in df.select("id", "name", "rec_crud_text", "delete_ind").collect())


def test_batches_restart_and_state(spark, tmp_path):
    cfg = config(tmp_path)
    land(spark, cfg, (1, "a", "REFRESH", 1), (2, "b", "INSERT", 2))
    land(spark, cfg, (1, "A", "UPDATE", 3), (3, "c", "INSERT", 4))
    query = run(spark, cfg)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 2
    assert current(spark, cfg) == [(1, "A", "UPDATE", 0), (2, "b", "INSERT", 0), (3, "c", "INSERT", 0)]
    run(spark, cfg)
    assert len(current(spark, cfg)) == 3
    land(spark, cfg, (2, "b", "DELETE", 5))
    run(spark, cfg)
    assert current(spark, cfg)[1] == (2, "b", "DELETE", 1)


def test_tables_are_registered_under_their_names(spark, tmp_path):
    cfg = config(tmp_path, trgt_table_name="reg_curr_t")
    land(spark, cfg, (1, "a", "UPDATE", 1), (1, "b", "UPDATE", 2))
    run(spark, cfg)
    for name in ("reg_curr_t", "reg_excp_t"):
        spark.catalog.refreshTable(name)
    assert spark.table("reg_curr_t").select("id", "name").collect() == [(1, "b")]
    assert spark.table("reg_excp_t").where("rec_create_date_key = 20240201").count() == 2


@pytest.mark.parametrize("guarded,name", [(True, "new"), (False, "old")])
def test_older_change_in_a_later_batch(spark, tmp_path, guarded, name):
    cfg = config(tmp_path)
    land(spark, cfg, (1, "new", "UPDATE", 9))
    run(spark, cfg, guarded=guarded)
    land(spark, cfg, (1, "old", "UPDATE", 3))
    run(spark, cfg, guarded=guarded)
    assert current(spark, cfg) == [(1, name, "UPDATE", 0)]


def test_null_keys_are_quarantined_and_reported(spark, tmp_path):
    cfg = config(tmp_path)
    land(spark, cfg, (None, "x", "INSERT", 1), (1, "a", "INSERT", 2))
    run(spark, cfg)
    assert current(spark, cfg) == [(1, "a", "INSERT", 0)]
    bad = spark.read.parquet(cfg.exception_location).collect()
    assert [(r["rule_name"], r["name"]) for r in bad] == [("NullCheckForPKs", "x")]


def test_exceptions_are_stored_by_date_with_hashes(spark, tmp_path):
    cfg = config(tmp_path)
    land(spark, cfg, (1, "a", "UPDATE", 1), (1, "b", "UPDATE", 2))
    run(spark, cfg)
    bad = spark.read.parquet(cfg.exception_location)
    assert bad.count() == 2
    row = bad.first()
    assert row["rule_name"] == "DuplicateCheck" and row["rec_create_date_key"] == 20240201
    assert len(row["rec_row_hash"]) == len(row["rec_pk_hash"]) == 64


def test_replayed_batch_adds_nothing(spark, tmp_path):
    cfg = config(tmp_path)
    log = str(tmp_path / "audit")
    land(spark, cfg, (1, "a", "UPDATE", 1), (1, "b", "UPDATE", 2))
    query = run(spark, cfg)
    before = current(spark, cfg), spark.read.parquet(cfg.exception_location).count()
    last = max(p.batchId for p in query.recentProgress if p.numInputRows)
    batch = jobs.change_rows(spark.read.parquet(cfg.input_location), cfg)
    jobs.merge_batch(batch, last, cfg, jobs.Audit(log), now=NOW)
    assert (current(spark, cfg), spark.read.parquet(cfg.exception_location).count()) == before
    counts = tables.read_or_empty(spark, log, AUDIT_LOGS).select("input_row_count", "output_row_count").first()
    assert tuple(counts) == (2, 1)


def test_fresh_checkpoint_does_not_hide_new_rows(spark, tmp_path):
    """Batch 0 of a second query is not mistaken for batch 0 of the first."""
    cfg = config(tmp_path)
    land(spark, cfg, (1, "a", "INSERT", 1))
    run(spark, cfg)
    second = config(tmp_path, checkpoint_location=str(tmp_path / "cp2"), input_location=str(tmp_path / "in2"))
    land(spark, second, (2, "b", "INSERT", 2))
    run(spark, second)
    assert [r[0] for r in current(spark, cfg)] == [1, 2]


def test_failure_is_logged_and_raised(spark, tmp_path):
    cfg = config(tmp_path, primary_keys="no_such_column")
    log = str(tmp_path / "audit")
    land(spark, cfg, (1, "a", "INSERT", 1))
    with pytest.raises(Exception, match="no_such_column"):
        run(spark, cfg, audit=jobs.Audit(log))
    row = tables.read_or_empty(spark, log, AUDIT_LOGS).first()
    assert (row["exception_ind"], row["output_row_count"]) == (1, 0) and "no_such_column" in row["exception_dtl"]


def test_append_load_keeps_every_change(spark, tmp_path):
    cfg = config(tmp_path, load_type="append")
    land(spark, cfg, (1, "a", "UPDATE", 1), (1, "b", "DELETE", 2))
    run(spark, cfg)
    run(spark, cfg)
    got = spark.read.parquet(cfg.output_location)
    assert got.count() == 2
    assert got.select("rec_pk_hash").distinct().count() == 1


def test_unknown_load_and_source_types_raise(spark, tmp_path):
    cfg = config(tmp_path, load_type="SNAPSHOT")
    land(spark, cfg, (1, "a", "UPDATE", 1))
    with pytest.raises(ValueError, match="SNAPSHOT"):
        run(spark, cfg)
    with pytest.raises(ValueError, match="FILES_XML"):
        streams.open_source(spark, config(tmp_path, source_type="files_xml"))


def test_all_four_source_types_open(spark, tmp_path):
    schema_file = tmp_path / "schema.json"
    schema_file.write_text(ROW.json())
    landed = tmp_path / "in"
    spark.createDataFrame([("k", '{"id": 1}')], "key string, value string").write.parquet(str(landed))
    for kind in ("FILES_CSV", "files_json", "DELTA_JSON", "DELTA_AVRO"):
        cfg = config(tmp_path, source_type=kind, input_schema=str(schema_file), input_timestamp_format="yyyy")
        stream = streams.open_source(spark, cfg)
        assert stream.isStreaming
        assert stream.columns == (["key", "value"] if kind == "DELTA_AVRO" else ["id", "name"])


def test_bounded_wait_returns_while_the_query_runs(spark, tmp_path):
    cfg = config(tmp_path, trigger_processing_time="1 seconds", timeout="2")
    land(spark, cfg, (1, "a", "UPDATE", 1))
    query = run(spark, cfg)
    assert query.isActive
    query.processAllAvailable()
    query.stop()
    assert current(spark, cfg) == [(1, "a", "UPDATE", 0)]


def frames(spark, tmp_path, *payloads):
    rows = [(bytearray(b"\x00\x00\x00\x00\x07" + p.encode()), "2024-01-05 10:00:00") for p in payloads]
    df = spark.createDataFrame(rows, "value binary, timestamp string")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "frames"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "frames"))


def payload(key, name, operation="INSERT", **more):
    headers = {"operation": operation, "changeSequence": seq(1), "timestamp": "2024-01-01T00:00:01.5"}
    return json.dumps({"data": {"id": key, "name": name, **more}, "beforeData": None, "headers": headers})


def test_ingest_lands_masked_changes_by_arrival_date(spark, tmp_path):
    cfg = config(tmp_path, output_location=str(tmp_path / "ct"), columns_to_be_masked="name")
    log = str(tmp_path / "audit")
    frames(spark, tmp_path, payload(1, "a"), "garbage")
    stream = frames(spark, tmp_path, payload(2, "b", "REFRESH"))
    jobs.wait(jobs.ingest_stream(spark, cfg, envelope(ROW), stream, audit=jobs.Audit(log)), cfg)
    ct = tables.read_appended(spark, cfg.output_location)
    assert ct.select("ingest_date").distinct().count() == 1
    assert sorted(str(r[0]) for r in ct.select("data.id").collect()) == ["1", "2", "None"]
    assert {len(r[0]) for r in ct.where("data is not null").select("data.name").collect()} == {64}
    logged = tables.read_or_empty(spark, log, AUDIT_LOGS).agg(F.sum("input_row_count"), F.count("*")).first()
    assert tuple(logged) == (3, 2)
    name = jobs.publish_history(spark, cfg)
    assert name == "job_hist"
    assert spark.table(name).where("rec_crud_text = 'REFRESH'").first()["rec_create_time_key"] == 120000


def test_ingest_replay_and_new_columns(spark, tmp_path):
    cfg = config(tmp_path, output_location=str(tmp_path / "ct"))
    stream = frames(spark, tmp_path, payload(1, "a"))
    query = jobs.wait(jobs.ingest_stream(spark, cfg, envelope(ROW), stream), cfg)
    again = spark.read.schema(stream.schema).parquet(str(tmp_path / "frames"))
    last = max(p.batchId for p in query.recentProgress if p.numInputRows)
    jobs.ingest_batch(again, last, cfg, envelope(ROW), "json", jobs.Audit())
    assert tables.read_appended(spark, cfg.output_location).count() == 1
    wider = T.StructType([*ROW.fields, T.StructField("extra", T.StringType())])
    frames(spark, tmp_path, payload(2, "b", extra="e"))
    jobs.wait(jobs.ingest_stream(spark, cfg, envelope(wider), stream), cfg)
    ct = tables.read_appended(spark, cfg.output_location)
    assert sorted((r[0], r[1]) for r in ct.select("data.id", "data.extra").collect()) == [(1, None), (2, "e")]


def test_stream_result_equals_batch_result(spark, tmp_path):
    cfg = config(tmp_path)
    changes = [(i % 7, f"n{i}", ("INSERT", "UPDATE", "DELETE")[i % 3], i) for i in range(40)]
    for part in range(0, 40, 10):
        land(spark, cfg, *changes[part : part + 10])
    run(spark, cfg)
    whole = jobs.change_rows(spark.read.parquet(cfg.input_location), cfg)
    want = jobs.current_rows(whole, cfg, now=NOW)
    got = KeyedTable(spark, cfg.output_location, jobs.current_table_schema(whole), ["id"]).read()
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_flat_feed_translation(spark, tmp_path):
    cfg = config(tmp_path, translation_type="CSV", source_type="FILES_CSV")
    spark.createDataFrame(
        [(1, "a", "2024-01-01 00:00:00", "U"), (1, "a", "2024-01-02 00:00:00", "D")],
        "id int, name string, timestamp string, flag string",
    ).write.csv(cfg.input_location)
    run(spark, cfg, schema=T.StructType([*ROW.fields, *[T.StructField(n, T.StringType()) for n in ("timestamp", "flag")]]))
    assert current(spark, cfg) == [(1, "a", "DELETE", 1)]


def test_epoch_columns_become_timestamps(spark, tmp_path):
    cfg = config(tmp_path, epoch_dates="id")
    rows = jobs.change_rows(envelopes(spark, [("INSERT", 1, 1500, "a")]), cfg)
    assert rows.first()["id"].second == 1


def test_progress_log_keeps_more_reports_than_spark_does(spark, tmp_path):
    """Spark keeps a few reports of a query; the log has all of them."""
    from tidemark.session import setting

    cfg = config(tmp_path, load_type="APPEND")
    for n in range(8):
        land(spark, cfg, (n, "a", "UPDATE", n + 1))
    with setting(spark, "spark.sql.streaming.numRecentProgressUpdates", "3"):
        with ProgressLog(spark, str(tmp_path / "progress")) as log:
            query = run(spark, cfg)
            log.wait(query)
    assert len(query.recentProgress) < 8
    logged = log.read()
    assert logged.schema == STREAMING_AUDITS
    assert logged.agg(F.sum("num_input_rows"), F.countDistinct("batch_id")).first()[:2] == (8, 8)


def test_progress_log_counts_failures_per_rule_and_batch(spark, tmp_path):
    """Counted while the batch passes: each row once, although the batch is used for several writes."""
    cfg = config(tmp_path, not_null_columns="name")
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        land(spark, cfg, (None, "a", "INSERT", 1), (None, None, "INSERT", 2), (1, None, "INSERT", 3), (2, "b", "INSERT", 4))
        log.wait(run(spark, cfg))
        land(spark, cfg, (3, "c", "INSERT", 5), (4, "", "UPDATE", 6), (4, "", "UPDATE", 6))
        log.wait(run(spark, cfg))
    counts = log.read_rules().groupBy("rule_name", "batch_id").agg(F.sum("failures")).collect()
    assert {tuple(r) for r in counts if r[2]} == {
        ("NullCheckForPKs", 0, 2), ("NullCheckForNotNullCols", 0, 1), ("NullCheckForNotNullCols", 1, 2),
    }


def test_a_reload_replaces_changed_rows_and_ignored_rows_are_counted(spark, tmp_path):
    cfg, log = config(tmp_path), str(tmp_path / "audit")
    land(spark, cfg, (1, "changed", "UPDATE", 9), (2, "b", "INSERT", 2))
    run(spark, cfg)
    land(spark, cfg, (1, "loaded", "REFRESH", 10), (3, "c", "REFRESH", 10))
    run(spark, cfg, audit=jobs.Audit(log))
    assert current(spark, cfg)[0] == (1, "changed", "UPDATE", 0)
    counts = spark.read.parquet(log).select("input_row_count", "output_row_count").collect()
    assert [tuple(r) for r in counts] == [(2, 1)]
    land(spark, cfg, (1, "loaded", "REFRESH", 11))
    run(spark, cfg, reload=True)
    assert current(spark, cfg)[0] == (1, "loaded", "REFRESH", 0)
    land(spark, cfg, (1, "later", "UPDATE", 12))
    run(spark, cfg)
    assert current(spark, cfg)[0] == (1, "later", "UPDATE", 0)


def test_history_is_published_while_the_stream_runs(spark, tmp_path):
    """Each batch asks for the newest record type; the view follows it and survives a quote in the user's name."""
    cfg = config(tmp_path, output_location=str(tmp_path / "ct"), trgt_table_name="pub_ct_t")
    calls = []

    def newest():
        calls.append(1)
        return envelope(ROW)

    record = {"data": {"id": 1, "name": "a"}, "headers": {"operation": "INSERT", "changeSequence": seq(1), "timestamp": "2024-01-01T00:00:01"}}
    frame = bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(record).encode())
    landed = spark.createDataFrame([(frame, "2024-01-05")], "value binary, timestamp string")
    landed.selectExpr("value", "cast(timestamp as timestamp) as timestamp").write.parquet(cfg.input_location)
    source = spark.readStream.schema("value binary, timestamp timestamp").parquet(cfg.input_location)
    query = jobs.ingest_stream(spark, cfg, newest, source, audit=jobs.Audit(user="O'Neil"), publish=True)
    jobs.wait(query, cfg)
    assert calls
    assert spark.table("pub_hist_t").select("id", "rec_create_user_name").collect() == [(1, "O'Neil")]
    days = list((tmp_path / "ct").glob("ingest_date=*/batch_id=*"))
    assert len(days) == 1


def test_kafka_and_delta_adapters_name_their_modules(spark, tmp_path):
    """Neither module is here: the readers must fail on the missing source, not before."""
    cfg = config(tmp_path, kafka_server="host:9092", kafka_topic="t", table_format="delta")
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_stream(spark, cfg, "user", "secret", {"maxOffsetsPerTrigger": "10"})
    with pytest.raises(Exception, match="(?i)delta"):
        streams.table_stream(spark, cfg)


def test_envelope_fixture_is_what_the_table_holds():
    assert ENVELOPE.names == ["data", "beforeData", "headers", "ingest_date"]


def test_parts_keep_their_partitions_and_are_one_batch_each(spark, monkeypatch):
    from workload import streams as workload_streams

    rows = spark.range(40).selectExpr("cast('{}' as binary) as value", "timestamp_seconds(id) as timestamp").repartition(4)
    monkeypatch.setattr(workload_streams.q, "changes", lambda spark, sf_dir: None)
    monkeypatch.setattr(workload_streams.q, "as_messages", lambda changes: rows)
    sources = []

    class Ended:
        def awaitTermination(self, *seconds):
            pass

    monkeypatch.setattr(workload_streams.jobs, "ingest_stream", lambda spark, cfg, envelope, source: sources.append(source) or Ended())
    cfg = workload_streams.config(spark, "parts")
    workload_streams.ingest_in_parts(spark, "", cfg, ("second(timestamp) < 20", "second(timestamp) >= 20"))
    batches = []
    stream = sources[-1].writeStream.option("checkpointLocation", cfg.checkpoint_location).trigger(**cfg.trigger)
    stream.foreachBatch(lambda df, i: batches.append((df.count(), df.select(F.input_file_name()).distinct().count()))).start().awaitTermination()
    assert len(batches) == 1 and batches[0][0] == 40 and batches[0][1] > 2


def test_a_replay_takes_the_messages_as_they_were_landed(spark, monkeypatch):
    from workload import streams as workload_streams

    rows = spark.range(40).selectExpr("cast('{}' as binary) as value", "timestamp_seconds(id) as timestamp").repartition(4)
    monkeypatch.setattr(workload_streams.q, "changes", lambda spark, sf_dir: None)
    monkeypatch.setattr(workload_streams.q, "as_messages", lambda changes: rows)
    cfg = workload_streams.config(spark, "replayed")
    query, part = workload_streams.ingest_in_parts(spark, "", cfg, ("second(timestamp) < 30", "second(timestamp) >= 30"))
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [10]
    assert part.inputFiles() and part.count() == 10
    assert part.columns == rows.columns
