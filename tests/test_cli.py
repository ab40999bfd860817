import json

import pytest

from tests.changes import ROW, envelopes, seq
from tidemark.__main__ import main
from tidemark.schemas import AUDIT_LOGS, envelope
from tidemark.sources.tables import append_batch, read_or_empty

COLUMNS = "JOB_NAME,LOAD_TYPE,INPUT_LOCATION,OUTPUT_LOCATION,TIMEOUT,CHECKPOINT_LOCATION,PRIMARY_KEYS,SOURCE_TYPE,TRIGGER_PROCESSING_TIME,INPUT_SQL_STMT,TRGT_TABLE_NAME,MERGE_BUCKETS"


@pytest.fixture
def config(tmp_path):
    file = tmp_path / "jobs.csv"
    file.write_text(
        f"{COLUMNS}\n"
        f"current,CDC,{tmp_path}/in,{tmp_path}/curr,-1,{tmp_path}/cp1,id,DELTA_AVRO,once,,,2\n"
        f"ingest,,,{tmp_path}/ct,-1,{tmp_path}/cp2,id,,once,,brz_ct_cli,2\n"
        f"gold,,,{tmp_path}/gold,-1,,,SALES,once,{tmp_path}/steps.json,gold_table,2\n"
    )
    return str(file)


def test_current_job(spark, tmp_path, config):
    envelopes(spark, [("INSERT", 1, 1, "a"), ("UPDATE", 2, 1, "b")]).write.parquet(str(tmp_path / "in"))
    main(["current", "--job-name", "current", "--config", config, "--audit", str(tmp_path / "log")])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "curr")).select("id", "name").collect()] == [(1, "b")]
    logged = read_or_empty(spark, str(tmp_path / "log"), AUDIT_LOGS).first()
    assert (logged["job_name"], logged["input_row_count"], logged["output_row_count"]) == ("current", 2, 1)


def test_ingest_job(spark, tmp_path, config):
    schema_file = tmp_path / "record.json"
    schema_file.write_text(envelope(ROW).json())
    record = {"data": {"id": 1, "name": "a"}, "headers": {"operation": "INSERT", "changeSequence": seq(1), "timestamp": "2024-01-01T00:00:01"}}
    frame = bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(record).encode())
    rows = spark.createDataFrame([(frame, "2024-01-05")], "value binary, timestamp string")
    rows.selectExpr("value", "cast(timestamp as timestamp) as timestamp").write.parquet(str(tmp_path / "frames"))
    main(["ingest", "--job-name", "ingest", "--config", config, "--envelope", str(schema_file), "--format", "json",
          "--source-folder", str(tmp_path / "frames")])
    assert spark.table("brz_hist_cli").select("id", "rec_crud_text").collect() == [(1, "INSERT")]


def test_usecase_job(spark, tmp_path, config):
    steps = [
        {"name": "cli_numbers", "sql": "select id from range(5)"},
        {"name": "input_count", "sql": "select count(*) row_count from cli_numbers"},
        {"name": "output_count", "sql": "select count(*) row_count from cli_numbers where id > 2 and :job_name = 'gold'"},
    ]
    (tmp_path / "steps.json").write_text(json.dumps(steps))
    main(["usecase", "--job-name", "gold", "--config", config, "--audit", str(tmp_path / "log")])
    logged = read_or_empty(spark, str(tmp_path / "log"), AUDIT_LOGS).first()
    assert (logged["input_row_count"], logged["output_row_count"], logged["sink_name"]) == (5, 2, "gold_table")


def test_sql_job(spark, tmp_path):
    out = str(tmp_path / "out")
    for mode in ("overwrite", "append"):
        main(["sql", "--job-name", "s", "--sql-query", "select 7 as x", "--output-location", out, "--write-mode", mode])
    assert [r[0] for r in spark.read.parquet(out).collect()] == [7, 7]


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        main(["current", "--job-name", "x"])


def test_compact_job(spark, tmp_path):
    path = str(tmp_path / "ct")
    for batch in range(2):
        append_batch(spark.sql(f"select {batch} a, date'2024-01-05' ingest_date"), path, ["ingest_date"], batch, fixed=True)
    main(["compact", "--path", path, "--value", "2024-01-05"])
    assert [f.name for f in (tmp_path / "ct" / "ingest_date=2024-01-05").iterdir() if f.is_dir()] == ["batch_id=compacted"]
    assert spark.read.parquet(path).count() == 2
