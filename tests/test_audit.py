import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, incremental
from tidemark.plans import jobs
from tidemark.schemas import AUDIT_LOGS, JOB_RUN_LOGS, USECASE_AUDIT_LOGS
from tidemark.sources.tables import append_rows, read_or_empty


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def log(spark, *entries):
    """(job, mark, status, created, updated) rows."""
    return spark.createDataFrame([(j, m, s, c, j, u, None) for j, m, s, c, u in entries], USECASE_AUDIT_LOGS)


@pytest.mark.parametrize(
    "entries,mark",
    [
        ([], dt.datetime(1900, 1, 1)),
        ([("j", at(5), None, at(6), None)], dt.datetime(1900, 1, 1)),
        ([("j", at(5), "COMPLETED", at(6), at(7)), ("j", at(9), None, at(9), None)], at(5)),
        ([("j", at(5), "COMPLETED", at(6), at(7)), ("j", None, "COMPLETED", at(8), at(8))], at(5)),
        ([("j", None, "COMPLETED", at(8), at(8))], dt.datetime(1900, 1, 1)),
        ([("other", at(5), "COMPLETED", at(6), at(7))], dt.datetime(1900, 1, 1)),
    ],
)
def test_watermark(spark, entries, mark):
    assert audit.watermark(log(spark, *entries), "j").first()[0] == mark


def test_incremental_rows_are_strictly_newer(spark, rows):
    df = spark.createDataFrame([(1, at(4)), (2, at(5)), (3, at(5, 1))], "id int, rec_update_timestamp timestamp")
    done = log(spark, ("j", at(5), "COMPLETED", at(6), at(6)))
    assert rows(incremental.incremental(df, done, "j"), "id") == [(3,)]
    assert incremental.incremental(df, done, "new job").count() == 3


def test_closing_touches_the_newest_open_run_only(spark):
    entries = [
        ("j", at(1), None, at(1), None),
        ("j", at(2), None, at(2), None),
        ("j", at(3), "COMPLETED", at(3), at(3)),
        ("k", at(4), "COMPLETED", at(4), at(4)),
    ]
    state = {(r[0], r[3]): r for r in audit.complete_newest(log(spark, *entries), at(9)).collect()}
    assert state["j", at(1)]["load_status"] is None
    closed = state["j", at(2)]
    assert (closed["load_status"], closed["rec_update_timestamp"], closed["rec_update_user_name"]) == ("COMPLETED", at(9), "j")
    assert state["j", at(3)]["rec_update_timestamp"] == at(3)
    assert len(state) == 4


def test_appended_closing_row_gives_the_updated_state(spark, rows):
    runs = log(spark, ("j", at(1), None, at(1), None), ("k", at(2), None, at(2), None))
    closing = audit.close_run(runs, "j", at(9))
    assert closing.count() == 1
    state = dict(rows(audit.run_state(runs.unionByName(closing)), "jobname", "load_status"))
    assert state == {"j": "COMPLETED", "k": None}
    assert audit.close_run(runs, "nobody", at(9)).count() == 0


def test_upstream_readiness(spark, rows):
    runs = log(
        spark,
        ("a", at(1), "COMPLETED", at(2), at(2)),
        ("b", at(1), "COMPLETED", at(2), at(2)),
        ("b", at(1), None, at(3), None),
        ("c", at(1), "COMPLETED", at(1), at(1)),
    )
    assert rows(audit.upstream_ready(runs, at(2))) == [("a", True), ("b", False)]
    assert audit.all_ready(runs, ["a"], at(2))
    assert not audit.all_ready(runs, ["a", "b"], at(2))
    assert not audit.all_ready(runs, ["a", "c"], at(2))


def test_run_log_row_of_success_and_failure(spark):
    good = audit.run_log_row(spark, "j", ("KAFKA", "t"), ("TABLE", "p"), 5, 4, now=at(1)).first()
    assert (good["input_row_count"], good["output_row_count"], good["exception_ind"], good["exception_dtl"]) == (5, 4, 0, "")
    bad = audit.run_log_row(spark, "j", ("KAFKA", "t"), ("TABLE", "p"), 5, 4, ValueError("it's bad"), at(1)).first()
    assert (bad["output_row_count"], bad["exception_ind"], bad["exception_dtl"]) == (0, 1, "its bad")
    assert bad["rec_create_timestamp"] == at(1)


def test_clock_is_read_at_call_time(spark):
    first = audit.run_log_row(spark, "j", (None, None), (None, None), 0, 0).first()["rec_create_timestamp"]
    assert abs(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - first) < dt.timedelta(minutes=5)


def test_job_run_row(spark):
    row = audit.job_run_row(spark, "RUN", "j", 7, "BATCH", "api", "ok", at(1))
    assert row.schema.names == JOB_RUN_LOGS.names and row.first()["job_id"] == 7


def test_reconcile_counts_groups_and_rows(spark):
    source = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    target = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    got = audit.reconcile(source, target, ["a", "b"], F.col("x") > 1, {"top": F.max("x")})
    assert got.columns == ["input_row_count", "output_row_count", "top"] and got.first() == (2, 2, 3)
    assert audit.reconcile(source, target).first() == (3, 3)


def test_audited_loads_pick_up_where_the_last_completed_one_stopped(spark, rows, tmp_path):
    audit_path, target = str(tmp_path / "audit"), str(tmp_path / "target")
    schema = "id int, rec_update_timestamp timestamp"

    def load(batch, marks):
        append_rows(batch, target)

    def broken(batch, marks):
        raise RuntimeError("no space")

    source = [(1, at(1)), (2, at(2))]
    jobs.run_incremental(spark, "j", audit_path, spark.createDataFrame(source, schema), load, now=at(10))
    source.append((3, at(3)))
    with pytest.raises(RuntimeError):
        jobs.run_incremental(spark, "j", audit_path, spark.createDataFrame(source, schema), broken, now=at(11))
    source.append((4, at(4)))
    result = jobs.run_incremental(spark, "j", audit_path, spark.createDataFrame(source, schema), load, now=at(12))
    assert (result.marks.low, result.marks.high, result.input_rows) == (at(2), at(4), 2)
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (3,), (4,)]
    empty = jobs.run_incremental(spark, "j", audit_path, spark.createDataFrame(source, schema), load, now=at(13))
    assert empty.input_rows == 0
    state = audit.run_state(read_or_empty(spark, audit_path, USECASE_AUDIT_LOGS))
    assert rows(state, "rec_create_timestamp", "load_status") == [
        (at(10), "COMPLETED"), (at(11), None), (at(12), "COMPLETED"), (at(13), "COMPLETED"),
    ]
    again = jobs.run_incremental(spark, "j", audit_path, spark.createDataFrame(source, schema), load, now=at(14))
    assert again.marks.low == at(4)


def test_script_counts_and_failures_are_logged(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    spark.range(10).createOrReplaceTempView("script_numbers")
    steps = [
        jobs.Step("script_even", "select id, :job_name as job from script_numbers where id % 2 = 0"),
        jobs.Step("input_count", "select count(*) row_count from script_numbers -- 10"),
        jobs.Step("output_count", "select count(*) row_count from script_even where job = :job_name"),
    ]
    assert jobs.run_usecase(spark, "j", steps, path, "numbers", ("SILVER", "even"), now=at(1)) == (10, 5)
    with pytest.raises(Exception, match="no_such_table"):
        jobs.run_usecase(spark, "j", [jobs.Step("x", "select * from no_such_table")], path, "n", ("S", "e"), now=at(2))
    logged = rows(read_or_empty(spark, path, AUDIT_LOGS), "input_row_count", "output_row_count", "exception_ind")
    assert logged == [(0, 0, 1), (10, 5, 0)]


def test_steps_come_from_a_json_list(spark, tmp_path):
    file = tmp_path / "steps.json"
    file.write_text('[{"name": "a", "sql": "select 1; "}, {"name": "b", "sql": "select 2"}]')
    assert [s.name for s in jobs.load_steps(spark, str(file))] == ["a", "b"]


def test_sql_job_modes_and_registration(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    jobs.run_sql_job(spark, "select :x as x", path, "overwrite", "sql_job_out", {"x": 1})
    jobs.run_sql_job(spark, "select :x as x", path, None, "sql_job_out", {"x": 2})
    spark.catalog.refreshTable("sql_job_out")
    assert rows(spark.table("sql_job_out")) == [(1,), (2,)]
    jobs.run_sql_job(spark, "select 3 as x", path, "overwrite")
    assert rows(spark.read.parquet(path)) == [(3,)]
