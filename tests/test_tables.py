import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import AGG_STORE_VISITS_DAILY
from tidemark.session import shared_folder, work_path
from tidemark.sources import tables


def test_create_table_once_with_properties(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.create_database(spark, "slv_test")
    for _ in range(2):
        tables.create_table(
            spark, path, AGG_STORE_VISITS_DAILY, ["visit_date_key"], "slv_test.visits", properties={"layer": "SILVER"}
        )
    assert spark.table("slv_test.visits").count() == 0
    shown = {r[0]: r[1] for r in spark.sql("show tblproperties slv_test.visits").collect()}
    assert shown["layer"] == "SILVER"
    assert [c.name for c in spark.catalog.listColumns("slv_test.visits") if c.isPartition] == ["visit_date_key"]
    tables.append_rows(
        spark.sql("select 5 as store_rhid, 20240101 as visit_date_key"), path, AGG_STORE_VISITS_DAILY, ["visit_date_key"]
    )
    spark.catalog.refreshTable("slv_test.visits")
    assert rows(spark.table("slv_test.visits"), "store_rhid", "visit_date_key", "entry_count") == [(5, 20240101, None)]


def test_create_table_keeps_existing_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("p", T.IntegerType())])
    spark.sql("select 1 a, 2 p").write.partitionBy("p").parquet(path)
    tables.create_table(spark, path, schema, ["p"], "kept_table")
    assert spark.table("kept_table").count() == 1


def test_create_table_as_select_is_once_only(spark, tmp_path, rows):
    tables.create_table_as(spark.sql("select 1 a"), "ctas_once", str(tmp_path / "c"))
    tables.create_table_as(spark.sql("select 2 a"), "ctas_once", str(tmp_path / "c"))
    assert rows(spark.table("ctas_once")) == [(1,)]


def test_batch_append_is_idempotent_and_evolves(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.sql("select 1 a, 10 p union all select 2, 20")
    tables.append_batch(first, path, ["p"], "q-0")
    tables.append_batch(first, path, ["p"], "q-0")
    tables.append_batch(spark.sql("select 3 a, 10 p, 'x' b"), path, ["p"], "q-1", balance=True)
    assert rows(tables.read_appended(spark, path), "a", "p", "b") == [(1, 10, None), (2, 20, None), (3, 10, "x")]


def test_staging_is_overwritten_and_sized(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    tables.overwrite_stage(spark.range(5).toDF("a"), path)
    assert rows(tables.overwrite_stage(spark.range(2).toDF("a"), path)) == [(0,), (1,)]


def test_views_are_lazy_and_replaced(spark, rows):
    tables.create_view(spark.sql("select 1 a"), "some_view")
    tables.create_view(spark.sql("select 2 a"), "some_view")
    assert rows(spark.table("some_view")) == [(2,)]


def test_read_or_empty(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert tables.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0


def test_work_paths_live_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    one, two = work_path(spark, "x"), work_path(spark, "x")
    assert one != two and one.startswith(folder)


def test_balanced_append_splits_a_hot_partition(spark, tmp_path):
    """One day holding nearly all rows is written by several tasks."""
    df = spark.range(200_000).select(F.when(F.col("id") < 10, 1).otherwise(2).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.append_batch(df.repartition(8), str(tmp_path / "t"), ["p"], 0, balance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "batch_id=0" / "p=2").glob("*.parquet"))) > 1


def test_compaction_makes_one_batch_of_a_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.append_batch(spark.sql("select 1 a, 10 p union all select 2, 20"), path, ["p"], "q-0", fixed=True)
    tables.append_batch(spark.sql("select 3 a, 10 p, 'x' b"), path, ["p"], "q-1", fixed=True)
    want = [(1, 10, None), (2, 20, None), (3, 10, "x")]
    for _ in range(2):
        assert tables.compact_partition(spark, path, "p", "10") == 2
        assert rows(tables.read_appended(spark, path), "a", "p", "b") == want
        assert [f.name for f in (tmp_path / "t" / "p=10").iterdir() if f.is_dir()] == ["batch_id=compacted"]
    assert [f.name for f in (tmp_path / "t" / "p=20").iterdir() if f.is_dir()] == ["batch_id=q-0"]


def test_compaction_that_broke_off_is_finished(spark, tmp_path, rows, monkeypatch):
    """The run ends after the rows were staged, when the partition is already gone."""
    path = str(tmp_path / "t")
    tables.append_batch(spark.sql("select 1 a, 10 p"), path, ["p"], "q-0", fixed=True)
    tables.append_batch(spark.sql("select 2 a, 10 p"), path, ["p"], "q-1", fixed=True)
    writer = type(spark.range(1).write)
    real = writer.parquet

    def torn(self, to, *more, **options):
        if to == f"{path}/p=10":
            real(spark.range(0).withColumnRenamed("id", "a").write.mode("overwrite"), to)
            raise OSError("lost")
        return real(self, to, *more, **options)

    monkeypatch.setattr(writer, "parquet", torn)
    with pytest.raises(OSError):
        tables.compact_partition(spark, path, "p", "10")
    monkeypatch.setattr(writer, "parquet", real)
    assert tables.compact_partition(spark, path, "p", "10") == 2
    assert rows(tables.read_appended(spark, path), "a", "p") == [(1, 10), (2, 10)]


def test_a_date_filter_lists_only_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_batch(spark.sql("select 1 a, date'2024-01-01' d union all select 2, date'2024-01-02'"), path, ["d"], "q-0", fixed=True)
    day = tables.read_appended(spark, path).where("d = date'2024-01-02'")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
