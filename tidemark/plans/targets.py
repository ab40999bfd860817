"""The target tables: databases, layers, partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources.tables import create_database, create_table


@dataclass(frozen=True)
class Target:
    database: str
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    layer: str

    @property
    def table(self) -> str:
        return f"{self.database}.{self.name}"

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.database}/{self.name}"


# Where each table lives and how it is partitioned.
USECASE_AUDIT = Target("delta_logs", "usecase_audit_logs", schemas.USECASE_AUDIT_LOGS, (), "SILVER")
STORE_VISITS = Target(
    "slv_retail_sales", "agg_store_visits_daily", schemas.AGG_STORE_VISITS_DAILY, ("visit_date_key",), "SILVER"
)
RETAIL_SALES = Target(
    "slv_retail_sales", "dtl_retail_sales", schemas.DTL_RETAIL_SALES, ("rec_create_date_key",), "SILVER"
)
STORE_METRICS = Target(
    "gld_performance", "agg_store_metrics_daily", schemas.AGG_STORE_METRICS_DAILY, ("rec_create_date_key",), "GOLD"
)
TARGETS = (USECASE_AUDIT, STORE_VISITS, RETAIL_SALES, STORE_METRICS)
STAGING_DATABASE = "transient_dl"

BATCH = T.StructField("batch_id", T.StringType())
#: Metrics are replaced day by day, so they lie by the month of their day.
MONTH = T.StructField("month_key", T.IntegerType())


def create_targets(spark: SparkSession, root: str) -> None:
    """Create the databases and the empty tables below ``root`` unless they exist.

    The appended sales fact carries the ``batch_id`` folder its loads write to,
    the metrics the month they lie by.
    """
    for database in dict.fromkeys([STAGING_DATABASE, *(t.database for t in TARGETS)]):
        create_database(spark, database)
    for target in TARGETS:
        schema, parts = target.schema, target.partition_by
        if target is RETAIL_SALES:
            schema, parts = T.StructType([*schema.fields, BATCH]), ("batch_id", *parts)
        elif target is STORE_METRICS:
            schema, parts = T.StructType([*schema.fields, MONTH]), (MONTH.name,)
        create_table(spark, target.path(root), schema, parts, target.table, properties={"layer": target.layer})
