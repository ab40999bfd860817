"""High-water-mark filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.audit import watermark


def incremental(df: DataFrame, audit: DataFrame, job: str, ts: str = "rec_update_timestamp") -> DataFrame:
    """Rows newer than the job's last completed load.

    The mark is an uncorrelated scalar subquery: Spark evaluates it first and
    pushes the resulting comparison into the file scan.  It is the mark that is
    cast to the column's type, never the column.
    """
    mark = watermark(audit, job).scalar().cast(df.schema[ts].dataType)
    return df.where(F.col(ts) > mark)
