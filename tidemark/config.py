"""Job configuration rows."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_list(text: str | None) -> list[str]:
    """Comma-separated names, trimmed; empty for null or blank text."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


@dataclass(frozen=True)
class JobConfig:
    """One configured job.

    The text columns are those of the configuration table; the properties give
    them their types.  ``table_format``, ``merge_buckets``,
    ``max_files_per_trigger`` and ``max_offsets_per_trigger`` are optional extra
    columns.
    """

    job_name: str
    table_name: str | None = None
    dataset_name: str | None = None
    kafka_server: str | None = None
    kafka_topic: str | None = None
    load_type: str | None = None
    translation_type: str | None = None
    input_location: str | None = None
    input_schema: str | None = None
    output_location: str | None = None
    timeout: str | None = None
    checkpoint_location: str | None = None
    primary_keys: str | None = None
    source_type: str | None = None
    trigger_processing_time: str | None = None
    input_timestamp_format: str | None = None
    input_sql_stmt: str | None = None
    trgt_table_name: str | None = None
    merge_statement: str | None = None
    columns_to_be_masked: str | None = None
    epoch_dates: str | None = None
    not_null_columns: str | None = None
    table_format: str = "parquet"
    merge_buckets: str | None = None
    max_files_per_trigger: str | None = None
    max_offsets_per_trigger: str | None = None

    @classmethod
    def from_mapping(cls, row: dict) -> JobConfig:
        known = {f.name for f in fields(cls)}
        values = {str(k).lower(): v for k, v in row.items()}
        return cls(**{k: v for k, v in values.items() if k in known and v is not None})

    @classmethod
    def from_table(cls, table: DataFrame, job_name: str) -> JobConfig:
        """The row of ``job_name``; anything but exactly one row is an error."""
        rows = table.where(F.col("job_name") == job_name).limit(2).collect()
        if len(rows) != 1:
            raise ValueError(f"{'no' if not rows else 'more than one'} config row for job {job_name!r}")
        return cls.from_mapping(rows[0].asDict())

    @property
    def keys(self) -> list[str]:
        return split_list(self.primary_keys)

    @property
    def not_null(self) -> list[str]:
        return split_list(self.not_null_columns)

    @property
    def masked(self) -> list[str]:
        return split_list(self.columns_to_be_masked)

    @property
    def epochs(self) -> list[str]:
        return split_list(self.epoch_dates)

    @property
    def timeout_seconds(self) -> int | None:
        """Seconds to wait for the stream, or None to wait until it ends."""
        seconds = int(self.timeout or -1)
        return seconds if seconds > 0 else None

    @property
    def buckets(self) -> int:
        return int(self.merge_buckets or 256)

    @property
    def trigger(self) -> dict:
        """Arguments for ``DataStreamWriter.trigger``."""
        interval = (self.trigger_processing_time or "once").strip().lower()
        return {"availableNow": True} if interval == "once" else {"processingTime": interval}

    @property
    def exception_location(self) -> str:
        """Beside the current table, never inside it."""
        return _sibling(self.output_location or "", "/curr", "/excp", "_excp")

    @property
    def exception_table(self) -> str | None:
        return self.trgt_table_name and _sibling(self.trgt_table_name, "_curr_", "_excp_", "_excp")

    @property
    def history_view(self) -> str | None:
        return self.trgt_table_name and _sibling(self.trgt_table_name, "_ct_", "_hist_", "_hist")


def _sibling(name: str, part: str, other: str, suffix: str) -> str:
    """The name with its layer part replaced, or with a suffix where it has none."""
    return name.replace(part, other) if part in name else name.rstrip("/") + suffix
