"""Row hashes, key hashes and masking."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "||"  # fixed value: joins the parts of a hashed row


def digest(columns: Iterable[str | Column], null_safe: bool = False) -> Column:
    """SHA-256 hex over the columns' text joined with ``||``.

    Nulls are skipped, so ('a', null, 'b') and ('a', 'b', null) share a digest.
    ``null_safe`` marks each part as present or null and keeps them apart.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [c.cast("string") for c in parts]
    if null_safe:
        parts = [F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c)) for c in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def with_hash(df: DataFrame, name: str, columns: Iterable[str], null_safe: bool = False) -> DataFrame:
    return df.withColumn(name, digest(columns, null_safe))


def mask(column: Column) -> Column:
    """SHA-256 hex of the value's text; null stays null."""
    return F.sha2(column.cast("string"), 256)


def mask_struct(df: DataFrame, struct: str, columns: Iterable[str]) -> Column:
    """``struct`` with the named fields masked, order kept, null struct kept."""
    chosen = {c.lower() for c in columns}
    fields = []
    for name in df.schema[struct].dataType.names:
        value = F.col(f"`{struct}`.`{name}`")
        fields.append((mask(value) if name.lower() in chosen else value).alias(name))
    return F.when(F.col(struct).isNotNull(), F.struct(*fields)).alias(struct)


def mask_pii(df: DataFrame, columns: Iterable[str], images: Iterable[str] = ("data", "beforeData")) -> DataFrame:
    """Mask the columns in both row images of a change table.

    A masked field becomes a string whatever its type was.
    """
    columns = list(columns)
    present = [image for image in images if image in df.columns]
    known = {n.lower() for image in present for n in df.schema[image].dataType.names}
    unknown = [c for c in columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"no such columns to mask: {unknown}")
    return df.withColumns({image: mask_struct(df, image, columns) for image in present})


def mask_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The same for a flat table."""
    return df.withColumns({c: mask(F.col(c)) for c in columns})
