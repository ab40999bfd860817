"""Whether two tables hold the same rows, as often: order-free digests of their contents.

Counts that agree say little: a lost row and a doubled one cancel. The digest
of a set of rows is their number, the sum of one 64-bit hash of each and the
exclusive or of another. It does not depend on order or partitions, repeats
count, and it combines map-side: a group costs one row per task.

A null is a value of its own, wherever it stands. Both sides need the same
columns; the right one is cast to the left one's types, so an int equals the
bigint it became. A value that the cast cannot hold fails it under ANSI rules.
Map columns have no order and are refused. Equal contents always have equal
digests; unlike ones agree by chance about once in 2^64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = ("source_rows", "target_rows")
_SIGN = "_sign"


class ContentMismatch(Exception):
    """What was written is not what was to be written."""


def _hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    maps = [c for c in columns if isinstance(df.schema[c].dataType, T.MapType)]
    if maps:
        raise ValueError(f"map columns have no order to digest: {', '.join(maps)}")
    named = [F.col(f"`{c}`") for c in columns]
    # The hash passes over nulls, so which columns are null goes into it too.
    return F.xxhash64(F.lit(seed), *[c.isNull() for c in named], *named)


def digest(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, Column]:
    """The aggregates of a digest over the columns (all), by name: for ``agg`` or ``observe``."""
    columns = df.columns if columns is None else columns
    return {
        "rows": F.count(F.lit(1)),
        "total": F.sum(_hash(df, columns, 1).cast("decimal(38,0)")),
        "mixed": F.bit_xor(_hash(df, columns, 2)),
    }


def watched(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The frame with an observation of its digest, which the pass that writes it fills on its way."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in digest(df, columns).items()]), seen


def digest_of(df: DataFrame, columns: Sequence[str] | None = None) -> dict:
    """The digest, by a pass of its own."""
    return df.agg(*[c.alias(n) for n, c in digest(df, columns).items()]).first().asDict()


def same_digest(one: dict, other: dict) -> bool:
    """Whether two digests agree; of no rows there is only one."""
    return all((one.get(n) or 0) == (other.get(n) or 0) for n in ("rows", "total", "mixed"))


def _signed(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both sides' rows under the left one's types, the target's with sign -1."""
    left = source.select(*[F.col(f"`{c}`") for c in columns])
    right = target.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in left.schema.fields])
    return left.withColumn(_SIGN, F.lit(1)).union(right.withColumn(_SIGN, F.lit(-1)))


def _columns(source: DataFrame, columns: Sequence[str] | None, groups: Sequence[str]) -> list[str]:
    chosen = list(source.columns if columns is None else columns)
    return [*chosen, *[g for g in groups if g not in chosen]]


def differing_groups(
    source: DataFrame, target: DataFrame, groups: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The groups whose rows differ between the sides: their keys, and the rows of both.

    Both sides are digested in one aggregation, so one exchange moves a row per
    group and task. Null is a group. A group that only one side has is listed.
    """
    signed = _signed(source, target, _columns(source, columns, groups))
    compared = [c for c in signed.columns if c != _SIGN]
    total = F.sum(_hash(signed, compared, 1).cast("decimal(38,0)") * F.col(_SIGN))
    counts = [F.count_if(F.col(_SIGN) == s).alias(n) for s, n in zip((1, -1), COUNTS, strict=True)]
    found = signed.groupBy(*groups).agg(*counts, total.alias("_total"), F.bit_xor(_hash(signed, compared, 2)).alias("_mixed"))
    unlike = (F.col(COUNTS[0]) != F.col(COUNTS[1])) | (F.col("_total") != 0) | (F.col("_mixed") != 0)
    return found.where(unlike).select(*groups, *COUNTS)


def differing_rows(
    source: DataFrame, target: DataFrame, groups: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows that one side has more often than the other, with how often each has them.

    Only rows of groups that differ are exchanged; equal groups cost their digest.
    """
    unlike = differing_groups(source, target, groups, columns).select(*[F.col(g).alias(f"_g_{g}") for g in groups])
    signed = _signed(source, target, _columns(source, columns, groups))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    compared = [c for c in signed.columns if c != _SIGN]
    counts = [F.count_if(F.col(_SIGN) == s).alias(n) for s, n in zip((1, -1), COUNTS, strict=True)]
    rows = signed.join(unlike, same, "left_semi").groupBy(*compared).agg(*counts)
    return rows.where(F.col(COUNTS[0]) != F.col(COUNTS[1]))
