"""Row validation: null rules, duplicates inside a batch, the exception set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import digest
from tidemark.operators.cdc import ORDERING, latest_by_key, tie_break

# Rule names in the exception table.
PK_RULE = "NullCheckForPKs"
NOT_NULL_RULE = "NullCheckForNotNullCols"
DUPLICATE_RULE = "DuplicateCheck"

CRUD = "rec_crud_text"


def is_blank(column: str) -> Column:
    """Null or the empty string; blanks made of spaces pass."""
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


def null_rule(primary_keys: Sequence[str], not_null: Sequence[str] = ()) -> Column:
    """The first rule a row breaks, or null."""
    rule = F.when(reduce(or_, map(is_blank, primary_keys)), F.lit(PK_RULE))
    if not_null:
        rule = rule.when(reduce(or_, map(is_blank, not_null)), F.lit(NOT_NULL_RULE))
    return rule


def rule_counts(primary_keys: Sequence[str], not_null: Sequence[str] = ()) -> list[Column]:
    """Failures per null rule as aggregates, named by the rule, for ``observe`` or ``agg``."""
    rule = null_rule(primary_keys, not_null)
    return [F.count_if(rule == name).alias(name) for name in (PK_RULE, NOT_NULL_RULE)]


def with_hashes(df: DataFrame, primary_keys: Sequence[str], row: Sequence[str] | None = None) -> DataFrame:
    """``rec_row_hash`` over the business columns and ``rec_pk_hash`` over key and operation."""
    row = list(row) if row is not None else df.columns
    return df.withColumns({"rec_row_hash": digest(row), "rec_pk_hash": digest([*primary_keys, CRUD])})


def null_check(df: DataFrame, primary_keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Adds ``rule_name`` and sets ``exception_ind`` to 1 on failing rows, null on the others."""
    checked = df.withColumn("rule_name", null_rule([*primary_keys, *_crud(df)], not_null))
    return checked.withColumn("exception_ind", F.when(F.col("rule_name").isNotNull(), 1))


def _crud(df: DataFrame) -> list[str]:
    return [CRUD] if CRUD in df.columns else []


def superseded_groups(
    df: DataFrame, primary_keys: Sequence[str], crud: str = CRUD, order: Sequence[str] = ORDERING
) -> DataFrame:
    """The (key, operation) groups holding at least one row that is not its key's newest.

    A group escapes only when it is a single row and that row is the newest of
    its key.  Row counts and newest positions come from an aggregate that
    combines map-side, so a key with a third of all rows ships a few rows per
    task; the window then sees one row per operation of each key.
    """
    position = F.struct(*[F.col(c) for c in order], tie_break(df).alias("_tie"))
    groups = df.groupBy(*primary_keys, crud).agg(F.count(F.lit(1)).alias("_n"), F.max(position).alias("_newest"))
    top = F.max("_newest").over(Window.partitionBy(*primary_keys))
    alone = (F.col("_n") == 1) & (F.col("_newest") == F.col("_top"))
    return groups.withColumn("_top", top).where(~alone).select(*primary_keys, crud)


def duplicate_check(
    df: DataFrame, primary_keys: Sequence[str], crud: str = CRUD, order: Sequence[str] = ORDERING
) -> DataFrame:
    """Every row whose (key, operation) also belongs to a superseded row of the batch."""
    groups, same = _keyed_groups(df, primary_keys, crud, order)
    return df.join(groups, same, "left_semi")


def _keyed_groups(
    df: DataFrame, primary_keys: Sequence[str], crud: str, order: Sequence[str]
) -> tuple[DataFrame, Column]:
    """The superseded groups under ``_g_`` names and the null-safe condition that joins them."""
    keys = [*primary_keys, crud]
    groups = superseded_groups(df, primary_keys, crud, order)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys]), same


def exceptions(
    df: DataFrame,
    primary_keys: Sequence[str],
    not_null: Sequence[str] = (),
    row: Sequence[str] | None = None,
    order: Sequence[str] = ORDERING,
) -> DataFrame:
    """Rows breaking a null rule plus the duplicates, header columns dropped, hashes last.

    A row can appear twice, once for each reason.
    """
    row = df.columns if row is None else row
    keys = [*primary_keys, CRUD]
    groups, same = _keyed_groups(df, primary_keys, CRUD, order)
    flagged = df.join(groups.withColumn("_duplicate", F.lit(True)), same, "left").drop(*[f"_g_{k}" for k in keys])
    # Both reasons of a row come out of one pass over it.
    reasons = F.array_compact(
        F.array(F.when(F.col("_duplicate"), F.lit(DUPLICATE_RULE)), null_rule(keys, not_null))
    )
    kept = [c for c in df.columns if c not in {"exception_ind", *order}]
    bad = with_hashes(flagged.where(F.size(reasons) > 0).withColumn("_reasons", reasons), primary_keys, row)
    return bad.select(
        F.explode("_reasons").alias("rule_name"), *kept, F.lit(1).alias("exception_ind"), "rec_row_hash", "rec_pk_hash"
    )


def valid_rows(
    df: DataFrame,
    primary_keys: Sequence[str],
    not_null: Sequence[str] = (),
    row: Sequence[str] | None = None,
    order: Sequence[str] = ORDERING,
) -> DataFrame:
    """The newest row of each key with ``exception_ind`` 0 or 1, hashes added.

    Rows breaking a null rule still pass, flagged.  Header columns are kept so
    a merge can compare change sequences.  Rules and hashes are computed on the
    newest rows only.
    """
    newest = latest_by_key(df, primary_keys, order)
    row = df.columns if row is None else row
    checked = null_check(with_hashes(newest, primary_keys, row), primary_keys, not_null)
    return checked.drop("rule_name").withColumn("exception_ind", F.coalesce("exception_ind", F.lit(0)))
