"""Reference-hub lookups, effective-dated joins and dimension flattening."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizing import BROADCAST_LIMIT, broadcast_if_small, measured_bytes

START = "effective_start_timestamp"
END = "effective_end_timestamp"
#: Versions that a code may have for a row to carry them all.
FEW = 8


def lookup_hub(
    hub: DataFrame,
    systems: DataFrame,
    master: DataFrame,
    table_name: str,
    group: str,
    columns: Sequence[str],
    system: str | None = None,
) -> DataFrame:
    """Master versions with their source-system keys, optionally of one source system.

    ``hub_code`` is the natural key without its ``_<source system id>`` ending,
    so a fact code can be matched by equality (null when the ending is absent).
    """
    rows = hub.where(F.col("ref_hub_table_name") == table_name)
    named = systems if system is None else systems.where(F.col("source_system_name") == system)
    joined = rows.join(named, "source_system_id").join(master, rows["grpid"] == master[group])
    return joined.select(
        "source_system_id",
        "source_system_name",
        "source_system_natural_key",
        hub_code().alias("hub_code"),
        *columns,
        START,
        END,
    )


def hub_code(natural_key: str = "source_system_natural_key", system_id: str = "source_system_id") -> Column:
    """``code`` such that ``code || '_' || system_id`` is the natural key, else null."""
    key = F.col(natural_key)
    ending = F.concat(F.lit("_"), F.col(system_id).cast("string"))
    return F.when(
        F.endswith(key, ending), F.substring(key, F.lit(1), F.length(key) - F.length(ending))
    )


def effective_join(
    fact: DataFrame,
    hub: DataFrame,
    code: str,
    ts: str,
    columns: Mapping[str, str] | Sequence[str],
    closed: str = "both",
    system: str | None = None,
    limit: int | None = BROADCAST_LIMIT,
) -> DataFrame:
    """Left join to the hub version in force at ``ts``; unmatched facts get nulls.

    ``columns`` maps hub columns to output names.  ``closed`` is ``both`` (start
    and end inclusive, touching versions match twice) or ``left`` (end excluded).
    ``system`` restricts the matching hub rows to one source system.

    The equality on the hub code makes this a hash join with a range residual.
    A hub within ``limit`` bytes is broadcast and the fact does not move; None
    takes the hub as given, with the hint it may already carry.
    """
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    side = hub_side(hub, columns, system)
    matched = fact.join(
        side if limit is None else broadcast_if_small(side, limit),
        (F.col(code).cast("string") == F.col("_code")) & _in_force(F.col(ts), F.col("_start"), F.col("_end"), closed),
        "left",
    )
    return matched.select(*fact.columns, *[F.col(f"_hub_{o}").alias(o) for o in columns.values()])


def hub_side(hub: DataFrame, columns: Mapping[str, str], system: str | None = None) -> DataFrame:
    """What an effective-dated join needs of the hub: its codes, their validity and the columns looked up."""
    if system is not None:
        hub = hub.where(F.col("source_system_name") == system)
    return hub.where(F.col("hub_code").isNotNull()).select(
        F.col("hub_code").alias("_code"),
        F.col(START).alias("_start"),
        F.col(END).alias("_end"),
        *[F.col(c).alias(f"_hub_{out}") for c, out in columns.items()],
    )


def _in_force(ts: Column, start: Column, end: Column, closed: str) -> Column:
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    at = ts.cast("timestamp")
    return (at >= start) & (at < end if closed == "left" else at <= end)


@dataclass(frozen=True)
class CarriedVersions:
    """The effective-dated join in two steps, for a hub that is too large to broadcast.

    ``attach`` gives each row the versions of its code, before the time is known
    or where the codes are fewer than the facts; ``pick`` keeps the ones in
    force at the time.  Together they return what ``effective_join`` does, but
    the facts need not move by the code after they have met their time: ``pick``
    moves nothing.  Codes of more than ``few`` versions are not carried; ``pick``
    looks them up by ``effective_join``.
    """

    hub: DataFrame
    code: str
    columns: Mapping[str, str]
    closed: str = "both"
    system: str | None = None
    few: int = FEW

    @property
    def _carried(self) -> str:
        return "_versions_" + "_".join(self.columns.values())

    def _counted(self) -> DataFrame:
        same_code = Window.partitionBy("_code")
        return hub_side(self.hub, self.columns, self.system).withColumn("_n", F.count(F.lit(1)).over(same_code))

    def attach(self, rows: DataFrame) -> DataFrame:
        version = F.struct("_start", "_end", *[f"_hub_{o}" for o in self.columns.values()])
        carried = self._counted().where(F.col("_n") <= self.few).groupBy("_code").agg(F.collect_list(version).alias(self._carried))
        return rows.join(carried, F.col(self.code).cast("string") == F.col("_code"), "left").drop("_code")

    def pick(self, fact: DataFrame, ts: str) -> DataFrame:
        held = F.filter(self._carried, lambda v: _in_force(F.col(ts), v["_start"], v["_end"], self.closed))
        names = [c for c in fact.columns if c != self._carried]
        outs = list(self.columns.values())
        found = fact.select("*", F.explode_outer(held).alias("_version"))
        found = found.select(*names, *[F.col(f"_version._hub_{o}").alias(o) for o in outs])
        rest = self._counted().where(F.col("_n") > self.few).drop("_n")
        size = measured_bytes(rest)
        if not size:
            return found
        # No row has versions from both, so the first that is there counts.
        rest = rest.select(F.col("_code").alias("hub_code"), F.col("_start").alias(START), F.col("_end").alias(END), *[f"_hub_{o}" for o in outs])
        both = effective_join(
            found, F.broadcast(rest) if size <= BROADCAST_LIMIT else rest, self.code, ts,
            {f"_hub_{o}": f"_rest_{o}" for o in outs}, self.closed, limit=None,
        )
        return both.select(*names, *[F.coalesce(o, f"_rest_{o}").alias(o) for o in outs])


def effective_join_lying(
    fact: DataFrame,
    hub: DataFrame,
    code: str,
    ts: str,
    columns: Mapping[str, str],
    by: str,
    closed: str = "both",
    asking: DataFrame | None = None,
) -> DataFrame:
    """``effective_join`` for facts that lie by ``by`` and a hub too large to broadcast.

    Only the distinct (``by``, code, time) go to the hub, and what they found
    comes back to where the facts lie: these do not move, whatever their width,
    and lie by ``by`` afterwards.  It needs
    ``spark.sql.requireAllClusterKeysForCoPartition`` off when it runs.  The
    facts are computed twice, so they should be read from a table; ``asking``
    has the same codes and times at less cost, if there is such a frame.
    """
    keys, outs = [by, code, ts], list(columns.values())
    known = (fact if asking is None else asking).where(F.col(code).isNotNull() & F.col(ts).isNotNull())
    asked = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    held = _in_force(F.col(f"_k_{ts}"), F.col("_start"), F.col("_end"), closed)
    found = asked.join(hub_side(hub, columns), (F.col(f"_k_{code}").cast("string") == F.col("_code")) & held)
    found = found.select(*[f"_k_{k}" for k in keys], *[f"_hub_{o}" for o in outs])
    same = reduce(and_, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    return fact.join(found, same, "left").select(*fact.columns, *[F.col(f"_hub_{o}").alias(o) for o in outs])


def interval_sweep(
    fact: DataFrame,
    hub: DataFrame,
    code: str,
    ts: str,
    columns: Mapping[str, str] | Sequence[str],
    closed: str = "both",
    slices: Sequence[object] = (),
) -> DataFrame:
    """The same left join for a hub whose codes have one version at a time, as one pass over facts and versions.

    Facts and versions are put in one line by code and time, and each fact takes
    the last version before it, if that is still in force: the work
    is linear in both, where the hash join compares every fact of a code with every version
    of it. It is meant for hubs too big to broadcast and for codes with
    thousands of versions.

    A code's versions must not overlap (``hub_overlaps`` lists those that do);
    where they do, the one that started last counts. Versions that only touch,
    the end of one being the start of the next, give a fact at that instant the
    later one. ``slices`` are ascending instants that cut the time line of each code: a slice
    is sorted in a task of its own, so a code with a third of all facts is
    spread over as many tasks, and a version that spans several slices is put at the start of each.
    Facts with a null code or time get nulls.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    cuts = F.array(*[F.lit(s).cast("timestamp") for s in slices]).cast("array<timestamp>")

    def slice_of(time: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= time))

    version = F.struct(F.col(END).alias("_end"), *[F.col(c).alias(o) for c, o in columns.items()])
    kept = hub.where(F.col("hub_code").isNotNull() & F.col(START).isNotNull() & F.col(END).isNotNull() & (F.col(START) <= F.col(END)))
    versions = kept.select(
        F.col("hub_code").alias("_code"), F.col(START).cast("timestamp").alias("_at"), F.lit(0).alias("_side"), version.alias("_version"),
        F.explode(F.sequence(slice_of(F.col(START)), slice_of(F.col(END)))).alias("_slice"),
    )
    at = F.col(ts).cast("timestamp")
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    known = F.col(code).isNotNull() & at.isNotNull()
    facts = fact.where(known).select(F.col(code).cast("string").alias("_code"), at.alias("_at"), F.lit(1).alias("_side"), row.alias("_row"), slice_of(at).alias("_slice"))
    line = facts.unionByName(versions, allowMissingColumns=True)
    so_far = Window.partitionBy("_code", "_slice").orderBy("_at", "_side", F.col("_version._end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = line.withColumn("_last", F.last("_version", ignorenulls=True).over(so_far)).where("_side = 1")
    valid = F.col("_at") < F.col("_last._end") if closed == "left" else F.col("_at") <= F.col("_last._end")
    found = swept.select("_row.*", *[F.when(valid, F.col(f"_last.`{o}`")).alias(o) for o in columns.values()])
    types = {f.name: f.dataType for f in found.schema.fields}
    rest = fact.where(~F.coalesce(known, F.lit(False))).select(*fact.columns, *[F.lit(None).cast(types[o]).alias(o) for o in columns.values()])
    return found.unionByName(rest)


def hub_overlaps(hub: DataFrame) -> DataFrame:
    """Hub rows whose validity touches or overlaps the next version of the same code."""
    following = Window.partitionBy("source_system_natural_key").orderBy(START, END)
    return hub.withColumn("next_start_timestamp", F.lead(START).over(following)).where(
        F.col("next_start_timestamp") <= F.col(END)
    )


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    nullable_keys: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Equi join in which two nulls of a nullable key match; key columns come from the left."""
    matched = [*keys, *nullable_keys]
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in matched})
    plain = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    tolerant = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in nullable_keys]
    joined = left.join(other, reduce(and_, plain + tolerant), how)
    return joined.drop(*[f"_r_{k}" for k in matched])


def assemble_branches(base: DataFrame, branches: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner joins of separately looked-up branches back on the fact key.

    All sides are keyed alike, so the whole chain needs one exchange per side.
    """
    result = base
    for branch in branches:
        result = result.join(branch, list(keys), "inner")
    return result


@dataclass(frozen=True)
class Dimension:
    """One left join of a flattened hierarchy.

    ``on`` is the column of the row so far, ``key`` the dimension's own column.
    """

    table: DataFrame
    on: str
    key: str
    prefix: str
    columns: Mapping[str, str] | None = None

    def side(self) -> DataFrame:
        names = self.columns or {
            c: f"{self.prefix}_{c}" for c in self.table.columns if c != self.key
        }
        return self.table.select(
            F.col(self.key).alias(f"_key_{self.prefix}"), *[F.col(c).alias(o) for c, o in names.items()]
        )


def flatten_dimensions(fact: DataFrame, dimensions: Iterable[Dimension]) -> DataFrame:
    """Left join each dimension in turn, its columns prefixed so none collide.

    A dimension read from files carries its size, so Spark itself decides
    which ones to broadcast.
    """
    result = fact
    for dim in dimensions:
        side = dim.side()
        key = f"_key_{dim.prefix}"
        result = result.join(side, F.col(dim.on) == F.col(key), "left").drop(key)
    return result
