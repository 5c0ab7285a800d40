"""Difference between current points and the last published snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from fieldledger.operators.columns import quoted
from fieldledger.operators.keys import key_rows, keys_match
from fieldledger.operators.packs import Packs, matched, repeated_units
from fieldledger.schemas import POINT, POINT_KEYS


def _code(columns: Sequence[Column], at: str) -> list[Column]:
    """128 bits of hash of some columns as two longs ``<at>1`` and ``<at>2``, null where one of them is null."""
    given = reduce(and_, [c.isNotNull() for c in columns])
    seeds = ([], [F.lit(1)])
    return [F.when(given, F.xxhash64(*seed, *columns)).alias(f"{at}{i}") for i, seed in enumerate(seeds, 1)]


def _compared(
    current: DataFrame, posted: DataFrame, keys: Sequence[str], value: str, posted_unique: bool, join_hint: str | None
) -> DataFrame:
    """All current rows, each once, with ``_kind``: ``new``, ``changed``, or null where nothing moved."""
    kinds = dict(current.dtypes)
    old_keys = [quoted(k) if dict(posted.dtypes)[k] == kinds[k] else quoted(k).cast(kinds[k]) for k in keys]
    old = posted.select(*_code(old_keys, "_k"), *_code([quoted(value).cast("string")], "_v")).where("_k1 IS NOT NULL")
    if posted_unique:
        old = old.select("_k1", "_k2", *[F.col(f"_v{i}").alias(f"_{end}{i}") for i in (1, 2) for end in ("low", "high")])
    else:
        ends = [f(f"_v{i}").alias(f"_{end}{i}") for i in (1, 2) for end, f in (("low", F.min), ("high", F.max))]
        old = old.groupBy(F.struct("_k1", "_k2").alias("_key")).agg(*ends).select("_key.*", *[f"_{e}{i}" for i in (1, 2) for e in ("low", "high")])
    if join_hint is not None:
        old = old.hint(join_hint)
    now = [c.alias(f"_own{i}") for i, c in enumerate(_code([quoted(k) for k in keys], "_"), 1)]
    coded = current.select("*", *now)
    joined = coded.join(old, (F.col("_own1") == F.col("_k1")) & (F.col("_own2") == F.col("_k2")), "left")
    given = _code([quoted(value).cast("string")], "_")
    differs = reduce(or_, [c != F.col(f"_{end}{i}") for i, c in enumerate(given, 1) for end in ("low", "high")])
    return joined.withColumn("_kind", F.when(F.col("_k1").isNull(), "new").when(differs, "changed"))


def _rows(points: DataFrame | Packs) -> DataFrame:
    return points.points() if isinstance(points, Packs) else points


def _kinds(
    current: DataFrame | Packs,
    posted: DataFrame | Packs,
    keys: Sequence[str],
    value: str,
    posted_unique: bool,
    join_hint: str | None,
) -> DataFrame:
    """``_compared``; where both sides are packs they are matched by unit, apart from units that are posted several times."""
    packed = isinstance(current, Packs) and isinstance(posted, Packs) and (current.numbers is None) == (posted.numbers is None)
    if not packed or list(keys) != POINT_KEYS or value != "VALUE":
        return _compared(_rows(current), _rows(posted), keys, value, posted_unique, join_hint)
    several = None if posted_unique else repeated_units(posted)
    if several is None:
        return matched(current, posted, join_hint)
    once = matched(current.only(several, "left_anti"), posted.only(several, "left_anti"), join_hint)
    parts = [packs.only(several, "left_semi").points() for packs in (current, posted)]
    rest = _compared(*parts, keys, value, False, join_hint).select(*[quoted(c) for c in POINT.names], "_kind")
    return once.unionByName(rest)


def delta(
    current: DataFrame | Packs,
    posted: DataFrame | Packs | None,
    keys: Sequence[str] = POINT_KEYS,
    value: str = "VALUE",
    posted_unique: bool = False,
    join_hint: str | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Current rows that are new or whose value changed, with a ``change_type``.

    A row is new when no posted row has its keys, and changed when a posted row of its keys has another value; it comes
    out once either way. Null values never count as changed, and null keys never match. Where posted keys repeat with
    different values, every current value differs from one of them, so all current rows of the key are changed until the
    snapshot holds one value again.

    One left join does the work of an anti join and an inner join. Of a posted row only 128 bits of hash of its keys and of
    its value take part, as longs: they are reduced to the least and greatest value of a key by a hash aggregate, on the
    map side too, so the join gives at most the current rows. They are grouped by one struct, which leaves the
    join a plain shuffle of each side: adaptive execution can split a hot key of the current rows. ``posted_unique`` skips
    the grouping where the snapshot is known to have unique keys.

    The join strategy is Spark's choice. Its size estimate is good for stored snapshots, but does not
    see that an unpivot multiplies rows: ``join_hint="merge"`` keeps such a snapshot from being broadcast.

    Where both sides are ``Packs``, one row per submission is shuffled instead of one per point, and a point is looked for
    in the row of its unit. Units that are posted several times go the way above.

    ``seen`` counts ``all`` current rows and the ``new`` and ``changed`` ones while the result is written.
    """
    names = [quoted(c) for c in (POINT.names if isinstance(current, Packs) else current.columns)]
    if posted is None:
        compared = _rows(current).withColumn("_kind", F.lit("new"))
    else:
        compared = _kinds(current, posted, keys, value, posted_unique, join_hint)
    if seen is not None:
        compared = compared.observe(seen, *_counts())
    return compared.where(F.col("_kind").isNotNull()).select(*names, F.col("_kind").alias("change_type"))


def _counts() -> list[Column]:
    """Counters over compared rows."""
    kinds = [F.count_if(F.col("_kind") == kind).alias(kind) for kind in ("new", "changed")]
    return [F.count(F.lit(1)).alias("all"), *kinds]


def removed(
    current: DataFrame, posted: DataFrame, keys: Sequence[str] = POINT_KEYS, value: str = "VALUE"
) -> DataFrame:
    """Posted rows whose keys are gone, with a null value: the points to delete."""
    now = key_rows(current, keys)
    gone = posted.join(now, keys_match(posted, now, keys), "left_anti")
    kind = dict(gone.dtypes)[value]
    return gone.withColumn(value, F.lit(None).cast(kind)).withColumn("change_type", F.lit("removed"))


def delta_with_deletes(
    current: DataFrame,
    posted: DataFrame | None,
    keys: Sequence[str] = POINT_KEYS,
    value: str = "VALUE",
    seen: Observation | None = None,
) -> DataFrame:
    """``delta`` plus the points to delete."""
    changes = delta(current, posted, keys, value, seen=seen)
    return changes if posted is None else changes.unionByName(removed(current, posted, keys, value))


def delta_counts(
    current: DataFrame | Packs,
    posted: DataFrame | Packs,
    keys: Sequence[str] = POINT_KEYS,
    value: str = "VALUE",
    posted_unique: bool = False,
    join_hint: str | None = None,
) -> DataFrame:
    """Row counts of a delta as ``metric``, ``n``: all current rows, and those of each change type that occurs.

    One pass over the compared rows. Where the delta itself is written, let ``delta(seen=...)`` count it.
    """
    counted = _kinds(current, posted, keys, value, posted_unique, join_hint).agg(*_counts())
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").alias("n")) for name in ("all", "new", "changed")]
    return counted.select(F.inline(F.array(*pairs))).where((F.col("metric") == "all") | (F.col("n") > 0))


def duplicate_keys(points: DataFrame | Packs, keys: Sequence[str] = POINT_KEYS, value: str = "VALUE") -> DataFrame:
    """Keys that occur more than once, with their number of rows and least and greatest value.

    A key of ``Packs`` can only repeat in a unit of several rows, or where a target stands at several positions, so the
    points of other rows are not looked at.
    """
    if isinstance(points, Packs):
        if list(keys) == POINT_KEYS and len({t[:3] for t in points.targets}) == len(points.targets):
            several = repeated_units(points)
            if several is None:
                return _repeats(points.points().where("false"), keys, value)
            points = points.only(several, "left_semi")
    return _repeats(_rows(points), keys, value)


def _repeats(points: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    grouped = points.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(quoted(value)).alias("min_value"),
        F.max(quoted(value)).alias("max_value"),
    )
    return grouped.where(F.col("n_rows") > 1)


def next_snapshot(
    current: DataFrame, posted: DataFrame | None, rejected: DataFrame | None, keys: Sequence[str] = POINT_KEYS
) -> DataFrame:
    """Snapshot after a publish: current points, but rejected keys keep what was posted before."""
    if rejected is None:
        return current
    bad = key_rows(rejected, keys)
    accepted = current.join(bad, keys_match(current, bad, keys), "left_anti")
    if posted is None:
        return accepted
    kept = posted.join(bad, keys_match(posted, bad, keys), "left_semi")
    return accepted.unionByName(kept.select(*[quoted(c) for c in current.columns]))
