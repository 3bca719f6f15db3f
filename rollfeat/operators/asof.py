"""Point-in-time join: for every instance, the latest feature row of its entity at or before its time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollfeat.functions.scalars import epoch_seconds, same
from rollfeat.operators.hotkeys import Limits, find_hot_keys

# The number of rows a slice of a hot entity holds on average on the busiest day of that entity.
SLICE_ROWS = 100_000
_DAY = 86_400

_ENTITY, _AT, _SIDE, _TIE, _SLICE, _FOUND = "__entity", "__at", "__side", "__tie", "__slice", "__found"
_CARRY, _FEATURE, _PROBE = -1, 0, 1


@dataclass(frozen=True)
class FeatureRows:
    """Feature values of one entity type. Of rows with equal entity and time, the highest ``tie_break`` counts, then the
    highest features (compared in their order; each by itself where features are looked up one by one). NULL is lowest."""

    frame: DataFrame
    entity: str
    time: str
    features: Sequence[str]
    tie_break: str | None = None


def asof_join(
    instances: DataFrame,
    entity: str,
    time: str,
    values: FeatureRows,
    per_feature: bool = False,
    limits: Limits = Limits(rows_per_span=10**18),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``instances`` plus the feature columns, every instance once.

    By default the latest row is taken as a whole, NULLs included. ``per_feature`` takes the latest non-NULL value of
    each feature instead. Instances without entity or time get NULLs.

    Instances and features meet in one sorted pass per entity. Entities with more rows than ``limits`` allow are cut
    into slices of time; what an earlier slice ended with is carried into the next, so no task holds such an entity.
    """
    clashes = sorted(set(values.features) & set(instances.columns))
    if clashes:
        raise ValueError(f"instances already have columns {', '.join(clashes)}")
    known = values.frame.where(F.col(values.entity).isNotNull() & F.col(values.time).isNotNull())
    tie = F.lit(None).cast("string") if values.tie_break is None else F.col(values.tie_break)
    facts = known.select(
        F.col(values.entity).alias(_ENTITY), F.col(values.time).alias(_AT), tie.alias(_TIE), *values.features
    )
    points = instances.select(F.col(entity).alias(_ENTITY), F.col(time).alias(_AT))
    times = facts.select(_ENTITY, _AT).unionByName(points).select(_ENTITY, epoch_seconds(_AT).alias("__sec"))
    hot = find_hot_keys(times, [_ENTITY], "__sec", _DAY, limits)

    if hot is None:
        probes = instances.select(
            F.col(entity).alias(_ENTITY), F.col(time).alias(_AT), F.struct(*instances.columns).alias("__instance")
        )
        rows = _rows(facts, probes, values.features, tie_type=dict(facts.dtypes)[_TIE])
        found = _latest(rows, [_ENTITY], values.features, per_feature)
        return found.where(F.col(_SIDE) == _PROBE).select("__instance.*", *values.features)

    rows = _rows(_one_per_time(facts, values.features, per_feature), points.distinct(), values.features, "string")
    rows = _sliced(rows, hot, slice_rows)
    rows = rows.unionByName(_carried(rows, values.features, per_feature))
    found = _latest(rows, [_ENTITY, _SLICE], values.features, per_feature)
    answers = found.where(F.col(_SIDE) == _PROBE).select(_ENTITY, _AT, *values.features)
    on = [same(F.col(entity), F.col(_ENTITY)), same(F.col(time), F.col(_AT))]
    return instances.join(answers, on, "left").drop(_ENTITY, _AT)


def _rows(facts: DataFrame, probes: DataFrame, features: Sequence[str], tie_type: str) -> DataFrame:
    if _TIE not in facts.columns:
        facts = facts.select("*", F.lit(None).cast(tie_type).alias(_TIE))
    return facts.select("*", F.lit(_FEATURE).alias(_SIDE)).unionByName(
        probes.select("*", F.lit(_PROBE).alias(_SIDE)), allowMissingColumns=True
    )


def _latest(rows: DataFrame, group: list[str], features: Sequence[str], per_feature: bool) -> DataFrame:
    """Replace the features of every row by the latest ones seen up to it. Features sort before probes of the same
    time; what was carried in sorts first. All rows of a tie first get its best, so which one sorts last does not matter."""
    order = [F.col(_SIDE) != _CARRY, _AT, _SIDE, _TIE]
    ordered = Window.partitionBy(*group).orderBy(*order)
    seen = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ties = ordered.rangeBetween(Window.currentRow, Window.currentRow)
    others = [c for c in rows.columns if c not in features]
    if per_feature:
        best = rows.select(*others, *[F.max(f).over(ties).alias(f) for f in features])
        return best.select(*others, *[F.last(f, ignorenulls=True).over(seen).alias(f) for f in features])
    whole = F.when(F.col(_SIDE) != _PROBE, F.struct(*features))
    best = rows.select(*others, F.max(whole).over(ties).alias(_FOUND))
    found = best.select(*others, F.last(_FOUND, ignorenulls=True).over(seen).alias(_FOUND))
    return found.select(*others, *[F.col(_FOUND)[f].alias(f) for f in features])


def _one_per_time(facts: DataFrame, features: Sequence[str], per_feature: bool) -> DataFrame:
    """At most one feature row per entity and time, combined before the shuffle."""
    grouped = facts.groupBy(_ENTITY, _AT)
    if per_feature:
        return grouped.agg(*[_newest(f, F.struct(_TIE, f), F.col(f).isNotNull()) for f in features])
    newest = grouped.agg(F.max(F.struct(F.col(_TIE), *features)).alias(_FOUND))
    return newest.select(_ENTITY, _AT, *[F.col(_FOUND)[f].alias(f) for f in features])


def _newest(feature: str, candidate: Column, condition: Column) -> Column:
    return F.max(F.when(condition, candidate))[feature].alias(feature)


def _sliced(rows: DataFrame, hot, slice_rows: int) -> DataFrame:
    """Number the slices of hot entities; other entities are one slice, NULL."""
    width = F.greatest(F.floor(F.lit(float(_DAY) * slice_rows) / F.col("peak")), F.lit(1).cast("bigint"))
    slices = hot.frame.select(F.col(_ENTITY).alias("__hot_entity"), width.alias("__width"))
    if hot.listed:
        slices = F.broadcast(slices)
    joined = rows.join(slices, same(F.col(_ENTITY), F.col("__hot_entity")), "left")
    return joined.select("*", F.floor(epoch_seconds(_AT) / F.col("__width")).alias(_SLICE)).drop(
        "__hot_entity", "__width"
    )


def _carried(rows: DataFrame, features: Sequence[str], per_feature: bool) -> DataFrame:
    """One row per slice of a hot entity with what all earlier slices ended with."""
    is_fact = F.col(_SIDE) == _FEATURE
    slices = rows.where(F.col(_SLICE).isNotNull()).groupBy(_ENTITY, _SLICE)
    earlier = Window.partitionBy(_ENTITY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    if per_feature:
        ends = slices.agg(*[_newest(f, F.struct(_AT, f), is_fact & F.col(f).isNotNull()) for f in features])
        carried = ends.select(
            _ENTITY, _SLICE, *[F.last(f, ignorenulls=True).over(earlier).alias(f) for f in features]
        )
        carried = carried.where(reduce(Column.__or__, [F.col(f).isNotNull() for f in features]))
    else:
        ends = slices.agg(F.max(F.when(is_fact, F.struct(F.col(_AT), *features))).alias(_FOUND))
        carried = ends.select(_ENTITY, _SLICE, F.last(_FOUND, ignorenulls=True).over(earlier).alias(_FOUND))
        carried = carried.where(F.col(_FOUND).isNotNull()).select(
            _ENTITY, _SLICE, *[F.col(_FOUND)[f].alias(f) for f in features]
        )
    kinds = dict(rows.dtypes)
    return carried.select(
        "*",
        F.lit(None).cast(kinds[_AT]).alias(_AT),
        F.lit(None).cast(kinds[_TIE]).alias(_TIE),
        F.lit(_CARRY).alias(_SIDE),
    )
