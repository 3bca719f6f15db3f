"""Exact COUNT(DISTINCT) over rolling frames, for keys and values of any size.

A value that occurs at second ``s`` is in the frames of all seconds from ``s`` (or ``s + 1`` if the current row is left out) to
``s + lookback``. Where such stretches of one value overlap they count once, so each value is present over disjoint
stretches: it appears where the occurrence before is too long ago, and leaves where the next one comes too late. The number of
distinct values is then the running sum, over the seconds of a key, of one for each that appears and minus one for each that leaves.

Nothing here holds a whole key: neighbouring occurrences are found in spans of time, into which the last occurrence before and the first
one after are copied; the running sum is taken in chunks of time that begin with the sum of the chunks before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollfeat.operators.chunked import CHUNK_SECONDS, join_seconds

# A (key, value) is cut into spans of this length, so a window over one holds at most that many rows.
SPAN_SECONDS = 30 * 86_400

_SEC, _KEEP, _VALUE, _SPAN, _HERE, _POS, _CHUNK = "__sec", "__keep", "__value", "__span", "__here", "__pos", "__chunk"


def distinct_features(rows: DataFrame, keys: list[str], features: list, last_offset: int) -> DataFrame:
    """The features, all of them ``count_distinct``, per (key, second) of the rows that are to be kept.

    NULL is not counted. Rows without a time are each other's whole frame, as in a plain window.
    """
    by_column = {f.column: [g for g in features if g.column == f.column] for f in features}
    parts = [_of_column(rows, keys, column, asked, -last_offset) for column, asked in by_column.items()]
    return reduce(lambda left, right: join_seconds(left, right, keys), parts)


def _of_column(rows: DataFrame, keys: list[str], column: str, features: list, shift: int) -> DataFrame:
    steps = [f"__step_{i}" for i in range(len(features))]
    timed = F.col(_SEC).isNotNull()
    events = _events(rows.where(timed & F.col(column).isNotNull()), keys, column, [f.seconds for f in features], steps, shift)
    nothing = [F.lit(0).alias(s) for s in steps]
    points = rows.where(timed).select(*keys, F.col(_SEC).alias(_POS), *nothing, _KEEP)
    together = events.select(*keys, _POS, *steps, F.lit(False).alias(_KEEP)).unionByName(points)
    merged = together.groupBy(*keys, _POS).agg(*_sums(steps), F.max(_KEEP).alias(_KEEP))
    counted = _running(merged, keys, steps)
    found = counted.select(*keys, F.col(_POS).alias(_SEC), *[F.col(s).alias(f.name) for s, f in zip(steps, features)])

    number = F.count_distinct(column).alias("__n")
    timeless = rows.where(~timed).groupBy(*keys).agg(F.max(_KEEP).alias(_KEEP), number).where(_KEEP)
    return found.unionByName(timeless.select(*keys, F.lit(None).cast("bigint").alias(_SEC), *[F.col("__n").alias(f.name) for f in features]))


def _events(rows: DataFrame, keys: list[str], column: str, lookbacks: list[int], steps: list[str], shift: int) -> DataFrame:
    """Where a value appears in the frames of each look-back and where it leaves them."""
    span = F.floor(F.col(_SEC) / F.lit(SPAN_SECONDS).cast("bigint")).alias(_SPAN)
    group = [*keys, _VALUE, _SPAN]
    seen = rows.select(*keys, F.col(column).alias(_VALUE), span, _SEC).distinct()
    over_spans = Window.partitionBy(*keys, _VALUE).orderBy(_SPAN)
    edges = seen.groupBy(*group).agg(F.min(_SEC).alias("__first"), F.max(_SEC).alias("__last"))
    edges = edges.select(*group, F.lag("__last").over(over_spans).alias("__before"), F.lead("__first").over(over_spans).alias("__after"))
    outside = edges.select(*group, F.explode(F.array_compact(F.array("__before", "__after"))).alias(_SEC))
    placed = seen.withColumn(_HERE, F.lit(True)).unionByName(outside.withColumn(_HERE, F.lit(False)))
    within = Window.partitionBy(*group).orderBy(_SEC)
    near = placed.select("*", F.lag(_SEC).over(within).alias("__last"), F.lead(_SEC).over(within).alias("__next")).where(_HERE)

    sec, last, following = F.col(_SEC), F.col("__last"), F.col("__next")
    appears = [last.isNull() | (last + seconds < sec + shift) for seconds in lookbacks]
    leaves = [following.isNull() | (following + shift > sec + seconds) for seconds in lookbacks]
    some = reduce(lambda a, b: a | b, appears)
    places = [F.when(some, _event(sec + shift, steps, [a.cast("int") for a in appears]))]
    for i, seconds in enumerate(lookbacks):
        places.append(F.when(leaves[i], _event(sec + seconds + 1, steps, [F.lit(-1 if j == i else 0) for j in range(len(steps))])))
    return near.select(*keys, F.inline(F.filter(F.array(*places), lambda p: p.isNotNull())))


def _event(pos: Column, steps: list[str], values: list[Column]) -> Column:
    return F.struct(pos.alias(_POS), *[v.alias(s) for v, s in zip(values, steps)])


def _running(merged: DataFrame, keys: list[str], steps: list[str]) -> DataFrame:
    """The running sum of each step over the positions of a key, for the positions to be kept."""
    width = F.lit(CHUNK_SECONDS).cast("bigint")
    rows = merged.withColumn(_CHUNK, F.floor(F.col(_POS) / width))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, _CHUNK).agg(*_sums(steps), F.max(_KEEP).alias(_KEEP))
    carried = totals.select(*keys, _CHUNK, _KEEP, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(s) for s in steps]).where(_KEEP)
    carried = carried.select(*keys, (F.col(_CHUNK) * width - 1).alias(_POS), *steps, F.lit(False).alias(_KEEP), _CHUNK)
    up_to = Window.partitionBy(*keys, _CHUNK).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.unionByName(carried).select(*keys, _POS, _KEEP, *[F.sum(s).over(up_to).alias(s) for s in steps])
    return summed.where(_KEEP)


def _sums(steps: list[str]) -> list[Column]:
    return [F.sum(s).alias(s) for s in steps]
