"""Rolling aggregates without a whole key in one task.

Frames are measured in whole seconds, so rows are first combined to one state row per (key, second), partly before the
shuffle. Time is then cut into chunks of ``width`` seconds. With a look-back of ``m`` chunks, the frame of a second
``t`` in chunk ``c`` has three parts:

* the part of chunk ``c`` before ``t``: a running aggregate, ascending;
* the whole chunks ``c - m + 1 .. c - 1``: a window over chunk totals, of which a key has only (time span / width);
* the part of chunk ``c - m`` from ``t - lookback`` on: chunk ``c - m`` is copied to chunk ``c`` with its seconds
  moved forward by the look-back, where the part is a running aggregate, descending.

A look-back of ``m`` chunks and a remainder of ``r`` seconds is the same with one part more: moved forward by the look-back, the
seconds of chunk ``c`` come from two chunks, and between them and the whole chunks lie the last ``r`` seconds of chunk
``c - m``, which have a total of their own.

The chunk totals travel as a further row at the end of chunk ``c``, so the last two parts are one running aggregate.
Everything is a merge of states (nothing is subtracted), and a (key, chunk) group holds at most
``width * (long look-backs + 2)`` rows however many rows the key has. Chunks are shorter where keys are dense, and tasks are as many
as the rows need, so neither a group nor a task grows with the input.

Look-backs up to :data:`SHORT_SECONDS` are too short for such chunks. Where keys are crowded they divide a chunk into
parts as long as themselves, with a copy of their own, and need no totals. Otherwise, and where they do not divide a
chunk, they are plain sliding windows; for these a chunk also holds the last rows of the chunk before it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import ceil, gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollfeat.functions.aggregates import state as state_of
from rollfeat.functions.scalars import same

# The shortest chunk.
SHORT_SECONDS = 3_600
# Look-backs of at most this many seconds are sliding windows: their frames hold at most that many rows.
SLIDING_SECONDS = 300
# Longer ones still are, up to the shortest chunk, while their frames are known to hold about this many rows or fewer.
SLIDING_ROWS = 200
# The preferred chunk; at most this many distinct seconds per key and chunk.
CHUNK_SECONDS = 86_400
# Where the densest key has more seconds than this in such a chunk, chunks are cut shorter, to one of these widths.
ROWS_PER_CHUNK = 5_000
WIDTHS = (86_400, 43_200, 21_600, 14_400, 10_800, 7_200, 3_600)
# Rows and copies that a task windows. Every sort of a task holds them, so this, and not the size of the input, is its memory.
ROWS_PER_TASK = 150_000
# They are fewer where rows have more states than this.
STATES_PER_ROW = 16

_SEC, _CHUNK, _POS, _SIDE, _KEEP = "__sec", "__chunk", "__pos", "__side", "__keep"
_ROWS, _HALO = -1, -2  # other sides are look-backs in seconds


@dataclass(frozen=True)
class Extent:
    """What a frame of seconds holds, or at most holds where it was taken from the rows that the seconds are made of."""

    n_seconds: int
    most_per_day: int  # of one key
    first_kept: int | None  # the first and last second that features are wanted for
    last_kept: int | None

    @classmethod
    def of(cls, seconds: DataFrame, keys: list[str]) -> Extent:
        """One pass over keys and seconds, counted per key and day before anything is moved."""
        kept, day = F.when(F.col(_KEEP), F.col(_SEC)), F.floor(F.col(_SEC) / F.lit(CHUNK_SECONDS))
        per_day = seconds.groupBy(*keys, day.alias(_CHUNK)).agg(F.count(F.lit(1)).alias("n"), F.min(kept).alias("first"), F.max(kept).alias("last"))
        n, most, first, last = per_day.agg(F.sum("n"), F.max("n"), F.min("first"), F.max("last")).first()
        return cls(n or 0, most or 0, first, last)

    @property
    def widest(self) -> int:
        """The widest chunk that the densest key does not crowd."""
        return next((w for w in WIDTHS if w * self.most_per_day <= ROWS_PER_CHUNK * CHUNK_SECONDS), WIDTHS[-1])


def n_tasks(df: DataFrame, n_rows: int, n_states: int) -> int:
    """Tasks for so many rows. Given as a number, so that adaptive execution does not merge them again."""
    n_rows = n_rows * max(n_states, STATES_PER_ROW) / STATES_PER_ROW
    return max(ceil(n_rows / ROWS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism)


@dataclass
class Grid:
    """Look-backs that share one chunk width. It divides those among the long ones that have a suitable divisor."""

    width: int
    long: list[int] = field(default_factory=list)
    nested: list[int] = field(default_factory=list)  # divide a chunk
    sliding: list[int] = field(default_factory=list)


def plan_grids(lookbacks: list[int], rows_per_second: float = 1.0, stored_width: int | None = None, widest: int = CHUNK_SECONDS) -> list[Grid]:
    """Put look-backs on as few grids as possible, with chunks no shorter than the short look-backs.

    ``rows_per_second`` is the measured density of the densest key; there is never more than one state row a second.
    Where totals of chunks of ``stored_width`` are kept, the look-backs that they divide share the first grid. No other chunk is
    wider than ``widest``.
    """
    stored = sorted({s for s in lookbacks if stored_width and s % stored_width == 0}, reverse=True)
    grids: list[Grid] = []
    for seconds in sorted({s for s in lookbacks if s > SHORT_SECONDS} - set(stored), reverse=True):
        for grid in grids:
            if gcd(grid.width, seconds) >= SHORT_SECONDS:
                grid.width = gcd(grid.width, seconds)
                grid.long.append(seconds)
                break
        else:
            width = _chunk_width(seconds, widest)
            if width is None and grids:
                grids[0].long.append(seconds)
            else:
                grids.append(Grid(width or widest, [seconds]))
    if stored:
        grids.insert(0, Grid(stored_width, stored))
    short = sorted({s for s in lookbacks if s <= SHORT_SECONDS})
    if short:
        if not grids:
            grids.append(Grid(widest))
        for seconds in short:
            crowded = seconds > SLIDING_SECONDS and seconds * rows_per_second > SLIDING_ROWS
            divides = crowded and grids[0].width % seconds == 0
            (grids[0].nested if divides else grids[0].sliding).append(seconds)
    return grids


def _chunk_width(seconds: int, widest: int) -> int | None:
    """The largest divisor between the two limits, if there is one."""
    return next((w for w in range(min(widest, seconds), SHORT_SECONDS - 1, -1) if seconds % w == 0), None)


def per_second(rows: DataFrame, keys: list[str], bound) -> DataFrame:
    """One row of states per (key, second)."""
    states = [state_of(s.state).build(bound.input(s)).alias(s.name) for s in bound.states]
    return rows.groupBy(*keys, _SEC).agg(F.max(_KEEP).alias(_KEEP), *states)


def direct_features(seconds: DataFrame, keys: list[str], bound, n_seconds: int) -> DataFrame:
    """Features per (key, second) by one window per key, for keys known to be small."""
    seconds = seconds.repartition(n_tasks(seconds, n_seconds, len(bound.states)), *keys)
    window = Window.partitionBy(*keys).orderBy(_SEC)
    end = bound.block.last_offset
    frames = {
        _name(s, f.seconds): _merge(s, F.col(s.name)).over(window.rangeBetween(-f.seconds, end))
        for f in bound.features
        for s in bound.states_of(f)
    }
    outputs = [
        bound.finish(f, {s.state: _name(s, f.seconds) for s in bound.states_of(f)}) for f in bound.features
    ]
    windowed = seconds.select("*", *[c.alias(n) for n, c in frames.items()]).where(_KEEP)
    return windowed.select(*keys, _SEC, *outputs)


def chunked_features(
    seconds: DataFrame,
    keys: list[str],
    bound,
    extent: Extent,
    rows_per_second: float = 1.0,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Features per (key, second) for keys of any size.

    ``extent`` tells how many tasks the seconds need and between which seconds features are wanted: copies into chunks before or after
    these are not made.
    ``stored`` holds the states of chunks of :data:`CHUNK_SECONDS`, one row per key and chunk. For look-backs that such chunks
    divide, ``seconds`` then needs the ends of the frames only.
    """
    grids = plan_grids([f.seconds for f in bound.features], rows_per_second, None if stored is None else CHUNK_SECONDS, extent.widest)
    parts = []
    for i, grid in enumerate(grids):
        from_stored = stored is not None and i == 0 and grid.long and not any(s % CHUNK_SECONDS for s in grid.long)
        parts.append(_grid_features(seconds, keys, bound, grid, extent, stored if from_stored else None))
    return reduce(lambda left, right: join_seconds(left, right, keys), parts)


def _grid_features(
    seconds: DataFrame, keys: list[str], bound, grid: Grid, extent: Extent, stored: DataFrame | None = None
) -> DataFrame:
    names = [s.name for s in bound.states]
    sec, width = F.col(_SEC), F.lit(grid.width).cast("bigint")
    chunk = F.floor(sec / width)
    columns = [*keys, _CHUNK, _POS, _SIDE, _KEEP, *names]

    # The row itself, its copies moved by a look-back, and its copy into the next chunk for sliding windows.
    places = [F.struct(chunk.alias(_CHUNK), sec.alias(_POS), F.lit(_ROWS).cast("bigint").alias(_SIDE))]
    for lookback in grid.long + grid.nested:
        places.append(_place(sec.isNotNull(), F.floor((sec + lookback) / width), sec + lookback, lookback))
    if grid.sliding:
        in_tail = sec >= (chunk + 1) * width - max(grid.sliding)
        places.append(_place(in_tail, chunk + 1, sec, _HALO))
    # Places that are not wanted are dropped after they are exploded: a filter of the array would run outside of generated code.
    placed = seconds.select(*keys, _KEEP, *names, F.explode(F.array(*places)).alias("__place")).where(F.col("__place").isNotNull())
    placed = placed.select(*keys, "__place.*", _KEEP, *names)
    wanted = F.lit(False)
    if extent.first_kept is not None:
        wanted = F.col(_CHUNK).between(extent.first_kept // grid.width, extent.last_kept // grid.width)
    rows = placed.where(F.col(_CHUNK).isNull() | wanted).select(*columns)
    totals = _whole_chunks(seconds.withColumn(_CHUNK, chunk), keys, bound, grid, stored)
    if totals is not None:
        rows = rows.unionByName(totals.select(*columns))
    rows = rows.repartition(n_tasks(rows, extent.n_seconds * len(places), len(bound.states)), *keys, _CHUNK)

    # Every window expression is named once here; features that share a state share its windows.
    here, side, pos = F.col(_SIDE) == _ROWS, F.col(_SIDE), F.col(_POS)
    nearby = side.isin(_ROWS, _HALO)
    end = bound.block.last_offset
    # Ascending frames have no use for copies: without a position there, they stay out of every sliding frame.
    ascending = Window.partitionBy(*keys, _CHUNK).orderBy(F.when(nearby, pos))
    features = [f for f in bound.features if f.seconds in grid.long + grid.nested + grid.sliding]
    running = {}
    for f in features:
        part = [F.floor(pos / f.seconds)] if f.seconds in grid.nested else []
        within = Window.partitionBy(*keys, _CHUNK, *part)
        for s in bound.states_of(f):
            state = F.col(s.name)
            if f.seconds in grid.sliding:
                running[_name(s, f.seconds)] = _merge(s, F.when(nearby, state)).over(
                    ascending.rangeBetween(-f.seconds, end)
                )
                continue
            up = within.orderBy(_POS) if part else ascending
            running[_before(s, f, grid)] = _merge(s, F.when(here, state)).over(
                up.rangeBetween(Window.unboundedPreceding, end)
            )
            running[_name(s, f.seconds)] = _merge(s, F.when(side == f.seconds, state)).over(
                within.orderBy(F.desc(_POS)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            )
    windowed = rows.select(*columns, *[c.alias(n) for n, c in running.items()]).where(here & F.col(_KEEP))

    def frame(f, s):
        value = F.col(_name(s, f.seconds))
        if f.seconds not in grid.sliding:
            value = state_of(s.state).join(F.col(_before(s, f, grid)), value)
        # Rows without a time are each other's whole frame.
        return F.when(pos.isNull(), F.col(s.name)).otherwise(value)

    framed = {_framed(s, f): frame(f, s) for f in features for s in bound.states_of(f)}
    outputs = [bound.finish(f, {s.state: _framed(s, f) for s in bound.states_of(f)}) for f in features]
    return windowed.select(*keys, F.col(_POS).alias(_SEC), *[c.alias(n) for n, c in framed.items()]).select(*keys, _SEC, *outputs)


def _whole_chunks(seconds: DataFrame, keys: list[str], bound, grid: Grid, stored: DataFrame | None = None) -> DataFrame | None:
    """For every chunk and long look-back, the states of the chunks that lie wholly inside all its frames."""
    spans = {lookback: divmod(lookback, grid.width) for lookback in grid.long if lookback > grid.width}
    if not spans:
        return None
    used = {lookback: {s.name for f in bound.features if f.seconds == lookback for s in bound.states_of(f)} for lookback in spans}
    tails = []
    for lookback, (_, rest) in spans.items():
        if rest:
            in_tail = F.pmod(F.col(_SEC), F.lit(grid.width)) >= grid.width - rest
            tails += [_merge(s, F.when(in_tail, F.col(s.name))).alias(_tail(s, lookback)) for s in bound.states if s.name in used[lookback]]
    totals = stored if stored is not None else seconds.groupBy(*keys, _CHUNK).agg(
        F.max(_KEEP).alias(_KEEP), *[_merge(s, F.col(s.name)).alias(s.name) for s in bound.states], *tails
    )
    window = Window.partitionBy(*keys).orderBy(_CHUNK)

    def between(state, lookback: int) -> Column:
        chunks, rest = spans[lookback]
        parts = []
        if chunks > 1:
            parts.append(_merge(state, F.col(state.name)).over(window.rangeBetween(1 - chunks, -1)))
        if rest:
            parts.append(_merge(state, F.col(_tail(state, lookback))).over(window.rangeBetween(-chunks, -chunks)))
        return reduce(state_of(state.state).join, parts)

    sums = []
    for lookback in spans:
        sums.append(
            F.struct(
                F.lit(lookback).cast("bigint").alias(_SIDE),
                *[
                    (between(s, lookback) if s.name in used[lookback] else F.lit(None)).cast(totals.schema[s.name].dataType).alias(s.name)
                    for s in bound.states
                ],
            )
        )
    end_of_chunk = (F.col(_CHUNK) + 1) * F.lit(grid.width).cast("bigint")
    return (
        totals.select(*keys, _CHUNK, _KEEP, F.array(*sums).alias("__sums"))
        .where(_KEEP)
        .select(*keys, _CHUNK, end_of_chunk.alias(_POS), _KEEP, F.inline("__sums"))
    )


def join_seconds(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    columns = [*keys, _SEC]
    renamed = right.select(*[F.col(c).alias(f"__r{c}") for c in columns], *[c for c in right.columns if c not in columns])
    on = [same(F.col(c), F.col(f"__r{c}")) for c in columns]
    return left.join(renamed, on, "inner").drop(*[f"__r{c}" for c in columns])


def _place(condition: Column, chunk: Column, pos: Column, side: int) -> Column:
    place = F.struct(chunk.alias(_CHUNK), pos.alias(_POS), F.lit(side).cast("bigint").alias(_SIDE))
    return F.when(condition, place)


def _tail(state, lookback: int) -> str:
    return f"{state.name}_tail_{lookback}"


def _name(state, seconds: int) -> str:
    return f"{state.name}_{seconds}"


def _framed(state, feature) -> str:
    return f"{state.name}_framed_{feature.seconds}"


def _before(state, feature, grid: Grid) -> str:
    """The running aggregate up to a row; all long look-backs have the same."""
    return f"{state.name}_before_{feature.seconds}" if feature.seconds in grid.nested else f"{state.name}_before"


def _merge(state, value: Column) -> Column:
    return state_of(state.state).merge(value)
