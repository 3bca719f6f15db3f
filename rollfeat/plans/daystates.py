"""Increments from kept states: whole days come from a table of states, raw rows are read for the ends of frames only.

For each block of a preset, a table holds one row of mergeable states per key and day. A frame that looks back ``m`` days
from a new row is the row's own day, the days between (from the table) and the end of the day ``m`` days before, so a
load reads raw rows of the new dates and of one older date per look-back, however long these are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.functions.aggregates import state as state_of
from rollfeat.functions.scalars import weekday_name
from rollfeat.operators import chunked
from rollfeat.operators.incremental import dated, halo_start
from rollfeat.operators.rolling import DISTINCT, BoundBlock, RollingBlock, attach, key_columns, keyed_rows
from rollfeat.plans.presets import Preset
from rollfeat.sources.tables import TableStore

_DATE = "tx_date"
_ROWS = "n_rows"
_DAY = chunked.CHUNK_SECONDS


def states_table(prefix: str, block: int) -> str:
    """The table that holds the states of a preset's block of this number."""
    return f"{prefix}_{block}"


def refresh_states(store: TableStore, prefix: str, staged: DataFrame, preset: Preset, first: dt.date, last: dt.date) -> list[list[dt.date]]:
    """Bring the states of the dates from ``first`` to ``last`` up to date with ``staged``; the dates written, for each block.

    A date is written where it has another number of rows than its states were made of, so new dates, dates with late rows and
    dates that a failed load left out are all the same case, and doing it twice changes nothing. Rows that were replaced one for one are not
    noticed. A date whose rows have all left ``staged`` is refused.
    """
    near = _between(staged, first, last)
    counts = near.groupBy(_DATE).agg(F.count(F.lit(1)).alias("n"))
    there = {r[0]: r[1] for r in counts.collect()}  # one row a date
    written = []
    for i, block in enumerate(preset.blocks):
        table, bound = states_table(prefix, i), _bound(block, staged)
        known = {}
        if store.exists(table):
            _check_columns(store.read(table), table, bound)
            kept = _between(store.read(table), first, last).groupBy(_DATE).agg(F.sum(_ROWS).alias("n"))
            known = {r[0]: r[1] for r in kept.collect()}
        gone = sorted(known.keys() - there.keys())
        if gone:
            raise ValueError(f"{table} has states of {gone[0]}, of which no rows are staged; drop the table to build it again")
        dates = sorted(d for d, n in there.items() if known.get(d) != n)
        if dates:
            states = _states(dated(near, _DATE, dates), block, bound)
            if store.exists(table):
                store.replace_partitions(table, states, [_DATE])
            else:
                store.create_if_absent(table, states, [_DATE])
        written.append(dates)
    return written


def features_from_states(store: TableStore, prefix: str, staged: DataFrame, preset: Preset, high: dt.date, created_at: Column | None = None) -> DataFrame:
    """What :func:`rollfeat.plans.presets.build_features` gives for the rows of ``staged`` dated after ``high``.

    The states are brought up to date first. ``staged`` should be a table partitioned by ``tx_date``: only the dates that are named in
    :func:`raw_dates` are read.
    """
    is_new = F.col(_DATE) > F.lit(high)
    new = sorted(r[0] for r in staged.where(is_new).select(_DATE).distinct().collect())
    out = staged.where(is_new).select("*", weekday_name("tx_ts").alias("day_of_the_week"))
    if new:
        first = halo_start(new[0] - dt.timedelta(days=1), preset.max_lookback)
        refresh_states(store, prefix, staged, preset, first, new[-1])
    for i, block in enumerate(preset.blocks):
        bound = _bound(block, staged)
        keys = key_columns(block)
        raw = dated(staged, _DATE, raw_dates(block, new))
        rows = keyed_rows(raw, block, is_new)
        stored = _stored(store, states_table(prefix, i), block, bound, new) if new else None
        extent = chunked.Extent(0, 0, None, None)
        if new:
            extent = chunked.Extent(raw.count(), 0, _day_number(new[0]) * _DAY, (_day_number(new[-1]) + 1) * _DAY - 1)
        out = attach(out, block, chunked.chunked_features(chunked.per_second(rows, keys, bound), keys, bound, extent, stored=stored))
    out = out.select(*staged.columns, "day_of_the_week", *preset.feature_names)
    if not preset.created_timestamp:
        return out
    return out.select("*", (F.current_timestamp() if created_at is None else created_at).alias("created_timestamp"))


def raw_dates(block: RollingBlock, new: Sequence[dt.date]) -> list[dt.date]:
    """The dates of which raw rows are needed: the new ones, where frames of whole days begin, and all that other frames reach."""
    back = {0}
    for feature in block.features():
        days, rest = divmod(feature.seconds, _DAY)
        back |= set(range(1, days + 2)) if rest else {days}
    return sorted({date - dt.timedelta(days=b) for date in new for b in back})


def _bound(block: RollingBlock, staged: DataFrame) -> BoundBlock:
    if any(f.aggregation == DISTINCT for f in block.features()):
        raise ValueError(f"{DISTINCT} has no states to keep; load presets that hold it without kept states")
    for column in block.columns:
        floating = isinstance(staged.schema[column].dataType, (T.FloatType, T.DoubleType))
        if floating and block.exact_type is None and any(f.spec.wide is not None for f in block.features()):
            raise ValueError(f"kept states of the floating-point column {column!r} need exact_type, the decimal type in which sums are taken")
    return BoundBlock(block, staged)


def _states(rows: DataFrame, block: RollingBlock, bound: BoundBlock) -> DataFrame:
    """One row per key and date. States are summed before the shuffle, so a key of any size is a row per task."""
    keys = key_columns(block)
    built = [state_of(s.state).build(bound.input(s)).alias(bound.stored_name(s)) for s in bound.states]
    # The values stay beside the keys: a block may aggregate one of the columns that it groups by.
    keyed = rows.select(_DATE, *[F.col(k).alias(n) for k, n in zip(block.partition, keys)], *dict.fromkeys(block.columns))
    return keyed.groupBy(*keys, _DATE).agg(F.count(F.lit(1)).alias(_ROWS), *built).select(
        *keys, _ROWS, *[bound.stored_name(s) for s in bound.states], _DATE
    )


def _stored(store: TableStore, table: str, block: RollingBlock, bound: BoundBlock, new: Sequence[dt.date]) -> DataFrame:
    """The kept states of all days that frames of the new dates hold as a whole, in the form of chunk totals."""
    keys = key_columns(block)
    first = new[0] - dt.timedelta(seconds=block.max_lookback)
    days = _between(store.read(table), first, new[-1])
    return days.select(
        *keys,
        F.unix_date(_DATE).cast("bigint").alias("__chunk"),
        (F.col(_DATE) >= F.lit(new[0])).alias("__keep"),
        *[F.col(bound.stored_name(s)).alias(s.name) for s in bound.states],
    )


def _check_columns(stored: DataFrame, table: str, bound: BoundBlock) -> None:
    wanted = {*key_columns(bound.block), _ROWS, _DATE, *[bound.stored_name(s) for s in bound.states]}
    if wanted != set(stored.columns):
        raise ValueError(f"{table} holds the states of other features; drop it to build it again")


def _between(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return df.where((F.col(_DATE) >= F.lit(first)) & (F.col(_DATE) <= F.lit(last)))


def _day_number(date: dt.date) -> int:
    return (date - dt.date(1970, 1, 1)).days
