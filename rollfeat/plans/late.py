"""Rows that arrive for dates a feature table already holds.

A late row changes the features of every row of the same key that looks back on it: from its own second until the longest
look-back later. Those rows, and no others, are computed again, and only the dates that hold one are rewritten.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.functions.scalars import same
from rollfeat.operators.hotkeys import Limits
from rollfeat.operators.incremental import changed_dates, dated, halo_start, high_date
from rollfeat.operators.rolling import RollingBlock, with_rolling
from rollfeat.plans.presets import Preset, build_features
from rollfeat.session import scratch_dir
from rollfeat.sources.tables import TableStore

_DATE = "tx_date"
_LATE, _REACHED = "__late", "__reached"


def load_late(
    store: TableStore,
    target: str,
    staged: DataFrame,
    preset: Preset,
    row_id: str = "tx_id",
    strategy: str = "auto",
    created_at: Column | None = None,
    limits: Limits = Limits(),
) -> list[dt.date]:
    """Bring the dates that ``target`` holds up to date with ``staged``; the dates that were rewritten.

    A date has late rows where ``staged`` has more rows of it than ``target``; which ones is decided by ``row_id`` (within a date). Afterwards the
    table is what a full build over the dates up to its latest would be. Rows that left ``staged``, or changed in place, are
    not noticed: a date with fewer rows than stored is refused, and a full refresh is the way to take rows back.
    """
    stored = store.read(target)
    high = high_date(stored, _DATE)
    if high is None:
        return []
    changed = changed_dates(staged, stored, _DATE, high)
    if not changed:
        return []
    rows = _reached(store, staged, stored, changed, high, preset, row_id, strategy, limits)
    touched = sorted(r[0] for r in rows.where(_REACHED).select(_DATE).distinct().collect())

    features = build_features(_needed(rows, preset), preset, strategy, F.col(_REACHED), created_at, limits)
    again = features.select(*[c for c in features.columns if c != _REACHED])
    old = dated(stored, _DATE, touched)
    gone = dated(rows, _DATE, touched).where(_REACHED).select(F.col(row_id).alias("__id"), F.col(_DATE).alias("__date")).distinct()
    kept = old.join(gone, same(F.col(row_id), F.col("__id")) & (F.col(_DATE) == F.col("__date")), "left_anti")
    store.replace_partitions(target, kept.unionByName(again), [_DATE])
    return touched


def _reached(store, staged, stored, changed, high, preset, row_id, strategy, limits) -> DataFrame:
    """Staged rows from the longest look-back before the first late row until one after the last, and which of them a late row reaches.

    Reach is a rolling count of late rows, so a key of any size is met like in any other window. Kept in the scratch folder: all later
    steps read it, not the source.
    """
    first = halo_start(changed[0] - dt.timedelta(days=1), preset.max_lookback)
    last = min(high, changed[-1] + dt.timedelta(seconds=preset.max_lookback + 86_400))
    known = dated(stored, _DATE, changed).groupBy(F.col(row_id).alias("__id"), F.col(_DATE).alias("__date")).agg(F.count(F.lit(1)).alias("__n"))
    fresh = dated(staged, _DATE, changed).groupBy(F.col(row_id).alias("__id"), F.col(_DATE).alias("__date")).agg(F.count(F.lit(1)).alias("__m"))
    on = same(F.col("k.__id"), F.col("f.__id")) & (F.col("k.__date") == F.col("f.__date"))
    compared = fresh.alias("f").join(known.alias("k"), on, "full").select(F.coalesce("f.__id", "k.__id").alias("__id"), F.coalesce("f.__date", "k.__date").alias("__date"), F.coalesce("__m", F.lit(0)).alias("__m"), F.coalesce("__n", F.lit(0)).alias("__n"))
    path = scratch_dir(store.spark, "late")
    compared.where("__m <> __n").write.parquet(path)
    late = store.spark.read.schema(compared.schema).parquet(path)
    lost = late.where("__m < __n").select("__date").distinct().limit(5).collect()
    if lost:
        raise ValueError(f"rows of {', '.join(str(r[0]) for r in lost)} are stored but no longer staged; a full refresh takes them back")

    near = staged.where((F.col(_DATE) >= F.lit(first)) & (F.col(_DATE) <= F.lit(last)))
    ids = late.select("__id", "__date", F.lit(1).alias(_LATE))
    marked = near.join(ids, same(F.col(row_id), F.col("__id")) & (F.col(_DATE) == F.col("__date")), "left").drop("__id", "__date")
    counts = [
        RollingBlock(["count"], [_LATE], b.partition, [f"{b.max_lookback}s"], b.timestamp, exclude_current_row=False) for b in _distinct_keys(preset)
    ]
    counted = with_rolling(marked, counts, strategy, limits=limits)
    reach = F.greatest(*[F.col(f.name) for b in counts for f in b.features()], F.lit(0)) > 0
    # Rows that share an id and a date are replaced together.
    one = counted.select(*near.columns, reach.alias(_REACHED))
    twins = one.where(_REACHED).select(F.col(row_id).alias("__id"), F.col(_DATE).alias("__date")).distinct().select("*", F.lit(True).alias("__twin"))
    both = one.join(twins, same(F.col(row_id), F.col("__id")) & (F.col(_DATE) == F.col("__date")), "left")
    result = both.select(*near.columns, F.coalesce("__twin", F.lit(False)).alias(_REACHED))
    path = scratch_dir(store.spark, "reached")
    result.write.partitionBy(_DATE).parquet(path)
    return store.spark.read.schema(result.schema).parquet(path)


def _distinct_keys(preset: Preset) -> list[RollingBlock]:
    """One block for each key, with the longest of its look-backs."""
    longest: dict[tuple, RollingBlock] = {}
    for block in preset.blocks:
        key = (tuple(block.partition), block.timestamp)
        if key not in longest or block.max_lookback > longest[key].max_lookback:
            longest[key] = block
    return [replace(b, aggregations=["count"], columns=["__any"]) for b in longest.values()]


def _needed(rows: DataFrame, preset: Preset) -> DataFrame:
    """The rows that the reached ones look back on: those that share one of their keys."""
    needed = F.col(_REACHED)
    out = rows
    for i, block in enumerate(_distinct_keys(preset)):
        names = [f"__k{i}_{j}" for j in range(len(block.partition))]
        keys = rows.where(_REACHED).select(*[F.col(k).alias(n) for k, n in zip(block.partition, names)]).distinct().select("*", F.lit(True).alias(f"__has{i}"))
        on = [same(F.col(k), F.col(n)) for k, n in zip(block.partition, names)]
        out = out.join(keys, on, "left")
        needed = needed | F.coalesce(F.col(f"__has{i}"), F.lit(False))
    return out.where(needed).select(*rows.columns)
