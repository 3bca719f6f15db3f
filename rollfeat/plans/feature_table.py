"""The feature table as a job: staging, first load, increments, full refresh."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.operators.incremental import halo_start, high_date, newer_than
from rollfeat.operators.quality import ChecksFailed
from rollfeat.plans.daystates import features_from_states, refresh_states
from rollfeat.plans.late import load_late
from rollfeat.plans.presets import Preset, build_features, label_transactions
from rollfeat.sources.tables import TableStore


def stage(store: TableStore, table: str, tx: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled transactions as a table partitioned by date.

    A rolling build reads its input once per key it groups by, so on large data the join is worth storing. Small jobs
    can pass ``label_transactions(...)`` on as it is.
    """
    staged = label_transactions(tx, labels)
    if "tx_date" not in staged.columns:
        staged = staged.select("*", F.to_date("tx_ts").alias("tx_date"))
    store.overwrite(table, staged, partition_by=["tx_date"])
    return store.read(table)


def refuse_early(rows: DataFrame, checks: Mapping[str, Column]) -> None:
    """Checks that need no feature are counted on the staged rows, each of which becomes one row of features: a load that they
    refuse then computes none. Those that pass are counted once more in the pass that writes."""
    failures = [F.count_if(~F.coalesce(check, F.lit(False))).alias(f"failed_{i}") for i, check in enumerate(checks.values())]
    try:
        counted = rows.agg(*failures)
        counted.schema  # names are looked up here at the latest
    except AnalysisException:
        return
    failed = [f"{name}: {n} failing rows" for name, n in zip(checks, counted.first()) if n]
    if failed:
        raise ChecksFailed("; ".join(failed))


def load_features(
    store: TableStore,
    target: str,
    staged: DataFrame,
    preset: Preset,
    history: str = "full",
    relation: DataFrame | None = None,
    full_refresh: bool = False,
    strategy: str = "auto",
    created_at: Column | None = None,
    late_rows: bool = False,
    batch_id: str | None = None,
    checks: Mapping[str, Column] | None = None,
    states: str | None = None,
) -> None:
    """Bring ``target`` up to date with ``staged`` (which carries ``tx_date``).

    The first load and a full refresh compute everything. Otherwise rows dated after the latest date of ``relation``
    (by default the target) are added:

    * ``history="full"`` also reads as many earlier days as the longest look-back needs, so features are the same as
      in a full build;
    * ``history="delta"`` lets windows see only the new rows. Cheap, but features lose what happened before.

    With ``late_rows``, rows that came in for dates the target already holds are merged first, and everything they reach is
    computed again (:func:`rollfeat.plans.late.load_late`); this needs ``history="full"``.

    With a ``batch_id`` the load counts as a whole or not at all: one that failed is repeated under the same id, and one
    that was committed is not done again. ``checks`` (conditions on every row) then keep a bad load from being committed. A target keeps to
    one way of loading, with batches or without.

    With ``states``, a prefix of table names, states per key and day are kept beside the target, and an increment reads them in place
    of the raw rows of earlier days (:mod:`rollfeat.plans.daystates`); this needs ``history="full"``. The result is the same.

    Rows without a timestamp enter with a first load or a full refresh only.
    """
    if history not in ("full", "delta"):
        raise ValueError(f"history must be 'full' or 'delta', not {history!r}")
    if states is not None and history != "full":
        raise ValueError("kept states hold all of history, which is history='full'")
    if batch_id is None and checks:
        raise ValueError("checks decide on a commit, so they need a batch_id")
    if batch_id is not None:
        if late_rows:
            raise ValueError("committed batches are never changed; late rows need a target without batches")
        if store.is_committed(target, batch_id):
            return

    def add(features: DataFrame) -> None:
        if batch_id is None:
            store.append(target, features, partition_by=["tx_date"])
        else:
            store.append_once(target, features, batch_id, partition_by=["tx_date"], replace=full_refresh, checks=checks)

    def check(rows: DataFrame) -> None:
        if checks:
            refuse_early(rows, checks)

    def keep_states() -> None:
        high = None if states is None else high_date(store.read(target))
        if high is not None:
            refresh_states(store, states, staged, preset, halo_start(high, preset.max_lookback), high)

    if batch_id is not None and (full_refresh or not store.exists(target)):
        check(staged)
        add(build_features(staged, preset, strategy, created_at=created_at))
        keep_states()
        return
    if full_refresh or not store.exists(target):
        features = build_features(staged, preset, strategy, created_at=created_at)
        store.overwrite(target, features, partition_by=["tx_date"])
        keep_states()
        return
    if late_rows:
        if history != "full":
            raise ValueError("late rows change earlier features, which needs history='full'")
        load_late(store, target, staged, preset, strategy=strategy, created_at=created_at)
    relation = store.read(target) if relation is None else relation
    column = "tx_date" if "tx_date" in relation.columns else "tx_ts"
    if history == "delta":
        delta = newer_than(staged, "tx_date", relation, column)
        check(delta)
        add(build_features(delta, preset, strategy, created_at=created_at))
        return
    high = high_date(relation, column)
    if high is None:
        check(staged)
        add(build_features(staged, preset, strategy, created_at=created_at))
        keep_states()
        return
    new = F.col("tx_date") > F.lit(high)
    check(staged.where(new))
    if states is not None:
        add(features_from_states(store, states, staged, preset, high, created_at))
        return
    with_halo = staged.where(F.col("tx_date") >= F.lit(halo_start(high, preset.max_lookback)))
    features = build_features(with_halo, preset, strategy, keep=new, created_at=created_at)
    add(features)
