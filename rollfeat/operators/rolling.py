"""Rolling aggregates per key over a range of event time, in whole seconds.

``with_rolling`` is the entry point. It computes ``AGG(column)`` over the rows of the same key whose second lies in
``[t - lookback, t - 1]`` (or ``[t - lookback, t]`` when the current row, and with it every row of the same second, is
included). Two plans give the same answer:

* *direct*: one Spark window per key. The right plan for keys with few rows per look-back.
* *chunked*: see :mod:`rollfeat.operators.chunked`. Linear in the data, and no task ever holds a whole key.

With ``strategy="auto"`` a cheap statistics pass decides, key by key, which plan computes which key. ``count_distinct`` has a plan of its
own for keys of any size, see :mod:`rollfeat.operators.distinct`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.functions.aggregates import SCALED, SUMMED, Aggregate, aggregate, exact_decimal, is_wide, state as state_of, wide_input
from rollfeat.functions.durations import parse_duration
from rollfeat.functions.exactsum import measure
from rollfeat.functions.scalars import epoch_seconds, same
from rollfeat.operators import chunked
from rollfeat.operators.distinct import distinct_features
from rollfeat.operators.hotkeys import Limits, find_hot_keys
from rollfeat.session import scratch_dir

_SEC = "__sec"
_DENSE = "__dense"
# The one aggregate that is not made of mergeable states.
DISTINCT = "count_distinct"


@dataclass(frozen=True)
class RollingBlock:
    """Every aggregation of every column over every look-back, for one key."""

    aggregations: Sequence[str]
    columns: Sequence[str]
    partition: Sequence[str]
    lookbacks: Sequence[str]
    timestamp: str = "tx_ts"
    exclude_current_row: bool = True
    exact_type: str | None = None  # decimal type in which floating-point columns are summed; without it, bit by bit

    def __post_init__(self):
        if isinstance(self.partition, str) or not self.partition:
            raise ValueError("partition must be a non-empty list of column names")
        for feature in self.features():
            aggregate(feature.aggregation)

    def features(self) -> list[Feature]:
        """In output order: by column, then aggregation, then look-back."""
        end = "1s" if self.exclude_current_row else "0s"
        by = "_".join(self.partition).lower()
        return [
            Feature(f"{agg.lower()}_{column.lower()}_by_{by}_{lookback}_{end}", agg.lower(), column, parse_duration(lookback))
            for column in self.columns
            for agg in self.aggregations
            for lookback in self.lookbacks
        ]

    @property
    def last_offset(self) -> int:
        """Where a frame ends, relative to the current second."""
        return -1 if self.exclude_current_row else 0

    @property
    def max_lookback(self) -> int:
        return max(f.seconds for f in self.features())


@dataclass(frozen=True)
class Feature:
    name: str
    aggregation: str
    column: str
    seconds: int

    @property
    def spec(self) -> Aggregate:
        return aggregate(self.aggregation)


@dataclass(frozen=True)
class StateColumn:
    """One mergeable state of one input column, as stored between the stages of the chunked plan."""

    name: str
    column: str
    state: str


class BoundBlock:
    """A block together with the types of the frame it runs on.

    Floating-point columns that are summed without a decimal type are measured first, by one pass over them.
    """

    def __init__(self, block: RollingBlock, df: DataFrame):
        self.block = block
        self.features = block.features()
        types = {c: df.schema[df.select(c).columns[0]].dataType for c in dict.fromkeys(block.columns)}
        self._exact = {c: exact_decimal(t, block.exact_type) for c, t in types.items()}
        wide = [c for c in types if any(self._is_wide(f) for f in self.features if f.column == c)]
        self._seen = measure(df, wide) if wide else {}
        self._needs = {f.name: f.spec.wide.states(self._seen[f.column]) if self._is_wide(f) else list(f.spec.states) for f in self.features}
        self.states = [
            StateColumn(f"__{state}_{i}", column, state)
            for i, column in enumerate(types)
            for state in dict.fromkeys(s for f in self.features if f.column == column for s in self._needs[f.name])
        ]

    def _is_wide(self, feature: Feature) -> bool:
        return bool(SUMMED & set(feature.spec.states)) and self._exact[feature.column] is None

    def decimal_of(self, state: StateColumn) -> T.DecimalType | None:
        """The decimal type in which the column of a state is summed."""
        return self._exact[state.column]

    def input(self, state: StateColumn) -> Column:
        """What a state is built from: limbs of doubles, the decimal form where it is summed, the plain column otherwise."""
        if is_wide(state.state):
            return wide_input(state.state, state.column, self._seen[state.column])
        exact = self._exact[state.column]
        value = F.col(state.column)
        if exact is None or state.state not in SUMMED:
            return value
        value = value.cast(exact)
        return (value * F.lit(Decimal(10**exact.scale))).cast("decimal(38,0)") if state.state in SCALED else value

    def states_of(self, feature: Feature) -> list[StateColumn]:
        return [s for s in self.states if s.column == feature.column and s.state in self._needs[feature.name]]

    def stored_name(self, state: StateColumn) -> str:
        """A name under which a state can be kept: it tells the state, its column and the decimal type it is summed in."""
        exact = self._exact[state.column] if state.state in SUMMED else None
        kind = "" if exact is None else f"__{exact.precision}_{exact.scale}"
        return f"{state.state}__{state.column.lower()}{kind}"

    def finish(self, feature: Feature, columns: dict[str, str]) -> Column:
        """The feature from the columns that hold its states."""
        if self._is_wide(feature):
            quoted = {state: f"`{column}`" for state, column in columns.items()}
            return feature.spec.wide.finish(quoted, self._seen[feature.column]).alias(feature.name)
        return self.finish_exact(feature, {state: F.col(column) for state, column in columns.items()})

    def finish_exact(self, feature: Feature, values: dict[str, Column]) -> Column:
        """The same from expressions, for all but doubles that are summed without a decimal type."""
        if self._is_wide(feature):
            raise ValueError(f"{feature.name}: sums of doubles without exact_type need with_rolling")
        exact = self._exact[feature.column]
        return feature.spec.finish(values, exact.scale if exact is not None else 0).alias(feature.name)


def rolling_columns(df: DataFrame, block: RollingBlock) -> list[Column]:
    """The features of a block as window expressions over raw rows, ready for one ``df.select("*", *columns)``.

    Sums of doubles need ``exact_type`` here; :func:`with_rolling` does without."""
    bound = BoundBlock(block, df)
    return [
        bound.finish_exact(f, {s.state: _raw_window(bound, s, f) for s in bound.states_of(f)}) for f in bound.features
    ]


def _raw_window(bound: BoundBlock, state: StateColumn, feature: Feature) -> Column:
    order = epoch_seconds(bound.block.timestamp)
    window = Window.partitionBy(*bound.block.partition).orderBy(order)
    frame = window.rangeBetween(-feature.seconds, bound.block.last_offset)
    exact = bound.decimal_of(state)
    if state.state == "sum" and exact is not None and exact.precision <= _LONG_DIGITS:
        return _sum_of_longs(bound.input(state), exact, frame)
    return state_of(state.state).build(bound.input(state)).over(frame)


# Decimals of so many digits are 64-bit integers. Their sums are longer, and a sliding window adds every frame up anew.
_LONG_DIGITS = 18
_HALF = 2**32


def _sum_of_longs(value: Column, exact: T.DecimalType, frame: WindowSpec) -> Column:
    """The sum of decimals over a frame. Their upper and lower 32 bits are summed as 64-bit integers, which is much cheaper, and put
    together once a row."""
    whole = (value * F.lit(Decimal(10**exact.scale))).cast("bigint")
    high, low = F.shiftright(whole, 32), whole.bitwiseAND(F.lit(_HALF - 1))
    total = F.sum(high).over(frame).cast("decimal(18,0)") * F.lit(Decimal(_HALF)) + F.sum(low).over(frame).cast("decimal(19,0)")
    scaled = total.cast(f"decimal({exact.precision + 10},0)") * F.lit(Decimal(1).scaleb(-exact.scale))
    return scaled.cast(f"decimal({exact.precision + 10},{exact.scale})")


def _direct(df: DataFrame, bounds: Sequence[BoundBlock]) -> DataFrame:
    """All blocks by plain windows; features that share a state (avg and count, say) share its window."""
    windows, outputs = {}, []
    for i, bound in enumerate(bounds):
        for f in bound.features:
            names = {s.state: f"__{i}{s.name}_{f.seconds}" for s in bound.states_of(f)}
            windows.update({names[s.state]: _raw_window(bound, s, f) for s in bound.states_of(f) if names[s.state] not in windows})
            outputs.append(bound.finish(f, names))
    windowed = df.select("*", *[c.alias(n) for n, c in windows.items()])
    return windowed.select(*df.columns, *outputs)


def with_rolling(
    df: DataFrame,
    blocks: Sequence[RollingBlock],
    strategy: str = "auto",
    keep: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """``df`` plus the features of all blocks, every input row once.

    ``keep`` limits the output (not the rows that windows see) to rows where it is true. ``strategy`` is ``auto``,
    ``direct`` or ``chunked``.
    """
    if strategy not in ("auto", "direct", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    names = [f.name for b in blocks for f in b.features()]
    clashes = sorted({n for n in names if names.count(n) > 1} | ({c.lower() for c in df.columns} & set(names)))
    if clashes:
        raise ValueError(f"columns defined more than once: {', '.join(clashes)}")

    direct, by_second = [], []
    for block in blocks:
        distinct = [f for f in block.features() if f.aggregation == DISTINCT]
        if distinct:
            by_second.append((block, distinct_features(keyed_rows(df, block, keep), key_columns(block), distinct, block.last_offset)))
            others = [a for a in block.aggregations if a.lower() != DISTINCT]
            if not others:
                continue
            block = replace(block, aggregations=others)
        bound = BoundBlock(block, df)
        features = None if strategy == "direct" else _features_by_second(df, bound, strategy, keep, limits)
        if features is None:
            direct.append(bound)
        else:
            by_second.append((block, features))

    result = _direct(df, direct) if direct else df
    if keep is not None:
        result = result.where(keep)
    for block, features in by_second:
        result = attach(result, block, features)
    return result.select(*df.columns, *names)


def key_columns(block: RollingBlock) -> list[str]:
    """What the keys of a block are called between the stages."""
    return [f"__key_{i}" for i in range(len(block.partition))]


def keyed_rows(df: DataFrame, block: RollingBlock, keep: Column | None) -> DataFrame:
    """Keys, second and values of the rows, and whether features are wanted for them."""
    return df.select(
        *[F.col(k).alias(n) for k, n in zip(block.partition, key_columns(block))],
        epoch_seconds(block.timestamp).alias(_SEC),
        *[F.col(c) for c in dict.fromkeys(block.columns)],
        (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias("__keep"),
    )


def _features_by_second(df, bound, strategy, keep, limits) -> DataFrame | None:
    """Features per (key, second) when some key is dense; None when plain windows over the rows do."""
    block = bound.block
    key_names = key_columns(block)
    rows = keyed_rows(df, block, keep)
    if strategy == "auto":
        hot = find_hot_keys(rows, key_names, _SEC, block.max_lookback, limits)
        if hot is None:
            return None
    seconds = chunked.per_second(rows, key_names, bound)
    if strategy == "chunked":
        return chunked.chunked_features(seconds, key_names, bound, chunked.Extent.of(rows, key_names))
    # Both plans read the seconds several times over: they are computed once, with a mark on those of dense keys.
    on = [same(F.col(k), F.col(f"__hot{k}")) for k in key_names]
    hot_keys = hot.keys(key_names, "__hot").withColumn(_DENSE, F.lit(True))
    marked = seconds.join(hot_keys, on, "left").select(*seconds.columns, F.coalesce(_DENSE, F.lit(False)).alias(_DENSE))
    path = scratch_dir(df.sparkSession, "seconds")
    marked.write.partitionBy(_DENSE).parquet(path)
    marked = df.sparkSession.read.schema(marked.schema).parquet(path)
    dense, sparse = marked.where(_DENSE).drop(_DENSE), marked.where(~F.col(_DENSE)).drop(_DENSE)
    extent = chunked.Extent.of(dense, key_names)
    density = hot.peak / block.max_lookback
    return chunked.chunked_features(dense, key_names, bound, extent, density).unionByName(
        chunked.direct_features(sparse, key_names, bound, sparse.count())
    )


def attach(df: DataFrame, block: RollingBlock, features: DataFrame) -> DataFrame:
    """Put per-second features back on the rows. A second may hold any number of rows: only the features side is
    unique, and adaptive execution splits an oversized join partition on the rows side."""
    keys = key_columns(block)
    on = [same(F.col(k), F.col(n)) for k, n in zip(block.partition, keys)]
    on.append(same(epoch_seconds(block.timestamp), F.col(_SEC)))
    return df.join(features, on, "left").drop(*keys, _SEC)
