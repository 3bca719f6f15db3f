"""Rolling aggregates as mergeable states.

Each aggregate is a finishing expression over a few *states*. A state can be built from raw values, merged over many
states and joined with one other state, so the same definition serves a plain window, a pre-aggregation before a
shuffle, and the time-chunked plan for hot keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.functions import exactsum
from rollfeat.functions.exactsum import HALF_BITS, Magnitudes


@dataclass(frozen=True)
class State:
    build: Callable[[Column], Column]  # raw values -> state
    merge: Callable[[Column], Column]  # states -> state
    join: Callable[[Column, Column], Column]  # two states -> state


def _add(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


# Numbers whose squares are summed are whole numbers high * LIMB + low; sums of the three products then fit 38 digits
# for any 64-bit number and for decimals of up to 24 digits.
LIMB = 10**9


def _high(v: Column) -> Column:
    return F.floor(v / F.lit(Decimal(LIMB))).cast("decimal(18,0)")


def _low(v: Column) -> Column:
    return (v - _high(v) * F.lit(Decimal(LIMB))).cast("decimal(10,0)")


STATES = {
    "count": State(F.count, F.sum, _add),
    "sum": State(F.sum, F.sum, _add),
    "high": State(lambda v: F.sum(_high(v)), F.sum, _add),
    "low": State(lambda v: F.sum(_low(v)), F.sum, _add),
    "high_high": State(lambda v: F.sum((_high(v) * _high(v)).cast("decimal(36,0)")), F.sum, _add),
    "high_low": State(lambda v: F.sum((_high(v) * _low(v)).cast("decimal(28,0)")), F.sum, _add),
    "low_low": State(lambda v: F.sum((_low(v) * _low(v)).cast("decimal(20,0)")), F.sum, _add),
    "min": State(F.min, F.min, F.least),
    "max": State(F.max, F.max, F.greatest),
    "sketch": State(
        lambda v: F.hll_sketch_agg(v.cast("string")), F.hll_union_agg, lambda a, b: F.coalesce(F.hll_union(a, b), a, b)
    ),
}


# Sums of limbs of doubles; the place of a limb is part of the state's name.
_LIMBS = State(F.sum, F.sum, _add)
STATES["marks"] = State(F.bit_or, F.bit_or, lambda a, b: F.coalesce(a.bitwiseOR(b), a, b))


def state(name: str) -> State:
    return STATES[name] if name in STATES else _LIMBS


def _limb_state(kind: str, place: int) -> str:
    return f"{kind}_{place}".replace("-", "m")


def is_wide(name: str) -> bool:
    return name == "marks" or name.split("_")[0] in ("half", "square")


def wide_input(name: str, column: str, seen: Magnitudes) -> Column:
    """What a state of a floating-point column is built from."""
    if name == "marks":
        return exactsum.marks(column)
    kind, _, place = name.partition("_")
    place = int(place.replace("m", "-"))
    if kind == "square":
        return exactsum.limb_of_squares(column, place, seen.places(HALF_BITS))
    return exactsum.limb_of_sum(column, place, seen)


@dataclass(frozen=True)
class Wide:
    """An aggregate of doubles that have no decimal type, over limbs at the places that the column has bits in."""

    states: Callable[[Magnitudes], list[str]]
    finish: Callable[[dict[str, str], Magnitudes], Column]  # of the columns that hold the states


def _wide_sum(mean: bool) -> Wide:
    def states(seen):
        return ["count", "marks", *[_limb_state("half", p) for p in seen.places(HALF_BITS)]]

    def finish(s, seen):
        limbs = [s[_limb_state("half", p)] for p in seen.places(HALF_BITS)]
        return exactsum.finish_sum(limbs, seen.places(HALF_BITS), s["marks"], s["count"] if mean else None)

    return Wide(states, finish)


def _wide_variance(lost: int, root: bool = False) -> Wide:
    def squares(places):
        return [_limb_state("square", p) for p in range(2 * places.start, 2 * places.stop - 1)]

    def states(seen):
        places = seen.places(HALF_BITS)
        if len(places) > exactsum.MOST_SQUARED:
            raise ValueError(f"moments of values from {seen.least} to {seen.most} need exact_type, the decimal type in which they are taken")
        return ["count", "marks", *[_limb_state("half", p) for p in places], *squares(places)]

    def finish(s, seen):
        places = seen.places(HALF_BITS)
        found = exactsum.finish_variance(s["count"], [s[_limb_state("half", p)] for p in places], [s[n] for n in squares(places)], places, s["marks"], lost)
        return F.sqrt(found) if root else found

    return Wide(states, finish)


@dataclass(frozen=True)
class Aggregate:
    states: tuple[str, ...]
    finish: Callable[[dict[str, Column], int], Column]  # states and the decimal scale of the summed values
    wide: Wide | None = None  # in its place for doubles whose sums no decimal type holds


def _count(s, scale):
    return F.coalesce(s["count"], F.lit(0)).cast("bigint")


def _mean(s, scale):
    return s["sum"].cast("double") / F.nullif(s["count"], F.lit(0)).cast("double")


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of values, each computed once however often the body uses it."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), F.lit(0))


def _all(v: Column, *more: str) -> dict[str, Column]:
    return {name: v[name] for name in (*_MOMENTS[1:], "n", *more)}


def _variance(lost: int):
    """Variance with ``lost`` degrees of freedom less than rows.

    The states are exact whole numbers, of values scaled by their decimal places. They are shifted by the rounded mean
    before anything becomes floating point, so no digits cancel.
    """

    def finish(s, scale):
        # The centre is the rounded mean, in the same two limbs.
        start = _let({name: s[name] for name in _MOMENTS} | {"n": F.nullif(s["count"], F.lit(0)).cast("decimal(12,0)")}, with_high)
        return F.when(s["count"] > lost, start / F.lit(float(10 ** (2 * scale))))

    def with_high(v):
        return _let(_all(v) | {"centre_high": F.floor(v["high"] / v["n"]).cast("decimal(18,0)")}, with_spare)

    def with_spare(v):
        spare = ((v["high"] - v["centre_high"] * v["n"]) * F.lit(Decimal(LIMB)) + v["low"]).cast("decimal(38,0)")
        return _let(_all(v, "centre_high") | {"spare": spare}, with_low)

    def with_low(v):
        return _let(_all(v, "centre_high", "spare") | {"centre_low": (v["spare"] / v["n"]).cast("decimal(20,0)")}, with_products)

    def with_products(v):
        def around(products, a, b, sum_a, sum_b):
            return (products - _whole(a * sum_b) - _whole(b * sum_a) + _whole(v["n"] * _whole(a * b))).cast("decimal(38,0)")

        high, low = v["centre_high"], v["centre_low"]
        products = {
            "highs": around(v["high_high"], high, high, v["high"], v["high"]),
            "mixed": around(v["high_low"], high, low, v["high"], v["low"]),
            "lows": around(v["low_low"], low, low, v["low"], v["low"]),
        }
        return _let({"n": v["n"], "drift": (v["spare"] - v["n"] * low).cast("double")} | products, together)

    def together(v):
        highs, mixed, lows, limb = v["highs"], v["mixed"], v["lows"], F.lit(Decimal(LIMB))
        # Near the centre the three sums cancel and are put together exactly; far from it the first one decides.
        near = (F.abs(highs) < F.lit(Decimal(10**12))) & (F.abs(mixed) < F.lit(Decimal(10**24)))
        exact = _whole(_whole(_whole(F.when(near, highs) * limb) * limb) + _whole(F.lit(2) * F.when(near, mixed)) * limb) + lows
        rough = highs.cast("double") * F.lit(1e18) + mixed.cast("double") * F.lit(2e9) + lows.cast("double")
        from_centre = F.when(near, exact.cast("double")).otherwise(rough)
        size = v["n"].cast("double")
        deviations = F.greatest(from_centre - v["drift"] * v["drift"] / size, F.lit(0.0))
        return deviations / F.nullif(size - F.lit(float(lost)), F.lit(0.0))

    return finish


def _root(finish):
    return lambda s, scale: F.sqrt(finish(s, scale))


_MOMENTS = ("count", "high", "low", "high_high", "high_low", "low_low")
# States that are built from values scaled to whole numbers.
SCALED = frozenset(_MOMENTS) - {"count"}
# States that sum values; those of doubles without decimal type are replaced by limbs.
SUMMED = SCALED | {"sum"}


def _estimate(s, scale):
    # A sketch that was never merged is estimated in another way than a merged one. Merged with itself it holds the
    # same, and the answer depends on the values alone, not on the plan that gathered them.
    return F.coalesce(F.hll_sketch_estimate(F.hll_union(s["sketch"], s["sketch"])), F.lit(0)).cast("double")


def _no_states(s, scale):
    raise ValueError("count_distinct has no mergeable state of bounded size; with_rolling counts it in another way")


AGGREGATES = {
    "count": Aggregate(("count",), _count),
    "avg": Aggregate(("count", "sum"), _mean, _wide_sum(mean=True)),
    "min": Aggregate(("min",), lambda s, _: s["min"].cast("double")),
    "max": Aggregate(("max",), lambda s, _: s["max"].cast("double")),
    "sum": Aggregate(("sum",), lambda s, _: s["sum"].cast("double"), _wide_sum(mean=False)),
    "stddev": Aggregate(_MOMENTS, _root(_variance(1)), _wide_variance(1, root=True)),
    "stddev_samp": Aggregate(_MOMENTS, _root(_variance(1)), _wide_variance(1, root=True)),
    "stddev_pop": Aggregate(_MOMENTS, _root(_variance(0)), _wide_variance(0, root=True)),
    "variance": Aggregate(_MOMENTS, _variance(1), _wide_variance(1)),
    "var_samp": Aggregate(_MOMENTS, _variance(1), _wide_variance(1)),
    "var_pop": Aggregate(_MOMENTS, _variance(0), _wide_variance(0)),
    "approx_count_distinct": Aggregate(("sketch",), _estimate),
    "count_distinct": Aggregate((), _no_states),
}


def aggregate(name: str) -> Aggregate:
    """Look an aggregate up by name, case-insensitively. Only listed names are accepted, never free text."""
    try:
        return AGGREGATES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown aggregate {name!r}; known: {', '.join(sorted(AGGREGATES))}") from None


def exact_decimal(data_type: T.DataType, exact_type: str | None) -> T.DecimalType | None:
    """The decimal type values are summed in, or None for floating-point values that have none.

    Decimals and whole numbers always sum exactly. Floating-point values do in the decimal type that ``exact_type`` names
    (for example ``decimal(18,2)``), which is cheapest, and otherwise bit by bit, see :mod:`rollfeat.functions.exactsum`.
    """
    if isinstance(data_type, T.DecimalType):
        return data_type
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.DecimalType(19, 0)
    if exact_type is None:
        return None
    declared = T.DataType.fromDDL(exact_type)
    if not isinstance(declared, T.DecimalType):
        raise ValueError(f"exact_type must be a decimal type, not {exact_type!r}")
    return declared
