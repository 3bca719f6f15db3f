"""Sums of doubles that do not depend on the order of their terms.

Every double is a whole number of units of 2**-1074. Cut into limbs at fixed places, multiples of 2**HALF_BITS, it has at most three that
are not zero, and limbs of one place add up exactly as whole numbers of 64 bits, in any order and over any number of stages, for up to
2**32 rows a frame. The sum of a frame is then rounded to a double once, to nearest and ties to even, as if taken with unlimited precision.

Only places that a column has bits in become states. They follow from its smallest and largest magnitude, which one narrow pass
measures; a value beyond them is an error, never a silent loss. NaN and infinities are kept apart as three marks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limbs that are summed: their sums, and a product of two of them, are whole numbers of 64 bits. Variances are rounded from twice that.
BITS = 60
HALF_BITS = 30
_MANTISSA = 53
# Columns whose limbs are squared may have so many of them. The values then span a factor of 2**400 or less.
MOST_SQUARED = 16
_NAN, _POSITIVE, _NEGATIVE = 1, 2, 4


@dataclass(frozen=True)
class Magnitudes:
    """The smallest and largest magnitude of a column's finite values other than zero."""

    least: float
    most: float

    def places(self, bits: int) -> range:
        """The places of all limbs that may hold a bit of such a value."""
        lowest = max(math.frexp(self.least)[1] - _MANTISSA, -1074)
        return range(lowest // bits, (math.frexp(self.most)[1] - 1) // bits + 1)


def measure(df: DataFrame, columns: list[str]) -> dict[str, Magnitudes]:
    """One pass over the columns; their aggregates combine before the shuffle."""
    bounds = []
    for i, column in enumerate(columns):
        size = F.abs(F.col(column).cast("double"))
        size = F.when(~F.isnan(size) & (size < F.lit(float("inf"))) & (size > 0), size)
        bounds += [F.min(size).alias(f"least{i}"), F.max(size).alias(f"most{i}")]
    found = df.agg(*bounds).first()
    return {c: Magnitudes(found[f"least{i}"] or 1.0, found[f"most{i}"] or 1.0) for i, c in enumerate(columns)}


def _double(column: str) -> str:
    return f"CAST(`{column}` AS DOUBLE)"


def _number(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"double('{x}')"


def _power_of_two(n: int) -> str:
    return _number(2.0**n if n < 1024 else math.inf)


def _limb(column: str, place: int, bits: int) -> str:
    """The whole number between 2**(bits * place) and the next place in a finite double, with its sign."""
    # Scaling by powers of two is exact, and so is a remainder. In two steps no factor leaves the range of doubles.
    power = -bits * place
    half = power // 2
    whole = f"CAST({_double(column)} * {_power_of_two(half)} * {_power_of_two(power - half)} % {_power_of_two(bits)} AS BIGINT)"
    beyond = bits * (place + 1) + _MANTISSA  # larger values end above this place, smaller ones than its unit below it
    size = f"abs({_double(column)})"
    return f"IF({size} >= {_power_of_two(bits * place)} AND {size} < {_power_of_two(beyond)}, {whole}, 0L)"


def _of_finite(column: str, whole: str, kind: str = "DECIMAL(19,0)") -> Column:
    """Null for null, nothing for NaN and infinities."""
    value = _double(column)
    finite = f"NOT isnan({value}) AND abs({value}) < double('Infinity')"
    return F.expr(f"CAST(CASE WHEN {value} IS NULL THEN NULL WHEN {finite} THEN {whole} ELSE 0L END AS {kind})")


def limb_of_sum(column: str, place: int, seen: Magnitudes) -> Column:
    """What a value adds to the sum of a place. The lowest one also checks that the value is among those measured."""
    taken = _limb(column, place, HALF_BITS)
    if place == seen.places(HALF_BITS).start:
        size = f"abs({_double(column)})"
        unseen = f"{size} > {_number(seen.most)} OR ({size} < {_number(seen.least)} AND {size} > 0)"
        lost = "CAST(raise_error('a value lies outside the range that was measured; the input changed in between') AS BIGINT)"
        taken = f"IF({unseen}, {lost}, {taken})"
    return _of_finite(column, taken, "BIGINT")


def limb_of_squares(column: str, place: int, places: range) -> Column:
    """What the square of a value has at a place of its limbs: the products of all pairs of limbs that fall there."""
    pairs = [(i, place - i) for i in places if place - i in places]
    return _of_finite(column, " + ".join(f"{_limb(column, i, HALF_BITS)} * {_limb(column, j, HALF_BITS)}" for i, j in pairs))


def marks(column: str) -> Column:
    """A bit each for NaN and the infinities; null for null."""
    value = _double(column)
    return F.expr(
        f"CASE WHEN {value} IS NULL THEN NULL WHEN isnan({value}) THEN {_NAN} "
        f"WHEN {value} = double('Infinity') THEN {_POSITIVE} WHEN {value} = double('-Infinity') THEN {_NEGATIVE} ELSE 0 END"
    )


# --- finishing -------------------------------------------------------------------------------------------------------
#
# As SQL text over column names, like the limbs: nested lambdas of this size take seconds to put together from Column objects.

_WIDE = "DECIMAL(38,0)"
_ZERO = f"CAST(0 AS {_WIDE})"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _array(limbs: list[str], length: int) -> str:
    return f"array({', '.join([f'CAST({x} AS {_WIDE})' for x in limbs] + [_ZERO] * (length - len(limbs)))})"


def _normal(limbs: str, bits: int) -> str:
    """Digits between 0 and 2**bits, lowest first, and the last carry: 0, or -1 for a negative number."""
    base = f"{2**bits}BD"
    digit = f"named_struct('carry', CAST((here - pmod(here, {base})) / {base} AS {_WIDE}), 'digits', concat(done.digits, array(CAST(pmod(here, {base}) AS BIGINT))))"
    nothing = f"named_struct('carry', {_ZERO}, 'digits', CAST(array() AS ARRAY<BIGINT>))"
    return f"aggregate({limbs}, {nothing}, (done, limb) -> {_let('here', f'CAST(done.carry + limb AS {_WIDE})', digit)})"


def _signed(limbs: str, bits: int) -> str:
    """Sign and digits of the magnitude."""
    negated = _normal(f"transform(limbs, limb -> CAST(-limb AS {_WIDE}))", bits)
    chosen = f"IF(plain.carry < 0, named_struct('sign', -1D, 'digits', {negated}.digits), named_struct('sign', 1D, 'digits', plain.digits))"
    return _let("limbs", limbs, _let("plain", _normal("limbs", bits), chosen))


def _rounded(limbs: str, n_limbs: int, first_place: int, divisor: str) -> str:
    """The double next to the number given by its limbs of BITS bits, divided by ``divisor``."""
    powers = [BITS * (first_place + i - 1) for i in range(n_limbs)]
    scales = [f"get(array({', '.join(_power_of_two(p) for p in half)}), top)" for half in ([p // 2 for p in powers], [p - p // 2 for p in powers])]
    # 62 leading bits, the last of which also stands for all that follow, so that the cast is the only rounding.
    bits = f"(shiftleft(at.high, {BITS} - at.shift) + shiftright(at.low, at.shift)) | IF(at.more OR at.low % shiftleft(1L, at.shift) <> 0, 1L, 0L)"
    value = f"n.sign * (CAST({bits} AS DOUBLE) * CAST(shiftleft(1L, at.shift) AS DOUBLE) / {divisor}) * {scales[0]} * {scales[1]}"
    at = (
        "named_struct('high', get(n.digits, top), 'low', coalesce(get(n.digits, top - 1), 0L), 'shift', greatest(length(bin(get(n.digits, top))) - 2, 0), "
        "'more', exists(slice(n.digits, 1, greatest(top - 1, 0)), digit -> digit <> 0))"
    )
    top = "array_max(transform(n.digits, (digit, i) -> IF(digit <> 0, i, NULL)))"
    return f"coalesce({_let('n', _signed(limbs, BITS), _let('top', top, _let('at', at, value)))}, 0D)"


def _rounding(first_place: int, mean: bool):
    """A function of limbs, behind the count where it is a mean, that gives the double next to their sum (divided once more). Nested, so
    that workers need nothing of this package."""
    bits = HALF_BITS

    def digits(limbs):
        """Digits between 0 and 2**bits, lowest first, and the last carry: 0, or -1 for a negative number."""
        out, carry = np.empty((len(limbs) + 2, limbs.shape[1]), np.int64), np.zeros(limbs.shape[1], np.int64)
        for i in range(len(out)):
            here = limbs[i] + carry if i < len(limbs) else carry
            out[i], carry = here & ((1 << bits) - 1), here >> bits
        return out, carry

    def rounded(*columns: pd.Series) -> pd.Series:
        limbs = np.stack([c.to_numpy(np.int64) for c in columns[1 if mean else 0 :]])
        found, carry = digits(limbs)
        negative = carry < 0
        if negative.any():
            found[:, negative], _ = digits(-limbs[:, negative])
        # Three digits of zero below the lowest, so that there always are two below the leading one, and what lies below those.
        found = np.concatenate([np.zeros((3, found.shape[1]), np.int64), found])
        some, rows = found != 0, np.arange(found.shape[1])
        top = np.where(some.any(axis=0), len(found) - 1 - some[::-1].argmax(axis=0), 3)
        more = np.logical_or.accumulate(some, axis=0)[top - 3, rows]
        high, low = found[top, rows], (found[top - 1, rows] << bits) + found[top - 2, rows]
        # 61 or 62 leading bits, the last of which also stands for all that follow, so that the cast is the only rounding.
        shift = np.maximum(np.frexp(high.astype(np.float64))[1].astype(np.int64) - 2, 0)
        more |= low & ((np.int64(1) << shift) - 1) != 0
        value = ((high << (2 * bits - shift)) + (low >> shift) | more).astype(np.float64)
        if mean:
            value /= np.maximum(columns[0].to_numpy(np.float64), 1.0)
        with np.errstate(over="ignore", under="ignore"):
            value = np.ldexp(value, shift + bits * (first_place + top - 5))
        return pd.Series(np.where(negative, -value, value))

    return F.pandas_udf(rounded, "double")


def finish_sum(limbs: list[str], places: range, mark: str, count: str | None = None) -> Column:
    """The sum, or the average over ``count`` rows; all arguments are column names. Zero is never negative.

    Whole columns of limbs are rounded at a time: limb by limb, expressions took longer than the windows did."""
    given = [F.expr(f"coalesce({c}, 0L)") for c in ([] if count is None else [count]) + limbs]
    value = _rounding(places.start, count is not None)(*given)
    both, marks = _POSITIVE | _NEGATIVE, F.expr(mark)
    return (
        F.when(F.expr(f"{limbs[0]} IS NULL"), F.lit(None).cast("double"))
        .when((marks.bitwiseAND(_NAN) != 0) | (marks.bitwiseAND(both) == both), F.lit(math.nan))
        .when(marks.bitwiseAND(_POSITIVE) != 0, F.lit(math.inf))
        .when(marks.bitwiseAND(_NEGATIVE) != 0, F.lit(-math.inf))
        .otherwise(value)
    )


def finish_variance(count: str, sums: list[str], squares: list[str], places: range, mark: str, lost: int) -> Column:
    """``(n * sum of squares - square of the sum) / (n * (n - lost))``: the difference is exact and rounded once, so no digits cancel.

    ``sums`` and ``squares`` are limbs of HALF_BITS bits; those of the squares begin at twice the place of the others. All
    arguments are column names.
    """
    length = len(sums) + 4  # four more for what a sum carries beyond the highest place
    size = 2 * length
    exact = "DECIMAL(19,0)"
    product = (
        f"aggregate(sequence(greatest(m - {length - 1}, 0), least(m, {length - 1})), {_ZERO}, "
        f"(done, i) -> CAST(done + CAST(get(total, i) AS {exact}) * CAST(get(total, m - i) AS {exact}) AS {_WIDE}))"
    )
    spread = f"transform(squares, (square, m) -> CAST(CAST(square AS {exact}) * CAST({count} AS {exact}) - IF(m < {size - 1}, {product}, {_ZERO}) AS {_WIDE}))"
    # Two limbs make one of BITS bits, from twice the lowest place of HALF_BITS on.
    paired = f"concat(transform(sequence(0, {length - 1}), j -> CAST(get(spread, 2 * j) + get(spread, 2 * j + 1) * {2**HALF_BITS}BD AS {_WIDE})), array({_ZERO}, {_ZERO}))"
    below = f"(CAST({count} AS DOUBLE) * (CAST({count} AS DOUBLE) - {float(lost)}D))"
    value = _rounded(paired, length + 2, places.start, below)
    value = _let("total", _signed(_array(sums, length), HALF_BITS) + ".digits", _let("squares", _normal(_array(squares, size), HALF_BITS) + ".digits", _let("spread", spread, value)))
    return F.expr(f"CASE WHEN {count} > {lost} THEN IF({mark} <> 0, double('NaN'), {value}) END")
