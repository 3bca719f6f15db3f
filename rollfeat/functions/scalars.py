"""Scalar column functions. All of them stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01, rounded down. Timestamps without zone are read in the session zone."""
    return F.unix_seconds(_column(ts).cast("timestamp"))


def event_date(ts: str | Column) -> Column:
    return F.to_date(_column(ts))


def weekday_name(ts: str | Column) -> Column:
    """Full English day name, ``Monday`` to ``Sunday``."""
    return F.date_format(_column(ts), "EEEE")


def abs_mod(x: str | Column, n: int) -> Column:
    """Absolute value of the remainder that keeps the sign of ``x`` (SQL ``MOD``)."""
    return F.abs(_column(x) % F.lit(n))


def text_hash(key: str | Column) -> Column:
    """A 60-bit hash of a string that other SQL engines can compute as well (leading MD5 digits)."""
    return F.conv(F.substring(F.md5(_column(key).cast("string")), 1, 15), 16, 10).cast("bigint")


def fast_hash(key: str | Column) -> Column:
    """A 64-bit hash, cheaper than :func:`text_hash` but particular to Spark."""
    return F.when(_column(key).isNotNull(), F.xxhash64(_column(key)))


def same(left: Column, right: Column) -> Column:
    """Equality in which NULL equals NULL; Spark still plans it as a hash or merge join key."""
    return left.eqNullSafe(right)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
