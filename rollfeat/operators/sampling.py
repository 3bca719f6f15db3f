"""Reproducible row samples and time splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.functions.scalars import abs_mod, fast_hash, text_hash


def in_sample(key: str, buckets: int = 100, bucket: int = 1, method: str = "text") -> Column:
    """True for about one key in ``buckets``, always the same ones.

    ``method="text"`` hashes so that other engines pick the same rows, ``"fast"`` with Spark's own 64-bit hash.
    """
    hashed = {"text": text_hash, "fast": fast_hash}[method](key)
    return abs_mod(hashed, buckets) == bucket


def hash_sample(df: DataFrame, key: str, buckets: int = 100, bucket: int = 1, method: str = "text") -> DataFrame:
    return df.where(in_sample(key, buckets, bucket, method))


def in_range(df: DataFrame, timestamp: str, start: str, end: str) -> Column:
    """True where ``start <= timestamp < end``."""
    kind = df.schema[timestamp].dataType.simpleString()
    return (F.col(timestamp) >= F.lit(start).cast(kind)) & (F.col(timestamp) < F.lit(end).cast(kind))


def time_range(df: DataFrame, timestamp: str, start: str, end: str, date: str | None = None) -> DataFrame:
    """Rows with ``start <= timestamp < end``. ``date`` names a partition column holding the event date, if there is
    one, so that only the days in question are read."""
    out = df.where(in_range(df, timestamp, start, end))
    if date is not None:
        kind = df.schema[timestamp].dataType.simpleString()
        first, last = (F.to_date(F.lit(bound).cast(kind)) for bound in (start, end))
        out = out.where((F.col(date) >= first) & (F.col(date) <= last))
    return out
