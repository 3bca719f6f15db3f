"""Finding keys too dense for one task, with a bound on what reaches the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# At most this many keys are ever listed on the driver and broadcast. With more, hot keys stay a distributed table.
MAX_LISTED_KEYS = 10_000


@dataclass(frozen=True)
class Limits:
    """What one task may be given.

    A window over a key re-reads the rows in its frame for every row, which makes ``rows * rows per look-back`` steps.
    """

    rows_per_span: int = 300  # beyond it a window over the key stops paying off
    rows_per_key: int = 1_000_000  # beyond it a key never goes to one task
    small_steps_per_key: int = 5_000_000  # dense keys are left alone while no key and
    small_steps: int = 150_000_000  # no table costs more than this
    listed_keys: int = MAX_LISTED_KEYS


@dataclass(frozen=True)
class HotKeys:
    """Key columns with ``n`` (rows) and ``peak`` (most rows in one span). ``listed``: known to be a short local list."""

    frame: DataFrame
    listed: bool
    peak: int  # of all keys

    def keys(self, names: list[str], prefix: str) -> DataFrame:
        """The keys under prefixed names; broadcast if their number was checked, left to the optimizer if not."""
        frame = self.frame.select(*[F.col(n).alias(prefix + n) for n in names])
        return F.broadcast(frame) if self.listed else frame


def find_hot_keys(df: DataFrame, keys: list[str], seconds: str, span_seconds: int, limits: Limits) -> HotKeys | None:
    """The keys that should not be windowed whole, or None.

    Rows are counted per key and span of ``span_seconds`` (the longest look-back), so a key that is quiet but for one
    burst is found too. It is one pass over the key and time columns, combined before the shuffle: a key with a third
    of all rows costs no more than any other.
    """
    span = F.floor(F.col(seconds) / F.lit(span_seconds)).alias("span")
    per_span = df.groupBy(*keys, span).agg(F.count(F.lit(1)).alias("n"))
    rows = F.col("n").cast("double")
    per_key = per_span.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("n").alias("peak"), F.sum(rows * rows).alias("steps")
    )
    hot = (F.col("n") > limits.rows_per_key) | (F.col("peak") > limits.rows_per_span)
    per_key = per_key.persist()
    try:
        count, most, total, largest, peak = per_key.agg(
            F.count_if(hot), F.max("steps"), F.sum("steps"), F.max("n"), F.max("peak")
        ).first()
        if not count:
            return None
        small = most <= limits.small_steps_per_key and total <= limits.small_steps
        if small and largest <= limits.rows_per_key:
            return None
        found = per_key.where(hot).select(*keys, "n", "peak")
        if count > limits.listed_keys:
            return HotKeys(found, False, peak)
        listed = [tuple(r) for r in found.collect()]
    finally:
        per_key.unpersist()
    counters = [T.StructField(c, T.LongType()) for c in ("n", "peak")]
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys] + counters)
    return HotKeys(df.sparkSession.createDataFrame(listed, schema), True, peak)
