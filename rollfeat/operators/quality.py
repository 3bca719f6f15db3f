"""Data checks. Each returns the failing rows; a report counts them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.functions.durations import parse_duration
from rollfeat.functions.scalars import epoch_seconds


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often. NULL is not a value. Counts combine before the shuffle."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def freshness(df: DataFrame, timestamp: str, now: Column, warn_after: str = "24h", error_after: str = "30h") -> DataFrame:
    """One row: the latest event time, its age in seconds, and ``pass``, ``warn`` or ``error``."""
    age = epoch_seconds(now) - epoch_seconds("latest")
    status = (
        F.when(age.isNull() | (age > parse_duration(error_after)), "error")
        .when(age > parse_duration(warn_after), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(timestamp).alias("latest")).select("latest", age.alias("age_seconds"), status.alias("status"))


@dataclass(frozen=True)
class NotNull:
    """A check for :func:`report`: rows whose column is NULL."""

    frame: DataFrame
    column: str


@dataclass(frozen=True)
class Unique:
    """A check for :func:`report`: values that occur more than once. NULL is not a value."""

    frame: DataFrame
    column: str


def report(checks: Mapping[str, DataFrame | NotNull | Unique]) -> DataFrame:
    """One row per check: its name, the number of failing rows, and ``pass`` or ``fail``.

    A check is a frame of failing rows, :class:`NotNull` or :class:`Unique`. All of the latter two on one frame are counted together,
    in one scan and at most one shuffle of it.
    """
    parts, by_frame = [], {}
    for name, check in checks.items():
        if isinstance(check, DataFrame):
            parts.append(check.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures"))
        else:
            by_frame.setdefault(id(check.frame), []).append((name, check))
    parts += [_counted_together(own) for own in by_frame.values()]
    counted = reduce(DataFrame.unionByName, parts)
    return counted.select("check_name", "failures", F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def _counted_together(own: list[tuple[str, NotNull | Unique]]) -> DataFrame:
    """Failures of checks on one frame. A row becomes one row for each column that must be unique, the first of which tells its NULLs;
    these combine before the shuffle, so values that are frequent, NULL among them, are a row per task."""
    frame = own[0][1].frame
    uniques = {i: c.column for i, (_, c) in enumerate(own) if isinstance(c, Unique)}
    nulls = {i: F.col(c.column).isNull().cast("int") for i, (_, c) in enumerate(own) if isinstance(c, NotNull)}
    copies = [
        F.struct(
            F.lit(u).alias("__unique"),
            *[F.when(F.lit(u == i), F.col(column)).alias(f"__key_{i}") for i, column in uniques.items()],
            *[(is_null if u == min(uniques) else F.lit(0)).alias(f"__{i}") for i, is_null in nulls.items()],
        )
        for u in uniques
    ]
    if copies:
        keys = ["__unique", *[f"__key_{i}" for i in uniques]]
        rows = frame.select(F.inline(F.array(*copies)))
        rows = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(f"__{i}").alias(f"__{i}") for i in nulls])
    else:
        rows = frame.select(*[is_null.alias(f"__{i}") for i, is_null in nulls.items()])
    repeated = {i: (F.col("__unique") == i) & F.col(f"__key_{i}").isNotNull() & (F.col("__n") > 1) for i in uniques}
    found = rows.agg(
        *[F.coalesce(F.sum(f"__{i}"), F.lit(0)).alias(f"__{i}") for i in nulls], *[F.count_if(r).alias(f"__{i}") for i, r in repeated.items()]
    )
    entries = [F.struct(F.lit(name).alias("check_name"), F.col(f"__{i}").cast("bigint").alias("failures")) for i, (name, _) in enumerate(own)]
    return found.select(F.inline(F.array(*entries)))


class ChecksFailed(AssertionError):
    pass


def assert_all(checks: Mapping[str, DataFrame | NotNull | Unique]) -> None:
    failed = report(checks).where(F.col("failures") > 0).collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.check_name}: {r.failures} failing rows" for r in failed))
