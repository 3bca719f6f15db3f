"""Finding the rows that a table does not hold yet, by whole event dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_date(relation: DataFrame, column: str = "tx_date") -> dt.date | None:
    """The latest event date in a table, or None if it has none. ``column`` may be a date or a timestamp."""
    return relation.agg(F.max(F.to_date(column))).first()[0]


def newer_than(df: DataFrame, column: str, relation: DataFrame, relation_column: str) -> DataFrame:
    """Rows of ``df`` dated after the latest date of ``relation``, as one plan with a scalar subquery.

    As in SQL, an empty ``relation`` lets nothing through. Rows that arrive later for a date already present are
    not picked up here, see :func:`rollfeat.plans.late.load_late`. Where ``column`` is a partition column, only the newer partitions are read.
    """
    latest = relation.select(F.max(_date(relation, relation_column)).alias("latest")).scalar()
    return df.where(_date(df, column) > latest)


def changed_dates(df: DataFrame, relation: DataFrame, column: str, until: dt.date) -> list[dt.date]:
    """Dates up to ``until`` of which the two hold different numbers of rows. Only the date column is read, which for a
    partition column is no column at all; at most one row a date reaches the driver."""
    counts = [d.where(F.col(column) <= F.lit(until)).groupBy(column).agg(F.count(F.lit(1)).alias("n")) for d in (df, relation)]
    joined = counts[0].join(counts[1].withColumnRenamed("n", "stored"), column, "full")
    return sorted(r[0] for r in joined.where(~F.col("n").eqNullSafe(F.col("stored"))).select(column).collect())


def dated(df: DataFrame, column: str, dates: list[dt.date]) -> DataFrame:
    """Rows of the given dates; where the column is a partition column, nothing else is read."""
    return df.where(F.col(column).isin(dates)) if dates else df.where(F.lit(False))


def halo_start(high: dt.date, max_lookback: int) -> dt.date:
    """The first date a window may reach back to from any row dated after ``high``."""
    first_new = dt.datetime.combine(high + dt.timedelta(days=1), dt.time())
    return (first_new - dt.timedelta(seconds=max_lookback)).date()


def _date(df: DataFrame, column: str) -> Column:
    # A bare date column keeps partition pruning possible; a cast around it would not.
    return F.col(column) if dict(df.dtypes)[column] == "date" else F.to_date(column)
