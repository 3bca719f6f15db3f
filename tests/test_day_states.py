"""Increments from kept states give what a full build gives, and read raw rows for the ends of frames only."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_late_and_batches import START, content, files_of, staged_rows, store, store_staged  # noqa: F401

from rollfeat.operators.rolling import RollingBlock
from rollfeat.plans.daystates import raw_dates, refresh_states, states_table
from rollfeat.plans.feature_table import load_features
from rollfeat.plans.presets import Preset, build_features

MONEY = "decimal(18,2)"
WIDE = Preset(
    "wide",
    (
        RollingBlock(["count", "avg", "stddev", "approx_count_distinct"], ["tx_amount"], ["customer_id"], ["10m", "1h", "1d", "3d", "9d"], exact_type=MONEY),
        RollingBlock(["min", "max"], ["tx_amount"], ["terminal_id", "customer_id"], ["2d", "30h", "7d"], exclude_current_row=False),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["1h"]),
    ),
    created_timestamp=False,
)
HIGH = date(2024, 1, 20)


def until(staged, day):
    return staged.where(F.col("tx_date") <= F.lit(day))


def spoil(spark, table, keep):
    """Dates of a table but those to keep hold no readable rows any more; their footers do, so counts can still be read."""
    for r in spark.table(table).select("tx_date", "_metadata.file_path").distinct().collect():
        if r[0] in keep:
            continue
        path = r[1].removeprefix("file:")
        rows = open(path, "rb").read()
        open(path, "wb").write(b"\0" * 100 + rows[100:])
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_increments_give_what_a_full_build_gives(spark, store):
    target, states, staged = f"{store.database}.f", f"{store.database}.s", store_staged(store, staged_rows(spark))
    # A whole day is missing at the end of the first load, as is one between two increments.
    for day in (HIGH, HIGH + timedelta(days=1), HIGH + timedelta(days=5), date(2024, 2, 1), date(2024, 2, 1)):
        load_features(store, target, until(staged, day), WIDE, states=states)
    assert content(store.read(target)) == content(build_features(staged, WIDE, "direct"))


def test_raw_rows_are_read_for_the_ends_of_frames_only(spark, store):
    preset = Preset("days", WIDE.blocks[:1], created_timestamp=False)
    target, states, staged = f"{store.database}.f", f"{store.database}.s", store_staged(store, staged_rows(spark))
    want = content(build_features(until(staged, HIGH + timedelta(days=1)), preset, "direct"))
    load_features(store, target, until(staged, HIGH), preset, states=states)
    new = HIGH + timedelta(days=1)
    needed = raw_dates(preset.blocks[0], [new])
    assert needed == [new - timedelta(days=b) for b in (9, 3, 1, 0)]
    spoil(spark, f"{store.database}.staged", needed)
    load_features(store, target, until(spark.table(f"{store.database}.staged"), new), preset, states=states)
    assert content(store.read(target)) == want


def test_states_follow_late_rows_and_failed_loads(spark, store):
    target, states, staged = f"{store.database}.f", f"{store.database}.s", store_staged(store, staged_rows(spark))
    late = (F.col("tx_date") == F.lit(date(2024, 1, 18))) & (F.col("terminal_id") == 3)
    load_features(store, target, until(staged, HIGH).where(~late), WIDE, states=states)
    before = files_of(spark, states_table(states, 0))
    with pytest.raises(Exception, match="broken"):
        broken = F.when(F.col("tx_date") > F.lit(HIGH), F.raise_error(F.lit("broken"))).otherwise(F.lit(0)).cast("int")
        load_features(store, target, staged.withColumn("tx_fraud", broken), WIDE, states=states)
    load_features(store, target, staged, WIDE, states=states, late_rows=True)
    assert content(store.read(target)) == content(build_features(staged, WIDE, "direct"))
    after = files_of(spark, states_table(states, 0))
    assert {d for d in before if before[d] != after[d]} == {date(2024, 1, 18)}
    first, last = START.date(), date(2024, 2, 1)
    refresh_states(store, states, staged, WIDE, first, last)
    assert refresh_states(store, states, staged, WIDE, first, last) == [[], [], []]


def test_what_states_refuse(spark, store):
    target, states, staged = f"{store.database}.f", f"{store.database}.s", store_staged(store, staged_rows(spark, 200))
    plain = Preset("plain", (RollingBlock(["avg"], ["tx_amount"], ["customer_id"], ["3d"]),), created_timestamp=False)
    first, last = START.date(), date(2024, 2, 1)
    with pytest.raises(ValueError, match="exact_type"):
        refresh_states(store, states, staged, plain, first, last)
    refresh_states(store, states, staged, plain.summing_in(MONEY), first, last)
    with pytest.raises(ValueError, match="other features"):
        refresh_states(store, states, staged, plain.summing_in("decimal(18,4)"), first, last)
    with pytest.raises(ValueError, match="no rows are staged"):
        refresh_states(store, states, staged.where(F.col("tx_date") != F.lit(HIGH)), plain.summing_in(MONEY), first, last)
    with pytest.raises(ValueError, match="history"):
        load_features(store, target, staged, plain, history="delta", states=states)


def test_an_empty_increment(spark, store):
    target, states, staged = f"{store.database}.f", f"{store.database}.s", store_staged(store, staged_rows(spark, 200))
    for rows in (staged.limit(0), staged, staged):
        load_features(store, target, rows, WIDE, states=states)
    assert content(store.read(target)) == content(build_features(staged, WIDE, "direct"))
