"""Exact rolling distinct counts against counting by hand, and what the plan holds in one group."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollfeat.operators import distinct
from rollfeat.operators.rolling import RollingBlock, rolling_columns, with_rolling

START = datetime(2024, 1, 1)
SCHEMA = "id long, k string, tx_ts timestamp_ntz, v double, w string"


def made_rows(n=700):
    """One key with two thirds of all rows, keys and values that are NULL, rows without a time, seconds that repeat."""
    rows = []
    for i in range(n):
        key = None if i % 23 == 0 else "hot" if i % 3 else f"k{i % 4}"
        place = (i * 7919) % 900_000
        at = None if i % 41 == 0 else START + timedelta(seconds=place - place % 60, microseconds=i)
        rows.append((i, key, at, None if i % 17 == 0 else float(i * i % 13), f"w{i * 31 % 57}"))
    return rows


def by_hand(rows, column, seconds, last_offset):
    place = {"v": 3, "w": 4}[column]
    second = {r[0]: None if r[2] is None else int((r[2] - START).total_seconds() // 1) for r in rows}
    out = {}
    for r in rows:
        t = second[r[0]]
        peers = [q for q in rows if q[1] == r[1] and (second[q[0]] is None) == (t is None)]
        frame = peers if t is None else [q for q in peers if t - seconds <= second[q[0]] <= t + last_offset]
        out[r[0]] = len({q[place] for q in frame if q[place] is not None})
    return out


@pytest.mark.parametrize("exclude", [True, False])
@pytest.mark.parametrize("span", [distinct.SPAN_SECONDS, 7_200])
def test_equal_to_counting_by_hand(spark, monkeypatch, exclude, span):
    monkeypatch.setattr(distinct, "SPAN_SECONDS", span)
    rows = made_rows()
    block = RollingBlock(["count_distinct", "count"], ["v", "w"], ["k"], ["60s", "1h", "36h", "9d"], exclude_current_row=exclude)
    out = with_rolling(spark.createDataFrame(rows, SCHEMA), [block])
    assert out.columns == ["id", "k", "tx_ts", "v", "w", *[f.name for f in block.features()]]
    got = out.collect()
    assert len(got) == len(rows)
    for f in block.features():
        if f.aggregation == "count_distinct":
            want = by_hand(rows, f.column, f.seconds, block.last_offset)
            assert {r.id: r[f.name] for r in got} == want, f.name


def test_keep_limits_rows_but_not_frames(spark):
    rows = made_rows(300)
    block = RollingBlock(["COUNT_DISTINCT"], ["w"], ["k"], ["2d"])
    out = with_rolling(spark.createDataFrame(rows, SCHEMA), [block], keep=F.col("id") % 5 == 0).collect()
    want = by_hand(rows, "w", 2 * 86_400, -1)
    assert {r.id: r["count_distinct_w_by_k_2d_1s"] for r in out} == {i: n for i, n in want.items() if i % 5 == 0}


def test_empty_tables_and_several_blocks(spark):
    blocks = [RollingBlock(["count_distinct"], ["w"], [k], ["1h"]) for k in ("k", "v")]
    empty = with_rolling(spark.createDataFrame([], SCHEMA), blocks)
    assert empty.columns[-2:] == ["count_distinct_w_by_k_1h_1s", "count_distinct_w_by_v_1h_1s"] and empty.isEmpty()


def test_no_window_holds_a_whole_key(spark):
    block = RollingBlock(["count_distinct"], ["w"], ["k"], ["1h"])
    plan = with_rolling(spark.createDataFrame(made_rows(50), SCHEMA), [block])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Whole keys are windowed over totals of chunks and edges of spans only, and both come out of an aggregate.
    assert windows and all("__chunk" in w or "__span" in w for w in windows)


def test_as_a_plain_expression_it_is_refused(spark):
    df = spark.createDataFrame(made_rows(5), SCHEMA)
    with pytest.raises(ValueError, match="with_rolling"):
        rolling_columns(df, RollingBlock(["count_distinct"], ["w"], ["k"], ["1h"]))
