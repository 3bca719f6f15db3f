"""Rolling windows: edge rows by hand, and every plan against a brute-force reading of the definition."""

import math
import random
import re
import statistics
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from fractions import Fraction

import duckdb
import pandas
import pytest
from pyspark.sql import functions as F

from rollfeat.functions.aggregates import AGGREGATES
from rollfeat.functions.durations import parse_duration
from rollfeat.operators import chunked
from rollfeat.operators.chunked import CHUNK_SECONDS, SHORT_SECONDS, plan_grids
from rollfeat.operators.hotkeys import Limits, find_hot_keys
from rollfeat.operators.rolling import BoundBlock, RollingBlock, key_columns, keyed_rows, rolling_columns, with_rolling

# Small enough for the test data to be routed key by key.
EAGER = Limits(rows_per_span=60, small_steps=0)
EPOCH = datetime(1970, 1, 1)
SCHEMA = "id bigint, k bigint, k2 string, tx_ts timestamp_ntz, v decimal(12,2), w double"


def random_rows(n, keys, span_days, seed, start=datetime(2024, 1, 1)):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice([None, *range(keys)]) if rng.random() < 0.7 else 0
        at = start + timedelta(seconds=rng.randrange(span_days * 86400), milliseconds=rng.choice([0, 250, 999]))
        if rng.random() < 0.2 and rows:
            at = rows[-1][3]
        if rng.random() < 0.03:
            at = None
        value = None if rng.random() < 0.05 else Decimal(rng.randrange(-5000, 50000)) / 100
        rows.append((i, key, rng.choice(["x", "y"]), at, value, None if value is None else float(value)))
    return rows


def second_of(at):
    return None if at is None else math.floor((at - EPOCH) / timedelta(seconds=1))


def brute_force(rows, block):
    names = ["id", "k", "k2", "tx_ts", "v", "w"]
    table = [dict(zip(names, r)) for r in rows]
    out = {}
    for row in table:
        key = tuple(row[p] for p in block.partition)
        at = second_of(row["tx_ts"])
        peers = [r for r in table if tuple(r[p] for p in block.partition) == key]
        for f in block.features():
            if at is None:
                frame = [r for r in peers if r["tx_ts"] is None]
            else:
                last = at + block.last_offset
                frame = [r for r in peers if r["tx_ts"] is not None and at - f.seconds <= second_of(r["tx_ts"]) <= last]
            values = [r[f.column] for r in frame if r[f.column] is not None]
            out[row["id"], f.name] = expected(f.aggregation, values)
    return out


def expected(aggregation, values):
    if aggregation == "count":
        return len(values)
    if aggregation == "approx_count_distinct":
        return len(set(values))
    if not values or (len(values) < 2 and aggregation in ("stddev", "var_samp")):
        return None
    return float(
        {
            "avg": lambda: sum(values) / len(values),
            "sum": lambda: sum(values),
            "min": lambda: min(values),
            "max": lambda: max(values),
            "stddev": lambda: statistics.stdev(values),
            "stddev_pop": lambda: statistics.pstdev(values),
            "var_samp": lambda: statistics.variance(values),
            "var_pop": lambda: statistics.pvariance(values),
        }[aggregation]()
    )


def assert_matches(df, rows, blocks, exact=True):
    got = {(r["id"], f.name): r[f.name] for r in df.collect() for b in blocks for f in b.features()}
    want = {}
    for b in blocks:
        want.update(brute_force(rows, b))
    assert got.keys() == want.keys()
    for key, value in want.items():
        if value is None or got[key] is None or (exact and "std" not in key[1] and "var" not in key[1]):
            assert got[key] == value, key
        else:
            assert got[key] == pytest.approx(value, rel=1e-9, abs=1e-9), key


@pytest.mark.parametrize("text, seconds", [("1s", 1), ("15m", 900), ("2h", 7200), ("28d", 2419200), ("1w", 604800)])
def test_durations(text, seconds):
    assert parse_duration(text) == seconds


@pytest.mark.parametrize("text", ["", "d", "5", "5y", "-1d", "0d", "1.5h", "5 d", "5D", "1h30m"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        parse_duration(text)


def test_names_and_order():
    block = RollingBlock(["COUNT", "Avg"], ["TX_Amount", "fee"], ["A", "b"], ["1h", "2d"], exclude_current_row=False)
    assert [f.name for f in block.features()] == [
        "count_tx_amount_by_a_b_1h_0s",
        "count_tx_amount_by_a_b_2d_0s",
        "avg_tx_amount_by_a_b_1h_0s",
        "avg_tx_amount_by_a_b_2d_0s",
        "count_fee_by_a_b_1h_0s",
        "count_fee_by_a_b_2d_0s",
        "avg_fee_by_a_b_1h_0s",
        "avg_fee_by_a_b_2d_0s",
    ]


def test_unknown_aggregate_is_refused():
    with pytest.raises(ValueError, match="unknown aggregate"):
        RollingBlock(["count(*) -- "], ["v"], ["k"], ["1h"])


def test_moments_over_too_many_magnitudes_need_an_exact_type(spark):
    df = spark.createDataFrame([(1, 1, "x", None, None, 1e-200), (2, 1, "x", None, None, 1e200)], SCHEMA)
    with pytest.raises(ValueError, match="exact_type"):
        rolling_columns(df, RollingBlock(["stddev"], ["w"], ["k"], ["1h"]))


def test_duplicate_feature_names_are_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="more than once"):
        with_rolling(df, [RollingBlock(["count"], ["v"], ["k"], ["1h"])] * 2)


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
@pytest.mark.parametrize(
    "exclude, want",
    [
        (True, {0: (2, 2.5, 3.0), 1: (2, 2.5, 3.0), 2: (0, None, None), 3: (0, None, None), 4: (0, None, None),
                5: (2, 4.5, 5.0), 6: (0, None, None), 7: (1, 6.0, 6.0)}),
        (False, {0: (2, 2.5, 3.0), 1: (2, 2.5, 3.0), 2: (1, 1.0, 1.0), 3: (2, 4.5, 5.0), 4: (2, 4.5, 5.0),
                 5: (2, 4.5, 5.0), 6: (1, 6.0, 6.0), 7: (2, 6.5, 7.0)}),
    ],
)
def test_edge_rows(spark, strategy, exclude, want):
    def at(second, micro):
        return datetime(2024, 1, 1, 0, 0, second, micro)

    rows = [
        (0, 1, None, 2.0),
        (1, 1, None, 3.0),
        (2, 1, datetime(1969, 12, 31, 23, 59, 59, 500000), 1.0),
        (3, 1, at(0, 100000), 4.0),
        (4, 1, at(0, 900000), 5.0),
        (5, 1, at(1, 200000), None),
        (6, None, at(1, 200000), 6.0),
        (7, None, at(2, 200000), 7.0),
    ]
    df = spark.createDataFrame(rows, "id int, k int, tx_ts timestamp_ntz, v double")
    end = "1s" if exclude else "0s"
    for lookback in ("3600s", "2h"):
        block = RollingBlock(["count", "avg", "max"], ["v"], ["k"], [lookback], exclude_current_row=exclude)
        out = with_rolling(df, [block], strategy)
        got = {r["id"]: tuple(r[f"{a}_v_by_k_{lookback}_{end}"] for a in ("count", "avg", "max")) for r in out.collect()}
        assert got == want


@pytest.mark.parametrize("strategy", ["direct", "chunked", "auto"])
@pytest.mark.parametrize("exclude", [True, False])
def test_against_brute_force(spark, strategy, exclude):
    rows = random_rows(260, 3, 12, seed=7)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = [
        RollingBlock(["count", "avg", "min", "stddev", "var_pop"], ["v"], ["k"], ["1h", "1d", "36h", "5d", "1w"], exclude_current_row=exclude),
        RollingBlock(["max", "sum"], ["w", "v"], ["k2", "k"], ["2m", "10m", "50m", "2d", "100001s"], exclude_current_row=exclude, exact_type="decimal(18,2)"),
    ]
    assert_matches(with_rolling(df, blocks, strategy, limits=EAGER), rows, blocks, exact=False)


def test_exact_type_makes_double_sums_exact(spark):
    rows = random_rows(300, 2, 10, seed=11)
    df = spark.createDataFrame(rows, SCHEMA)
    block = RollingBlock(["sum", "avg", "stddev"], ["w"], ["k"], ["1h", "3d"], exact_type="decimal(18,2)")
    decimals = RollingBlock(["sum", "avg", "stddev"], ["v"], ["k"], ["1h", "3d"])
    exact = with_rolling(df, [decimals], "direct").select("id", *[f.name for f in decimals.features()])
    for strategy in ("direct", "chunked"):
        doubles = with_rolling(df, [block], strategy).select("id", *[f.name for f in block.features()])
        assert {tuple(r) for r in doubles.collect()} == {tuple(r) for r in exact.collect()}


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_distinct_counts_from_sketches(spark, strategy):
    rows = random_rows(200, 2, 4, seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = [RollingBlock(["approx_count_distinct"], ["v"], ["k"], ["30m", "1d"])]
    got = {(r["id"], f.name): r[f.name] for r in with_rolling(df, blocks, strategy).collect() for f in blocks[0].features()}
    for key, value in brute_force(rows, blocks[0]).items():
        assert got[key] == pytest.approx(value, rel=0.05, abs=0.5), key


def test_more_hot_keys_than_may_be_listed(spark):
    rows = random_rows(300, 6, 5, seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = [RollingBlock(["count", "max"], ["v"], ["k"], ["1h", "2d"])]
    limits = Limits(rows_per_span=10, small_steps=0, listed_keys=2)
    hot = find_hot_keys(df.withColumn("s", F.unix_seconds(F.col("tx_ts").cast("timestamp"))), ["k"], "s", 172800, limits)
    assert not hot.listed and 2 < hot.frame.count() < 8
    assert_matches(with_rolling(df, blocks, "auto", limits=limits), rows, blocks)


@pytest.mark.parametrize("strategy", ["direct", "chunked", "auto"])
def test_keep_limits_output_not_frames(spark, strategy):
    rows = random_rows(300, 2, 10, seed=13)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = [RollingBlock(["count", "min"], ["v"], ["k"], ["1h", "4d"]), RollingBlock(["max"], ["v"], ["k2"], ["3d"])]
    cutoff = F.lit(datetime(2024, 1, 6)).cast("timestamp_ntz")
    kept = with_rolling(df, blocks, strategy, keep=F.col("tx_ts") >= cutoff, limits=EAGER)
    full = with_rolling(df, blocks, "direct").where(F.col("tx_ts") >= cutoff)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, full.collect()))


def test_duplicate_rows_stay(spark):
    rows = random_rows(60, 2, 3, seed=17)
    df = spark.createDataFrame(rows + rows, SCHEMA)
    blocks = [RollingBlock(["count", "avg"], ["v"], ["k"], ["1h", "1d"])]
    direct = sorted(map(repr, with_rolling(df, blocks, "direct").collect()))
    assert direct == sorted(map(repr, with_rolling(df, blocks, "chunked").collect()))
    assert len(direct) == 120


def test_one_second_holding_a_third_of_all_rows(spark):
    """A burst collapses to one state row before the windows, and all its rows get the answer back."""
    burst = spark.range(20_000).select(F.lit(0).alias("k"), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("tx_ts"), F.lit(1.0).alias("v"))
    rest = spark.range(40_000).select((F.col("id") % 50).cast("int"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") * 5)).cast("timestamp_ntz"), F.lit(2.0))
    df = burst.union(rest)
    block = RollingBlock(["count"], ["v"], ["k"], ["1h", "2d"], exclude_current_row=False)
    out = with_rolling(df, [block], limits=EAGER)
    row = out.where("v = 1.0").agg(F.count("*"), F.min("count_v_by_k_2d_0s"), F.max("count_v_by_k_2d_0s")).first()
    before = 86400 // 250 + 1  # rows of key 0 on the first day, the one at midnight included
    assert tuple(row) == (20_000, 20_000 + before, 20_000 + before)


@pytest.mark.parametrize("lookback", ["100003m", "86401s", "7919h", "3d", "259201s"])
def test_any_lookback_in_chunks(spark, lookback):
    df = spark.createDataFrame(random_rows(300, 2, 700, seed=31), SCHEMA)
    blocks = [RollingBlock(["count", "sum", "min", "stddev", "approx_count_distinct"], ["v"], ["k"], [lookback, "28d"])]
    assert sorted(map(repr, with_rolling(df, blocks, "direct").collect())) == sorted(map(repr, with_rolling(df, blocks, "chunked").collect()))


def test_every_plan_gives_the_same_answer(spark):
    """Thousands of distinct values, one dense key: direct, chunked and mixed, bit for bit, on every aggregate."""
    rows = spark.range(6_000).select(
        "id",
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 40).alias("k"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id") * 90)).cast("timestamp_ntz").alias("tx_ts"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e6).alias("w"),
        (F.col("id") * 7919 + 3_000_000_000_000_000_000).alias("big"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7.0).alias("plain"),
    )
    names = [a for a in AGGREGATES if a not in ("stddev", "variance")]
    blocks = [
        RollingBlock(names, ["w"], ["k"], ["1h", "1d", "2d"], exact_type="decimal(24,6)"),
        RollingBlock(["stddev", "var_pop", "sum", "approx_count_distinct"], ["big"], ["k"], ["2d"]),
        RollingBlock(["avg", "sum", "stddev"], ["plain"], ["k"], ["1h", "2d"]),
    ]
    direct = sorted(map(repr, with_rolling(rows, blocks, "direct").collect()))
    assert direct == sorted(map(repr, with_rolling(rows, blocks, "chunked").collect()))
    assert direct == sorted(map(repr, with_rolling(rows, blocks, limits=Limits(rows_per_span=500, small_steps=0, small_steps_per_key=0)).collect()))


def test_moments_of_large_numbers(spark):
    start = 3 * 10**18
    rows = [(i, 0, datetime(2024, 1, 1, 0, 0, i), start + (i * i) % 17) for i in range(60)] + [(100 + i, 1, datetime(2024, 1, 1, 0, 0, i), (-1) ** i * (start + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k long, tx_ts timestamp_ntz, v long")
    got = {r["id"]: r[-1] for r in with_rolling(df, [RollingBlock(["var_samp"], ["v"], ["k"], ["1m"])], "chunked").collect()}
    for first in (0, 100):
        values = [v for i, _, _, v in rows if first <= i < first + 59]
        assert got[first + 59] == pytest.approx(float(statistics.variance([Fraction(v) for v in values])), rel=1e-12)


def magnitudes(n, kind, seed=3):
    rng = random.Random(seed)
    pick = {
        "all": lambda: rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1000, 1000),
        "denormal": lambda: rng.choice([-1, 1]) * rng.randint(0, 2**20) * 5e-324,
        "money": lambda: round(rng.uniform(-1e6, 1e6), 2),
        "near the largest": lambda: rng.choice([-1, 1]) * rng.random() * 1.7e308,
        "shifted": lambda: rng.random() * 2.0 ** rng.randint(-10, 10) + 1e6,
    }[kind]
    return [None if rng.random() < 0.05 else pick() for _ in range(n)]


def nearest(x):
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


@pytest.mark.parametrize("strategy", ["direct", "chunked", "auto"])
@pytest.mark.parametrize("kind", ["all", "denormal", "money", "near the largest", "shifted"])
def test_doubles_are_summed_exactly(spark, kind, strategy):
    """Every sum is the double next to the exact sum, also where most of it cancels, and moments lose no digits."""
    values = magnitudes(120, kind)
    values += [None if v is None else -v for v in values[:60]] + [0.0, -0.0]
    rows = [(i, i % 2, "x", EPOCH + timedelta(seconds=97 * i), None, v) for i, v in enumerate(values)]
    moments = kind != "all"
    block = RollingBlock(["avg", "sum", "count", *(["var_samp", "var_pop"] if moments else [])], ["w"], ["k"], ["1h", "2d"], exclude_current_row=False)
    got = {r["id"]: r for r in with_rolling(spark.createDataFrame(rows, SCHEMA), [block], strategy, limits=EAGER).collect()}
    for i, k, _, at, _, _ in rows:
        for name, seconds in (("1h", 3600), ("2d", 172800)):
            frame = [Fraction(w) for _, k2, _, at2, _, w in rows if k2 == k and w is not None and timedelta() <= at - at2 <= timedelta(seconds=seconds)]
            n, total = len(frame), sum(frame)
            cell = lambda a: got[i][f"{a}_w_by_k_{name}_0s"]
            assert cell("count") == n
            assert cell("sum") == (nearest(total) if n else None)
            assert n == 0 or cell("avg") == nearest(total) / n or math.isinf(nearest(total))
            if moments and n > 1 and kind != "near the largest":
                spread = nearest(n * sum(v * v for v in frame) - total * total)
                assert (cell("var_samp"), cell("var_pop")) == (spread / (n * (n - 1)), spread / (n * n))


@pytest.mark.parametrize("values,want", [
    ([1.0, float("nan")], "nan"), ([float("inf"), 1.0], "inf"), ([float("-inf"), 1e308], "-inf"),
    ([float("inf"), float("-inf")], "nan"), ([1e308, 1e308], "inf"), ([-0.0], "0.0"), ([None, None], "None"), ([None, 2.5], "2.5"),
])
def test_sums_of_special_doubles(spark, values, want):
    rows = [(i, 1, "x", EPOCH, None, v) for i, v in enumerate(values)]
    block = RollingBlock(["sum", "stddev"], ["w"], ["k"], ["1h"], exclude_current_row=False)
    for strategy in ("direct", "chunked"):
        row = with_rolling(spark.createDataFrame(rows, SCHEMA), [block], strategy).first()
        assert str(row["sum_w_by_k_1h_0s"]) == want
        if any(v is not None and not math.isfinite(v) for v in values):
            assert math.isnan(row["stddev_w_by_k_1h_0s"])


def test_sums_of_doubles_are_cheap_states(spark):
    """Limbs are whole numbers of 64 bits, rounding them takes no expression for each limb, and rows with many of them go to more tasks."""
    rows = [(i, 1, "x", EPOCH + timedelta(seconds=i), None, w) for i, w in enumerate((1e-300, 1e300, -1e300, 3.0))]
    df = spark.createDataFrame(rows, SCHEMA)
    block = RollingBlock(["avg", "sum"], ["w"], ["k"], ["1h"], exclude_current_row=False)
    bound = BoundBlock(block, df)
    seconds = chunked.per_second(keyed_rows(df, block, None), key_columns(block), bound)
    limbs = [s.name for s in bound.states if s.state.startswith("half")]
    assert len(limbs) > 60 and {seconds.schema[n].dataType.simpleString() for n in limbs} == {"bigint"}
    plan = with_rolling(df, [block], "direct")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    assert chunked.n_tasks(df, 10**8, 8) == chunked.n_tasks(df, 10**8, 1) < chunked.n_tasks(df, 10**8, len(limbs))
    got = {r["id"]: (r["sum_w_by_k_1h_0s"], r["avg_w_by_k_1h_0s"]) for r in with_rolling(df, [block], "direct").collect()}
    assert got == {0: (1e-300, 1e-300), 1: (1e300, 5e299), 2: (1e-300, 1e-300 / 3), 3: (3.0, 0.75)}


def test_averages_do_not_overflow(spark):
    rows = [(i, 1, "x", EPOCH, None, 1.5e308) for i in range(3)]
    block = RollingBlock(["avg"], ["w"], ["k"], ["1h"], exclude_current_row=False)
    assert with_rolling(spark.createDataFrame(rows, SCHEMA), [block]).first()["avg_w_by_k_1h_0s"] == 1.5e308


def test_moments_agree_with_another_engine(spark):
    """DuckDB's own functions, within what its floating-point steps allow."""
    rows = [(i, i % 3, "x", EPOCH + timedelta(seconds=500 * i), None, v) for i, v in enumerate(magnitudes(200, "shifted"))]
    block = RollingBlock(["stddev", "var_pop"], ["w"], ["k"], ["1d"])
    got = {r["id"]: (r[-2], r[-1]) for r in with_rolling(spark.createDataFrame(rows, SCHEMA), [block]).collect()}
    frame = pandas.DataFrame([(i, k, 500 * i, w) for i, k, _, _, _, w in rows], columns=["id", "k", "s", "w"])
    over = "OVER (PARTITION BY k ORDER BY s RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)"
    for i, stddev, var_pop in duckdb.sql(f"SELECT id, stddev(w) {over}, var_pop(w) {over} FROM (SELECT id, k, s, CASE WHEN isnan(w) THEN NULL ELSE w END AS w FROM frame)").fetchall():
        for ours, theirs in zip(got[i], (stddev, var_pop)):
            assert (ours is None) == (theirs is None) and (ours is None or ours == pytest.approx(theirs, rel=1e-6, abs=1e-6)), i


def test_grids_divide_their_lookbacks():
    day = 86400
    (grid,) = plan_grids([3600, 5 * day, 28 * day, 90 * day, 95 * day])
    assert (grid.width, sorted(grid.long), grid.nested) == (day, [5 * day, 28 * day, 90 * day, 95 * day], [3600])
    (grid,) = plan_grids([3600, 5 * day], rows_per_second=0.01)
    assert (grid.nested, grid.sliding) == ([], [3600])
    for lookbacks in ([3601], [5400, 7200], [day + 1, 5 * day], [7919 * 1009], [60], [36 * 3600, 5 * day]):
        grids = plan_grids(lookbacks)
        assert sorted(s for g in grids for s in g.long + g.nested + g.sliding) == sorted(lookbacks)
        for g in grids:
            assert all(g.width % s == 0 for s in g.nested) and SHORT_SECONDS <= g.width <= CHUNK_SECONDS


def test_preset_blocks_share_two_windows(spark):
    df = spark.createDataFrame([], "customer_id long, terminal_id long, tx_ts timestamp_ntz, tx_amount double")
    blocks = [
        RollingBlock(["count", "avg", "min"], ["tx_amount"], ["customer_id"], ["1h", "5d", "28d"], exact_type="decimal(18,2)"),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["1h", "3d"]),
    ]
    plan = with_rolling(df, blocks, "direct")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2


def test_sliding_sums_add_whole_numbers_of_64_bits(spark):
    """Decimals of up to 18 digits, of either sign and with NULLs, beyond what one 64-bit sum holds; longer ones as before."""
    most = Decimal("9999999999999999.99")
    values = [most] * 12 + [-most] * 25 + [None, Decimal("-0.01"), Decimal("0.01"), Decimal("42949672.96"), Decimal("-42949672.97")]
    rows = [(i, 1, EPOCH + timedelta(seconds=i), v, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, k long, tx_ts timestamp_ntz, v decimal(18,2), longer decimal(19,2)")
    block = RollingBlock(["sum", "avg", "count"], ["v", "longer"], ["k"], ["3s", "1h"], exclude_current_row=False)
    for column in rolling_columns(df, block), None:
        got = df.select("*", *column) if column else with_rolling(df, [block], "direct")
        for row in got.collect():
            for seconds, name in ((3, "3s"), (3600, "1h")):
                frame = [v for v in values[max(0, row["id"] - seconds) : row["id"] + 1] if v is not None]
                for c in ("v", "longer"):
                    total = float(sum(frame))
                    assert row[f"sum_{c}_by_k_{name}_0s"] == total and row[f"avg_{c}_by_k_{name}_0s"] == total / len(frame)
    empty = with_rolling(df.where("id = 0"), [RollingBlock(["sum"], ["v"], ["k"], ["1h"])], "direct").first()
    assert empty["sum_v_by_k_1h_1s"] is None
    narrow = with_rolling(df.drop("longer"), [RollingBlock(["avg"], ["v"], ["k"], ["1h"])], "direct")
    window = next(line for line in narrow._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in line)
    assert "sum(_w" in window and "sum(v" not in window


def test_places_are_chosen_in_generated_code(spark):
    """A filter of an array takes a function, which runs outside of generated code."""
    df = spark.createDataFrame(random_rows(50, 2, 40, seed=29), SCHEMA)
    out = with_rolling(df, [RollingBlock(["max"], ["v"], ["k"], ["1m", "3d", "28d"])], "chunked")
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_plan_of_the_chunked_strategy(spark):
    """States are combined before they are shuffled, that shuffle is read twice, and no window sorts a whole key."""
    df = spark.createDataFrame(random_rows(200, 2, 40, seed=23), SCHEMA)
    out = with_rolling(df, [RollingBlock(["count", "max"], ["v"], ["k"], ["1m", "5d", "28d"])], "chunked")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_max" in plan
    windows = [line for line in plan.splitlines() if "+- Window [" in line]
    assert len(windows) == 3
    whole_key = [w for w in windows if re.search(r"windowspecdefinition\(__key_0#\w+, __chunk#\w+ ASC", w)]
    assert len(whole_key) == 1  # over chunk totals, of which there are few
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_a_crowded_second_is_split_when_features_return_to_its_rows(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.range(0, 60_000, numPartitions=8).select(
        "id",
        (F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)).alias("k"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")))).cast("timestamp_ntz").alias("tx_ts"),
        F.lit(1.0).alias("v"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = with_rolling(rows, [RollingBlock(["count"], ["v"], ["k"], ["2d"], exclude_current_row=False)], "chunked")
        assert out.where("id % 3 = 0").agg(F.min("count_v_by_k_2d_0s")).first()[0] >= 20_000
        assert out.collect() and "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("strategy", ["auto", "chunked"])
def test_dense_keys_have_shorter_chunks_and_more_tasks(spark, monkeypatch, strategy):
    rows = random_rows(300, 2, 12, seed=51)
    df = spark.createDataFrame(rows, SCHEMA)
    block = RollingBlock(["count", "avg", "max"], ["v"], ["k"], ["1h", "2d", "5d", "100003m"])
    keep = (F.col("tx_ts") >= F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("tx_ts") < F.lit("2024-01-09").cast("timestamp_ntz"))
    want = {r["id"]: r for r in with_rolling(df, [block], "direct", keep).collect()}
    monkeypatch.setattr(chunked, "ROWS_PER_CHUNK", 5)
    monkeypatch.setattr(chunked, "ROWS_PER_TASK", 20)
    got = with_rolling(df, [block], strategy, keep, EAGER)
    plan = got._jdf.queryExecution().toString()
    assert max(int(n) for n in re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", plan)) > spark.sparkContext.defaultParallelism
    assert {r["id"]: r for r in got.collect()} == want and want


def test_chunks_are_no_wider_than_dense_keys_allow(spark):
    keyed = spark.range(5_000).select(F.lit(1).alias("k"), F.col("id").alias("__sec"), (F.col("id") < 10).alias("__keep"))
    extent = chunked.Extent.of(keyed.unionByName(spark.range(1).select(F.lit(2).alias("k"), F.lit(None).cast("bigint").alias("__sec"), F.lit(True).alias("__keep"))), ["k"])
    assert (extent.n_seconds, extent.most_per_day, extent.first_kept, extent.last_kept, extent.widest) == (5_001, 5_000, 0, 9, 86_400)
    assert chunked.Extent(0, 80_000, 0, 9).widest == 3_600
    (grid,) = plan_grids([3_600, 5 * 86_400, 14 * 86_400], widest=21_600)
    assert (grid.width, grid.nested) == (21_600, [3_600])
