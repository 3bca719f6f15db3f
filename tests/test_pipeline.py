"""Tables, staging, incremental loads, data checks, sampling."""

import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollfeat.operators import quality
from rollfeat.operators.incremental import halo_start, high_date, newer_than
from rollfeat.operators.rolling import RollingBlock
from rollfeat.operators.sampling import hash_sample, time_range
from rollfeat.plans.feature_table import load_features, stage
from rollfeat.plans.presets import PRESET_A, PRESET_B, Preset, build_features, label_transactions
from rollfeat.session import scratch_dir
from rollfeat.sources.tables import Sources, TableStore, copy_labels, copy_profiles, copy_transactions, fetch, typed, typed_query

START = datetime(2024, 1, 1)
SMALL = Preset(
    "small",
    (
        RollingBlock(["count", "avg"], ["tx_amount"], ["customer_id"], ["1h", "2d"], exact_type="decimal(18,2)"),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["5d"]),
    ),
    created_timestamp=True,
)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "tables"))
    made.database = f"t_{uuid.uuid4().hex}"
    made.create_database(made.database)
    return made


def transactions(spark, n=400, days=20):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("tx_id"),
        (F.lit(START).cast("timestamp") + F.make_interval(secs=F.pmod(F.col("id") * 48611, F.lit(days * 86400)))).cast("timestamp_ntz").alias("tx_ts"),
        (F.col("id") % 4).alias("customer_id"),
        (F.col("id") % 3).alias("terminal_id"),
        ((F.col("id") * 37 % 500) / 4).alias("tx_amount"),
    )
    return rows


def labels(spark):
    return spark.createDataFrame([(str(i), i % 2) for i in range(0, 400, 3)], "tx_id string, tx_fraud int")


def content(df, drop=("created_timestamp",)):
    kept = sorted(c for c in df.columns if c not in drop)
    return sorted(map(repr, df.select(*kept).collect()))


def test_presets_have_the_documented_features():
    assert len(PRESET_A.feature_names) == 20 and len(PRESET_B.feature_names) == 17
    assert PRESET_A.feature_names[0] == "count_tx_amount_by_customer_id_1h_1s"
    assert PRESET_A.feature_names[-1] == "max_tx_amount_by_terminal_id_175d_1s"


def test_copies_happen_once(spark, store):
    tx, table = transactions(spark), f"{store.database}.tx"
    assert copy_transactions(store, table, tx)
    before = content(store.read(table))
    assert not copy_transactions(store, table, tx.limit(3))
    assert content(store.read(table)) == before
    assert copy_labels(store, f"{store.database}.txlabels", labels(spark).withColumn("more", F.lit(1)))
    assert store.read(f"{store.database}.txlabels").columns == ["tx_id", "tx_fraud"]
    assert copy_profiles(store, f"{store.database}.customers", tx) and not copy_profiles(store, f"{store.database}.customers", tx)
    store.create_database(store.database)  # creating it again is fine


def test_sources(spark, store):
    copy_labels(store, f"{store.database}.txlabels", labels(spark))
    sources = Sources(spark, {"txlabels": f"{store.database}.txlabels"})
    assert sources.load("txlabels").count() == labels(spark).count()
    with pytest.raises(KeyError, match="not declared"):
        sources.load("tx")


def test_overwrite_replaces_and_append_matches_by_name(spark, store):
    table = f"{store.database}.t"
    store.overwrite(table, spark.createDataFrame([(1, "a")], "x int, y string"))
    store.overwrite(table, spark.createDataFrame([(2, "b")], "x int, y string"))
    store.append(table, spark.createDataFrame([("c", 3)], "y string, x int"))
    assert sorted(map(tuple, store.read(table).collect())) == [(2, "b"), (3, "c")]


def test_staging_keeps_unlabelled_rows_and_repeats_for_several_labels(spark):
    tx = transactions(spark, 4).withColumnRenamed("tx_id", "TX_ID")
    many = spark.createDataFrame([("0", 1), ("0", 0), ("2", 1), ("9", 1), (None, 1)], "tx_id string, tx_fraud int")
    got = sorted((r["tx_id"], r["tx_fraud"]) for r in label_transactions(tx, many).fillna(-1, ["tx_fraud"]).collect())
    assert got == [("0", 0), ("0", 1), ("1", -1), ("2", 1), ("3", -1)]


def test_created_timestamp_and_weekday(spark):
    staged = label_transactions(transactions(spark, 5), labels(spark))
    stamp = datetime(2024, 5, 1, 12)
    out = build_features(staged, SMALL, created_at=F.lit(stamp).cast("timestamp"))
    assert out.columns[:7] == [*staged.columns, "day_of_the_week"] and out.columns[-1] == "created_timestamp"
    for row in out.collect():
        assert row["created_timestamp"] == stamp and row["day_of_the_week"] == row["tx_ts"].strftime("%A")
    assert build_features(staged, SMALL).schema["created_timestamp"].dataType.simpleString() == "timestamp"


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_stepwise_loads_equal_one_build(spark, store, strategy):
    tx = transactions(spark)
    staged = stage(store, f"{store.database}.staged", tx, labels(spark))
    steps = f"{store.database}.steps"
    for day in (5, 6, 13, 20):
        until = F.lit(START.date() + timedelta(days=day))
        load_features(store, steps, staged.where(F.col("tx_date") < until), SMALL, strategy=strategy)
    once = build_features(staged, SMALL, "direct")
    assert content(store.read(steps)) == content(once)
    load_features(store, steps, staged, SMALL)  # nothing new, nothing added
    assert store.read(steps).count() == tx.count()


def test_delta_loads_forget_history_and_full_refresh_restores_it(spark, store):
    staged = label_transactions(transactions(spark), labels(spark)).withColumn("tx_date", F.to_date("tx_ts"))
    first = staged.where(F.col("tx_date") < F.lit(date(2024, 1, 11)))
    rest = staged.where(F.col("tx_date") >= F.lit(date(2024, 1, 11)))
    table = f"{store.database}.f"
    load_features(store, table, first, SMALL)
    load_features(store, table, staged, SMALL, history="delta")
    apart = build_features(first, SMALL).unionByName(build_features(rest, SMALL))
    assert content(store.read(table)) == content(apart) != content(build_features(staged, SMALL))
    load_features(store, table, staged, SMALL, full_refresh=True)
    assert content(store.read(table)) == content(build_features(staged, SMALL))


def test_empty_target(spark, store):
    staged = label_transactions(transactions(spark, 50), labels(spark)).withColumn("tx_date", F.to_date("tx_ts"))
    for history, expected in (("delta", 0), ("full", 50)):
        table = f"{store.database}.{history}"
        load_features(store, table, staged.limit(0), SMALL)
        load_features(store, table, staged, SMALL, history=history)
        assert store.read(table).count() == expected
    with pytest.raises(ValueError):
        load_features(store, table, staged, SMALL, history="some")


def test_relation_other_than_the_target(spark, store):
    staged = label_transactions(transactions(spark), labels(spark)).withColumn("tx_date", F.to_date("tx_ts"))
    table = f"{store.database}.r"
    load_features(store, table, staged.limit(0), SMALL)
    relation = staged.where(F.col("tx_date") <= F.lit(date(2024, 1, 15))).select("tx_ts")
    for history in ("delta", "full"):
        load_features(store, table, staged, SMALL, history=history, relation=relation)
    late = staged.where(F.col("tx_date") > F.lit(date(2024, 1, 15))).count()
    assert late > 0 and store.read(table).count() == 2 * late


def test_halo_reaches_back_far_enough():
    assert halo_start(date(2024, 1, 10), 86400) == date(2024, 1, 10)
    assert halo_start(date(2024, 1, 10), 86401) == date(2024, 1, 9)
    assert halo_start(date(2024, 1, 10), 3600) == date(2024, 1, 10)


def test_incremental_filter_prunes_partitions(spark, store):
    copy_transactions(store, f"{store.database}.tx", transactions(spark))
    tx = store.read(f"{store.database}.tx")
    target = tx.where(F.col("tx_date") <= F.lit(date(2024, 1, 15)))
    new = newer_than(tx, "tx_date", target, "tx_date")
    assert new.agg(F.min("tx_date")).first()[0] == date(2024, 1, 16)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx_date" in plan and "Subquery" in plan
    assert high_date(target) == date(2024, 1, 15) and high_date(tx.limit(0)) is None


def test_time_range_prunes_partitions(spark, store):
    copy_transactions(store, f"{store.database}.tx", transactions(spark))
    tx = store.read(f"{store.database}.tx")
    bounds = ("2024-01-03 12:00:00", "2024-01-05 00:00:00")
    got = time_range(tx, "tx_ts", *bounds, date="tx_date")
    assert "PartitionFilters: [isnotnull(tx_date" in got._jdf.queryExecution().executedPlan().toString()
    assert content(got) == content(time_range(tx, "tx_ts", *bounds))
    low, high = got.agg(F.min("tx_ts"), F.max("tx_ts")).first()
    assert datetime(2024, 1, 3, 12) <= low and high < datetime(2024, 1, 5)


def test_hash_samples_are_stable_and_partition_the_keys(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    for method in ("text", "fast"):
        parts = [{r["k"] for r in hash_sample(keys, "k", 4, b, method).collect()} for b in range(4)]
        assert sum(map(len, parts)) == 2000 == len(set().union(*parts))
        assert all(400 < len(p) < 600 for p in parts)
        assert {r["k"] for r in hash_sample(keys.repartition(7), "k", 4, 1, method).collect()} == parts[1]
    assert hash_sample(spark.createDataFrame([(None,)], "k string"), "k", 1, 0).count() == 0


def test_checks(spark):
    good = spark.createDataFrame([("a",), ("b",)], "id string")
    bad = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "id string")
    checks = {"good null": quality.not_null(good, "id"), "good unique": quality.unique(good, "id")}
    quality.assert_all(checks)
    assert quality.not_null(bad, "id").count() == 2
    assert [tuple(r) for r in quality.unique(bad, "id").collect()] == [("a", 2)]
    checks["bad unique"] = quality.unique(bad, "id")
    assert {tuple(r) for r in quality.report(checks).collect()} == {
        ("good null", 0, "pass"), ("good unique", 0, "pass"), ("bad unique", 1, "fail")
    }
    with pytest.raises(quality.ChecksFailed, match="bad unique: 1"):
        quality.assert_all(checks)


@pytest.mark.parametrize("hours, status", [(24, "pass"), (25, "warn"), (30, "warn"), (31, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(START,), (START - timedelta(days=9),)], "ts timestamp")
    row = quality.freshness(df, "ts", F.lit(START + timedelta(hours=hours))).first()
    assert (row["latest"], row["age_seconds"], row["status"]) == (START, hours * 3600, status)
    assert quality.freshness(df.limit(0), "ts", F.current_timestamp()).first()["status"] == "error"


def test_typed_reads(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), True, "x", START, [1])], "i int, d decimal(9,2), b boolean, s string, t timestamp, a array<int>")
    assert [t for _, t in typed(df).dtypes] == ["bigint", "double", "boolean", "string", "timestamp", "array<int>"]
    assert typed_query(spark, "SELECT i + 1 AS n FROM {df}", df=df).first()["n"] == 2
    assert len(fetch(df, 1)) == 1
    with pytest.raises(ValueError, match="more than 1 rows"):
        fetch(df.union(df), 1)


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
