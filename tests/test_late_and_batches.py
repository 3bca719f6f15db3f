"""Rows that come late, and loads that fail half-way: the tables end up as if neither had happened."""

import os
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollfeat.operators.hotkeys import Limits
from rollfeat.operators.quality import ChecksFailed
from rollfeat.operators.rolling import RollingBlock
from rollfeat.plans.config import parse_config
from rollfeat.plans import feature_table
from rollfeat.plans.feature_table import load_features
from rollfeat.plans.late import load_late
from rollfeat.plans.presets import Preset, build_features
from rollfeat.plans.registry import FeatureStore
from rollfeat.sources.tables import ATTEMPT, TableStore

SMALL = Preset(
    "small",
    (
        RollingBlock(["count", "avg"], ["tx_amount"], ["customer_id"], ["1h", "3d"]),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["2d"]),
    ),
    created_timestamp=False,
)
START = datetime(2024, 1, 1)
HIGH = date(2024, 1, 25)


@pytest.fixture
def store(spark, tmp_path):
    tables = TableStore(spark, str(tmp_path))
    tables.database = f"db_{uuid.uuid4().hex}"
    tables.create_database(tables.database)
    yield tables
    tables.drop_database(tables.database)


def staged_rows(spark, n=900):
    """A customer with half of all rows, rows without customer, and ids that repeat."""
    row = F.col("id")
    return spark.range(n).select(
        (F.lit(START).cast("timestamp") + F.make_interval(secs=F.pmod(F.xxhash64(row), F.lit(29 * 86_400)))).cast("timestamp_ntz").alias("tx_ts"),
        F.when(row % 50 == 0, "same").otherwise(row.cast("string")).alias("tx_id"),
        F.when(row % 2 == 0, 0).when(row % 31 == 0, None).otherwise(row % 7).cast("bigint").alias("customer_id"),
        (row % 5).cast("bigint").alias("terminal_id"),
        (F.pmod(F.hash(row), F.lit(10_000)) / 7.0).alias("tx_amount"),
        F.lit(None).cast("int").alias("tx_fraud"),
    ).withColumn("tx_date", F.to_date("tx_ts"))


def content(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def files_of(spark, table):
    return {r[0]: r[1] for r in spark.table(table).groupBy("tx_date").agg(F.sort_array(F.collect_set("_metadata.file_path"))).collect()}


EAGER = Limits(rows_per_span=20, small_steps=0, small_steps_per_key=0)


@pytest.mark.parametrize(
    "late,limits", [("tx_date = '2024-01-09' AND terminal_id = 3", Limits()), ("pmod(hash(tx_ts), 8) = 0", EAGER), ("tx_id = 'same'", Limits()), ("tx_date = '2024-01-25'", Limits())]
)
def test_late_rows_give_what_a_full_build_gives(spark, store, late, limits):
    target, staged = f"{store.database}.f", store_staged(store, staged_rows(spark))
    known = staged.where(F.col("tx_date") <= F.lit(HIGH))
    load_features(store, target, known.where(f"NOT ({late})"), SMALL)
    before = files_of(spark, target)
    touched = load_late(store, target, staged, SMALL, limits=limits)
    high = max(before)
    assert content(store.read(target)) == content(build_features(known.where(F.col("tx_date") <= F.lit(high)), SMALL, "direct"))
    after = files_of(spark, target)
    assert {d for d in after if before.get(d) != after[d]} == set(touched)
    reached = known.where(late).select("tx_date").distinct().collect()
    span = timedelta(days=3)
    assert all(any(r[0] <= d <= r[0] + span for r in reached) for d in touched)
    assert load_late(store, target, staged, SMALL) == []
    load_features(store, target, staged, SMALL, late_rows=True)
    assert content(store.read(target)) == content(build_features(staged, SMALL, "direct"))


def store_staged(store, staged):
    store.overwrite(f"{store.database}.staged", staged, partition_by=["tx_date"])
    return store.read(f"{store.database}.staged")


def test_late_rows_read_the_look_back_only(spark, store):
    target, staged = f"{store.database}.f", store_staged(store, staged_rows(spark))
    load_features(store, target, staged.where("tx_date <= '2024-01-25' AND NOT (tx_date = '2024-01-20' AND terminal_id = 1)"), SMALL)
    # Dates that neither a late row reaches nor a reached row looks back on are not opened: they hold no readable file any more.
    for r in spark.table(f"{store.database}.staged").where("tx_date < '2024-01-16'").select("_metadata.file_path").distinct().collect():
        path = r[0].removeprefix("file:")
        size = os.path.getsize(path)
        rows = open(path, "rb").read()
        open(path, "wb").write(b"\0" * 100 + rows[100:size])  # pages destroyed, footer left: counts can still be read
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    touched = load_late(store, target, staged, SMALL)
    assert touched and min(touched) == date(2024, 1, 20) and max(touched) <= date(2024, 1, 23)


def test_rows_that_left_are_refused(spark, store):
    target, staged = f"{store.database}.f", store_staged(store, staged_rows(spark, 200))
    load_features(store, target, staged, SMALL)
    with pytest.raises(ValueError, match="full refresh"):
        load_late(store, target, staged.where("tx_id <> '7'"), SMALL)
    empty = f"{store.database}.e"
    load_features(store, empty, staged.limit(0), SMALL)
    assert load_late(store, empty, staged, SMALL) == []
    with pytest.raises(ValueError, match="history"):
        load_features(store, target, staged, SMALL, history="delta", late_rows=True)


# --- batches ---------------------------------------------------------------------------------------------------------


def failing(df):
    return df.withColumn("tx_amount", F.when(F.col("terminal_id") == 4, F.raise_error(F.lit("half-way")).cast("double")).otherwise(F.col("tx_amount")))


def test_a_batch_counts_as_a_whole_or_not_at_all(spark, store):
    table, rows = f"{store.database}.t", staged_rows(spark, 300).repartition(6)
    with pytest.raises(Exception, match="half-way"):
        store.append_once(table, failing(rows), "one", ["tx_date"])
    assert not store.is_committed(table, "one")
    # What a failed attempt left behind, however much of it, is never read.
    store.append(table, rows.withColumn(ATTEMPT, F.lit("left-behind")), [ATTEMPT, "tx_date"])
    assert store.read(table).count() == 0
    assert store.append_once(table, rows, "one", ["tx_date"])
    assert not store.append_once(table, failing(rows), "one", ["tx_date"])  # not even computed
    assert content(store.read(table)) == content(rows)
    assert store.append_once(table, rows.limit(10), "two", ["tx_date"])
    assert store.read(table).count() == 310
    records = {r["batch_id"]: r for r in store.commits(table).collect()}
    files = spark.table(table).groupBy(ATTEMPT).agg(F.count_distinct("_metadata.file_path")).collect()
    assert [records[b]["n_rows"] for b in ("one", "two")] == [300, 10]
    assert {(r[ATTEMPT], r["n_files"]) for r in records.values()} == {tuple(r) for r in files if r[0] != "left-behind"}
    assert store.drop_uncommitted(table) == 1 and spark.table(table).count() == 310
    assert store.append_once(table, rows.limit(7), "three", ["tx_date"], replace=True)
    assert store.read(table).count() == 7
    store.append_once(table, rows.limit(5).withColumn("more", F.lit(1)), "four", ["tx_date"], widen=True)
    assert store.read(table).count() == 12 and store.read(table).where("more = 1").count() == 5


def test_two_attempts_that_both_committed_count_once(spark, store):
    table, rows = f"{store.database}.t", staged_rows(spark, 20)
    store.append_once(table, rows, "one")
    store.append(table, rows.withColumn(ATTEMPT, F.lit("racing")), [ATTEMPT])
    store._commit(table, "one", "racing", False, 20, 1)
    assert store.read(table).count() == 20


def test_checks_are_counted_in_the_writing_pass(spark, store):
    table, rows = f"{store.database}.t", staged_rows(spark, 100)
    with pytest.raises(ChecksFailed, match="known customer: [1-9]"):
        store.append_once(table, rows, "one", checks={"known customer": F.col("customer_id") >= 0, "id": F.col("tx_id").isNotNull()})
    assert store.read(table).count() == 0 and store.commits(table).count() == 0
    assert store.append_once(table, rows, "one", checks={"id": F.col("tx_id").isNotNull()})


def test_plain_tables_and_batches_do_not_mix(spark, store):
    plain, batched, rows = f"{store.database}.p", f"{store.database}.b", staged_rows(spark, 20)
    store.append(plain, rows)
    store.append_once(batched, rows, "one")
    with pytest.raises(ValueError, match="not made for batches"):
        store.append_once(plain, rows, "one")
    with pytest.raises(ValueError, match="other columns"):
        store.append(batched, rows)
    with pytest.raises(ValueError, match="never changed"):
        store.replace_partitions(batched, rows, ["tx_date"])
    with pytest.raises(ValueError, match="batch_id"):
        load_features(store, f"{store.database}.f", rows, SMALL, checks={"id": F.lit(True)})


@pytest.mark.parametrize("history", ["full", "delta"])
def test_loads_as_batches(spark, store, history):
    target, staged = f"{store.database}.f", staged_rows(spark, 400)
    first = staged.where(F.col("tx_date") <= F.lit(HIGH))
    with pytest.raises(Exception, match="half-way"):
        load_features(store, target, failing(first), SMALL, batch_id="one")
    for _ in range(2):
        load_features(store, target, first, SMALL, batch_id="one")
    for _ in range(2):
        load_features(store, target, staged, SMALL, history=history, batch_id="two")
    plain = f"{store.database}.p"
    load_features(store, plain, first, SMALL)
    load_features(store, plain, staged, SMALL, history=history)
    assert content(store.read(target)) == content(store.read(plain))
    load_features(store, target, staged, SMALL, batch_id="three", full_refresh=True)
    assert content(store.read(target)) == content(build_features(staged, SMALL, "direct"))


def test_a_run_is_repeated_without_repeating_rows(spark, store):
    rows = staged_rows(spark, 60)
    for name in ("a", "b"):
        store.overwrite(f"{store.database}.{name}", rows)
    mapping = lambda name, entity: {
        "entity_type_id": entity, "feature_time": "tx_ts", "entity_id_field": f"{entity}_id", "output_full_table_id": f"{store.database}.{name}",
        "features": [{"feature_name": f"amount_{entity}", "column_name": "tx_amount"}],
    }
    raw = {"experimental_feature_store": {"id": store.database, "ingestion_mode": "ingest"}, "feature_mapping": [mapping("a", "customer"), mapping("b", "terminal")]}
    features = FeatureStore(store, store.database)
    for _ in range(2):
        features.run(parse_config(raw), batch_id="monday")
    assert features.values("customer").count() == features.values("terminal").count() == 60
    features.run(parse_config(raw), batch_id="tuesday")
    assert features.values("customer").count() == 120


@pytest.mark.parametrize("history", ["full", "delta"])
def test_a_load_that_staged_columns_refuse_computes_no_features(spark, store, history, monkeypatch):
    target, staged = f"{store.database}.f", staged_rows(spark, 200)
    load_features(store, target, staged.where(F.col("tx_date") <= F.lit(HIGH)), SMALL, batch_id="first")
    before = content(store.read(target))

    def build(*args, **options):
        raise AssertionError("features were computed")

    with monkeypatch.context() as patch:
        patch.setattr(feature_table, "build_features", build)
        checks = {"labelled": F.col("tx_fraud").isNotNull(), "id": F.col("tx_id").isNotNull()}
        n = staged.where(F.col("tx_date") > F.lit(HIGH)).count()
        with pytest.raises(ChecksFailed, match=f"^labelled: {n} failing rows$"):
            load_features(store, target, staged, SMALL, history=history, batch_id="second", checks=checks)
    assert content(store.read(target)) == before
    with pytest.raises(ChecksFailed, match="many"):
        load_features(store, target, staged, SMALL, history=history, batch_id="second", checks={"many": F.col("count_tx_amount_by_customer_id_1h_1s") < 0})
    load_features(store, target, staged, SMALL, history=history, batch_id="second", checks={"id": F.col("tx_id").isNotNull()})
    assert store.read(target).count() == 200
