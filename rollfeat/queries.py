"""One runnable query per capability, over the generic test tables.

Every query reads whole tables. What has to be written on the way (copied tables, feature tables, registries) goes to
a new database in the shared scratch folder, and the query returns what is read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce, wraps
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollfeat.functions.scalars import epoch_seconds, event_date, text_hash, weekday_name
from rollfeat.operators import quality, sampling
from rollfeat.operators.asof import FeatureRows, asof_join
from rollfeat.operators.hotkeys import Limits
from rollfeat.operators.incremental import high_date, newer_than
from rollfeat.operators.rolling import RollingBlock, with_rolling
from rollfeat.operators.sampling import in_range, time_range
from rollfeat.plans import registry, training
from rollfeat.plans.config import parse_config
from rollfeat.plans.feature_table import load_features, stage
from rollfeat.plans.presets import PRESET_A, PRESET_B, build_features, label_transactions
from rollfeat.session import scratch_dir, use_utc
from rollfeat.sources import samples
from rollfeat.sources.tables import (
    Sources,
    TableStore,
    copy_labels,
    copy_profiles,
    copy_transactions,
    typed_query,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Amounts have two decimals; summing them as decimals makes averages the same in every engine.
MONEY = "decimal(18,2)"

# Event dates up to and including this one are loaded first in the incremental queries.
FIRST_LOAD_UNTIL = dt.date(2024, 1, 19)
TRAIN = ("2024-01-10 00:00:00", "2024-01-24 00:00:00")
VALIDATION = ("2024-01-24 00:00:00", "2024-01-30 00:00:00")
# Labels cover the first days only.
LABELLED_TRAIN = ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
LABELLED_VALIDATION = ("2024-01-03 00:00:00", "2024-01-08 00:00:00")

MAPPING = {
    "experimental_feature_store": {"id": "payments", "ingestion_mode": "ingest"},
    "feature_mapping": [
        {
            "entity_type_id": "customer",
            "feature_time": "tx_ts",
            "entity_id_field": "customer_id",
            "output_full_table_id": "payments.features",
            "features": [
                {"feature_name": "avg_amount_7d", "column_name": "avg_tx_amount_by_customer_id_7d_1s"},
                {"feature_name": "count_28d", "column_name": "count_tx_amount_by_customer_id_28d_1s"},
                {"feature_name": "min_tx_amount_by_customer_id_1h_1s", "description": "column of the same name"},
            ],
        },
        {
            "entity_type_id": "terminal",
            "feature_time": "tx_ts",
            "entity_id_field": "terminal_id",
            "output_full_table_id": "payments.features",
            "features": [
                {"feature_name": "max_amount_28d", "column_name": "max_tx_amount_by_terminal_id_28d_1s"},
                {"feature_name": "max_amount_90d", "column_name": "max_tx_amount_by_terminal_id_90d_1s"},
            ],
        },
    ],
}
CUSTOMER, TERMINAL = parse_config(MAPPING).mappings

PASS_THROUGH = ["tx_fraud", "tx_amount", "avg_tx_amount_by_customer_id_1h_1s", "min_tx_amount_by_customer_id_1h_1s"]


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_utc(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def new_store(spark: SparkSession) -> tuple[TableStore, str]:
    """A table store in a new scratch folder, and a new database in it."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    database = f"rollfeat_{uuid.uuid4().hex}"
    store.create_database(database)
    return store, database


def staged_events(spark, sf_dir):
    return label_transactions(samples.events_tx(spark, sf_dir), samples.events_labels(spark, sf_dir))


def block(aggregations, lookbacks, column="tx_amount", partition=("customer_id",), **options):
    columns = [column] if isinstance(column, str) else column
    return RollingBlock(aggregations, columns, list(partition), lookbacks, exact_type=MONEY, **options)


def rolled(rows: DataFrame, *blocks: RollingBlock, **options) -> DataFrame:
    names = [f.name for b in blocks for f in b.features()]
    return with_rolling(rows, blocks, **options).select("tx_id", *names)


def without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("created_timestamp", "tx_date")


# --- sources and sinks ---------------------------------------------------------------------------------------------


@query
def scan_tx(spark, sf_dir):
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    return Sources(spark, {"tx": f"{database}.tx"}).load("tx").drop("tx_date")


@query
def scan_txlabels(spark, sf_dir):
    return Sources(spark, {"txlabels": f"{sf_dir}/labels.parquet"}).load("txlabels").select(
        F.col("doc_id").cast("string").alias("tx_id"), F.col("toxic").alias("tx_fraud")
    )


@query
def ctas_tx(spark, sf_dir):
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    copied = store.read(f"{database}.tx")
    return copied.select(*[c for c in copied.columns if c != "tx_date"], F.col("tx_date").cast("string").alias("tx_date"))


@query
def ctas_txlabels(spark, sf_dir):
    store, database = new_store(spark)
    copy_labels(store, f"{database}.txlabels", samples.events_labels(spark, sf_dir))
    return store.read(f"{database}.txlabels")


def copied_profiles(spark, name, raw):
    store, database = new_store(spark)
    copy_profiles(store, f"{database}.{name}", raw)
    copy_profiles(store, f"{database}.{name}", raw.limit(0))  # a second copy changes nothing
    return store.read(f"{database}.{name}")


@query
def ctas_customers(spark, sf_dir):
    return copied_profiles(spark, "customers", samples.table(spark, sf_dir, "customer"))


@query
def ctas_terminals(spark, sf_dir):
    return copied_profiles(spark, "terminals", samples.table(spark, sf_dir, "supplier"))


@query
def ctas_customersterminals(spark, sf_dir):
    return copied_profiles(spark, "customersterminals", samples.customer_terminals(spark, sf_dir))


@query
def typed_read(spark, sf_dir):
    rows = staged_events(spark, sf_dir).select(
        "tx_id", "tx_ts", F.col("tx_amount").cast(MONEY).alias("tx_amount"), F.col("tx_fraud"), (F.col("tx_amount") > 50).alias("large")
    )
    return typed_query(spark, "SELECT * FROM {rows}", rows=rows)


# --- projections, joins, scalar functions --------------------------------------------------------------------------


@query
def staging_join(spark, sf_dir):
    name = f"rollfeat_staging_{uuid.uuid4().hex}"
    with TableStore(spark, scratch_dir(spark, "tables")).view(name, staged_events(spark, sf_dir)):
        return spark.sql(f"SELECT * FROM {name}")


def staged_table(spark, sf_dir):
    """The labelled transactions, joined once and stored by date."""
    store, database = new_store(spark)
    return stage(store, f"{database}.staged", samples.events_tx(spark, sf_dir), samples.events_labels(spark, sf_dir))


def staged_orders(store: TableStore, database: str, sf_dir: str) -> DataFrame:
    """Orders with their terminals, joined once and stored: a build reads its input several times over."""
    store.overwrite(f"{database}.staged_orders", samples.orders_tx(store.spark, sf_dir))
    return store.read(f"{database}.staged_orders")


@query
def features_preset_a(spark, sf_dir):
    return without_stamp(build_features(staged_table(spark, sf_dir), PRESET_A.summing_in(MONEY)))


@query
def features_created_at(spark, sf_dir):
    """The time of the build, given from outside."""
    stamp = F.lit("2024-02-01 04:00:00").cast("timestamp_ntz")
    features = build_features(staged_events(spark, sf_dir), PRESET_A, created_at=stamp)
    return features.select("tx_id", "tx_ts", "created_timestamp")


@query
def features_preset_b(spark, sf_dir):
    return build_features(staged_table(spark, sf_dir), PRESET_B.summing_in(MONEY)).drop("tx_date")


@query
def features_preset_a_orders(spark, sf_dir):
    return without_stamp(build_features(staged_orders(*new_store(spark), sf_dir), PRESET_A.summing_in(MONEY)))


@query
def features_preset_b_orders(spark, sf_dir):
    return build_features(staged_orders(*new_store(spark), sf_dir), PRESET_B.summing_in(MONEY))


@query
def read_instances(spark, sf_dir):
    return sample_instances(features_preset_a(spark, sf_dir))


def instances_of(features: DataFrame) -> DataFrame:
    return features.select(
        "tx_id",
        F.col("tx_ts").alias("timestamp"),
        F.col("customer_id").alias("customer"),
        F.col("terminal_id").alias("terminal"),
        *PASS_THROUGH,
    )


def sample_instances(features: DataFrame) -> DataFrame:
    return instances_of(sampling.hash_sample(time_range(features, "tx_ts", *TRAIN), "tx_id"))


@query
def training_columns(spark, sf_dir):
    return training.training_frame(features_preset_b(spark, sf_dir))


@query
def time_split_train(spark, sf_dir):
    return time_range(staged_events(spark, sf_dir), "tx_ts", *TRAIN)


@query
def time_split_val(spark, sf_dir):
    return time_range(staged_events(spark, sf_dir), "tx_ts", *VALIDATION)


@query
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(staged_events(spark, sf_dir), "tx_id")


@query
def hash_sample_values(spark, sf_dir):
    return staged_events(spark, sf_dir).select("tx_id", text_hash("tx_id").alias("hash"))


@query
def weekday(spark, sf_dir):
    return samples.events_tx(spark, sf_dir).select("tx_id", weekday_name("tx_ts").alias("day_of_the_week"))


@query
def unix_seconds(spark, sf_dir):
    return samples.events_tx(spark, sf_dir).select("tx_id", epoch_seconds("tx_ts").alias("seconds"))


@query
def event_dates(spark, sf_dir):
    return samples.events_tx(spark, sf_dir).select("tx_id", event_date("tx_ts").cast("string").alias("tx_date"))


# --- rolling windows -----------------------------------------------------------------------------------------------


@query
def roll_count(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["count"], ["1h", "5d"]))


@query
def roll_avg(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["avg"], ["1h", "5d"]))


@query
def roll_min(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["min"], ["1h", "5d"]))


@query
def roll_max(spark, sf_dir):
    return rolled(samples.orders_tx(spark, sf_dir), block(["max"], ["3d", "28d", "175d"], partition=["terminal_id"]))


@query
def roll_sum(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["sum"], ["1h", "5d"]))


@query
def roll_stddev(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["stddev", "var_samp"], ["1d", "7d"]))


@query
def roll_count_distinct(spark, sf_dir):
    both = block(["count", "count_distinct"], ["1h", "2d", "7d"], column=["terminal_id", "tx_amount"])
    return rolled(samples.events_tx(spark, sf_dir), both)


@query
def roll_count_distinct_hot(spark, sf_dir):
    """Five keys hold the whole table, and the current second counts."""
    counted = block(["count_distinct"], ["10m", "36h", "14d"], column="customer_id", partition=["event_type"], exclude_current_row=False)
    users = samples.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("tx_id"), F.col("ts").alias("tx_ts"), "event_type", F.col("user_id").alias("customer_id")
    )
    return rolled(users, counted)


@query
def roll_approx_distinct(spark, sf_dir):
    return rolled(
        samples.events_tx(spark, sf_dir), block(["approx_count_distinct"], ["1h", "2d"], column="terminal_id")
    )


@query
def roll_approx_distinct_wide(spark, sf_dir):
    """Sketches of thousands of values: each estimate within a twentieth of the exact number."""
    counted = block(["count", "approx_count_distinct"], ["7d", "28d"], column="tx_id", partition=["event_type"])
    rows = rolled(events_by_type(spark, sf_dir), counted)
    names = {d: [f"{a}_tx_id_by_event_type_{d}_1s" for a in ("count", "approx_count_distinct")] for d in ("7d", "28d")}
    close = [(F.abs(F.col(about) - F.col(n)) <= F.col(n) * 0.05).alias(f"close_{d}") for d, (n, about) in names.items()]
    return rows.select("tx_id", *[F.col(n).alias(f"n_{d}") for d, (n, _) in names.items()], *close)


@query
def roll_odd_lookback(spark, sf_dir):
    """A look-back that no chunk divides, in chunks."""
    return rolled(
        samples.orders_tx(spark, sf_dir), block(["count", "avg", "max"], ["100003m", "28d"], partition=["terminal_id"]), strategy="chunked"
    )


@query
def roll_stddev_double(spark, sf_dir):
    """Moments of a floating-point column, of whole numbers near 3e18, and of the two plans."""
    rows = samples.orders_tx(spark, sf_dir).withColumn("large", F.lit(3 * 10**18) + F.floor("tx_amount").cast("bigint"))
    moments = [block(["stddev", "var_samp"], ["28d", "175d"], column=c, partition=["terminal_id"]) for c in ("tx_amount", "large")]
    return rolled(rows, *moments, strategy="chunked")


def of_all_magnitudes(rows: DataFrame) -> DataFrame:
    """Amounts of either sign, times a power of two between 2**-996 and 2**996."""
    n = F.col("tx_id").cast("bigint")
    sign = F.when(n % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return rows.withColumn("wide", F.col("tx_amount") * sign * F.pow(F.lit(2.0), (n % 1993 - 996).cast("double")))


@query
def roll_avg_double(spark, sf_dir):
    """Sums of doubles from 1e-300 to 1e300 without a decimal type, in each plan."""
    rows = of_all_magnitudes(samples.events_tx(spark, sf_dir))
    wide = RollingBlock(["avg", "sum"], ["wide"], ["customer_id"], ["1h", "5d"])
    plans = [rolled(rows, wide, strategy=plan).withColumn("plan", F.lit(plan)) for plan in ("direct", "chunked")]
    return plans[0].unionByName(plans[1])


@query
def roll_include_current(spark, sf_dir):
    return rolled(
        samples.orders_tx(spark, sf_dir),
        block(["count", "avg", "max"], ["1d", "28d"], partition=["terminal_id"], exclude_current_row=False),
    )


@query
def roll_units(spark, sf_dir):
    return rolled(samples.events_tx(spark, sf_dir), block(["count"], ["3600s", "90m", "6h", "2d", "1w"]))


@query
def roll_multi_key(spark, sf_dir):
    return rolled(
        samples.orders_tx(spark, sf_dir),
        block(["count", "avg"], ["28d", "52w"], partition=["customer_id", "terminal_id"]),
    )


@query
def roll_multi_col(spark, sf_dir):
    return rolled(
        samples.lineitem_tx(spark, sf_dir),
        block(["count", "avg", "max"], ["28d", "175d"], column=["tx_amount", "l_quantity"], partition=["terminal_id"]),
    )


def events_by_type(spark, sf_dir):
    return samples.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("tx_id"),
        F.col("ts").alias("tx_ts"),
        "event_type",
        F.col("value").alias("tx_amount"),
    )


HOT_BLOCK = block(["count", "avg", "min", "max"], ["1h", "5d", "14d"], partition=["event_type"])


@query
def roll_hot_key(spark, sf_dir):
    """Five keys hold the whole table: every one of them is cut into chunks of time."""
    return rolled(events_by_type(spark, sf_dir), HOT_BLOCK, limits=Limits(small_steps=0))


@query
def roll_chunked_orders(spark, sf_dir):
    return rolled(
        samples.orders_tx(spark, sf_dir),
        block(["count", "avg", "min", "max"], ["28d", "90d", "175d"], partition=["terminal_id"]),
        strategy="chunked",
    )


# --- incremental loads ---------------------------------------------------------------------------------------------


def incremental(spark, sf_dir, history):
    """First load up to a date, then the rest as an increment on a table partitioned by date."""
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    staged = label_transactions(store.read(f"{database}.tx"), samples.events_labels(spark, sf_dir))
    target, preset = f"{database}.features", PRESET_B.summing_in(MONEY)
    load_features(store, target, staged.where(F.col("tx_date") <= F.lit(FIRST_LOAD_UNTIL)), preset)
    load_features(store, target, staged, preset, history=history)
    return store.read(target)


@query
def incremental_full(spark, sf_dir):
    return without_stamp(incremental(spark, sf_dir, "full"))


@query
def incremental_delta(spark, sf_dir):
    return without_stamp(incremental(spark, sf_dir, "delta"))


@query
def incremental_late(spark, sf_dir):
    """A first load that lacks every ninth row of its dates; these come in with the increment."""
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    staged = label_transactions(store.read(f"{database}.tx"), samples.events_labels(spark, sf_dir))
    target, preset = f"{database}.features", PRESET_B.summing_in(MONEY)
    in_time = (F.col("tx_date") <= F.lit(FIRST_LOAD_UNTIL)) & (F.col("tx_id").cast("bigint") % 9 != 0)
    load_features(store, target, staged.where(in_time), preset)
    load_features(store, target, staged, preset, late_rows=True)
    return without_stamp(store.read(target))


@query
def incremental_states(spark, sf_dir):
    """Two increments that read whole days from kept states, on a first load that lacks rows of some dates until late."""
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    staged = stage(store, f"{database}.staged", store.read(f"{database}.tx"), samples.events_labels(spark, sf_dir))
    target, preset = f"{database}.features", PRESET_B.summing_in(MONEY)
    day = F.col("tx_date")
    in_time = (day <= F.lit(FIRST_LOAD_UNTIL)) & (F.col("tx_id").cast("bigint") % 9 != 0)
    load_features(store, target, staged.where(in_time), preset, states=f"{database}.states")
    middle = staged.where(day <= F.lit(FIRST_LOAD_UNTIL + dt.timedelta(days=4)))
    load_features(store, target, middle, preset, states=f"{database}.states", late_rows=True)
    load_features(store, target, staged, preset, states=f"{database}.states")
    return without_stamp(store.read(target))


@query
def incremental_batches(spark, sf_dir):
    """Loads as batches: one is refused by a check, then repeated, and then asked for once more."""
    store, database = new_store(spark)
    staged = stage(store, f"{database}.staged", samples.events_tx(spark, sf_dir), samples.events_labels(spark, sf_dir))
    target, preset = f"{database}.features", PRESET_B.summing_in(MONEY)
    load_features(store, target, staged.where(F.col("tx_date") <= F.lit(FIRST_LOAD_UNTIL)), preset, batch_id="first")
    try:
        load_features(store, target, staged, preset, batch_id="second", checks={"labelled": F.col("tx_fraud").isNotNull()})
        raise AssertionError("rows without a label were not noticed")
    except quality.ChecksFailed:
        pass
    for _ in range(2):
        load_features(store, target, staged, preset, batch_id="second", checks={"tx_id": F.col("tx_id").isNotNull()})
    return without_stamp(store.read(target))


@query
def incremental_first_load(spark, sf_dir):
    store, database = new_store(spark)
    staged = staged_events(spark, sf_dir).withColumn("tx_date", F.to_date("tx_ts"))
    target, preset = f"{database}.features", PRESET_B.summing_in(MONEY)
    load_features(store, target, staged.limit(0), preset)  # leaves an empty target
    load_features(store, target, staged, preset)
    return without_stamp(store.read(target))


@query
def full_refresh(spark, sf_dir):
    """A table loaded up to a date, then replaced whole."""
    store, database = new_store(spark)
    staged = stage(store, f"{database}.staged", samples.events_tx(spark, sf_dir), samples.events_labels(spark, sf_dir))
    target = f"{database}.features"
    load_features(store, target, staged.where(F.col("tx_date") <= F.lit(FIRST_LOAD_UNTIL)), PRESET_B)
    load_features(store, target, staged, PRESET_B, full_refresh=True)
    return store.read(target).drop("tx_date")


@query
def incremental_filter(spark, sf_dir):
    store, database = new_store(spark)
    copy_transactions(store, f"{database}.tx", samples.events_tx(spark, sf_dir))
    tx = store.read(f"{database}.tx")
    target = tx.where(F.col("tx_date") <= F.lit(FIRST_LOAD_UNTIL))
    return newer_than(tx, "tx_date", target, "tx_ts").drop("tx_date")


@query
def target_high_date(spark, sf_dir):
    rows = samples.events_tx(spark, sf_dir)
    high = high_date(rows, "tx_ts")
    return rows.where(event_date("tx_ts") == F.lit(high)).agg(
        F.max(event_date("tx_ts")).cast("string").alias("high_date"), F.count(F.lit(1)).alias("rows_on_it")
    )


# --- data quality --------------------------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    return quality.not_null(staged_events(spark, sf_dir), "tx_fraud").select("tx_id", "tx_amount")


@query
def dq_unique(spark, sf_dir):
    return quality.unique(samples.lineitem_tx(spark, sf_dir), "tx_id")


@query
def dq_freshness(spark, sf_dir):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    return quality.freshness(samples.events_tx(spark, sf_dir), "tx_ts", now)


@query
def dq_report(spark, sf_dir):
    events, lines = samples.events_tx(spark, sf_dir), samples.lineitem_tx(spark, sf_dir)
    return quality.report(
        {
            "events_tx_id_not_null": quality.NotNull(events, "tx_id"),
            "events_tx_id_unique": quality.Unique(events, "tx_id"),
            "lineitem_tx_id_not_null": quality.NotNull(lines, "tx_id"),
            "lineitem_tx_id_unique": quality.Unique(lines, "tx_id"),
            "orders_tx_id_unique": quality.Unique(samples.orders_tx(spark, sf_dir), "tx_id"),
        }
    )


# --- registry and feature values -----------------------------------------------------------------------------------


def stored_features(spark, sf_dir, preset=PRESET_B):
    """A feature table that is built once and read from then on."""
    store, database = new_store(spark)
    staged = stage(store, f"{database}.staged", samples.events_tx(spark, sf_dir), samples.events_labels(spark, sf_dir))
    load_features(store, f"{database}.features", staged, preset)
    return store, database, store.read(f"{database}.features")


def with_counts(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Descriptive rows with the number of values their column holds."""
    names = [c for c in features.columns if c != "tx_date"]
    return rows.join(F.broadcast(registry.profile(features, names)), "column_name")


@query
def schema_types(spark, sf_dir):
    _, _, features = stored_features(spark, sf_dir)
    return with_counts(registry.schema_types(features), features)


@query
def feature_mapping(spark, sf_dir):
    return mapping_with_counts(stored_features(spark, sf_dir)[2])


def mapping_with_counts(features: DataFrame) -> DataFrame:
    mapped = registry.feature_mapping(features, CUSTOMER).unionByName(registry.feature_mapping(features, TERMINAL))
    return with_counts(mapped, features)


@query
def registry_new_rows(spark, sf_dir):
    """The terminal features are registered already; the customer features are new. Each with its number of values."""
    _, _, features = stored_features(spark, sf_dir)
    wanted = registry.feature_rows(spark, CUSTOMER, features.schema).unionByName(
        registry.feature_rows(spark, TERMINAL, features.schema)
    )
    stored = registry.feature_rows(spark, TERMINAL, features.schema)
    new = registry.absent_rows(wanted, stored).select("entity_type", "feature_name", "value_type")
    return new.join(mapping_with_counts(features), ["entity_type", "feature_name"])


@query
def type_check(spark, sf_dir):
    """One stored type is wrong; the mismatch comes back with the number of values it affects."""
    _, _, features = stored_features(spark, sf_dir)
    stored = registry.feature_rows(spark, CUSTOMER, features.schema).withColumn(
        "value_type", F.when(F.col("feature_name") == "count_28d", "DOUBLE").otherwise(F.col("value_type"))
    )
    mismatches = registry.type_mismatches(stored, CUSTOMER, features.schema)
    return with_counts(mismatches, features)


def run_mappings(store, database, mappings, batch_id=None) -> registry.FeatureStore:
    raw = {"experimental_feature_store": {"id": database, "ingestion_mode": "ingest"}, "feature_mapping": mappings}
    features = registry.FeatureStore(store, database)
    features.run(parse_config(raw), tie_break="tx_id", batch_id=batch_id)
    return features


def ingested(spark, sf_dir, *entity_types):
    """Entity types of the mapping, registered and ingested from a feature table."""
    store, database, table = stored_features(spark, sf_dir)
    wanted = [m for m in MAPPING["feature_mapping"] if m["entity_type_id"] in entity_types]
    return run_mappings(store, database, [{**m, "output_full_table_id": f"{database}.features"} for m in wanted]), table


@query
def ingest_customer(spark, sf_dir):
    return ingested(spark, sf_dir, "customer")[0].values("customer").drop("feature_date")


@query
def ingest_batch_twice(spark, sf_dir):
    """The second run of a batch adds nothing."""
    store, database, _ = stored_features(spark, sf_dir)
    customer = {**MAPPING["feature_mapping"][0], "output_full_table_id": f"{database}.features"}
    for _ in range(2):
        features = run_mappings(store, database, [customer], batch_id="2024-01")
    return features.values("customer").drop("feature_date")


@query
def ingest_terminal(spark, sf_dir):
    return ingested(spark, sf_dir, "terminal")[0].values("terminal").drop("feature_date")


def ingested_in_turn(spark, sf_dir, first: list[int], second: list[int]):
    """The customer features by their numbers in the mapping, in two runs over the same table."""
    store, database, _ = stored_features(spark, sf_dir)
    mapping = {**MAPPING["feature_mapping"][0], "output_full_table_id": f"{database}.features"}
    for numbers in (first, second):
        features = run_mappings(store, database, [{**mapping, "features": [mapping["features"][i] for i in numbers]}])
    return features.values("customer").drop("feature_date")


@query
def ingest_new_feature(spark, sf_dir):
    """The second run adds a feature: NULL in the rows of the first run, filled in its own."""
    return ingested_in_turn(spark, sf_dir, [0], [0, 1])


@query
def ingest_subset(spark, sf_dir):
    """The second run has fewer features: what it leaves out is NULL in its rows."""
    return ingested_in_turn(spark, sf_dir, [0, 1], [1])


@query
def ingest_two_tables(spark, sf_dir):
    """One entity type with features from two tables, each ingested from its own."""
    store, database, _ = stored_features(spark, sf_dir)
    store.overwrite(f"{database}.orders", build_features(staged_orders(store, database, sf_dir), PRESET_B))
    customer = MAPPING["feature_mapping"][0]
    orders = {"feature_name": "order_count_28d", "column_name": "count_tx_amount_by_customer_id_28d_1s"}
    features = run_mappings(
        store,
        database,
        [
            {**customer, "output_full_table_id": f"{database}.features", "features": customer["features"][:1]},
            {**customer, "output_full_table_id": f"{database}.orders", "features": [orders]},
        ],
    )
    return features.values("customer").drop("feature_date")


# --- point-in-time joins -------------------------------------------------------------------------------------------


def hourly(spark, sf_dir, entity):
    """Every transaction asks for what was known about its customer or terminal when its hour began."""
    return samples.events_tx(spark, sf_dir).select(
        "tx_id", F.col(entity).alias("entity"), F.date_trunc("hour", "tx_ts").cast("timestamp_ntz").alias("as_of")
    )


def customer_values(spark, sf_dir):
    names = {"1h": "avg_1h", "5d": "avg_5d"}
    rows = with_rolling(samples.events_tx(spark, sf_dir), [block(["avg"], list(names))])
    return FeatureRows(
        rows.select("customer_id", "tx_ts", F.col("tx_id").alias("row_id"),
                    *[F.col(f"avg_tx_amount_by_customer_id_{k}_1s").alias(n) for k, n in names.items()]),
        "customer_id", "tx_ts", list(names.values()), tie_break="row_id",
    )


@query
def asof_customer(spark, sf_dir):
    return asof_join(hourly(spark, sf_dir, "customer_id"), "entity", "as_of", customer_values(spark, sf_dir))


@query
def asof_per_feature(spark, sf_dir):
    instances = hourly(spark, sf_dir, "customer_id")
    return asof_join(instances, "entity", "as_of", customer_values(spark, sf_dir), per_feature=True)


def terminal_values(spark, sf_dir):
    rows = with_rolling(samples.events_tx(spark, sf_dir), [block(["max"], ["3d"], partition=["terminal_id"])])
    rows = rows.withColumnRenamed("max_tx_amount_by_terminal_id_3d_1s", "max_3d").withColumnRenamed("tx_id", "row_id")
    return FeatureRows(rows, "terminal_id", "tx_ts", ["max_3d", "tx_amount"], tie_break="row_id")


@query
def asof_terminal(spark, sf_dir):
    return asof_join(hourly(spark, sf_dir, "terminal_id"), "entity", "as_of", terminal_values(spark, sf_dir))


@query
def asof_ties(spark, sf_dir):
    """Feature times are cut to the hour, so most are shared: both plans choose the same row."""
    events = events_by_type(spark, sf_dir)
    hour = F.date_trunc("hour", "tx_ts").cast("timestamp_ntz")
    instances = events.select(F.col("tx_id").alias("probe_id"), F.col("event_type").alias("entity"), F.col("tx_ts").alias("as_of"))
    rows = events.select("event_type", hour.alias("tx_ts"), F.col("tx_id").alias("row_id"), "tx_amount")
    values = FeatureRows(rows, "event_type", "tx_ts", ["row_id", "tx_amount"])
    whole = asof_join(instances, "entity", "as_of", values, limits=Limits(rows_per_span=10**18, rows_per_key=10**18))
    sliced = asof_join(instances, "entity", "as_of", values, limits=Limits(rows_per_key=200, small_steps=0), slice_rows=200)
    return whole.withColumn("plan", F.lit("whole")).unionByName(sliced.withColumn("plan", F.lit("sliced")))


@query
def asof_hot_entity(spark, sf_dir):
    """Five entities hold all rows: each is cut into slices of time."""
    events = events_by_type(spark, sf_dir)
    instances = events.select(
        "tx_id", F.col("event_type").alias("entity"), F.date_trunc("hour", "tx_ts").cast("timestamp_ntz").alias("as_of")
    )
    values = FeatureRows(events.withColumnRenamed("tx_id", "row_id"), "event_type", "tx_ts", ["row_id", "tx_amount"])
    return asof_join(instances.withColumnRenamed("tx_id", "probe_id"), "entity", "as_of", values,
                     limits=Limits(rows_per_key=200, small_steps=0), slice_rows=200)


@query
def serve_point_in_time(spark, sf_dir):
    features, table = ingested(spark, sf_dir, "customer", "terminal")
    ids = {"customer": ["avg_amount_7d", "count_28d"], "terminal": ["max_amount_28d", "max_amount_90d"]}
    return features.serve(instances_of(time_range(table, "tx_ts", *TRAIN, date="tx_date")), ids, PASS_THROUGH, until=TRAIN[1])


# --- training ------------------------------------------------------------------------------------------------------


def splits(spark, sf_dir):
    """Both splits from one build over all rows. It is stored, since a fit reads its rows many times over."""
    ranges = (LABELLED_TRAIN, LABELLED_VALIDATION)
    staged = staged_table(spark, sf_dir)
    either = reduce(or_, [in_range(staged, "tx_ts", *bounds) for bounds in ranges])
    built = build_features(staged, PRESET_B.summing_in(MONEY), keep=either).drop("tx_date")
    path = scratch_dir(spark, "splits")
    built.write.parquet(path)
    features = spark.read.schema(built.schema).parquet(path)
    train, validation = (training.training_frame(time_range(features, "tx_ts", *bounds)) for bounds in ranges)
    return train, validation, training.FeaturePlan.of(train)


@query
def train_features(spark, sf_dir):
    """The training frame as the trees see it, before it is packed into vectors: categories fitted on the training
    rows, missing numbers flagged."""
    train, _, plan = splits(spark, sf_dir)
    filled = plan.fill(train)
    indexers = training.Pipeline(stages=plan.encoder()[:-1]).fit(filled)
    return indexers.transform(filled).select(plan.label, *[name for name, _ in plan.inputs])


def fitted(spark, sf_dir):
    train, validation, plan = splits(spark, sf_dir)
    return training.fit(train, plan, rounds=10, depth=4), train, validation, plan


@query
def train_split_stats(spark, sf_dir):
    """Rows and mean label of the labelled rows of each split."""
    train, validation, plan = splits(spark, sf_dir)
    return training.split_stats(plan, {"train": train, "validation": validation})


@query
def top_counted(spark, sf_dir):
    """The forty parts ordered most often, ranked as features are."""
    counts = samples.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(F.count(F.lit(1)).alias("score"))
    return training.top_features(counts, 40)


@query
def train_rounds(spark, sf_dir):
    """The error on both splits after each round; the validation rows take part in the fit only to end it early."""
    train, validation, plan = splits(spark, sf_dir)
    return training.errors_by_round(training.fit(train, plan, rounds=10, depth=4, validation=validation), plan, {"train": train, "validation": validation})


@query
def train_score(spark, sf_dir):
    model, train, validation, plan = fitted(spark, sf_dir)
    return training.scores(model, plan, {"train": train, "validation": validation})


@query
def importance_topk(spark, sf_dir):
    model, _, _, plan = fitted(spark, sf_dir)
    return training.top_features(training.split_counts(model, plan, scratch_dir(spark, "model")), 40)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label join, weekday, and all twenty rolling features of the first preset."""
    return features_preset_a(spark, sf_dir)
