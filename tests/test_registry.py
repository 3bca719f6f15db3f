"""Configuration, registry, type checks, ingestion, serving."""

import copy
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.plans import registry
from rollfeat.plans.config import ConfigError, load_config, parse_config
from rollfeat.plans.feature_table import load_features
from rollfeat.plans.presets import PRESET_A, PRESET_B
from rollfeat.plans.registry import FeatureStore, MappingError
from rollfeat.queries import new_store
from rollfeat.sources.tables import ColumnsDiffer, TableStore

YAML = """
version: 2
experimental_feature_store:
  id: {store}
  ingestion_mode: {mode}
feature_mapping:
- entity_type_id: customer
  feature_time: tx_ts
  entity_id_field: customer_id
  output_full_table_id: {store}.source
  labels: {{team: a}}
  features:
  - feature_name: spent
    column_name: AMOUNT
    description: "any text"
    monitoring: enabled
  - feature_name: visits
- entity_type_id: terminal
  feature_time: tx_ts
  entity_id_field: terminal_id
  output_full_table_id: {store}.source
  features:
  - feature_name: busy
    column_name: flag
"""


def at(hour):
    return datetime(2024, 1, 1, hour)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "tables"))
    made.database = f"s_{uuid.uuid4().hex}"
    made.create_database(made.database)
    rows = [(1, 7, at(1), 1.5, 10, True, "a"), (1, 7, at(3), 2.5, None, False, "b"), (2, 7, at(2), 9.0, 4, True, "c")]
    columns = "customer_id bigint, terminal_id bigint, tx_ts timestamp_ntz, amount double, visits int, flag boolean, tx_id string"
    made.overwrite(f"{made.database}.source", spark.createDataFrame(rows, columns))
    return made


def config(store, mode="ingest"):
    return load_config(YAML.format(store=store.database, mode=mode))


def test_config(spark):
    parsed = load_config(YAML.format(store="s", mode="ingest"))
    customer, terminal = parsed.mappings
    assert (parsed.store_id, parsed.mode, customer.labels) == ("s", "ingest", {"team": "a"})
    assert customer.source_fields == {"spent": "AMOUNT", "visits": "visits"}
    assert customer.features[0].monitoring == "enabled" and terminal.table == "s.source"


def test_config_reports_every_problem():
    with pytest.raises(ConfigError) as error:
        parse_config({
            "experimental_feature_store": {"ingestion_mode": "later"},
            "feature_mapping": [{"entity_type_id": "c", "features": [{"column_name": "x"}, {"feature_name": "f"}, {"feature_name": "f"}]}],
        })
    for part in ("id is missing", "'later' is not one of", "feature_time is missing", "features[0]: feature_name is missing", "f is listed twice"):
        assert part in str(error.value)


def test_value_types():
    schema = T.StructType.fromDDL(
        "s string, i int, l bigint, f float, d double, b boolean, sa array<string>, la array<bigint>, da array<double>, "
        "ba array<boolean>, n decimal(9,2), na array<decimal(9,2)>, t timestamp, dt date, st struct<x:int>, m map<string,int>, aa array<array<int>>"
    )
    assert registry.value_types(schema) == {
        "s": "STRING", "i": "INT64", "l": "INT64", "f": "DOUBLE", "d": "DOUBLE", "b": "BOOL",
        "sa": "STRING_ARRAY", "la": "INT64_ARRAY", "da": "DOUBLE_ARRAY", "ba": "BOOL_ARRAY",
    }


def test_ingest_then_serve(spark, store):
    features = registry.FeatureStore(store, store.database)
    features.run(config(store), tie_break="tx_id")
    registered = {(r.entity_type, r.feature_name, r.value_type) for r in features.features().collect()}
    assert registered == {("customer", "spent", "DOUBLE"), ("customer", "visits", "INT64"), ("terminal", "busy", "BOOL")}
    assert {r.entity_type for r in features.entity_types().collect()} == {"customer", "terminal"}
    assert features.values("customer").columns == ["entity_id", "feature_time", "tie_break", "spent", "visits", "feature_date"]

    instances = spark.createDataFrame([("p", at(2), 1, 7, 0.5), ("q", at(4), 1, 7, 1.5), ("r", at(4), 5, 8, 2.5)], "tx_id string, timestamp timestamp_ntz, customer bigint, terminal bigint, tx_amount double")
    served = features.serve(instances, {"customer": ["spent", "visits"], "terminal": ["busy"]}, ["tx_amount"], until="2024-01-02")
    assert served.columns == ["tx_id", "timestamp", "tx_amount", "entity_type_customer", "entity_type_terminal", "spent", "visits", "busy"]
    got = {r.tx_id: (r.spent, r.visits, r.busy) for r in served.collect()}
    assert got == {"p": (1.5, 10, True), "q": (2.5, None, False), "r": (None, None, None)}
    each = features.serve(instances, {"customer": ["visits"]}, per_feature=True)
    assert {r.tx_id: r.visits for r in each.collect()} == {"p": 10, "q": 10, "r": None}


def test_registering_twice_changes_nothing(spark, store):
    features = registry.FeatureStore(store, store.database)
    features.run(config(store, "check_types_only"))
    before = sorted(map(repr, features.features().collect()))
    raw = store.read(f"{store.database}.source").withColumn("visits", F.col("visits").cast("double"))
    features.register(config(store).mappings[0], raw.schema)
    assert sorted(map(repr, features.features().collect())) == before


def test_changed_column_type_is_reported(spark, store):
    features = registry.FeatureStore(store, store.database)
    mapping = config(store).mappings[0]
    features.run(config(store, "check_types_only"))
    schema = copy.deepcopy(store.read(f"{store.database}.source").schema)
    schema["visits"].dataType, schema["amount"].dataType = T.StringType(), T.BooleanType()
    found = registry.type_mismatches(features.features("customer"), mapping, schema).collect()
    assert {(r.feature_name, r.stored_type, r.table_type) for r in found} == {("visits", "INT64", "STRING"), ("spent", "DOUBLE", "BOOL")}
    with pytest.raises(registry.TypeMismatch, match="visits is INT64, column visits is STRING"):
        features.check_types(mapping, schema)


def test_missing_columns_stop_everything_before_a_change(spark, store):
    raw = YAML.format(store=store.database, mode="ingest").replace("column_name: flag", "column_name: tx_ts").replace("- feature_name: visits", "- feature_name: nope")
    features = registry.FeatureStore(store, store.database)
    with pytest.raises(registry.MappingError, match="nope: column nope does not exist"):
        features.run(load_config(raw))
    assert not store.exists(f"{store.database}.registry_features")
    with pytest.raises(registry.MappingError, match="type that cannot be a feature"):
        registry.feature_rows(spark, load_config(raw).mappings[1], store.read(f"{store.database}.source").schema)


def numbered(spark, store, database, table, rows, schema="id long, at timestamp_ntz, a double, b double, n long"):
    store.overwrite(f"{database}.{table}", spark.createDataFrame(rows, schema))
    return f"{database}.{table}"


def mapping_of(table, *names, entity="customer"):
    return {
        "entity_type_id": entity, "feature_time": "at", "entity_id_field": "id", "output_full_table_id": table,
        "features": [{"feature_name": n, "column_name": c} for n, c in names],
    }


def config_of(database, *mappings):
    return parse_config({"experimental_feature_store": {"id": database, "ingestion_mode": "ingest"}, "feature_mapping": list(mappings)})


@pytest.fixture
def database(spark):
    store, name = new_store(spark)
    yield store, name
    store.drop_database(name)


MORNING = datetime(2024, 1, 1)


def test_numeric_ties_compare_as_numbers(spark, database):
    store, name = database
    table = numbered(spark, store, name, "t", [(1, MORNING, 1.5, 0.0, 9), (1, MORNING, 2.5, 0.0, 10)])
    features = FeatureStore(store, name)
    features.run(config_of(name, mapping_of(table, ("a", "a"))), tie_break="n")
    features.run(config_of(name, mapping_of(table, ("a", "a"))), tie_break="n")  # again: rows repeat, the answer does not change
    instances = spark.createDataFrame([(1, MORNING)], "customer long, timestamp timestamp_ntz")
    assert features.serve(instances, {"customer": ["a"]}).first()["a"] == 2.5
    with pytest.raises(ValueError, match="before the latest instance"):
        features.serve(instances, {"customer": ["a"]}, until="2023-12-31")


def test_each_mapping_reads_its_own_table(spark, database):
    store, name = database
    one = numbered(spark, store, name, "one", [(1, MORNING, 1.0, 0.0, 1)])
    two = numbered(spark, store, name, "two", [(1, MORNING, 2.0, 0.0, 1)])
    features = FeatureStore(store, name)
    features.run(config_of(name, mapping_of(one, ("x", "a")), mapping_of(two, ("y", "a"))))
    assert sorted((r["x"] or 0, r["y"] or 0) for r in features.values("customer").collect()) == [(0, 2.0), (1.0, 0)]
    with pytest.raises(ConfigError, match="also mapped from another table"):
        config_of(name, mapping_of(one, ("x", "a")), mapping_of(two, ("X", "a")))
    with pytest.raises(ConfigError, match="reserved"):
        config_of(name, mapping_of(one, ("entity_id", "a")))


def test_nothing_is_written_when_a_mapping_is_bad(spark, database):
    store, name = database
    table = numbered(spark, store, name, "t", [(1, MORNING, 1.0, 0.0, 1)])
    features = FeatureStore(store, name)
    for bad in (mapping_of(table, ("x", "missing"), entity="terminal"),):
        with pytest.raises(MappingError):
            features.run(config_of(name, mapping_of(table, ("x", "a")), bad))
    with pytest.raises(MappingError, match="tie break"):
        features.run(config_of(name, mapping_of(table, ("x", "a"))), tie_break="missing")
    assert not store.exists(f"{name}.registry_features") and not store.exists(f"{name}.values_customer")


def test_append_never_drops_columns(spark, database):
    store, name = database
    target = f"{name}.t"
    store.overwrite(target, spark.createDataFrame([(1, "a")], "id long, x string"))
    wider = spark.createDataFrame([(2, "b", 3)], "id long, x string, y long")
    with pytest.raises(ColumnsDiffer, match="not in the table: y"):
        store.append(target, wider)
    with pytest.raises(ColumnsDiffer, match="not in the new rows: x"):
        store.append(target, wider.select("id"))
    store.append(target, wider, widen=True)
    store.append(target, wider.select("id"), widen=True)
    assert sorted(map(tuple, store.read(target).collect()), key=repr) == [(1, "a", None), (2, "b", 3), (2, None, None)]


def test_a_failed_overwrite_keeps_the_table(spark, database):
    store, name = database
    target = f"{name}.t"
    store.overwrite(target, spark.createDataFrame([(1,)], "id long"))
    with pytest.raises(Exception, match="no such row"):
        store.overwrite(target, spark.range(3).selectExpr("raise_error('no such row') AS id"))
    assert [r["id"] for r in store.read(target).collect()] == [1]
    store.overwrite(target, store.read(target).selectExpr("id + 1 AS id"))
    assert [r["id"] for r in store.read(target).collect()] == [2] and [t.name for t in spark.catalog.listTables(name) if not t.isTemporary] == ["t"]


def test_a_widened_preset_is_refused(spark, database):
    store, name = database
    rows = spark.sql("SELECT '1' AS tx_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS tx_ts, 1L AS customer_id, 2L AS terminal_id, 3.0D AS tx_amount, 0 AS tx_fraud, DATE '2024-01-01' AS tx_date")
    load_features(store, f"{name}.features", rows, PRESET_B)
    later = rows.selectExpr("tx_id", "tx_ts + INTERVAL 1 DAY AS tx_ts", "customer_id", "terminal_id", "tx_amount", "tx_fraud", "DATE '2024-01-02' AS tx_date")
    with pytest.raises(ColumnsDiffer, match="full refresh"):
        load_features(store, f"{name}.features", rows.unionByName(later), PRESET_A)
    load_features(store, f"{name}.features", rows.unionByName(later), PRESET_A, full_refresh=True)
    assert store.read(f"{name}.features").count() == 2
