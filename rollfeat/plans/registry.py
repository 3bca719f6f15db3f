"""Feature registry and feature values as plain tables.

Database ``<store_id>`` holds ``registry_entity_types``, ``registry_features`` and one ``values_<entity type>`` table per
entity type, wide, partitioned by the date of the feature time.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.operators.asof import FeatureRows, asof_join
from rollfeat.operators.hotkeys import Limits
from rollfeat.plans.config import EntityMapping, StoreConfig
from rollfeat.sources.tables import TableStore

ENTITY_TYPES, FEATURES = "registry_entity_types", "registry_features"
_LABELS = T.MapType(T.StringType(), T.StringType())
ENTITY_TYPES_SCHEMA = T.StructType(
    [T.StructField("entity_type", T.StringType()), T.StructField("description", T.StringType()), T.StructField("labels", _LABELS)]
)
FEATURES_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("entity_type", "feature_name", "value_type", "column_name", "description")]
    + [T.StructField("labels", _LABELS), T.StructField("monitoring", T.StringType())]
)


def value_type(data_type: T.DataType) -> str | None:
    """The feature type that holds a column of this type, or None if no feature type does."""
    if isinstance(data_type, T.ArrayType):
        element = None if isinstance(data_type.elementType, T.ArrayType) else value_type(data_type.elementType)
        return None if element is None else f"{element}_ARRAY"
    # The names of the feature types.
    for kinds, name in (
        ((T.StringType,), "STRING"),
        ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "INT64"),
        ((T.FloatType, T.DoubleType), "DOUBLE"),
        ((T.BooleanType,), "BOOL"),
    ):
        if isinstance(data_type, kinds):
            return name
    return None


def value_types(schema: T.StructType) -> dict[str, str]:
    """Column name -> feature type, without the columns that cannot be features."""
    found = ((f.name, value_type(f.dataType)) for f in schema)
    return {name: kind for name, kind in found if kind is not None}


def schema_types(df: DataFrame) -> DataFrame:
    """``value_types`` of a table as rows. Only the schema is looked at; :func:`profile` counts values."""
    return df.sparkSession.createDataFrame(list(value_types(df.schema).items()), "column_name string, value_type string")


class MappingError(ValueError):
    pass


def feature_rows(spark: SparkSession, mapping: EntityMapping, schema: T.StructType) -> DataFrame:
    """The registry rows a mapping asks for. Columns that are missing or of an unsupported type are all reported."""
    types = {name.lower(): kind for name, kind in value_types(schema).items()}
    present = {f.name.lower() for f in schema}
    problems = [
        f"{f.name}: column {f.column} " + ("has a type that cannot be a feature" if f.column.lower() in present else "does not exist")
        for f in mapping.features
        if f.column.lower() not in types
    ]
    problems += [
        f"{role} column {c} does not exist"
        for role, c in (("feature time", mapping.feature_time), ("entity id", mapping.entity_id_field))
        if c.lower() not in present
    ]
    if problems:
        raise MappingError(f"table {mapping.table}, entity type {mapping.entity_type}: " + "; ".join(problems))
    rows = [
        (mapping.entity_type, f.name, types[f.column.lower()], f.column, f.description, dict(f.labels), f.monitoring)
        for f in mapping.features
    ]
    return spark.createDataFrame(rows, FEATURES_SCHEMA)


def entity_type_rows(spark: SparkSession, mappings: Iterable[EntityMapping]) -> DataFrame:
    rows = {m.entity_type: (m.entity_type, m.description, dict(m.labels)) for m in mappings}
    return spark.createDataFrame(list(rows.values()), ENTITY_TYPES_SCHEMA)


def absent_rows(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted registry rows that do not exist yet. Existing rows are never changed."""
    keys = [c for c in ("entity_type", "feature_name") if c in wanted.columns]
    return wanted.join(stored.select(*keys), keys, "left_anti")


def feature_mapping(df: DataFrame, mapping: EntityMapping) -> DataFrame:
    """Feature -> column, for a table that has these columns."""
    feature_rows(df.sparkSession, mapping, df.schema)  # complains about what is missing
    rows = [(mapping.entity_type, name, column) for name, column in mapping.source_fields.items()]
    return df.sparkSession.createDataFrame(rows, "entity_type string, feature_name string, column_name string")


def type_mismatches(stored: DataFrame, mapping: EntityMapping, schema: T.StructType) -> DataFrame:
    """Mapped features whose stored type differs from the type of their column. Unmapped features are skipped."""
    spark = stored.sparkSession
    actual = feature_rows(spark, mapping, schema).select(
        "entity_type", "feature_name", "column_name", F.col("value_type").alias("table_type")
    )
    return (
        stored.select("entity_type", "feature_name", F.col("value_type").alias("stored_type"))
        .join(actual, ["entity_type", "feature_name"])
        .where(~F.col("stored_type").eqNullSafe(F.col("table_type")))
        .select("entity_type", "feature_name", "column_name", "stored_type", "table_type")
    )


class TypeMismatch(AssertionError):
    pass


def ingest_rows(df: DataFrame, mapping: EntityMapping, tie_break: str | None = None) -> DataFrame:
    """The mapped columns under their feature names, keyed by entity and feature time. ``tie_break`` orders rows that
    share both, in its own type."""
    tie = F.lit(None).cast("string") if tie_break is None else F.col(tie_break)
    return df.select(
        F.col(mapping.entity_id_field).alias("entity_id"),
        F.col(mapping.feature_time).alias("feature_time"),
        tie.alias("tie_break"),
        *[F.col(column).alias(feature) for feature, column in mapping.source_fields.items()],
    )


class FeatureStore:
    def __init__(self, store: TableStore, store_id: str):
        self.tables = store
        self.spark = store.spark
        self.store_id = store_id

    def create(self) -> None:
        """Make the database and its two registry tables unless they exist."""
        self.tables.create_database(self.store_id)
        self.tables.create_if_absent(self._name(ENTITY_TYPES), self.spark.createDataFrame([], ENTITY_TYPES_SCHEMA))
        self.tables.create_if_absent(self._name(FEATURES), self.spark.createDataFrame([], FEATURES_SCHEMA))

    def entity_types(self) -> DataFrame:
        return self.tables.read(self._name(ENTITY_TYPES))

    def features(self, entity_type: str | None = None) -> DataFrame:
        registry = self.tables.read(self._name(FEATURES))
        return registry if entity_type is None else registry.where(F.col("entity_type") == entity_type)

    def register(self, mapping: EntityMapping, schema: T.StructType) -> None:
        wanted = feature_rows(self.spark, mapping, schema)
        self._append_absent(ENTITY_TYPES, entity_type_rows(self.spark, [mapping]), self.entity_types())
        self._append_absent(FEATURES, wanted, self.features())

    def _append_absent(self, table: str, wanted: DataFrame, stored: DataFrame) -> None:
        # A mapping has few rows; collecting them keeps the append from reading the table it writes to.
        rows = absent_rows(wanted, stored).collect()
        if rows:
            self.tables.append(self._name(table), self.spark.createDataFrame(rows, wanted.schema))

    def check_types(self, mapping: EntityMapping, schema: T.StructType) -> None:
        found = type_mismatches(self.features(mapping.entity_type), mapping, schema).collect()
        if found:
            raise TypeMismatch(
                f"table {mapping.table}: "
                + "; ".join(f"feature {r.feature_name} is {r.stored_type}, column {r.column_name} is {r.table_type}" for r in found)
            )

    def ingest(self, mapping: EntityMapping, df: DataFrame, tie_break: str | None = None, batch_id: str | None = None) -> None:
        """Append exactly the mapped features. Features that are new to the entity type become columns, NULL in older
        rows; features left out are NULL in the new ones.

        With a ``batch_id`` the rows count as a whole or not at all, and ingesting the same batch again is a no-op
        (:meth:`TableStore.append_once`). Without one, ingesting a table again repeats its rows, which does not change what is served: of
        rows with equal entity and time, one is chosen by tie and values."""
        rows = ingest_rows(df, mapping, tie_break).select("*", F.to_date("feature_time").alias("feature_date"))
        if batch_id is None:
            self.tables.append(self._values(mapping.entity_type), rows, partition_by=["feature_date"], widen=True)
        else:
            self.tables.append_once(self._values(mapping.entity_type), rows, batch_id, partition_by=["feature_date"], widen=True)

    def values(self, entity_type: str) -> DataFrame:
        return self.tables.read(self._values(entity_type))

    def run(self, config: StoreConfig, tie_break: str | None = None, batch_id: str | None = None) -> None:
        """Register everything a (checked) configuration names, then check types or ingest, as its mode says. A run that failed
        half-way can be repeated under the same ``batch_id``: what it had ingested is not ingested again."""
        sources = [(mapping, self.tables.read(mapping.table)) for mapping in config.mappings]
        for mapping, frame in sources:  # all mappings before any change
            feature_rows(self.spark, mapping, frame.schema)
            if tie_break is not None and config.mode == "ingest" and tie_break.lower() not in {c.lower() for c in frame.columns}:
                raise MappingError(f"table {mapping.table}, entity type {mapping.entity_type}: tie break column {tie_break} does not exist")
        self.create()
        for mapping, frame in sources:
            self.register(mapping, frame.schema)
            if config.mode == "ingest":
                self.ingest(mapping, frame, tie_break, None if batch_id is None else f"{batch_id}:{mapping.table}")
            else:
                self.check_types(mapping, frame.schema)

    def serve(
        self,
        instances: DataFrame,
        feature_ids: dict[str, list[str]],
        pass_through: list[str] = (),
        time: str = "timestamp",
        until: str | None = None,
        **options,
    ) -> DataFrame:
        """As :func:`serve`, from the stored values. ``until`` (a date) keeps later values from being read; it must not
        be earlier than the latest instance, whose values would silently be out of date."""
        frames = {entity_type: self.values(entity_type) for entity_type in feature_ids}
        if until is not None:
            last = F.to_date(F.lit(until))
            latest = instances.agg(F.max(F.to_date(time)).alias("day")).select("day", (F.col("day") > last).alias("later")).first()
            if latest["later"]:
                raise ValueError(f"until {until} is before the latest instance, {latest['day']}")
            frames = {name: frame.where(F.col("feature_date") <= last) for name, frame in frames.items()}
        return serve(instances, frames, feature_ids, pass_through, time, **options)

    def _name(self, table: str) -> str:
        return f"{self.store_id}.{table}"

    def _values(self, entity_type: str) -> str:
        return self._name(f"values_{entity_type}")


def serve(
    instances: DataFrame,
    values: dict[str, DataFrame],
    feature_ids: dict[str, list[str]],
    pass_through: list[str] = (),
    time: str = "timestamp",
    per_feature: bool = False,
    limits: Limits | None = None,
) -> DataFrame:
    """Training rows: each instance with the features that were known at its time.

    ``instances`` has a time column and one id column per entity type, named after it; the ids come back as
    ``entity_type_<name>``. ``values`` maps entity types to tables as written by :meth:`FeatureStore.ingest`.
    """
    options = {"per_feature": per_feature} | ({} if limits is None else {"limits": limits})
    keep = [c for c in instances.columns if c == time or c in pass_through or c not in feature_ids]
    start = instances.select(*keep, *[F.col(e).alias(f"entity_type_{e}") for e in feature_ids])

    def add(rows: DataFrame, entity_type: str) -> DataFrame:
        known = FeatureRows(values[entity_type], "entity_id", "feature_time", feature_ids[entity_type], "tie_break")
        return asof_join(rows, f"entity_type_{entity_type}", time, known, **options)

    return reduce(add, feature_ids, start)


def profile(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(column_name, n_values)``: how many values, NULL not counted, each column holds. One pass; meant for stored tables."""
    names = list(columns)
    counts = df.agg(*[F.count(F.col(c)).alias(f"__{i}") for i, c in enumerate(names)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"__{i}").alias("n_values")) for i, c in enumerate(names)]
    return counts.select(F.inline(F.array(*entries)))
