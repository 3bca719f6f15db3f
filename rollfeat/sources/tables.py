"""Declared source tables, and the tables the package creates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.operators.quality import ChecksFailed
from rollfeat.session import scratch_dir

TX_COLUMNS = ("tx_id", "tx_ts", "customer_id", "terminal_id", "tx_amount")
LABEL_COLUMNS = ("tx_id", "tx_fraud")


class Sources:
    """Logical source names bound to catalog tables (``db.table``) or Parquet folders (anything with a slash)."""

    def __init__(self, spark: SparkSession, locations: Mapping[str, str]):
        self._spark = spark
        self._locations = dict(locations)

    def load(self, name: str) -> DataFrame:
        if name not in self._locations:
            raise KeyError(f"source {name!r} is not declared; declared: {', '.join(sorted(self._locations))}")
        location = self._locations[name]
        return self._spark.read.parquet(location) if "/" in location else self._spark.table(location)


class ColumnsDiffer(ValueError):
    pass


# The partition column of tables that are written in batches, and the table of their commit records.
ATTEMPT = "batch_attempt"
COMMITS = "{}__commits"
COMMIT_SCHEMA = "version long, batch_id string, batch_attempt string, replaces boolean, n_rows long, n_files long, committed_at timestamp"


class TableStore:
    """Databases below one root folder, with the four ways of writing a table the pipeline needs.

    Writes that are partitioned by a column are rebalanced on it first, so that a date does not end in one small file
    per task and adaptive execution splits a date that is too large for one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create_database(self, name: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/{name}.db'")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def read(self, table: str) -> DataFrame:
        """The rows of a table; of one that is written in batches, the rows of committed batches."""
        rows = self.spark.table(table)
        if ATTEMPT not in rows.columns:
            return rows
        return rows.join(self._valid(table).select(ATTEMPT), ATTEMPT, "left_semi").drop(ATTEMPT)

    def create_if_absent(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> bool:
        """CREATE TABLE IF NOT EXISTS ... AS SELECT. True if the table was created."""
        if self.exists(table):
            return False
        self._writer(df, partition_by).mode("ignore").saveAsTable(table)
        return True

    def overwrite(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Replace the table. The rows are computed to the scratch folder first, so a computation that fails leaves the old
        table, and they may come from it."""
        if self.exists(table):
            path = scratch_dir(self.spark, "overwrite")
            df.write.parquet(path)
            df = self.spark.read.schema(df.schema).parquet(path)
        self._writer(df, partition_by).mode("overwrite").saveAsTable(table)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), widen: bool = False) -> None:
        """Plain append: no key is checked and no row replaced. Columns are matched by name.

        Nothing is dropped: if the columns differ, the append is refused. With ``widen``, columns the table lacks are
        added to it (NULL in the rows it has), and columns the frame lacks are NULL in the new rows.
        """
        if self.exists(table):
            stored = self.spark.table(table).schema
            known, given = {f.name.lower() for f in stored}, {f.name.lower() for f in df.schema}
            added = [f for f in df.schema if f.name.lower() not in known]
            absent = [f for f in stored if f.name.lower() not in given]
            if (added or absent) and not widen:
                differing = "; ".join(f"{what}: {', '.join(f.name for f in fields)}" for what, fields in (("not in the table", added), ("not in the new rows", absent)) if fields)
                raise ColumnsDiffer(f"{table} has other columns than the rows to append ({differing}); a full refresh replaces the table")
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in absent]
            df = df.select("*", *nothing).select(*self.spark.table(table).columns)
        self._writer(df, partition_by).mode("append").saveAsTable(table)

    # --- batches -----------------------------------------------------------------------------------------------------

    def append_once(
        self,
        table: str,
        df: DataFrame,
        batch_id: str,
        partition_by: Sequence[str] = (),
        widen: bool = False,
        replace: bool = False,
        checks: Mapping[str, Column] | None = None,
    ) -> bool:
        """Append a batch that counts as a whole or not at all. False if it was committed before: nothing is written then.

        Every attempt writes to a partition of its own. Its commit record (batch, attempt, rows, files) is written last, and :meth:`read` sees
        the attempts that have one; of several attempts at one batch only the first committed. What a failed attempt left is never
        read, and :meth:`drop_uncommitted` removes it. With ``replace``, the batch takes the place of all rows before it.

        ``checks`` are conditions that every row must meet. They are counted in the pass that writes, and a batch with a row that does not
        meet one (or for which it is NULL) is not committed.
        """
        if self.exists(table) and ATTEMPT not in self.spark.table(table).columns:
            raise ValueError(f"{table} was not made for batches; copy it into a table that is")
        if self.is_committed(table, batch_id):
            return False
        attempt = uuid.uuid4().hex
        seen = Observation(f"batch-{attempt}")
        names = list(checks or {})
        failures = [F.count_if(~F.coalesce(checks[name], F.lit(False))).alias(f"failed_{i}") for i, name in enumerate(names)]
        observed = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *failures)
        self.append(table, observed.withColumn(ATTEMPT, F.lit(attempt)), [ATTEMPT, *partition_by], widen)
        found = seen.get
        failed = [f"{name}: {found[f'failed_{i}']} failing rows" for i, name in enumerate(names) if found[f"failed_{i}"]]
        if failed:
            raise ChecksFailed("; ".join(failed))
        written = self.spark.table(table).where(F.col(ATTEMPT) == attempt)
        n_rows, n_files = written.agg(F.count(F.lit(1)), F.count_distinct("_metadata.file_path")).first()
        if n_rows != found["n_rows"]:
            raise RuntimeError(f"batch {batch_id} of {table}: {found['n_rows']} rows were computed, {n_rows} are stored; it is not committed")
        self._commit(table, batch_id, attempt, replace, n_rows, n_files)
        return True

    def is_committed(self, table: str, batch_id: str) -> bool:
        return not self.commits(table).where(F.col("batch_id") == batch_id).isEmpty()

    def commits(self, table: str) -> DataFrame:
        """One row for each commit record of a table."""
        name = COMMITS.format(table)
        return self.spark.table(name) if self.exists(name) else self.spark.createDataFrame([], COMMIT_SCHEMA)

    def drop_uncommitted(self, table: str) -> int:
        """Remove what failed attempts left; no writer may be at work. The number of attempts removed."""
        valid = self.commits(table).select(ATTEMPT)
        gone = [r[0] for r in self.spark.table(table).select(ATTEMPT).distinct().join(valid, ATTEMPT, "left_anti").collect()]
        location = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        folders = [self.spark._jvm.org.apache.hadoop.fs.Path(f"{location}/{ATTEMPT}={attempt}") for attempt in gone]
        for folder in folders:
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.spark.catalog.refreshTable(table)
        return len(gone)

    def _commit(self, table: str, batch_id: str, attempt: str, replaces: bool, n_rows: int, n_files: int) -> None:
        last = self.commits(table).agg(F.max("version")).first()[0]
        record = self.spark.range(1).select(
            F.lit((last or 0) + 1).cast("long").alias("version"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(attempt).alias(ATTEMPT),
            F.lit(replaces).alias("replaces"),
            F.lit(n_rows).cast("long").alias("n_rows"),
            F.lit(n_files).cast("long").alias("n_files"),
            F.current_timestamp().alias("committed_at"),
        )
        record.write.format("parquet").mode("append").saveAsTable(COMMITS.format(table))

    def _valid(self, table: str) -> DataFrame:
        """The attempts that count: the first of each batch, from the last replacing one on."""
        commits = self.commits(table)
        first = commits.groupBy("batch_id").agg(F.min(F.struct("version", ATTEMPT)).alias("first"))
        start = commits.where("replaces").agg(F.max(F.struct("version", ATTEMPT))).scalar()
        return first.where(start.isNull() | (F.col("first") >= start)).select(f"first.{ATTEMPT}")

    def replace_partitions(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Replace the partitions that ``df`` has rows of and leave all others. Rows are computed to the scratch folder first, so
        they may come from the table, and a computation that fails changes nothing."""
        if ATTEMPT in self.spark.table(table).columns:
            raise ValueError(f"{table} is written in batches, which are never changed")
        path = scratch_dir(self.spark, "replace")
        rows = df.select(*self.read(table).columns)
        rows.write.parquet(path)
        # The mode is a setting of the session; one of its own leaves the caller's as it is.
        session = self.spark.newSession()
        session.conf.set("spark.sql.session.timeZone", self.spark.conf.get("spark.sql.session.timeZone"))
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        session.read.schema(rows.schema).parquet(path).hint("rebalance", *partition_by).write.insertInto(table, overwrite=True)
        self.spark.catalog.refreshTable(table)

    def drop_database(self, name: str) -> None:
        """The database with all its tables and their files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")

    @contextmanager
    def view(self, name: str, df: DataFrame) -> Iterator[DataFrame]:
        """The rows under a name that SQL can use, for as long as the block lasts. Frames made of it outlive it."""
        df.createTempView(name)
        try:
            yield self.spark.table(name)
        finally:
            self.spark.catalog.dropTempView(name)

    @staticmethod
    def _writer(df: DataFrame, partition_by: Sequence[str]):
        if not partition_by:
            return df.write.format("parquet")
        return df.hint("rebalance", *partition_by).write.format("parquet").partitionBy(*partition_by)


def copy_transactions(store: TableStore, table: str, raw: DataFrame) -> bool:
    """The transaction columns of a raw table, partitioned by event date."""
    columns = [F.col(c).alias(c) for c in TX_COLUMNS]
    return store.create_if_absent(
        table, raw.select(*columns, F.to_date("tx_ts").alias("tx_date")), partition_by=["tx_date"]
    )


def copy_labels(store: TableStore, table: str, raw: DataFrame) -> bool:
    return store.create_if_absent(table, raw.select(*[F.col(c).alias(c) for c in LABEL_COLUMNS]))


def copy_profiles(store: TableStore, table: str, raw: DataFrame) -> bool:
    """Any table, with all its columns."""
    return store.create_if_absent(table, raw)


def typed(df: DataFrame) -> DataFrame:
    """Whole numbers as long, fractions as double, text and booleans as they are; other types stay untouched."""

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType, T.DoubleType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[cast(f) for f in df.schema])


def typed_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL (over tables, or frames named in braces) and cast the result as :func:`typed` does."""
    return typed(spark.sql(sql, **frames))


def fetch(df: DataFrame, max_rows: int = 1_000_000):
    """A bounded result as a pandas frame. Refuses to move more than ``max_rows`` rows rather than cutting them off."""
    result = typed(df).limit(max_rows + 1).toPandas()
    if len(result) > max_rows:
        raise ValueError(f"the result has more than {max_rows} rows; sample it first or keep it in Spark")
    return result
