"""Tables kept on the way, so that a later step neither computes them again nor loses them with an executor."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from rollfeat.session import scratch_dir


ROWS_PER_TASK = 250_000


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did, if they have that folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, known]) if known else root
    return spark


class Store:
    """Parquet tables in one new folder below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, purpose: str):
        self._spark = spark
        self._root = scratch_dir(spark, purpose)
        self._count = 0

    def keep(self, df: DataFrame, most_rows: int | None = None) -> DataFrame:
        """Write the frame once; the result reads it back. Where at most so many rows are known to come, no more tasks than
        they need write them."""
        self._count += 1
        path = f"{self._root}/{self._count}"
        if most_rows is not None:
            df = df.coalesce(max(1, -(-most_rows // ROWS_PER_TASK)))
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def few(self, df: DataFrame, most_rows: int) -> DataFrame:
        """As :meth:`keep`, and no more tasks than they need read the rows: what one task reads is grouped and joined without a shuffle."""
        return self.keep(df, most_rows).coalesce(max(1, -(-most_rows // ROWS_PER_TASK)))
