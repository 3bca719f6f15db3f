"""Transaction-shaped readings of the generic test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: a user pays at terminal ``props.k``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("tx_id"),
        F.col("ts").alias("tx_ts"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
    )


def events_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("tx_id"), F.col("toxic").alias("tx_fraud")
    )


def orders_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as unlabelled transactions over seven years; the nation stands for the terminal."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").cast("string").alias("tx_id"),
        F.col("o_orderdate").alias("tx_ts"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("terminal_id"),
        F.col("o_totalprice").alias("tx_amount"),
    )


def lineitem_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions; ``tx_id`` is not unique here."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tx_id"),
        F.col("l_shipdate").alias("tx_ts"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_extendedprice").alias("tx_amount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("tx_fraud"),
        F.col("l_quantity"),
    )


def customer_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of every customer and supplier that did business, one row per pair."""
    pairs = lineitem_tx(spark, sf_dir).select("customer_id", "terminal_id").distinct()
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return (
        pairs.join(customer, F.col("customer_id") == F.col("c_custkey"))
        .join(supplier, F.col("terminal_id") == F.col("s_suppkey"))
        .drop("customer_id", "terminal_id")
    )
