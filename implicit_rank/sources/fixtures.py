"""Interaction tables derived from the driver's TPC-H-like tables.

* purchases: ``lineitem`` joined to ``orders`` on the order key, grouped by
  (customer, part), ``cnt`` = sum of quantities.
* events: ``user_id`` x the ``k`` field of the JSON ``props``, ``cnt`` = number
  of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, cnt DOUBLE) from lineitem x orders.

    Only the four needed columns are read. The join is an equi-join on the
    order key (sort-merge, or broadcast when AQE measures a small side); the
    aggregation is partial before the shuffle on (user, item).
    """
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"]).where(
        F.col("l_partkey").isNotNull()
    )
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"]).where(
        F.col("o_custkey").isNotNull()
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.sum("l_quantity").alias("cnt"))
    )


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, cnt BIGINT) from events; item = ``props.k``."""
    events = read_table(spark, sf_dir, "events", ["user_id", "props"])
    item = F.get_json_object("props", "$.k").cast("bigint")
    return (
        events.select("user_id", item.alias("item_id"))
        .where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
        .groupBy("user_id", "item_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
