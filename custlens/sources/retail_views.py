"""Logical retail tables (orders, products, customers, marketing) over the star-schema parquet files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("style"),
        F.col("p_size").alias("size"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
        F.col("p_retailprice").alias("base_price"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line; every third line has no price."""
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    heads = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """The prices of :func:`orders` alone, without the join."""
    lines = _table(spark, folder, "lineitem")
    return lines.select(F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Ages have gaps and values outside 15 to 100 on purpose."""
    people = _table(spark, folder, "customer")
    nations = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return people.join(nations, people.c_nationkey == nations.n_nationkey).select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(key % 17 != 0, (10 + key % 95).cast("double")).alias("age"),
        F.col("c_mktsegment").alias("gender"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 1000).cast("int")).alias("signup_date"),
    )


def event_counters() -> list[Column]:
    """Marketing counters of a group of events."""
    kind, value = F.col("event_type"), F.col("value")
    return [
        F.count_if(kind == "view").alias("impressions"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "purchase").alias("conversions"),
        F.sum(F.when(kind != "purchase", value).otherwise(0.0)).alias("spend"),
        F.sum(F.when(kind == "purchase", value).otherwise(0.0)).alias("revenue"),
    ]


def marketing(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty campaigns, one row per campaign and day."""
    campaign = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 20
    days = _table(spark, folder, "events").groupBy(campaign.alias("campaign_id"), F.col("ts").cast("date").alias("date"))
    return days.agg(*event_counters())
