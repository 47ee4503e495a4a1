"""Tables that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators import churn, cleaning, enrich, rfm
from custlens.session import stage
from custlens.sources import retail_views as views

CHURN_AS_OF = "2001-04-01"  # both churn windows hold orders around this day


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with completed prices and amounts."""
    return cleaning.price_orders(views.orders(spark, folder), views.products(spark, folder))


def with_segment(df: DataFrame) -> DataFrame:
    """A segment every engine can compute: five groups by customer number."""
    return df.withColumn("segment", (F.col("customer_id") % 5).cast("int"))


def assigned_segments(spark: SparkSession, folder: str) -> DataFrame:
    return with_segment(views.customers(spark, folder).select("customer_id"))


def rfm_table(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm(sales(spark, folder))


def staged_rfm(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table behind scores, segments and clusters: the orders are joined and aggregated once."""
    return stage(rfm_table(spark, folder), "rfm")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return with_segment(rfm.rfm_scores(staged_rfm(spark, folder)))


def wide_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer and product; prices are completed from the product that is joined anyway."""
    wide = enrich.denormalise_orders(views.orders(spark, folder), views.customers(spark, folder), views.products(spark, folder))
    return cleaning.add_amount(wide.withColumn("price", F.coalesce("price", "base_price")))


def segment_table(spark: SparkSession, folder: str) -> DataFrame:
    people = views.customers(spark, folder).select(
        "customer_id", F.col("age").alias("age_first"), F.col("gender").alias("gender_first"), F.col("city").alias("city_first")
    )
    return rfm.segment_table(scored(spark, folder), people)


def staged_segments(spark: SparkSession, folder: str) -> DataFrame:
    return stage(segment_table(spark, folder), "segments")


def product_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with segment and product attributes."""
    return with_segment(enrich.enrich(views.orders(spark, folder), views.products(spark, folder), "product_id"))


def campaign_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder).withColumn("campaign_id", (F.col("order_id") % 20).cast("int"))


def numeric_facts(spark: SparkSession, folder: str) -> DataFrame:
    """recency, frequency, monetary and age (with gaps) per customer."""
    ages = views.customers(spark, folder).select("customer_id", "age", "gender")
    return stage(enrich.enrich(rfm_table(spark, folder), ages, "customer_id"), "facts")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labels, predicted classes and scores of two models, computed from customer numbers."""
    key = F.col("customer_id")

    def entry(model: str, times: int, below: int, stride: int):
        return F.struct(
            F.lit(model).alias("model"),
            (key % 3 == 0).cast("int").alias("label"),
            (key * times % 10 < below).cast("int").alias("predicted"),
            ((key * stride % 101).cast("double") / 101).alias("score"),
        )

    both = F.array(entry("forest", 7, 4, 37), entry("boosted", 11, 6, 53))
    return views.customers(spark, folder).select("customer_id", F.inline(both))


def churn_rows(spark: SparkSession, folder: str) -> DataFrame:
    base = churn.churn_base(
        sales(spark, folder), views.customers(spark, folder), assigned_segments(spark, folder), as_of=CHURN_AS_OF
    )
    return churn.code_categories(stage(base, "churn-base"))


def churn_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """A probability per customer from the customer number, for the operators that read churn scores."""
    base = assigned_segments(spark, folder)
    return base.withColumn("churn_probability", (F.col("customer_id") * 29 % 97).cast("double") / 97)
