"""Counts, preferences and value by segment and product attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.columns import last_date, total
from custlens.functions.order_stats import frequencies, medians, quantiles_of, with_slots
from custlens.operators.enrich import share_of_total
from custlens.session import stage


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows per non-null value, most frequent first; ``normalize`` gives percentages instead."""
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("count"))
    if normalize:
        counts = share_of_total(counts, "count", "pct").drop("count")
    return counts.orderBy(F.desc("pct" if normalize else "count"), column)


def group_size(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("count"))


def top_per_group(df: DataFrame, group: str, item: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent items of each group. Spark keeps n rows per group and task before the shuffle."""
    ranking = Window.partitionBy(group).orderBy(F.desc("count"), item)
    return group_size(df, group, item).withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= n)


def product_preferences(
    sales: DataFrame,
    segment: str = "segment",
    attributes: Sequence[str] = ("category", "style", "size", "color"),
    order: str = "order_id",
) -> DataFrame:
    """(segment, attribute, value, orders) for all attributes in one scan, sorted within segment.

    Rows are first counted by the combination of all attributes, then each combination feeds its attributes.
    """
    combos = sales.dropna(subset=[segment]).groupBy(segment, *attributes).agg(F.count(order).alias("_orders"))
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    return (
        combos.select(segment, "_orders", F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy(segment, "attribute", "value")
        .agg(F.sum("_orders").alias("orders"))
        .orderBy(segment, "attribute", F.desc("orders"), "value")
    )


def basket_stats(sales: DataFrame, segment: str = "segment", price: str = "price") -> DataFrame:
    """Mean, median and number of prices per segment, all from one count of equal prices."""
    counts = stage(frequencies(sales, [price], [segment]), "prices")
    whole = F.sum("_n")
    means = counts.groupBy(segment).agg((F.sum(F.col("_v") * F.col("_n")) / whole).alias("mean"), whole.alias("count"))
    middle = quantiles_of(stage(with_slots(counts), "slots"), [price], [0.5], [segment])
    return means.join(middle, segment, "left").select(segment, "mean", F.col(f"{price}_q")[0].alias("median"), "count")


def segment_value(
    segments: DataFrame,
    orders: DataFrame,
    customer: str = "customer_id",
    segment: str = "segment",
    revenue: str = "amount",
) -> DataFrame:
    """Revenue per segment, its mean and median per customer, customers, share; no order counts as 0."""
    spent = orders.dropna(subset=[customer]).groupBy(customer).agg(total(revenue).cast("double").alias("_spent"))
    valued = (
        segments.select(customer, segment)
        .dropna(subset=[segment])
        .join(spent, customer, "left")
        .withColumn("_spent", F.coalesce("_spent", F.lit(0.0)))
    )
    sums = valued.groupBy(segment).agg(
        F.sum("_spent").alias("total_revenue"), F.avg("_spent").alias("avg_revenue"), F.count("_spent").alias("customer_count")
    )
    middle = medians(valued, ["_spent"], [segment]).withColumnRenamed("_spent_median", "median_revenue")
    together = sums.join(middle, segment, "left")
    grand_total = valued.agg(F.sum("_spent")).scalar()
    return together.select(
        segment,
        "total_revenue",
        "avg_revenue",
        "median_revenue",
        "customer_count",
        (F.try_divide("total_revenue", grand_total) * 100).alias("revenue_pct"),
    )


def add_tenure(df: DataFrame, signup: str = "signup_date", tenure: str = "tenure_days") -> DataFrame:
    """Days from the signup to the latest signup of the table."""
    return df.withColumn(tenure, F.datediff(last_date(df, signup), F.col(signup)))


def segment_tenure(df: DataFrame, segment: str = "segment", signup: str = "signup_date") -> DataFrame:
    return add_tenure(df, signup).dropna(subset=[segment]).groupBy(segment).agg(F.avg("tenure_days").alias("avg_tenure_days"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def count_distinct(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(f"{c}_distinct") for c in columns])
