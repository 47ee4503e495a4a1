"""Campaign, segment and daily performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import one_row, require_columns, return_on, safe_ratio, total
from custlens.operators.enrich import full_outer_by

COUNTERS = ("impressions", "clicks", "spend", "conversions", "revenue")


def campaign_kpis(marketing: DataFrame, campaign: str = "campaign_id") -> DataFrame:
    """Summed counters per campaign with CTR, CPC, CPM, conversion rate and ROI."""
    sums = marketing.dropna(subset=[campaign]).groupBy(campaign).agg(*[total(c).alias(c) for c in COUNTERS])
    return sums.select(
        "*",
        safe_ratio("clicks", "impressions", 100).alias("CTR"),
        safe_ratio("spend", "clicks").alias("CPC"),
        safe_ratio("spend", "impressions", 1000).alias("CPM"),
        safe_ratio("conversions", "clicks", 100).alias("conversion_rate"),
        return_on("revenue", "spend").alias("ROI"),
    )


def campaign_performance(
    marketing: DataFrame,
    sales: DataFrame | None = None,
    campaign: str = "campaign_id",
    date: str = "date",
    spend: str = "spend",
    revenue: str = "revenue",
    order: str = "order_id",
) -> DataFrame:
    """Spend, revenue, ROI per campaign; with ``sales`` also distinct orders, quantity, amount and cost per order.

    Both sides are aggregated to campaigns before they are joined.
    """
    require_columns(marketing, [campaign, date, spend], "marketing")
    measures = [spend] + ([revenue] if revenue in marketing.columns else [])
    result = marketing.dropna(subset=[campaign]).groupBy(campaign).agg(*[total(c).alias(c) for c in measures])
    if revenue in measures:
        result = result.withColumn("roi", return_on(revenue, spend))
    if sales is not None and campaign in sales.columns:
        sold = (
            sales.dropna(subset=[campaign])
            .groupBy(campaign)
            .agg(
                F.countDistinct(order).alias("orders"),
                total("quantity").alias("quantity"),
                total("amount").alias("amount"),
            )
        )
        result = result.join(sold, campaign, "left").withColumn("cpa", safe_ratio(spend, "orders"))
    return result


def campaign_totals(performance: DataFrame, spend: str = "spend", revenue: str = "revenue") -> DataFrame:
    """One row: total_spend, avg_roi (mean of the campaign ROIs), total_orders, total_revenue as far as known."""
    wanted = [total(spend).alias("total_spend")]
    if "roi" in performance.columns:
        wanted.append(F.avg("roi").alias("avg_roi"))
    if "orders" in performance.columns:
        wanted.append(total("orders").alias("total_orders"))
    if revenue in performance.columns:
        wanted.append(total(revenue).alias("total_revenue"))
    return performance.agg(*wanted)


def segment_performance(
    orders: DataFrame,
    segments: DataFrame,
    marketing: DataFrame,
    customer: str = "customer_id",
    segment: str = "segment",
    order: str = "order_id",
    revenue: str = "price",
) -> DataFrame:
    """Orders, revenue, basket, orders per buying customer, spend shared by customer count, ROI per segment.

    ``segments`` has one row per customer. Orders are reduced to customers first, so the join moves one row
    per customer and a very frequent customer is one row too.
    """
    per_customer = (
        orders.dropna(subset=[customer])
        .groupBy(customer)
        .agg(F.count(order).alias("_orders"), F.sum(revenue).alias("_revenue"))
    )
    assigned = segments.select(customer, segment).dropna(subset=[segment])
    sold = (
        per_customer.join(assigned, customer)
        .groupBy(segment)
        .agg(
            F.sum("_orders").alias("orders"),
            total("_revenue").alias("revenue"),
            F.count("*").alias("_buyers"),
        )
    )
    sizes = assigned.groupBy(segment).agg(F.count("*").alias("customers"))
    spend = one_row(marketing, total("spend").alias("spend"))["spend"]
    everyone = one_row(segments, F.count("*").alias("rows"))["rows"]
    return (
        sold.join(sizes, segment)
        .select(
            segment,
            "customers",
            "orders",
            "revenue",
            safe_ratio("revenue", "orders").alias("avg_order_value"),
            safe_ratio("orders", "_buyers", 100).alias("conversion_rate"),
            (spend * safe_ratio(F.col("customers"), everyone)).alias("spend"),
        )
        .withColumn("ROI", return_on("revenue", "spend"))
    )


def daily_marketing(marketing: DataFrame, date: str = "date") -> DataFrame:
    """Marketing counters per day with CTR and CPC."""
    sums = marketing.dropna(subset=[date]).groupBy(date).agg(*[total(c).alias(c) for c in COUNTERS])
    return sums.select(
        F.col(date).alias("date"),
        "impressions",
        "clicks",
        "spend",
        "conversions",
        F.col("revenue").alias("campaign_revenue"),
        safe_ratio("clicks", "impressions", 100).alias("CTR"),
        safe_ratio("spend", "clicks").alias("CPC"),
    )


def daily_orders(orders: DataFrame, date: str = "order_date", order: str = "order_id", revenue: str = "price") -> DataFrame:
    """Number and revenue of orders per day."""
    return (
        orders.dropna(subset=[date])
        .groupBy(F.col(date).alias("date"))
        .agg(F.count(order).alias("orders"), total(revenue).alias("sales_revenue"))
    )


def temporal_trends(marketing: DataFrame, orders: DataFrame, revenue: str = "price") -> DataFrame:
    """Both daily tables side by side, in date order; a missing side adds 0 to total_revenue."""
    both = full_outer_by(daily_marketing(marketing), daily_orders(orders, revenue=revenue), "date")
    nothing = F.lit(0.0)
    together = F.coalesce("campaign_revenue", nothing) + F.coalesce("sales_revenue", nothing)
    return both.withColumn("total_revenue", together).orderBy("date")


def kpi_totals(campaigns: DataFrame) -> DataFrame:
    """One row of totals; CTR and ROI are ratios of the sums, 0 without a denominator."""
    sums = campaigns.agg(*[total(c).alias(f"total_{c}") for c in COUNTERS])
    zero = F.lit(0.0)
    return sums.select(
        "*",
        F.coalesce(safe_ratio("total_clicks", "total_impressions", 100), zero).alias("avg_ctr"),
        F.coalesce(return_on("total_revenue", "total_spend"), zero).alias("avg_roi"),
    )


def best_worst(df: DataFrame, name: str, metric: str) -> DataFrame:
    """One row: the names with the largest and smallest metric; the smallest name wins a tie."""
    known = F.col(metric).isNotNull()
    return df.agg(
        F.min_by(name, F.when(known, F.struct(-F.col(metric), F.col(name)))).alias(f"best_{name}"),
        F.max(metric).alias(f"best_{metric}"),
        F.min_by(name, F.when(known, F.struct(F.col(metric), F.col(name)))).alias(f"worst_{name}"),
        F.min(metric).alias(f"worst_{metric}"),
    )


def trend_signal(
    daily: DataFrame, value: str, date: str = "date", last_days: int = 7, factor: float = 1.2, more_than: int = 30
) -> DataFrame:
    """One row: how far the mean of the last rows is above the overall mean, in percent, and whether it counts.

    ``is_rising`` needs more than ``more_than`` days and a recent mean above ``factor`` times the overall mean.
    """
    recent = one_row(daily.orderBy(F.desc(date)).limit(last_days), F.avg(value).alias("mean"))["mean"]
    overall = daily.agg(F.count("*").alias("days"), F.avg(value).alias("overall_mean"))
    above: Column = (F.try_divide(F.col("recent_mean"), F.col("overall_mean")) - 1) * 100
    rising = (F.col("days") > more_than) & (F.col("recent_mean") > F.col("overall_mean") * factor)
    return (
        overall.withColumn("recent_mean", recent)
        .withColumn("pct_above", above)
        .withColumn("is_rising", F.coalesce(rising, F.lit(False)))
    )

