"""Customer lifetime value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import one_row, require_columns, total
from custlens.operators.cleaning import period_filter
from custlens.operators.enrich import enrich
from custlens.session import stage


def clv_margin(
    orders: DataFrame,
    as_of: Column | dt.date | str | None = None,
    months: int = 12,
    margin: float = 0.3,
    retention_months: int = 12,
    customer: str = "customer_id",
    date: str = "order_date",
    amount: str = "amount",
    customers: DataFrame | None = None,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Margin of the last ``months``: mean per order * orders per month * months the customer stays."""
    recent = period_filter(orders, date, as_of, months_back=months).dropna(subset=[customer])
    per_customer = recent.groupBy(customer).agg(
        F.min(date).alias("first_purchase"),
        F.max(date).alias("last_purchase"),
        F.count(date).alias("purchase_count"),
        total(F.col(amount) * margin).alias("total_margin"),
    )
    result = (
        per_customer.withColumn("purchase_freq", F.col("purchase_count") / F.lit(float(months)))
        .withColumn("avg_order_value", F.try_divide("total_margin", "purchase_count"))
        .withColumn("clv", F.col("avg_order_value") * F.col("purchase_freq") * retention_months)
    )
    for table in (customers, segments):
        if table is not None:
            result = enrich(result, table, customer)
    return result


def clv_projected(
    transactions: DataFrame,
    retention: float = 0.7,
    years: int = 3,
    customer: str = "customer_id",
    date: str = "date",
    amount: str = "amount",
    customers: DataFrame | None = None,
) -> DataFrame:
    """Mean amount * orders per year * expected years as a customer * projected years."""
    require_columns(transactions, [customer, date, amount], "transactions")
    per_customer = transactions.groupBy(customer).agg(
        F.avg(amount).alias("avg_order_value"),
        F.count(date).alias("total_orders"),
        F.min(date).alias("_first"),
        F.max(date).alias("_last"),
    )
    per_customer = stage(per_customer, "clv-customers")  # the span of all dates follows from the customers' dates
    days_active = one_row(per_customer, F.datediff(F.max("_last"), F.min("_first")).alias("days"))["days"]
    years_active = F.greatest(days_active / F.lit(365.0), F.lit(0.1))
    lifespan = 1 / (1 - retention)
    result = (
        per_customer.dropna(subset=[customer])
        .drop("_first", "_last")
        .withColumn("_years", years_active)
        .withColumn("purchase_frequency", F.col("total_orders") / F.col("_years"))
        .drop("_years")
        .withColumn("clv", F.col("avg_order_value") * F.col("purchase_frequency") * lifespan * years)
    )
    return enrich(result, customers, customer) if customers is not None else result


def top_customers(df: DataFrame, n: int = 10, value: str = "clv", customer: str = "customer_id") -> DataFrame:
    """The ``n`` largest values; the smallest id wins a tie."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.desc(value), customer).limit(n)
