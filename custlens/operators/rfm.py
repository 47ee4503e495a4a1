"""Customer aggregates, recency / frequency / monetary values and scores, segment profiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import (
    as_date,
    days_between,
    first_known,
    last_date,
    months_after,
    require_columns,
    total,
)
from custlens.functions.order_stats import exact_quantiles, modes
from custlens.operators.cleaning import quantile_scores
from custlens.operators.enrich import enrich
from custlens.operators.quality import coerce_dates, coerce_numeric
from custlens.session import stage

# Labels from the lowest to the highest quintile.
SCORE_LABELS = {"recency": [5, 4, 3, 2, 1], "frequency": [1, 2, 3, 4, 5], "monetary": [1, 2, 3, 4, 5]}
SCORE_NAMES = {"recency": "R", "frequency": "F", "monetary": "M"}


def customer_aggregate(
    sales: DataFrame,
    customer: str = "customer_id",
    date: str = "order_date",
    quantity: str = "quantity",
    amount: str = "amount",
    first: Sequence[str] = ("name", "age", "gender", "city"),
    order: Sequence[str] = ("order_date", "order_id"),
    customers: DataFrame | None = None,
    attributes: Sequence[str] = ("name", "age", "gender", "city"),
) -> DataFrame:
    """Per customer: first known attributes, summed quantity and amount, first, last and number of order dates.

    ``first`` are columns of the sales; ``attributes`` come from ``customers``, where they are the same for all orders, and
    are joined after the aggregation, so the orders of a very frequent customer are first added up where they lie.
    """
    per_customer = (
        sales.filter(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            *[first_known(c, order).alias(f"{c}_first") for c in first],
            total(quantity).alias("quantity_sum"),
            total(amount).alias("amount_sum"),
            F.min(date).alias("order_date_min"),
            F.max(date).alias("order_date_max"),
            F.count(date).alias("order_date_count"),
        )
    )
    if customers is None:
        return per_customer
    known = customers.select(customer, *[F.col(c).alias(f"{c}_first") for c in attributes])
    return per_customer.join(known, customer, "left")


def rfm(
    orders: DataFrame,
    as_of: Column | dt.date | str | None = None,
    offset_days: int = 0,
    window_months: int | None = None,
    customer: str = "customer_id",
    date: str = "order_date",
    amount: str = "amount",
    monetary: str = "monetary",
    customers: DataFrame | None = None,
    count: str = "rows",
) -> DataFrame:
    """recency (days from the last order to ``as_of`` + ``offset_days``), frequency and monetary per customer.

    ``as_of`` defaults to the last order date. ``window_months`` keeps orders of that many months up to
    ``as_of``. Text dates and amounts are converted first. Attributes of ``customers`` are added if given.
    Frequency counts all orders, or with ``count="dates"`` only those with a date.
    """
    if count not in ("rows", "dates"):
        raise ValueError(f"unknown count {count!r}")
    require_columns(orders, [customer, date, amount], "orders")
    kinds = dict(orders.dtypes)
    if kinds[date] == "string":
        orders = coerce_dates(orders, [date])
    if kinds[amount] == "string":
        orders = coerce_numeric(orders, [amount])
    pivot = None if as_of is None else as_date(as_of)
    if window_months is not None:
        pivot = last_date(orders, date) if pivot is None else pivot
        day = F.col(date)
        orders = orders.filter((day >= months_after(pivot, -window_months)) & (day <= pivot))
    per_customer = (
        orders.filter(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            F.max(date).alias("_last"),
            (F.count("*") if count == "rows" else F.count(date)).alias("frequency"),
            total(amount).alias(monetary),
        )
    )
    if pivot is None:
        # The last date follows from the customers' last dates, without reading the orders again.
        per_customer = stage(per_customer, "rfm-customers")
        pivot = last_date(per_customer, "_last")
    reference = F.date_add(pivot, offset_days) if offset_days else pivot
    result = per_customer.select(customer, days_between(reference, "_last").alias("recency"), "frequency", monetary)
    return enrich(result, customers, customer) if customers is not None else result


def rfm_checks(rfm_table: DataFrame, monetary: str = "monetary") -> DataFrame:
    """One row: customers, negative_monetary, non_positive_frequency, unknown_recency."""
    return rfm_table.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col(monetary) < 0).alias("negative_monetary"),
        F.count_if(F.col("frequency") <= 0).alias("non_positive_frequency"),
        F.count_if(F.col("recency").isNull()).alias("unknown_recency"),
    )


def rfm_scores(rfm_table: DataFrame) -> DataFrame:
    """Add R, F, M (quintiles, 5 is best) and their sum RFM_Score."""
    scored = quantile_scores(rfm_table, SCORE_LABELS, SCORE_NAMES)
    return scored.withColumn("RFM_Score", F.col("R") + F.col("F") + F.col("M"))


def segment_table(scored: DataFrame, aggregates: DataFrame, customer: str = "customer_id", segment: str = "segment") -> DataFrame:
    """Segments with the customer attributes, one row per customer known to both sides."""
    left = scored.select(customer, segment, "recency", "frequency", "monetary", "RFM_Score")
    return left.join(aggregates.select(customer, "age_first", "gender_first", "city_first"), customer)


def cluster_profile(
    scored: DataFrame,
    segment: str = "segment",
    measures: Sequence[str] = ("recency", "frequency", "monetary", "R", "F", "M", "RFM_Score"),
) -> DataFrame:
    """Mean of every measure per segment."""
    return scored.dropna(subset=[segment]).groupBy(segment).agg(*[F.avg(c).alias(f"avg_{c}") for c in measures])


def segment_profile(
    segments: DataFrame,
    segment: str = "segment",
    age: str = "age_first",
    modal: Sequence[str] = ("gender_first", "city_first"),
    measures: Sequence[str] = ("recency", "frequency", "monetary", "RFM_Score"),
) -> DataFrame:
    """Mean age and measures, most frequent gender and city per segment."""
    means = segments.dropna(subset=[segment]).groupBy(segment).agg(*[F.avg(c).alias(f"avg_{c}") for c in (age, *measures)])
    return means.join(modes(segments, modal, [segment]), segment, "left")


def segment_stats(df: DataFrame, features: Sequence[str], segment: str = "segment") -> DataFrame:
    """Mean, median, sample standard deviation and count of every feature per segment."""
    means = (
        df.dropna(subset=[segment])
        .groupBy(segment)
        .agg(
            *[
                fn(c).alias(f"{c}_{name}")
                for c in features
                for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("count", F.count))
            ]
        )
    )
    middle = exact_quantiles(df, features, [0.5], [segment])
    middle = middle.select(segment, *[F.col(f"{c}_q")[0].alias(f"{c}_median") for c in features])
    names = [f"{c}_{name}" for c in features for name in ("mean", "median", "std", "count")]
    return means.join(middle, segment, "left").select(segment, *names)


def segment_characteristics(
    segments: DataFrame, segment: str = "segment", gender: str = "gender_first", age: str = "age_first"
) -> DataFrame:
    """Size, means and a gender -> customers map per segment."""
    by_gender = (
        segments.dropna(subset=[segment])
        .groupBy(segment, gender)
        .agg(
            F.count("*").alias("_rows"),
            *[F.sum(c).alias(f"_{c}_sum") for c in ("monetary", "frequency", "recency", "RFM_Score", age)],
            *[F.count(c).alias(f"_{c}_n") for c in ("monetary", "frequency", "recency", "RFM_Score", age)],
        )
    )

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"_{c}_sum").cast("double"), F.sum(f"_{c}_n").cast("double"))

    entry = F.when(F.col(gender).isNotNull(), F.struct(F.col(gender), F.col("_rows")))
    return by_gender.groupBy(segment).agg(
        F.sum("_rows").alias("customers"),
        mean("monetary").alias("avg_clv"),
        mean("frequency").alias("avg_purchase_freq"),
        mean("monetary").alias("avg_order_value"),
        mean("recency").alias("avg_recency"),
        mean("RFM_Score").alias("avg_rfm_score"),
        mean(age).alias("avg_age"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("gender_distribution"),
    )


def segment_overview(segments: DataFrame, segment: str = "segment", monetary: str = "monetary") -> DataFrame:
    """One row: total_customers, segment_count, avg_clv."""
    return segments.agg(
        F.count("*").alias("total_customers"),
        F.countDistinct(segment).alias("segment_count"),
        F.avg(monetary).alias("avg_clv"),
    )


def segment_detail(segments: DataFrame, segment: str = "segment", monetary: str = "monetary") -> DataFrame:
    """Size and mean value, frequency and recency of every segment."""
    return (
        segments.dropna(subset=[segment])
        .groupBy(segment)
        .agg(
            F.count("*").alias("customers"),
            F.avg(monetary).alias("avg_clv"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("recency").alias("avg_recency"),
        )
    )
