"""Row cleaning, price completion and scalar derivations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import as_date, attach, last_date, months_after, one_row, require_columns
from custlens.functions.order_stats import medians, quantile_struct, running_totals
from custlens.session import stage


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_median(df: DataFrame, column: str) -> DataFrame:
    middle = medians(df, [column]).select(f"{column}_median").scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), middle))


def fill_constant(df: DataFrame, column: str, value: float = 0) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def filter_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with low <= column <= high; NULL is outside."""
    return df.filter(F.col(column).between(low, high))


def fill_price(
    orders: DataFrame,
    products: DataFrame,
    key: str = "product_id",
    price: str = "price",
    base_price: str = "base_price",
    mode: str = "coalesce",
    prices: DataFrame | None = None,
) -> DataFrame:
    """Complete order prices from the product list.

    ``coalesce`` fills single gaps. ``all_missing`` takes the list price for every order, but only if no
    order has a price. ``overwrite_if_any`` takes it for every order as soon as one price is missing.
    An order table without a price column gets the list prices in every mode. The last two modes look at all prices
    first; ``prices``, a cheaper table with the same price column, spares computing the orders twice.
    """
    require_columns(products, [key, base_price], "product list")
    listed = products.select(key, F.col(base_price).alias("_listed"))
    joined = orders.join(listed, key, "left")
    if price not in orders.columns:
        return joined.withColumnRenamed("_listed", price)
    if mode == "coalesce":
        filled = F.coalesce(price, "_listed")
    elif mode in ("all_missing", "overwrite_if_any"):
        counts = one_row(orders if prices is None else prices, F.count(price).alias("priced"), F.count("*").alias("rows"))
        replace = counts["priced"] == 0 if mode == "all_missing" else counts["priced"] < counts["rows"]
        filled = F.when(replace, F.col("_listed")).otherwise(F.col(price))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.select(*[filled.alias(price) if c == price else F.col(c) for c in orders.columns])


def add_amount(orders: DataFrame, quantity: str = "quantity", price: str = "price", amount: str = "amount") -> DataFrame:
    """amount = quantity * price; an amount that is already there is kept where either is missing."""
    product = F.col(quantity) * F.col(price)
    if amount in orders.columns:
        product = F.coalesce(product, F.col(amount))
    return orders.withColumn(amount, product)


def price_orders(orders: DataFrame, products: DataFrame, key: str = "product_id", mode: str = "coalesce") -> DataFrame:
    """Completed prices and amounts in one pass over the orders."""
    return add_amount(fill_price(orders, products, key, mode=mode))


def period_filter(
    df: DataFrame,
    date: str,
    as_of: Column | dt.date | str | None = None,
    months_back: int | None = None,
    months_ahead: int | None = None,
) -> DataFrame:
    """Calendar-month windows around ``as_of`` (default: last date in the table).

    ``months_back`` keeps [as_of - n months, as_of]; ``months_ahead`` keeps (as_of, as_of + n months].
    """
    if (months_back is None) == (months_ahead is None):
        raise ValueError("give months_back or months_ahead")
    pivot = last_date(df, date) if as_of is None else as_date(as_of)
    day = F.col(date)
    if months_back is not None:
        return df.filter((day >= months_after(pivot, -months_back)) & (day <= pivot))
    return df.filter((day > pivot) & (day <= months_after(pivot, months_ahead)))


def range_select(df: DataFrame, date: str, period: str) -> DataFrame:
    """Trailing period up to the last date: 1m, 6m, 1y, YTD or all."""
    last = last_date(df, date)
    starts = {
        "1m": lambda: months_after(last, -1),
        "6m": lambda: months_after(last, -6),
        "1y": lambda: months_after(last, -12),
        "YTD": lambda: F.trunc(last, "year"),
    }
    if period == "all":
        return df
    if period not in starts:
        raise ValueError(f"unknown period {period!r}")
    return df.filter(F.col(date) >= starts[period]())


def flag_threshold(df: DataFrame, score: str, threshold: float = 0.5, flag: str = "at_risk") -> DataFrame:
    return df.withColumn(flag, F.col(score) >= F.lit(threshold))


def _scores_from_edges(value: Column, edges: Column, labels: Sequence[int], fallback: int) -> Column:
    """Right-closed bins. Fewer bins than labels (equal edges) means the fallback for every row."""
    bins = len(labels)
    degenerate = reduce(lambda a, b: a | b, [edges[i] == edges[i + 1] for i in range(bins)])
    chain = F.when(value <= edges[1], F.lit(labels[0]))
    for i in range(1, bins - 1):
        chain = chain.when(value <= edges[i + 1], F.lit(labels[i]))
    scored = F.when(degenerate, F.lit(fallback)).otherwise(chain.otherwise(F.lit(labels[-1])))
    return F.when(value.isNotNull(), scored)


def quantile_scores(
    df: DataFrame, labels: Mapping[str, Sequence[int]], names: Mapping[str, str] | None = None, fallback: int = 3
) -> DataFrame:
    """Score columns by equal-frequency bins, all columns in one quantile pass.

    ``labels`` gives, per column, the labels from the lowest to the highest bin; ``names`` the score columns.
    """
    names = names or {c: f"{c}_score" for c in labels}
    sizes = {len(v) for v in labels.values()}
    if len(sizes) != 1:
        raise ValueError("every column needs the same number of labels")
    bins = sizes.pop()
    probs = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    edges = F.col("_edges")
    return (
        attach(df, "_edges", quantile_struct(df, list(labels), probs))
        .withColumns(
            {
                names[c]: _scores_from_edges(F.col(c).cast("double"), edges[f"{c}_q"], wanted, fallback)
                for c, wanted in labels.items()
            }
        )
        .drop("_edges")
    )


CATEGORY_VALUES = 100_000  # distinct values that one task ranks, about


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): dense codes from 0 in sorted order of the distinct values; NULL counts as the text 'nan'.

    Values are ranked inside ranges; their number follows from that of the distinct values, so a task ranks about
    ``CATEGORY_VALUES`` of them at every size, whatever the values have in common. The distinct values are staged, as counting,
    ranging and ranking read them.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    distinct = stage(df.select(value.alias("value")).distinct(), "categories")
    ranges = max(1, -(-distinct.count() // CATEGORY_VALUES))
    ranged = distinct.repartitionByRange(ranges, "value").withColumn("_range", F.spark_partition_id()).withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(stage(ranged, "category-ranges"), ["value"], ["one"], slot=F.col("_range"))
    return ranked.select("value", F.col("one_before").cast("int").alias("code"))


def encode_categories(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace category columns by their codes, or with ``suffix`` add the codes as further columns."""
    result = df
    for column in columns:
        codes = category_codes(df, column).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
        joined = result.withColumn("_value", text).join(codes, "_value", "left").drop("_value")
        result = joined.withColumn(f"{column}{suffix}", F.col("_code")).drop("_code")
    return result


def project(df: DataFrame, columns: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Select, rename and cast: {new name: old name or (old name, type)}."""
    picked = []
    for new, old in columns.items():
        name, kind = (old, None) if isinstance(old, str) else old
        column = F.col(name).cast(kind) if kind else F.col(name)
        picked.append(column.alias(new))
    return df.select(*picked)
