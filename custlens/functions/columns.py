"""Column expressions used by more than one operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "input") -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")


def one_row(df: DataFrame, *aggregates: Column) -> Column:
    """The aggregates of ``df`` as a struct usable inside any other query.

    It becomes an uncorrelated scalar subquery: computed once, never collected by the caller, and
    no join is needed to bring a total or a last date to every row.
    """
    return df.agg(F.struct(*aggregates).alias("one_row")).scalar()


def attach(df: DataFrame, name: str, scalar: Column) -> DataFrame:
    """Add a scalar as a column, for use in several expressions.

    Every mention of a scalar subquery is planned on its own, so a scalar is named once and its column
    is used from then on.
    """
    return df.withColumn(name, scalar)


def as_date(value: Column | dt.date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def last_date(df: DataFrame, column: str) -> Column:
    return one_row(df, F.max(column).cast("date").alias("last"))["last"]


def months_after(date: Column, months: int) -> Column:
    """Calendar months, clamped to the end of shorter months."""
    return F.add_months(date, months)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days; negative when ``later`` comes first."""
    return F.datediff(later, earlier)


def safe_ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """numerator / denominator * scale, NULL when the denominator is 0 or NULL."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(num.cast("double"), den.cast("double")) * F.lit(float(scale))


def return_on(revenue: Column | str, spend: Column | str) -> Column:
    """Return on investment in percent."""
    rev = F.col(revenue) if isinstance(revenue, str) else revenue
    cost = F.col(spend) if isinstance(spend, str) else spend
    return safe_ratio(rev - cost, cost, 100)


def total(column: Column | str) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    return F.coalesce(F.sum(column), F.lit(0))


def first_known(column: str, order: Sequence[str]) -> Column:
    """Aggregate: earliest non-null value by ``order``."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def rounded(df: DataFrame, digits: int = 2, half_even: bool = True) -> DataFrame:
    """Round every floating column."""
    fn = F.bround if half_even else F.round
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[fn(F.col(c), digits).alias(c) if c in floating else F.col(c) for c in df.columns])
