"""Equality joins between facts, dimensions and scores.

No side is broadcast by hint: Spark broadcasts a side whose size it has measured to be below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, with AQE splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import one_row, require_columns


def lookup_join(facts: DataFrame, table: DataFrame, key: str, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Bring ``columns`` of ``table`` to ``facts``; a name that already exists is an error."""
    require_columns(table, [key, *columns], "lookup table")
    clash = [c for c in columns if c in facts.columns]
    if clash:
        raise ValueError(f"columns {clash} exist on both sides")
    return facts.join(table.select(key, *columns), key, how)


def enrich(facts: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of every column of ``table`` that ``facts`` does not have yet."""
    new = [c for c in table.columns if c != key and c not in facts.columns]
    return lookup_join(facts, table, key, new) if new else facts


def inner_join(facts: DataFrame, table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return lookup_join(facts, table, key, columns, "inner")


def denormalise_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    customer_key: str = "customer_id",
    product_key: str = "product_id",
) -> DataFrame:
    """One wide sales table: orders, their customer and their product."""
    return enrich(enrich(orders, products, product_key), customers, customer_key)


def full_outer_by(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "full")


def members_only(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key), key, "left_semi")


def non_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key), key, "left_anti")


def flag_members(df: DataFrame, members: DataFrame, key: str, flag: str, when_member: int = 1) -> DataFrame:
    """Integer flag for rows whose key occurs in ``members``; ``when_member=0`` marks those that do not."""
    keys = members.select(F.col(key)).distinct().withColumn("_member", F.lit(True))
    flagged = df.join(keys, key, "left")
    found = F.when(F.col("_member"), F.lit(when_member)).otherwise(F.lit(1 - when_member))
    return flagged.withColumn(flag, found).drop("_member")


def dictionary_map(
    df: DataFrame, table: DataFrame, key: str, value: str, target: str, latest_by: Sequence[str] | None = None
) -> DataFrame:
    """Map a key to a value. A key listed twice keeps its last entry by ``latest_by``; without that it is an error."""
    if latest_by:
        pairs = table.groupBy(key).agg(F.max_by(value, F.struct(*latest_by)).alias("_mapped"))
    else:
        repeated = F.raise_error(F.lit(f"{key} is listed more than once: say by latest_by which entry counts"))
        only = F.when(F.count("*") == 1, F.first(value)).otherwise(repeated.cast(table.schema[value].dataType))
        pairs = table.groupBy(key).agg(only.alias("_mapped"))
    return df.join(pairs, key, "left").withColumn(target, F.col("_mapped")).drop("_mapped")


def share_of_total(df: DataFrame, column: str, share: str, scale: float = 100.0) -> DataFrame:
    """column / sum(column) * scale, with the sum as a scalar instead of a window over all rows."""
    whole = one_row(df, F.sum(column).cast("double").alias("whole"))["whole"]
    return df.withColumn(share, F.try_divide(F.col(column).cast("double"), whole) * F.lit(scale))
