"""Typing of text columns, validation, summaries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import attach, one_row, require_columns
from custlens.functions.order_stats import exact_quantiles

# Date patterns that are tried, day first before year first.
DATE_FORMATS = ["d/M/yyyy", "yyyy-M-d", "d-M-yyyy", "yyyy/M/d"]
# Texts that mean "no number".
NO_NUMBER = ["", "nan", "None", "null"]
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|infinity|Infinity)\s*$"
# Analyses that each absent column blocks.
BLOCKED_BY = {
    "order_date": "time analyses",
    "amount": "revenue",
    "price": "revenue when amount is absent",
    "quantity": "revenue when amount is absent",
}


def _shape(fmt: str) -> str | None:
    """An expression that every text in ``fmt`` matches; None for formats of other letters than d, M and yyyy."""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]+", fmt)
    if not all(t in ("d", "dd", "M", "MM", "yyyy") or re.fullmatch(r"[-/. ]+", t) for t in tokens):
        return None
    parts = [r"[+-]?[0-9]{4,}" if t == "yyyy" else r"[+-]?[0-9]+" if t.isalpha() else re.escape(t) for t in tokens]
    return f"^{''.join(parts)}$"


def _parsed(column: str, fmt: str) -> Column:
    """The date, or NULL. A text that cannot be in the format is never parsed, as a failed attempt costs far more."""
    text = F.col(column).cast("string")
    shape = _shape(fmt)
    found = F.try_to_date(text, fmt)
    return found if shape is None else F.when(text.rlike(shape), found)


def coerce_dates(
    df: DataFrame, cols: Sequence[str], formats: Sequence[str] = tuple(DATE_FORMATS), per_row: bool = False
) -> DataFrame:
    """Text to dates. Per column the first format that reads at least one value is used for all values;
    with ``per_row`` each value takes the first format that reads it. Unreadable values become NULL."""
    cols = [c for c in cols if c in df.columns]
    if per_row:
        return df.withColumns({c: F.coalesce(*[_parsed(c, f) for f in formats]) for c in cols})
    readable = [F.count(_parsed(c, f)).alias(f"{c}_{i}") for c in cols for i, f in enumerate(formats)]
    seen = F.col("_seen")
    return (
        attach(df, "_seen", one_row(df, *readable))
        .withColumns(
            {
                c: reduce(
                    lambda chain, i: chain.when(seen[f"{c}_{i}"] > 0, _parsed(c, formats[i])),
                    range(1, len(formats)),
                    F.when(seen[f"{c}_0"] > 0, _parsed(c, formats[0])),
                )
                for c in cols
            }
        )
        .drop("_seen")
    )


def as_number(column: str) -> Column:
    text = F.replace(F.col(column).cast("string"), F.lit(","), F.lit("."))
    return F.when(~text.isin(NO_NUMBER) & text.rlike(_NUMBER), text).try_cast("double")


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to doubles with decimal comma or point; anything else becomes NULL."""
    return df.withColumns({c: as_number(c) for c in cols if c in df.columns})


def _long(df_one_row: DataFrame, entries: Sequence[tuple[str, Sequence[Column]]], names: Sequence[str]) -> DataFrame:
    """One row per entry from a one-row table of aggregates."""
    rows = F.array(*[F.struct(F.lit(key).alias("column_name"), *[v.alias(n) for v, n in zip(vals, names)]) for key, vals in entries])
    return df_one_row.select(F.inline(rows))


def coercion_report(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column_name, null_before, null_after: what a coercion lost. One pass over each table."""
    cols = [c for c in cols if c in after.columns]
    old = one_row(before, *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    lost = attach(after.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]), "_old", old)
    return _long(lost, [(c, [F.col("_old")[c], F.col(c)]) for c in cols], ["null_before", "null_after"])


def validate_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """column_name, is_present, null_count, null_pct for every required column."""
    present = [c for c in required if c in df.columns]
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    rows = F.col("_rows").cast("double")
    entries = [
        (c, [F.lit(True), F.col(c), F.try_divide(F.col(c).cast("double"), rows) * 100])
        if c in present
        else (c, [F.lit(False), F.lit(None).cast("long"), F.lit(None).cast("double")])
        for c in required
    ]
    return _long(counts, entries, ["is_present", "null_count", "null_pct"])


def blocked_analyses(
    df: DataFrame, expected: Sequence[str], blocks: Mapping[str, str] | None = None, empty_too: bool = False
) -> DataFrame:
    """column_name, blocks: absent columns and the analysis each would be needed for.

    With ``empty_too`` a column without a single value counts as absent; all columns are counted in one pass.
    """
    blocks = BLOCKED_BY if blocks is None else blocks
    wanted = {c: why for c, why in blocks.items() if c in expected}
    absent = [(c, why) for c, why in wanted.items() if c not in df.columns]
    missing = df.sparkSession.createDataFrame(absent, "column_name string, blocks string")
    present = {c: why for c, why in wanted.items() if c in df.columns}
    if not (empty_too and present):
        return missing
    counts = df.agg(*[F.count(c).alias(c) for c in present])
    lines = [F.struct(F.lit(c).alias("column_name"), F.lit(why).alias("blocks"), F.col(c).alias("n")) for c, why in present.items()]
    return missing.unionAll(counts.select(F.inline(F.array(*lines))).filter("n = 0").select("column_name", "blocks"))


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    require_columns(df, required)
    return df.na.drop(subset=list(required))


def incomplete_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """removed_rows, remaining_rows of :func:`drop_incomplete`, in one pass."""
    require_columns(df, required)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.agg(F.count_if(~complete).alias("removed_rows"), F.count_if(complete).alias("remaining_rows"))


def missing_tables(tables: Mapping[str, DataFrame], required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in tables]


def _is_number(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if _is_number(kind)]


def table_summary(df: DataFrame) -> DataFrame:
    """Per column: data_type, row_count, null_count and, for numbers, min, max, mean, std. One pass."""
    kinds = dict(df.dtypes)
    numbers = numeric_columns(df)
    aggregates = [F.count("*").alias("_rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"_null{i}"))
        if c in numbers:
            value = F.col(c).cast("double")
            for name, fn in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp)):
                aggregates.append(fn(value).alias(f"_{name}{i}"))
    missing = F.lit(None).cast("double")
    entries = [
        (
            c,
            [F.lit(kinds[c]), F.col("_rows"), F.col(f"_null{i}")]
            + [F.col(f"_{name}{i}") if c in numbers else missing for name in ("min", "max", "mean", "std")],
        )
        for i, c in enumerate(df.columns)
    ]
    names = ["data_type", "row_count", "null_count", "min_value", "max_value", "mean_value", "std_value"]
    return _long(df.agg(*aggregates), entries, names)


def duplicate_count(df: DataFrame) -> DataFrame:
    """duplicate_rows: rows beyond the first of each set of equal rows."""
    sizes = df.groupBy(*df.columns).agg(F.count("*").alias("_size"))
    return sizes.agg(F.coalesce(F.sum(F.col("_size") - 1), F.lit(0)).alias("duplicate_rows"))


def describe_columns(df: DataFrame) -> DataFrame:
    """Per column: count, null_count; texts get unique, top, freq; numbers mean, std, min, quartiles, max."""
    numbers = numeric_columns(df)
    texts = [c for c in df.columns if c not in numbers]
    base = table_summary(df)
    result = base.select(
        "column_name",
        "data_type",
        (F.col("row_count") - F.col("null_count")).alias("count"),
        "null_count",
        F.col("mean_value").alias("mean"),
        F.col("std_value").alias("std"),
        F.col("min_value").alias("min"),
        F.col("max_value").alias("max"),
    )
    if texts:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_v")) for c in texts])
        counts = (
            df.select(F.inline(pairs)).filter(F.col("_v").isNotNull()).groupBy("column_name", "_v").agg(F.count("*").alias("_n"))
        )
        tops = counts.groupBy("column_name").agg(
            F.count("*").alias("unique"),
            F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias("top"),
            F.max("_n").alias("freq"),
        )
        result = result.join(tops, "column_name", "left")
    if numbers:
        found = exact_quantiles(df, numbers, [0.25, 0.5, 0.75])
        quartiles = found.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            *[F.col(f"{c}_q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
                        )
                        for c in numbers
                    ]
                )
            )
        )
        result = result.join(quartiles, "column_name", "left")
    return result


def date_ranges(df: DataFrame) -> DataFrame:
    """column_name, first_date, last_date, span_days for every date or timestamp column."""
    dates = [c for c, kind in df.dtypes if kind in ("date", "timestamp", "timestamp_ntz")]
    if not dates:
        raise ValueError("no date column")
    ends = df.agg(
        *[F.min(c).cast("date").alias(f"_{i}_first") for i, c in enumerate(dates)],
        *[F.max(c).cast("date").alias(f"_{i}_last") for i, c in enumerate(dates)],
    )
    entries = [
        (c, [F.col(f"_{i}_first"), F.col(f"_{i}_last"), F.datediff(f"_{i}_last", f"_{i}_first")])
        for i, c in enumerate(dates)
    ]
    return _long(ends, entries, ["first_date", "last_date", "span_days"])
