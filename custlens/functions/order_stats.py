"""Exact order statistics that never put a whole column into one task.

Values are first reduced to (value, count) pairs, so a value shared by a third of all rows is one
row. Each pair then falls into one of a fixed number of slots. The slot is a monotone function of
the value (the octave of its magnitude and its place inside, equal widths between the smallest and the largest
value, so small numbers spread as well as large ones: 500 slots an octave at least), so ranks follow from
the slot totals, and only rows inside a slot need sorting. Values that crowd into less than a five-hundredth of an
octave, beside others of all magnitudes, share a slot. Slots depend on nothing but the values:
a recomputed task always gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.columns import attach, one_row
from custlens.session import stage

SLOTS = 1 << 20
_LARGEST = 1.7976931348623157e308


def _octaves(value: Column) -> Column:
    """Octaves above the smallest double, straight inside each, with the sign of the value; 0 for 0.

    Like the bit pattern of a double it never turns two values round, and small magnitudes get as much
    room as large ones.
    """
    size = F.least(F.abs(value), F.lit(_LARGEST))
    octave = F.floor(F.log2(size))
    # 2 ** -1074 is the smallest double; in two steps, as 2 ** 1074 would be infinite
    inside = size * F.pow(F.lit(2.0), -F.floor(octave / 2)) * F.pow(F.lit(2.0), F.floor(octave / 2) - octave)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.signum(value) * (octave + F.lit(1075.0) + inside - 1))


def value_slot(value: Column, low: Column, high: Column, slots: int = SLOTS) -> Column:
    """Slot 0..slots-1 of ``value`` within [low, high]; a larger value never gets a smaller slot."""
    share = F.try_divide(_octaves(value) - _octaves(low), _octaves(high) - _octaves(low))
    return F.coalesce(F.least(F.floor(share * slots), F.lit(slots - 1)), F.lit(0)).cast("int")


def frequencies(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., _metric, _v, _n): how often each value of each column occurs. Nulls and NaN are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_v")) for c in cols])
    long = df.select(*by, F.inline(pairs)).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if by:
        long = long.dropna(subset=list(by))
    return long.groupBy(*by, "_metric", "_v").agg(F.count("*").alias("_n"))


def with_slots(freq: DataFrame) -> DataFrame:
    """Add ``_slot``. The edges are one row per measured column, so they can always be broadcast."""
    # The condition always holds; it keeps the columns of ``freq`` the same in every branch, so that Spark
    # computes its exchange once and reuses it.
    value = F.when(F.col("_n") > 0, F.col("_v"))
    edges = freq.groupBy("_metric").agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    joined = freq.join(F.broadcast(edges), "_metric")
    return joined.withColumn("_slot", value_slot(F.col("_v"), F.col("_low"), F.col("_high"))).drop("_low", "_high")


def _preceding(*keys: str, order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0).cast("long"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``{col}_q`` (array, one entry per probability, linear interpolation) and ``{col}_n``.

    The value counts are staged once and shared by all that follows.
    """
    return quantiles_of(stage(with_slots(stage(frequencies(df, cols, by), "frequencies")), "slots"), cols, probs, by)


def quantiles_of(slotted: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """:func:`exact_quantiles` of values that are already counted and in slots; only slots with a wanted rank are sorted."""
    by = list(by)
    whole_group = Window.partitionBy(*by, "_metric")
    slot_totals = (
        slotted.groupBy(*by, "_metric", "_slot")
        .agg(F.sum("_n").alias("_slot_n"))
        .withColumn("_start", _sum_before("_slot_n", _preceding(*by, "_metric", order="_slot")))
        .withColumn("_total", F.sum("_slot_n").over(whole_group))
    )

    wanted = F.lit([float(p) for p in probs])

    def holds(rank: Column, size: str) -> Column:
        return (F.col("_start") <= rank) & (rank < F.col("_start") + F.col(size))

    def position(p: Column) -> Column:
        return p * (F.col("_total") - 1)

    def holds_any(p: Column) -> Column:
        return holds(F.floor(position(p)), "_slot_n") | holds(F.ceil(position(p)), "_slot_n")

    needed = slot_totals.filter(F.exists(wanted, holds_any)).drop("_slot_n")
    if not by:
        needed = F.broadcast(needed)  # at most two slots per column and probability
    ranked = slotted.join(needed, [*by, "_metric", "_slot"]).withColumn(
        "_start", F.col("_start") + _sum_before("_n", _preceding(*by, "_metric", "_slot", order="_v"))
    )
    p, v = F.col("_p"), F.col("_v")
    neighbours = (
        ranked.select(*by, "_metric", "_v", "_n", "_start", "_total", F.posexplode(wanted).alias("_i", "_p"))
        .withColumn("_low", F.when(holds(F.floor(position(p)), "_n"), v))
        .withColumn("_high", F.when(holds(F.ceil(position(p)), "_n"), v))
        .filter(F.col("_low").isNotNull() | F.col("_high").isNotNull())
        .groupBy(*by, "_metric", "_i", "_p", "_total")
        .agg(F.max("_low").alias("_low"), F.max("_high").alias("_high"))
    )
    share = position(p) - F.floor(position(p))
    points = neighbours.select(
        *by, F.struct("_metric", "_i", (F.col("_low") + (F.col("_high") - F.col("_low")) * share).alias("_q"), "_total").alias("_point")
    )
    # One entry per column and probability.
    found = points.groupBy(*by).agg(F.array_sort(F.collect_list("_point")).alias("_points"))

    def of(c: str) -> Column:
        return F.filter("_points", lambda e: e["_metric"] == c)

    quantiles = {c: F.when(F.size(of(c)) > 0, F.transform(of(c), lambda e: e["_q"])) for c in cols}
    counts = {c: F.coalesce(F.get(of(c), 0)["_total"], F.lit(0)) for c in cols}
    return found.select(*by, *[x for c in cols for x in (counts[c].alias(f"{c}_n"), quantiles[c].alias(f"{c}_q"))])


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with ``{col}_median``."""
    found = exact_quantiles(df, cols, [0.5], by)
    return found.select(*by, *[F.col(f"{c}_q")[0].alias(f"{c}_median") for c in cols])


def quantile_struct(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> Column:
    """Ungrouped quantiles as a scalar struct with one array field ``{col}_q`` per column."""
    found = exact_quantiles(df, cols, probs)
    return found.select(F.struct(*[F.col(f"{c}_q") for c in cols]).alias("quantiles")).scalar()


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    weights: Sequence[str],
    by: Sequence[str] = (),
    slot: Column | None = None,
) -> DataFrame:
    """Add ``{weight}_before``: the weight of all rows of the group that sort before this one.

    ``slot`` must never decrease along ``order``; left out, it is taken from the first order column,
    which must then be numeric. Rows are shuffled once, by group and slot.
    """
    by = list(by)
    if slot is None:
        lead = F.col(order[0]).cast("double")
        # weights are never negative; naming them keeps the columns of this branch as in the others
        known = F.when(reduce(or_, [F.col(w) >= 0 for w in weights]), lead)
        edge = one_row(df, F.min(known).alias("low"), F.max(known).alias("high"))
        slot = value_slot(lead, F.col("_edge.low"), F.col("_edge.high"))
        slotted = attach(df, "_edge", edge).withColumn("_slot", slot).drop("_edge")
    else:
        slotted = df.withColumn("_slot", slot)
    slot_totals = slotted.groupBy(*by, "_slot").agg(*[F.sum(w).alias(f"_{w}_slot") for w in weights])
    before_slot = _preceding(*by, order="_slot")
    if not by:
        # one row per slot; still named as a partition key so that nothing depends on a global window
        slot_totals = slot_totals.withColumn("_all", F.lit(0))
        before_slot = _preceding("_all", order="_slot")
    offsets = slot_totals.select(
        *by, "_slot", *[_sum_before(f"_{w}_slot", before_slot).alias(f"_{w}_offset") for w in weights]
    )
    inside = Window.partitionBy(*by, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = slotted.select("*", *[_sum_before(w, inside).alias(f"_{w}_inside") for w in weights])
    return summed.join(offsets, [*by, "_slot"]).select(
        *df.columns, *[(F.col(f"_{w}_inside") + F.col(f"_{w}_offset")).alias(f"{w}_before") for w in weights]
    )


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Most frequent value per group and column (``{col}_mode``); the smallest value wins a tie."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_metric"), F.col(c).cast("string").alias("_v")) for c in cols])
    counts = (
        df.dropna(subset=list(by))
        .select(*by, F.inline(pairs))
        .filter(F.col("_v").isNotNull())
        .groupBy(*by, "_metric", "_v")
        .agg(F.count("*").alias("_n"))
    )
    best_first = F.struct(-F.col("_n"), F.col("_v"))
    return counts.groupBy(*by).agg(
        *[F.min_by("_v", F.when(F.col("_metric") == c, best_first)).alias(f"{c}_mode") for c in cols]
    )


def spread_join(df: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "left", parts: int | None = None) -> DataFrame:
    """Join ``table`` (few rows per key) to ``df`` when single keys of ``df`` may be very frequent.

    Each key of ``df`` is split into ``parts`` (default: the shuffle partitions) by a hash of the ``spread`` columns and ``table`` is repeated
    for each part, so one hot key is worked on by many tasks. Nothing is broadcast unless Spark finds it small.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int")
    repeated = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return df.withColumn("_part", part).join(repeated, [*on, "_part"], how).drop("_part")
