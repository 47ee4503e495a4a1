"""Distribution summaries and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import attach, one_row
from custlens.functions.order_stats import exact_quantiles, frequencies, quantiles_of, running_totals, with_slots
from custlens.operators.quality import numeric_columns
from custlens.session import stage


def box_stats(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """(by, measure, min, q1, median, q3, max, whisker_low, whisker_high), whiskers at 1.5 interquartile ranges.

    A whisker is the outermost value inside its fence. Slots that lie inside the fences give it from
    their own smallest and largest value; only the slots that a fence cuts are looked at value by value.
    """
    slotted = stage(with_slots(stage(frequencies(df, cols, [by]), "frequencies")), "slots")
    found = quantiles_of(slotted, cols, [0, 0.25, 0.5, 0.75, 1], [by])
    boxes = found.select(
        by, F.inline(F.array(*[F.struct(F.lit(c).alias("_metric"), F.col(f"{c}_q").alias("q")) for c in cols]))
    ).filter(F.col("q")[0].isNotNull())
    reach = 1.5 * (F.col("q")[3] - F.col("q")[1])
    fenced = boxes.withColumn("_low", F.col("q")[1] - reach).withColumn("_high", F.col("q")[3] + reach)

    slots = slotted.groupBy(by, "_metric", "_slot").agg(F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    slots = slots.join(fenced.select(by, "_metric", "_low", "_high"), [by, "_metric"])
    inside = (F.col("_first") >= F.col("_low")) & (F.col("_last") <= F.col("_high"))
    outside = (F.col("_last") < F.col("_low")) | (F.col("_first") > F.col("_high"))
    whole = slots.filter(inside).select(by, "_metric", "_first", "_last")
    cut = slots.filter(~inside & ~outside).select(by, "_metric", "_slot", "_low", "_high")
    partly = (
        slotted.join(cut, [by, "_metric", "_slot"])
        .filter(F.col("_v").between(F.col("_low"), F.col("_high")))
        .select(by, "_metric", F.col("_v").alias("_first"), F.col("_v").alias("_last"))
    )
    whiskers = (
        whole.unionByName(partly)
        .groupBy(by, "_metric")
        .agg(F.min("_first").alias("whisker_low"), F.max("_last").alias("whisker_high"))
    )
    return fenced.join(whiskers, [by, "_metric"]).select(
        by,
        F.col("_metric").alias("measure"),
        *[F.col("q")[i].alias(name) for i, name in enumerate(("min", "q1", "median", "q3", "max"))],
        "whisker_low",
        "whisker_high",
    )


def histogram(df: DataFrame, column: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """Equal-width bins over the whole range: bin, bin_low, bin_high, count, and the mean and median of all values.

    With ``by`` every group is counted on the same bins. Empty bins are listed with 0. NULL, NaN and infinite values
    are left out.
    """
    value = F.col(column).cast("double")
    known = df.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    ends = F.col("_ends")
    extent = one_row(known, F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"))
    width = ends["high"] - ends["low"]
    slot = F.least(F.floor(F.coalesce(F.try_divide(F.lit(bins) * (value - ends["low"]), width), F.lit(0.0))), F.lit(bins - 1))
    groups = [by] if by else []
    if by:
        known = known.dropna(subset=[by])
    binned = attach(known, "_ends", extent)
    counts = binned.groupBy(*groups, slot.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    if by:
        every = counts.select(by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    else:
        every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    middle = exact_quantiles(known, [column], [0.5]).select(F.col(f"{column}_q")[0]).scalar()
    return attach(every.join(counts, [*groups, "bin"], "left"), "_ends", extent).select(
        *groups,
        "bin",
        (ends["low"] + F.col("bin") * width / bins).alias("bin_low"),
        (ends["low"] + (F.col("bin") + 1) * width / bins).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"),
        ends["mean"].alias("mean"),
        middle.alias("median"),
    )


def _matrix(pairs: DataFrame, cols: Sequence[str], constant: Column) -> DataFrame:
    """Both halves and the diagonal from (first, second, correlation) of each pair."""
    both = F.array(
        F.struct(F.col("first").alias("row_name"), F.col("second").alias("column_name"), "correlation"),
        F.struct(F.col("second").alias("row_name"), F.col("first").alias("column_name"), "correlation"),
    )
    halves = pairs.select(F.inline(both))
    names = attach(pairs.sparkSession.createDataFrame([(c,) for c in cols], "row_name string"), "_constant", constant)
    diagonal = names.select(
        "row_name",
        F.col("row_name").alias("column_name"),
        F.when(~F.array_contains("_constant", F.col("row_name")), F.lit(1.0)).alias("correlation"),
    )
    return halves.unionByName(diagonal)


def correlation(df: DataFrame, cols: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """Correlation matrix in long form (row_name, column_name, correlation) over rows where both values are known.

    ``spearman`` uses average ranks; ``kendall`` is tau-b. Both are exact and work on counts of equal value pairs.
    """
    cols = list(cols or numeric_columns(df))
    if len(cols) < 2:
        raise ValueError("a correlation needs at least two numeric columns")
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    df = df.select(*[number[c].alias(c) for c in cols])
    constants = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.min(c) < F.max(c), F.lit(False)), F.lit(c)) for c in cols])
    )
    constant = df.agg(constants.alias("constant")).scalar()
    couples = list(combinations(cols, 2))
    if method == "pearson":
        sums = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(couples)])
        rows = F.array(
            *[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"_{i}").alias("correlation")) for i, (a, b) in enumerate(couples)]
        )
        return _matrix(sums.select(F.inline(rows)), cols, constant)
    if method not in ("spearman", "kendall"):
        raise ValueError(f"unknown method {method!r}")

    entries = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for i, (a, b) in enumerate(couples)])
    counts = (
        df.select(F.inline(entries))
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("pair", "x", "y")
        .agg(F.count("*").alias("n"))
    )
    measured = _spearman(counts) if method == "spearman" else _kendall(counts)
    names = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second")) for a, b in couples])
    pairs = measured.select(names[F.col("pair")]["first"].alias("first"), names[F.col("pair")]["second"].alias("second"), "correlation")
    return _matrix(pairs, cols, constant)


def _ranks(counts: DataFrame, value: str) -> DataFrame:
    """Per pair and distinct value: rows with it, rows below it, distinct values below it."""
    sizes = counts.groupBy("pair", value).agg(F.sum("n").alias("size")).withColumn("one", F.lit(1).cast("long"))
    return running_totals(sizes, [value], ["size", "one"], by=["pair"])


def _spearman(counts: DataFrame) -> DataFrame:
    sizes = F.broadcast(counts.groupBy("pair").agg(F.sum("n").alias("rows")))  # one row per column pair

    def centred(value: str) -> DataFrame:
        rank = F.col("size_before") + (F.col("size") + 1) / 2 - (F.col("rows") + 1) / 2
        return _ranks(counts, value).join(sizes, "pair").select("pair", value, rank.alias(f"rank_{value}"))

    joined = counts.join(centred("x"), ["pair", "x"]).join(centred("y"), ["pair", "y"])
    n, rx, ry = F.col("n"), F.col("rank_x"), F.col("rank_y")
    sums = joined.groupBy("pair").agg(
        F.sum(n * rx * ry).alias("xy"), F.sum(n * rx * rx).alias("xx"), F.sum(n * ry * ry).alias("yy")
    )
    return sums.select("pair", F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("correlation"))


# Dense ranks are read as digits of this many bits; sixteen digits hold every long.
_DIGIT_BITS = 4
_DIGITS = 16


def digit_positions(top: Column) -> Column:
    """The positions, lowest first, of the digits that ranks up to ``top`` need."""
    return F.filter(F.sequence(F.lit(0), F.lit(_DIGITS - 1)), lambda p: F.call_function("shiftright", top, p * _DIGIT_BITS) > 0)


def _kendall(counts: DataFrame) -> DataFrame:
    """tau-b without comparing rows pairwise.

    Two rows with different x rank differ in a highest digit of the rank and share the digits above it.
    So for every digit position, rows with the same higher digits are sorted by y, and each row adds the
    rows before it (smaller y) with a smaller digit: every concordant pair is counted at one position.
    The work is (distinct value pairs) * (digits in use), whatever the number of pairs.
    """
    rx = _ranks(counts, "x").select("pair", "x", F.col("one_before").alias("dx"))
    ry = _ranks(counts, "y").select("pair", "y", F.col("one_before").alias("dy"))
    ranked = counts.join(rx, ["pair", "x"]).join(ry, ["pair", "y"]).select("pair", "dx", "dy", "n")

    top = one_row(rx, F.max("dx").alias("dx"))["dx"]
    in_use = digit_positions(F.col("_top"))
    per_digit = attach(ranked, "_top", top).select("pair", "dx", "dy", "n", F.explode(in_use).alias("position"))
    shifted = F.call_function("shiftright", F.col("dx"), (F.col("position") * _DIGIT_BITS).cast("int"))
    digits = 1 << _DIGIT_BITS
    per_digit = per_digit.withColumn("digit", shifted.bitwiseAND(digits - 1)).withColumn(
        "higher", F.shiftright(shifted, _DIGIT_BITS)
    )
    keys = ["pair", "position", "higher"]
    by_y = per_digit.groupBy(*keys, "dy").agg(
        *[F.coalesce(F.sum(F.when(F.col("digit") == d, F.col("n"))), F.lit(0)).alias(f"w{d}") for d in range(digits)]
    )
    weights = [f"w{d}" for d in range(digits)]
    summed = running_totals(by_y, ["dy"], weights, by=keys, slot=F.shiftright("dy", 16))
    smaller = F.lit(0.0)
    pairs_here = F.lit(0.0)
    for d in range(1, digits):
        smaller = smaller + F.col(f"w{d - 1}_before")
        pairs_here = pairs_here + F.col(f"w{d}") * smaller
    concordant = summed.groupBy("pair").agg(F.sum(pairs_here).alias("concordant"))

    def choose2(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2

    def ties(*by: str) -> DataFrame:
        sizes = counts.groupBy("pair", *by).agg(F.sum("n").alias("size"))
        return sizes.groupBy("pair").agg(F.sum(choose2(F.col("size"))).alias("ties_" + "".join(by)))

    everything = counts.groupBy("pair").agg(choose2(F.sum("n")).alias("all_pairs"), F.sum(choose2(F.col("n"))).alias("ties_xy"))
    joined = everything.join(ties("x"), "pair").join(ties("y"), "pair").join(concordant, "pair", "left")
    found = F.coalesce("concordant", F.lit(0.0))
    discordant = F.col("all_pairs") - F.col("ties_x") - F.col("ties_y") + F.col("ties_xy") - found
    scale = F.sqrt((F.col("all_pairs") - F.col("ties_x")) * (F.col("all_pairs") - F.col("ties_y")))
    return joined.select("pair", F.try_divide(found - discordant, scale).alias("correlation"))
