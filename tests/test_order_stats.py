import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.functions.columns import attach
from custlens.functions.order_stats import exact_quantiles, frequencies, medians, modes, running_totals, spread_join, with_slots
from custlens.operators import cleaning, stats

PROBS = [0, 0.2, 0.25, 0.5, 0.6000000000000001, 0.99, 1]


def sample(kind, n, seed):
    rng = np.random.default_rng(seed)
    values = {
        "heavy": lambda: np.exp(rng.normal(0, 8, n)) * rng.choice([-1, 1], n),
        "tied": lambda: rng.integers(-2, 3, n).astype(float),
        "constant": lambda: np.full(n, 7.25),
        "hot": lambda: np.where(rng.random(n) < 0.5, 3.0, rng.random(n) * 1e-6),
        "extreme": lambda: rng.choice([1.7e308, -1.7e308, 0.0, 5e-324, 1.0], n),
    }
    return values[kind]()


@pytest.mark.parametrize("kind", ["heavy", "tied", "constant", "hot", "extreme"])
@pytest.mark.parametrize("n", [1, 2, 501])
def test_quantiles_match_numpy(spark, kind, n):
    values = sample(kind, n, n)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    row = exact_quantiles(df, ["x"], PROBS).first()
    ordered = np.sort(values)
    for p, got in zip(PROBS, row.x_q):
        pos = p * (n - 1)
        low, high = ordered[int(np.floor(pos))], ordered[int(np.ceil(pos))]
        with np.errstate(over="ignore"):
            expected = low + (high - low) * (pos - np.floor(pos))
        assert got == expected or (np.isnan(got) and np.isnan(expected))
    assert row.x_n == n


def test_quantiles_by_group_ignore_null_and_nan(spark):
    rng = random.Random(1)
    data = [(rng.choice("abc"), rng.choice([None, float("nan"), rng.gauss(0, 1)]), rng.randint(0, 9)) for _ in range(900)]
    data += [(None, 1.0, 1), ("only null", None, None)]
    df = spark.createDataFrame(data, "g string, x double, y int")
    found = {r.g: r for r in exact_quantiles(df, ["x", "y"], [0.25, 0.5], ["g"]).collect()}
    assert set(found) == {"a", "b", "c"}
    for g, row in found.items():
        xs = [x for k, x, _ in data if k == g and x is not None and x == x]
        ys = [y for k, _, y in data if k == g]
        assert row.x_q == pytest.approx(np.quantile(xs, [0.25, 0.5])) and row.x_n == len(xs)
        assert row.y_q == pytest.approx(np.quantile(ys, [0.25, 0.5]))


def test_median_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    row = medians(df, ["x", "y"]).first()
    assert (row.x_median, row.y_median) == (None, 1.0)


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_totals(spark, partitions):
    rng = random.Random(2)
    values = {(g, round(rng.lognormvariate(0, 3), 4)) for g in "ab" for _ in range(400)}
    data = [(g, v, rng.randint(1, 5)) for g, v in values]
    df = spark.createDataFrame(data, "g string, v double, n long").repartition(partitions)
    for row in running_totals(df, ["v"], ["n"], by=["g"]).collect():
        assert row.n_before == sum(n for g, v, n in data if g == row.g and v < row.v)
    everything = running_totals(df.groupBy("v").agg(F.sum("n").alias("n")), ["v"], ["n"]).collect()
    for row in everything[:50]:
        assert row.n_before == sum(n for _, v, n in data if v < row.v)


def test_modes_take_the_smallest_of_the_most_frequent(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, "b"), (1, None), (2, None), (2, "z")], "g int, v string")
    assert rows(modes(df, ["v"], ["g"])) == [(1, "a"), (2, "z")]


def test_spread_join_equals_a_plain_join(spark, rows):
    df = spark.createDataFrame([("hot", i) for i in range(300)] + [("cold", 1), (None, 2)], "k string, i int")
    table = spark.createDataFrame([("hot", 1.5), ("cold", 2.5)], "k string, c double")
    spread = spread_join(df, table, ["k"], ["i"]).select("k", "i", "c")
    assert sorted(map(str, spread.collect())) == sorted(map(str, df.join(table, "k", "left").collect()))


def most_in_a_slot(slots):
    return slots.groupBy("slot").count().agg(F.max("count"), F.count("*")).first()


def test_small_magnitudes_spread_over_slots(spark):
    rng = np.random.default_rng(1)
    values = spark.createDataFrame([(float(v),) for v in [*(rng.random(50_000) * 1e-7), 1.0]], "x double")
    slots = with_slots(frequencies(values, ["x"])).select(F.col("_slot").alias("slot"))
    most, n = most_in_a_slot(slots)
    assert n >= 100 and most < 500


def test_slots_keep_the_order_of_values(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    near = [float(np.nextafter(2.0**e, d)) for e in (-1074, -1022, -3, 0, 1, 52, 1023) for d in (0, huge)]
    values = sorted({0.0, tiny, 3 * tiny, huge, 1.5, *near, *(2.0**e for e in range(-1074, 1024, 7))})
    values = sorted({*values, *(-v for v in values)})
    rows = with_slots(frequencies(spark.createDataFrame([(v,) for v in values], "x double"), ["x"])).orderBy("_v").collect()
    slots = [r._slot for r in rows]
    assert slots == sorted(slots) and slots[0] == 0 and len(set(slots)) > 500


def test_categories_with_a_common_start_spread_over_ranges(spark):
    names = spark.range(50_000).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("value"))
    names = names.union(spark.createDataFrame([("nan",)], "value string"))
    slots = attach(names, "_bounds", cleaning._sampled_bounds(names)).select(cleaning._range_of("value").alias("slot"))
    most, n = most_in_a_slot(slots)
    assert n >= 100 and most < 5_000
    codes = cleaning.category_codes(names, "value").collect()
    ordered = sorted(r.value for r in names.collect())
    assert {r.value: r.code for r in codes} == {v: i for i, v in enumerate(ordered)}


def test_kendall_reads_every_digit_of_a_rank(spark):
    tops = [1, 15, 16, 2**40, 2**40 + 1, 2**62]
    rows = spark.createDataFrame([(t,) for t in tops], "top long").select("top", stats.digit_positions(F.col("top")).alias("p")).collect()
    assert {r.top: len(r.p) for r in rows} == {t: -(-t.bit_length() // 4) for t in tops}
