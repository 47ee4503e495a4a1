import itertools
import math
import random

import numpy as np
import pytest

from custlens.operators import quality, stats


def kendall(xs, ys):
    concordant = tx = ty = 0
    for (a, b), (c, d) in itertools.combinations(zip(xs, ys), 2):
        concordant += ((a > c) - (a < c)) * ((b > d) - (b < d))
        tx += a != c
        ty += b != d
    return concordant / math.sqrt(tx * ty)


def ranks(xs):
    return [sum(o < x for o in xs) + (sum(o == x for o in xs) + 1) / 2 for x in xs]


@pytest.mark.parametrize("levels", [3, 40, 100000])
def test_rank_correlations_match_brute_force(spark, levels):
    rng = random.Random(levels)
    data = [(float(rng.randrange(levels)), float(rng.randrange(levels)), None if i % 9 == 0 else rng.gauss(0, 1)) for i in range(260)]
    data = [(a, (a + b) // 2, c) for a, b, c in data]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(6)
    tau = {(r.row_name, r.column_name): r.correlation for r in stats.correlation(df, method="kendall").collect()}
    rho = {(r.row_name, r.column_name): r.correlation for r in stats.correlation(df, method="spearman").collect()}
    assert len(tau) == len(rho) == 9 and tau[("a", "a")] == 1.0
    for (i, x), (j, y) in itertools.combinations(enumerate("abc"), 2):
        known = [(r[i], r[j]) for r in data if r[i] is not None and r[j] is not None]
        xs, ys = zip(*known)
        assert tau[(x, y)] == tau[(y, x)] == pytest.approx(kendall(xs, ys), abs=1e-12)
        assert rho[(x, y)] == pytest.approx(np.corrcoef(ranks(xs), ranks(ys))[0, 1], abs=1e-12)


def test_perfect_and_constant_columns(spark):
    df = spark.createDataFrame([(float(i), float(-i), 1.0) for i in range(50)], "a double, b double, k double")
    for method in ("pearson", "spearman", "kendall"):
        found = {(r.row_name, r.column_name): r.correlation for r in stats.correlation(df, ["a", "b"], method).collect()}
        assert found[("a", "b")] == pytest.approx(-1.0)
    constant = {(r.row_name, r.column_name): r.correlation for r in stats.correlation(df, method="kendall").collect()}
    assert constant[("k", "k")] is None and constant[("a", "k")] is None
    with pytest.raises(ValueError):
        stats.correlation(df, ["a"])


def test_box_whiskers(spark):
    rng = random.Random(3)
    data = [("g", rng.gauss(0, 1)) for _ in range(300)] + [("g", 50.0), ("g", -40.0), ("h", 1.0)]
    row = {r.g: r for r in stats.box_stats(spark.createDataFrame(data, "g string, x double"), ["x"], "g").collect()}
    xs = np.array([v for g, v in data if g == "g"])
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    inside = xs[(xs >= q1 - 1.5 * (q3 - q1)) & (xs <= q3 + 1.5 * (q3 - q1))]
    assert (row["g"].whisker_low, row["g"].whisker_high) == (inside.min(), inside.max())
    assert (row["g"].min, row["g"].max) == (-40.0, 50.0)
    assert (row["h"].whisker_low, row["h"].q1, row["h"].whisker_high) == (1.0, 1.0, 1.0)


def test_histogram_lists_empty_bins_and_keeps_the_maximum(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "x double")
    found = sorted((r.bin, r["count"]) for r in stats.histogram(df, "x", bins=5).collect())
    assert found == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]
    flat = stats.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", bins=3).collect()
    assert sum(r["count"] for r in flat) == 2


def test_describe_and_summary(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 3, None), ("b", 3, 6.0)], "t string, i int, x double")
    rows = {r.column_name: r for r in quality.describe_columns(df).collect()}
    assert (rows["t"]["unique"], rows["t"].top, rows["t"].freq) == (2, "b", 2)
    assert (rows["x"]["count"], rows["x"].null_count, rows["x"].q50) == (2, 1, 4.0)
    assert quality.duplicate_count(df).first().duplicate_rows == 0
    assert quality.duplicate_count(df.select("t", "i")).first().duplicate_rows == 1
