"""All k-means starts in the same scans, and category codes in ranges by size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import cleaning, clustering


def lloyd(points, centres, iterations=50):
    for _ in range(iterations):
        d = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        centres = np.array([points[own == i].mean(axis=0) if (own == i).any() else c for i, c in enumerate(centres)])
    return centres, ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_starts_move_together(spark):
    draw = np.random.default_rng(2)
    middles = draw.normal(0, 20, (6, 2))
    points = np.concatenate([m + draw.normal(0, 1, (100, 2)) for m in middles])
    frame = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double")
    fit = clustering.fit_kmeans(frame, ["a", "b"], 6, seed=1, starts=10)
    best = min(lloyd(points, points[draw.choice(len(points), 6, replace=False)])[1] for _ in range(50))
    assert fit.cost <= best * 1.001
    assert lloyd(points, np.array(fit.centres), 1)[1] == pytest.approx(fit.cost, rel=1e-3)
    assert fit.iterations <= 21


def test_scans_are_iterations_not_starts(spark, monkeypatch):
    frame = spark.range(200).select((F.col("id") % 4 * 10).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"))
    scans = []
    nearest = clustering._nearest
    monkeypatch.setattr(clustering, "_nearest", lambda points, sets: scans.append(len(sets)) or nearest(points, sets))
    fit = clustering.fit_kmeans(frame, ["a", "b"], 4, starts=10)
    assert scans[:4] == [10, 10, 10, 10] and len(scans) == fit.iterations + 3  # two rounds, weights, then the iterations


def test_fewer_points_than_clusters_and_missing_values(spark, rows):
    frame = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0), (4, None)], "id int, a double")
    segmented, fit = clustering.kmeans_segments(frame, ["a"], k=3, starts=3)
    assert [(r.id, r.segment) for r in segmented.orderBy("id").collect()] == [(1, "0"), (2, "0"), (3, "1"), (4, None)]
    assert fit.cost == pytest.approx(0) and len(fit.centres) == 2
    with pytest.raises(ValueError, match="no rows"):
        clustering.fit_kmeans(frame.filter("false"), ["a"], 2)


def test_codes_of_very_many_values_with_a_common_beginning(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "CATEGORY_VALUES", 20_000)
    sizes = []
    totals = cleaning.running_totals
    monkeypatch.setattr(cleaning, "running_totals", lambda df, *a, **b: sizes.extend(r.n for r in df.groupBy("_range").agg(F.count("*").alias("n")).collect()) or totals(df, *a, **b))
    n = 400_000
    text = F.when(F.col("id") % 10 == 0, F.concat(F.lit("z"), "id")).otherwise(F.concat(F.lit("the same beginning of all "), F.lpad("id", 7, "0")))
    codes = cleaning.category_codes(spark.range(n).select(text.alias("c")), "c")
    row = codes.agg(F.count("*").alias("n"), F.min("code").alias("low"), F.max("code").alias("high"), F.count_distinct("code").alias("d")).first()
    assert tuple(row) == (n, 0, n - 1, n)
    assert len(sizes) == 20 and max(sizes) < 2 * 20_000
    first = codes.orderBy("code").limit(3).collect()
    assert [r.value for r in first] == [f"the same beginning of all {i:07d}" for i in (1, 2, 3)]
