"""Work on many narrow rows is dealt to several tasks, and costly expressions are computed once a row."""

import pytest
from pyspark.sql import functions as F

from custlens.operators import boosting, churn, clustering, quality
from custlens.session import spread_rows, stage
from custlens.sources import delimited


def labelled(spark, n, at):
    key = F.col("id")
    return spark.range(n).coalesce(1).select(key.alias("customer_id"), key.cast("double").alias("a_z"), (key >= at).cast("int").alias("churn"))


def test_rows_are_spread_the_same_way_every_time(spark):
    rows = stage(labelled(spark, 250, 100), "rows")
    placed = lambda: [(r.customer_id, r.p) for r in spread_rows(rows, 100).withColumn("p", F.spark_partition_id()).collect()]
    assert placed() == placed() and len({p for _, p in placed()}) == 3
    assert spread_rows(rows, 250) is rows


def test_forest_keeps_its_place_in_every_tree(spark):
    model = churn.train_random_forest(labelled(spark, 60, 30), ["a"], trees=2, max_depth=2).stages[-1]
    assert model.getOrDefault(model.getParam("cacheNodeIds"))


@pytest.mark.parametrize("train", [churn.train_random_forest, churn.train_boosted_trees])
def test_many_rows_are_split_at_quantiles_of_all_of_them(spark, monkeypatch, train):
    """Spark ML's own quantiles come from about 10,000 of these rows, and none falls on the step."""
    monkeypatch.setattr(churn, "TASK_ROWS", 10_000)
    rows = labelled(spark, 32_000, 24_000)
    model = train(rows, ["a"], trees=3, max_depth=3, max_bins=4)
    scored = churn.score(model, rows)
    assert scored.columns == ["customer_id", "a_z", "churn", "predicted", "churn_probability"]
    assert scored.filter("predicted <> churn").count() <= 4  # a ten-thousandth of the rows


def test_points_of_k_means_are_spread(spark, monkeypatch):
    seen = []
    fit = clustering.fit_kmeans
    monkeypatch.setattr(clustering, "TASK_ROWS", 100)
    monkeypatch.setattr(clustering, "fit_kmeans", lambda rows, *a, **b: seen.append(rows.rdd.getNumPartitions()) or fit(rows, *a, **b))
    clustering.kmeans_segments(labelled(spark, 250, 1).withColumnRenamed("a_z", "a"), ["a"], k=2, starts=1)
    assert seen == [3]


def test_rows_of_boosting_are_spread(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "stage", lambda df, purpose: seen.append(df.rdd.getNumPartitions()) or stage(df, purpose))
    boosting.train(labelled(spark, 250, 100), ["a_z"], trees=1)
    assert seen[0] == 3


def test_a_record_is_parsed_once(spark):
    records = spark.createDataFrame([('1;"a;b"',), ("1;2;3",)], "value string").repartition(2)
    split = delimited._fields(records, {";": ";"}, 2, F.lit(";"))
    named = split.filter(F.col("n_fields") <= 2).select(F.get("fields", F.lit(0)).alias("a"), F.get("fields", F.lit(1)).alias("b"))
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert [tuple(r) for r in named.collect()] == [("1", "a;b")]


def test_texts_that_cannot_be_in_a_format_are_not_parsed(spark):
    texts = ["1/2/2020", "01/02/2020", "31/2/2020", "2020-1-2", "2020/01/02", "1-2-2020", "n/a", "", None, "1/2/20", " 1/2/2020", "001/2/2020", "1/2/+2020", "1/2/12020", "-1/2/2020", "1/2/2020 x", "١/2/2020", "1/2/2020\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fmt in quality.DATE_FORMATS:
        assert "rlike" in str(quality._parsed("t", fmt))
        assert df.filter(~quality._parsed("t", fmt).eqNullSafe(F.try_to_date("t", fmt))).count() == 0
    assert quality._shape("dd MMM yyyy") is None and quality._shape("yyyy'-'M") is None
