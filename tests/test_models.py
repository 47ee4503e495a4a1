import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import advice, churn, clustering, enrich, marketing, metrics, rfm
from custlens.plans import catalog


def test_split_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(1003).select(F.col("id").alias("customer_id"), (F.col("id") % 10 < 3).cast("int").alias("churn"))
    once = churn.stratified_split(df.repartition(3))
    again = churn.stratified_split(df.orderBy(F.desc("customer_id")).repartition(9))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    sizes = {(r.churn, r.split): r["count"] for r in once.groupBy("churn", "split").count().collect()}
    assert sizes[(0, "test")] + sizes[(1, "test")] == 301  # ceil(0.3 * 1003)
    assert sizes[(1, "test")] in (90, 91) and sum(sizes.values()) == 1003


def orders(spark, *entries):
    data = [(c, i, 10.0, dt.date.fromisoformat(d)) for i, (c, d) in enumerate(entries)]
    return spark.createDataFrame(data, "customer_id string, order_id int, price double, order_date date")


def test_churn_labels(spark, rows):
    table = orders(spark, ("a", "2025-01-10"), ("a", "2025-03-01"), ("b", "2025-01-20"), ("c", "2024-01-01"), ("d", "2025-02-02"))
    found = churn.churn_labels(table, "2025-02-01")
    assert rows(found) == [("a", 22, 1, 10.0, 0), ("b", 12, 1, 10.0, 1)]


def test_shorter_horizon_when_everyone_comes_back(spark, rows):
    table = orders(spark, ("a", "2025-01-10"), ("a", "2025-02-10"), ("b", "2025-01-20"), ("b", "2025-04-15"))
    assert rows(churn.churn_labels(table, "2025-02-01"), "customer_id", "churn") == [("a", 0), ("b", 1)]


def test_single_class_is_refused(spark):
    table = orders(spark, ("a", "2025-01-10"), ("b", "2025-01-20"))
    with pytest.raises(Exception, match="same churn label"):
        churn.churn_labels(table).collect()


@pytest.fixture(scope="module")
def training(spark):
    df = spark.range(400).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 2).cast("int").alias("churn"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 2 * 10.0 + F.col("id") % 3).alias("recency"),
        (F.col("id") % 5).cast("double").alias("age"),
    )
    split = churn.stratified_split(df)
    return split.filter("split = 'train'").persist(), split.filter("split = 'test'").persist()


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_models_learn_and_score(spark, training, kind):
    train, test = training
    features = ["recency", "age"]
    rows = churn.model_input(train, features)
    fit = (lambda: churn.train_random_forest(rows, features, trees=5, max_depth=4)) if kind == "forest" else (
        lambda: churn.train_boosted_trees(rows, features, trees=5)
    )
    model = fit()
    scored = churn.score(model, churn.model_input(test, features, train)).persist()
    assert scored.count() == test.count()
    assert scored.filter("churn_probability < 0 or churn_probability > 1").count() == 0
    result = metrics.classification_metrics(scored.withColumn("model", F.lit(kind)), "churn").first()
    assert result.accuracy > 0.9 and result.rows == test.count()
    importance = churn.feature_importance(model, train, features).collect()
    assert importance[0].feature == "recency" and sum(r.importance for r in importance) == pytest.approx(1.0)
    scores = churn.churn_scores(model, churn.model_input(train, features))
    assert {r.churn_risk for r in scores.collect()} <= {"high", "medium", "low"}


def predictions(spark, pairs):
    data = [("m", label, predicted, score) for label, predicted, score in pairs]
    return spark.createDataFrame(data, "model string, label int, predicted int, score double")


def test_metrics_without_positive_predictions(spark):
    row = metrics.classification_metrics(predictions(spark, [(1, 0, 0.1), (0, 0, 0.2), (0, 0, 0.3)])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)
    assert row.accuracy == pytest.approx(2 / 3) and row.weighted_precision == pytest.approx(4 / 9)


def test_auc(spark):
    table = predictions(spark, [(1, 0, 0.9), (0, 0, 0.5), (1, 0, 0.5), (0, 0, 0.1)])
    assert metrics.roc_auc(table).first().roc_auc == pytest.approx(0.875)
    assert metrics.roc_auc(predictions(spark, [(1, 1, 0.9), (1, 1, 0.5)])).first().roc_auc == 0.5


def test_confusion_has_empty_cells(spark, rows):
    table = metrics.confusion_matrix(predictions(spark, [(1, 1, 0.9), (1, 0, 0.5)]))
    assert rows(table) == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 1)]
    rate = metrics.churn_rates(table).first()
    assert (rate.actual_rate, rate.predicted_rate) == (1.0, 0.5)


def test_risk_threshold_is_inclusive(spark):
    scores = spark.createDataFrame([("a", 0.5), ("b", 0.49), ("c", None)], "customer_id string, churn_probability double")
    row = churn.churn_risk_summary(scores).first()
    assert (row.customers, row.at_risk_count) == (3, 1) and row.avg_risk_pct == pytest.approx(49.5)


def test_cluster_indices(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 0.0, 2.0), ("b", 10.0, 0.0), ("b", 10.0, 2.0)], "segment string, x double, y double")
    row = clustering.cluster_dispersion(df, ["x", "y"]).first()
    assert (row.inertia, row.calinski_harabasz) == (4.0, 50.0)
    assert clustering.davies_bouldin(df, ["x", "y"]).first().davies_bouldin == pytest.approx(0.2)
    one = df.filter("segment = 'a'")
    assert clustering.cluster_dispersion(one, ["x", "y"]).first().calinski_harabasz == 0.0
    assert clustering.davies_bouldin(one, ["x", "y"]).first().davies_bouldin == 0.0
    assert clustering.silhouette(one, ["x", "y"]).first().silhouette == 0.0
    flat = clustering.standardise(spark.createDataFrame([(3.0,), (3.0,)], "x double"), ["x"])
    assert [r.x_z for r in flat.collect()] == [0.0, 0.0]


def test_segment_recommendations(spark):
    data = [("idle", 200, 1, 10.0)] * 3 + [("loyal", 10, 20, 10.0)] * 3 + [("rich", 10, 1, 900.0)] + [("plain", 10, 1, 10.0)] * 3
    df = spark.createDataFrame(data, "segment string, recency int, frequency int, monetary double")
    found = {r.segment: r.recommendations for r in advice.segment_recommendations(df).collect()}
    assert found["idle"] == [advice.REACTIVATE] and found["loyal"] == [advice.LOYALTY]
    assert found["rich"] == [advice.VIP]
    assert found["plain"] == [text % "plain" for text in advice.GENERIC]


def test_segment_strategies(spark):
    data = [(0, 100.0, 2.0, 9.0), (1, 10.0, 0.5, 4.0)]
    df = spark.createDataFrame(data, "segment int, avg_clv double, avg_purchase_freq double, avg_rfm_score double")
    high, low = advice.segment_strategies(df).orderBy("segment").collect()
    assert high.objectives == [advice.HIGH_VALUE["objective"]] and high.budget == pytest.approx(20.0) and high.kpis == []
    assert low.actions == [part["action"] for part in (advice.LOWER_VALUE, advice.RARE_BUYERS, advice.LOW_SCORE)]
    assert low.budget == pytest.approx(1.0) and len(low.kpis) == 2


def test_trend_signal(spark):
    data = [(dt.date(2025, 1, 1) + dt.timedelta(days=i), 10.0 if i < 33 else 30.0) for i in range(40)]
    daily = spark.createDataFrame(data, "date date, v double")
    row = marketing.trend_signal(daily, "v").first()
    assert row.is_rising and row.recent_mean == 30.0
    assert not marketing.trend_signal(daily.filter("date > '2025-01-15'"), "v").first().is_rising


def test_playbook_leaves_unknown_segments_empty(spark):
    df = spark.createDataFrame([("0",), ("1",), ("x",)], "segment string")
    found = {r.segment: r.objective for r in advice.segment_playbook(df).collect()}
    assert found == {"0": None, "1": advice.PLAYBOOK[0][1], "x": None}


def test_silhouette_against_all_distances(spark):
    rng = np.random.default_rng(4)
    points = [(str(rng.integers(3)), *map(float, rng.normal(size=2))) for _ in range(60)] + [("alone", 5.0, 5.0), (None, 0.0, 0.0)]
    found = clustering.silhouette(spark.createDataFrame(points, "segment string, x double, y double"), ["x", "y"]).first().silhouette
    known = [p for p in points if p[0]]
    values = []
    for name, *p in known:
        by = {}
        for other, *q in known:
            by.setdefault(other, []).append(sum((a - b) ** 2 for a, b in zip(p, q)))
        inside = sum(by[name]) / (len(by[name]) - 1) if len(by[name]) > 1 else None
        outside = min(np.mean(v) for k, v in by.items() if k != name)
        values.append(0 if inside is None else (outside - inside) / max(outside, inside))
    assert found == pytest.approx(np.mean(values))


def test_confusion_for_every_model(spark, rows):
    data = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("b", 0, 0)], "model string, label int, predicted int")
    table = metrics.confusion_matrix(data, by="model")
    assert rows(table, "model", "actual", "predicted", "count") == sorted(
        (m, a, p, {("a", 1, 1): 1, ("a", 0, 1): 1, ("b", 0, 0): 1}.get((m, a, p), 0)) for m in "ab" for a in (0, 1) for p in (0, 1)
    )
    assert rows(metrics.churn_rates(table, by="model"), "model", "actual_rate", "predicted_rate") == [("a", 0.5, 1.0), ("b", 0.0, 0.0)]


def test_mapping_with_repeated_keys(spark, rows):
    facts = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    table = spark.createDataFrame([("x", 9, 1), ("x", 3, 2), ("y", 5, 1)], "k string, v int, version int")
    assert rows(enrich.dictionary_map(facts, table, "k", "v", "to", ["version"]).fillna(-1)) == [("x", 3), ("y", 5), ("z", -1)]
    with pytest.raises(Exception, match="more than once"):
        enrich.dictionary_map(facts, table, "k", "v", "to").collect()


def test_undated_orders_and_first_known_attributes(spark, rows):
    day = dt.date(2025, 1, 2)
    sales = spark.createDataFrame(
        [(1, 1, 2, 5.0, day, None), (2, 1, 1, 1.0, None, "late"), (3, 1, 1, 1.0, day + dt.timedelta(3), "mail"), (4, 2, 1, 1.0, None, None)],
        "order_id int, customer_id int, quantity int, amount double, order_date date, contact string",
    )
    assert rows(rfm.rfm(sales), "customer_id", "frequency") == [(1, 3), (2, 1)]
    assert rows(rfm.rfm(sales, count="dates"), "customer_id", "frequency") == [(1, 2), (2, 0)]
    people = spark.createDataFrame([(1, "Zoé")], "customer_id int, name string")
    dated = sales.dropna(subset=["order_date"])
    found = rfm.customer_aggregate(dated, first=["contact"], customers=people, attributes=["name"])
    assert rows(found, "customer_id", "contact_first", "name_first", "order_date_count") == [(1, "mail", "Zoé", 2)]


def test_registered_boosted_trees_keep_the_default_number(spark, monkeypatch):
    class Asked(Exception):
        pass

    def note(*_, **more):
        raise Asked(more)

    monkeypatch.setattr(churn, "train_boosted_trees", note)
    monkeypatch.setattr(churn, "train_random_forest", lambda *_, **__: None)
    for name in ("boosted_trees_known_labels", "churn_scores_known_labels", "train_and_compare", "compared_confusion"):
        with pytest.raises(Asked) as asked:
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "trees" not in asked.value.args[0]
