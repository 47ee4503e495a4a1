import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import churn, forest, metrics, stored
from custlens.session import stage

FEATURES = ["recency", "age"]  # two: every node tries both, so that trees follow from the bags alone


@pytest.fixture(scope="module")
def people(spark):
    key = F.col("id")
    noise = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(100))
    late = F.pmod(F.xxhash64(key, F.lit(2)), F.lit(300)).cast("double")
    return spark.range(2_000).select(
        key.alias("customer_id"),
        F.when(noise < 10, (late <= 150).cast("int")).otherwise((late > 150).cast("int")).alias("churn"),
        F.when(key % 7 != 0, late).alias("recency"),
        F.pmod(F.xxhash64(key, F.lit(3)), F.lit(60)).cast("double").alias("age"),
    ).persist()


@pytest.fixture(scope="module")
def rows(people):
    return stage(churn.model_input(people, FEATURES), "forest-people")  # bags follow the layout of the rows


@pytest.fixture
def off_the_driver(monkeypatch):
    monkeypatch.setattr(churn, "DRIVER_ROWS", 10_000)


def fitted(rows, **options):
    return churn.train_random_forest(rows, FEATURES, trees=10, **options)


def scores(model, rows):
    return {r.customer_id: (r.predicted, r.churn_probability) for r in churn.score(model, rows).collect()}


def test_large_forests_stay_off_the_driver(rows, off_the_driver):
    model = fitted(rows)
    assert isinstance(model.stages[-1], forest.Forest)
    assert model.stages[-1].parts.count() == 10
    found = churn.score(model, rows).persist()
    assert found.columns == [*rows.columns, "predicted", "churn_probability"]
    assert found.count() == 2_000 and found.filter("churn_probability < 0 or churn_probability > 1").count() == 0
    own = metrics.classification_metrics(found.withColumn("model", F.lit("forest")), "churn").first()
    assert own.accuracy > 0.8  # a tenth of the labels is noise
    importance = churn.feature_importance(model, rows, FEATURES).collect()
    assert importance[0].feature == "recency" and sum(r.importance for r in importance) == pytest.approx(1.0)


def test_close_to_spark(rows, monkeypatch):
    theirs = churn.train_random_forest(rows, FEATURES, trees=60)
    assert not isinstance(theirs.stages[-1], forest.Forest)
    monkeypatch.setattr(churn, "DRIVER_ROWS", 10_000)
    ours = churn.train_random_forest(rows, FEATURES, trees=60)
    a, b = scores(theirs, rows), scores(ours, rows)
    p, q = (np.array([x[k][1] for k in sorted(a)]) for x in (a, b))
    assert np.abs(p - q).mean() < 0.06 and np.corrcoef(p, q)[0, 1] > 0.95
    assert ours.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=0.03)


@pytest.mark.parametrize("depth", [30, 4])
def test_parts_and_stretches_change_nothing(rows, off_the_driver, monkeypatch, depth):
    model = fitted(rows, max_depth=depth)
    once = scores(model, rows)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 150)
    monkeypatch.setattr(forest, "SCORED_ROWS", 700)
    monkeypatch.setattr(forest, "TREE_GROUPS", 3)
    split = fitted(rows, max_depth=depth)
    assert split.stages[-1].parts.count() > 20
    again = scores(split, rows)
    assert all(again[k][0] == v[0] for k, v in once.items() if abs(v[1] - 0.5) > 1e-9)  # sums of doubles decide a tie
    assert [again[k][1] for k in sorted(again)] == pytest.approx([once[k][1] for k in sorted(once)], abs=1e-12)
    assert split.stages[-1].importances == pytest.approx(model.stages[-1].importances)


def test_stored(spark, people, rows, off_the_driver, tmp_path):
    model = fitted(rows)
    kept = stored.remember(model, people, FEATURES)
    kept.save(spark, str(tmp_path / "kept"))
    kept.save(spark, str(tmp_path / "kept"))  # replaces
    again = stored.load(spark, str(tmp_path / "kept"))
    assert again.model.stages[-1].featureImportances == model.stages[-1].featureImportances
    fresh = {r.customer_id: r.churn_probability for r in churn.churn_scores(model, rows).collect()}
    assert {r.customer_id: r.churn_probability for r in again.scores(people).collect()} == pytest.approx(fresh)


def test_missing_values_are_refused(rows, off_the_driver):
    for bad in (rows.withColumn("age_z", F.when(F.col("customer_id") != 5, F.col("age_z"))), rows.withColumn("churn", F.when(F.col("customer_id") != 5, F.col("churn")))):
        with pytest.raises(Exception, match="(?i)null"):
            churn.train_random_forest(bad, FEATURES, trees=10)


def test_growth():
    draw = np.random.default_rng(3)
    bins, label = draw.integers(0, 12, (4_000, 5)).astype(np.uint8), draw.integers(0, 3, 4_000)
    weight = draw.integers(1, 4, 4_000).astype(float)
    for depth, most in ((30, 5), (6, 2), (0, 5)):
        feature, threshold, left, counts, gains = forest._grow(bins, label, weight, 3, 12, depth, most, np.random.default_rng(1))
        leaf = forest._walk(feature, threshold, left, bins)
        assert (feature[leaf] < 0).all()
        reached = np.zeros_like(counts)
        np.add.at(reached, (leaf, label), weight)
        assert (reached[feature < 0] == counts[feature < 0]).all()
        inner = np.flatnonzero(feature >= 0)
        assert (gains[inner] > 0).all() and (counts[inner] == counts[left[inner]] + counts[left[inner] + 1]).all()
        level = np.zeros(len(feature), int)
        for node in inner:
            level[left[node]] = level[left[node] + 1] = level[node] + 1
        assert level.max() <= depth
        both_leaves = inner[(feature[left[inner]] < 0) & (feature[left[inner] + 1] < 0)]
        assert (counts[left[both_leaves]].argmax(1) != counts[left[both_leaves] + 1].argmax(1)).all()

    def rest(of):  # weight times impurity
        c = np.bincount(label[of], weight[of], 3)
        return c.sum() - (c**2).sum() / c.sum()

    least = min(rest(bins[:, f] <= t) + rest(bins[:, f] > t) for f in range(5) for t in range(11))
    feature, threshold, *_ = forest._grow(bins, label, weight, 3, 12, 30, 5, np.random.default_rng(1))
    low = bins[:, feature[0]] <= threshold[0]
    assert rest(low) + rest(~low) == pytest.approx(least)
