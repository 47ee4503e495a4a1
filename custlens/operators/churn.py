"""Churn data sets, splits, models and scores."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.columns import as_date, attach, last_date, months_after, one_row, total
from custlens.functions.order_stats import medians, running_totals
from custlens.operators import forest as own_forest
from custlens.operators import metrics
from custlens.operators.cleaning import encode_categories
from custlens.operators.clustering import standardise
from custlens.operators.enrich import enrich
from custlens.session import spread_rows, stage

# Features in the order models see them, and those that are categories.
FEATURES = ["recency", "frequency", "monetary", "age", "gender", "tenure", "segment"]
CATEGORIES = ["gender", "city", "segment"]

TASK_ROWS = 100_000  # rows of a model that one task scans, about; a forest of 100 trees keeps half a kilobyte a row
DRIVER_ROWS = 500_000  # rows times trees that Spark ML may grow: up to two nodes each, about half a kilobyte a node, on the driver


def churn_labels(
    orders: DataFrame,
    as_of: Column | dt.date | str | None = None,
    observe_months: int = 6,
    horizon_months: int = 3,
    fallback_months: int = 1,
    customer: str = "customer_id",
    date: str = "order_date",
    order: str = "order_id",
    amount: str = "price",
) -> DataFrame:
    """recency, frequency, monetary before ``as_of`` and churn = no order in the months after it.

    One pass and one shuffle: both windows are conditional aggregates of the same group. If all customers
    get the same label the shorter ``fallback_months`` horizon is used; if that gives one class too the
    query fails, as no model can be trained on it.
    """
    as_of = last_date(orders, date) if as_of is None else as_date(as_of)
    day = F.col(date)
    in_reach = (day >= months_after(as_of, -observe_months)) & (day <= months_after(as_of, max(horizon_months, fallback_months)))
    pivot = F.col("_as_of")
    before = day <= pivot
    soon = (day > pivot) & (day <= months_after(pivot, fallback_months))
    in_horizon = (day > pivot) & (day <= months_after(pivot, horizon_months))
    per_customer = (
        attach(orders.filter(in_reach & F.col(customer).isNotNull()), "_as_of", as_of)
        .groupBy(customer)
        .agg(
            F.max(F.when(before, day)).alias("_last"),
            F.count(F.when(before, F.col(order))).alias("frequency"),
            total(F.when(before, F.col(amount))).alias("monetary"),
            F.min(F.when(in_horizon, 0).otherwise(1)).alias("_churn"),
            F.min(F.when(soon, 0).otherwise(1)).alias("_churn_soon"),
        )
        .filter(F.col("_last").isNotNull())
    )
    per_customer = stage(per_customer, "churn-customers")  # read twice: for the classes, then for the rows
    classes = one_row(
        per_customer,
        F.countDistinct("_churn").alias("long"),
        F.countDistinct("_churn_soon").alias("short"),
    )
    label = (
        F.when(F.col("_classes.long") > 1, F.col("_churn"))
        .when(F.col("_classes.short") > 1, F.col("_churn_soon"))
        .otherwise(F.raise_error(F.lit("all customers have the same churn label")).cast("int"))
    )
    return attach(per_customer, "_classes", classes).select(
        customer, F.datediff(as_of, "_last").alias("recency"), "frequency", "monetary", label.alias("churn")
    )


def churn_base(
    orders: DataFrame,
    customers: DataFrame,
    segments: DataFrame | None = None,
    as_of: Column | dt.date | str | None = None,
    customer: str = "customer_id",
    signup: str = "signup_date",
    date: str = "order_date",
    **windows,
) -> DataFrame:
    """Labels and RFM with demographics, segment and tenure (days, may be negative)."""
    pivot = last_date(orders, date) if as_of is None else as_date(as_of)
    rows = churn_labels(orders, pivot, customer=customer, date=date, **windows)
    rows = enrich(rows, customers, customer)
    if segments is not None:
        rows = enrich(rows, segments, customer)
    return rows.withColumn("tenure", F.datediff(pivot, F.col(signup)))


def code_categories(base: DataFrame) -> DataFrame:
    """Codes instead of categories. Every category is a branch that reads ``base``: stage it first."""
    return encode_categories(base, [c for c in CATEGORIES if c in base.columns])


def churn_dataset(orders: DataFrame, customers: DataFrame, segments: DataFrame | None = None, **options) -> DataFrame:
    """:func:`churn_base` with coded categories."""
    return code_categories(churn_base(orders, customers, segments, **options))


def churn_features(rows: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in rows.columns]


def label_distribution(rows: DataFrame, label: str = "churn") -> DataFrame:
    """Rows and percentage per label."""
    counts = rows.groupBy(label).agg(F.count("*").alias("count"))
    whole = F.sum("count").over(Window.partitionBy(F.lit(0)))  # one row per label
    return counts.withColumn("pct", F.try_divide(F.col("count").cast("double"), whole.cast("double")) * 100)


def stratified_split(
    df: DataFrame, label: str = "churn", test_fraction: float = 0.3, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """Add ``split`` (train or test) with an exact share of each label.

    Rows are ranked within their label by a hash of key and seed, so the split is the same for every
    partitioning. The test size is rounded up; labels get their share of it by largest remainder.
    Hash ranges are ranked apart from each other, so a very frequent label is spread over many tasks.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(hashed, ["_hash", key], ["_one"], by=[label], slot=F.shiftright("_hash", 52))
    classes = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = one_row(classes, F.sum("n").alias("n"))["n"]
    test_rows = F.ceil(F.col("_whole") * test_fraction)
    fair = F.col("n") * test_rows / F.col("_whole")
    shares = attach(classes, "_whole", whole).select(
        label, test_rows.alias("test_rows"), F.floor(fair).alias("base"), (fair - F.floor(fair)).alias("rest")
    )
    all_labels = Window.partitionBy("test_rows")  # one row per label, all with the same test size
    left_over = F.col("test_rows") - F.sum("base").over(all_labels)
    place = F.row_number().over(all_labels.orderBy(F.desc("rest"), label))
    quotas = shares.select(label, (F.col("base") + F.when(place <= left_over, 1).otherwise(0)).alias("quota"))
    quota = quotas.agg(F.map_from_entries(F.collect_list(F.struct(label, "quota")))).scalar()
    split = F.when(F.col("_one_before") < quota[F.col(label)], F.lit("test")).otherwise(F.lit("train"))
    return ranked.withColumn("split", split).select(*df.columns, "split")


def fill_features(df: DataFrame, features: Sequence[str], stats_from: DataFrame | None = None) -> DataFrame:
    """Missing features become the median of ``stats_from`` (default: ``df``)."""
    middle = medians(df if stats_from is None else stats_from, features)
    known = middle.select(F.struct(*[F.col(f"{c}_median").alias(c) for c in features]).alias("middle")).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("_known")[c]) for c in features}
    return attach(df, "_known", known).withColumns(filled).drop("_known")


def model_input(df: DataFrame, features: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Filled and standardised features as ``{feature}_z``, both with the statistics of the training rows."""
    base = df if train is None else train
    filled = fill_features(df, features, base)
    return standardise(filled, features, fill_features(base, features))


def _edges(staged: DataFrame, names: Sequence[str], max_bins: int) -> list[list[float]]:
    """Edges of ``max_bins`` buckets a column at quantiles of all rows (within a ten-thousandth of the rows)."""
    at = [i / max_bins for i in range(1, max_bins)]
    found = staged.agg(*[F.percentile_approx(c, at, 10_000).alias(c) for c in names]).first()
    # a bucket holds its lower edge, a bin its upper one
    return [[-math.inf, *sorted({math.nextafter(v, math.inf) for v in found[c] or []}), math.inf] for c in names]


def _fit(classifier, rows: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit on rows that are written once and dealt to tasks of about ``TASK_ROWS``.

    Spark ML takes the quantiles that features are split at from a sample as soon as there are more rows than its sample
    holds. From there on features are cut at quantiles of all rows first, so that every bin is one value to Spark ML.
    Forests that could outgrow the driver are grown by :mod:`custlens.operators.forest`, on such bins too.
    """
    names, label = [f"{c}_z" for c in features], classifier.getLabelCol()
    staged = stage(rows.select(*names, label), "fit-input")
    n = staged.count()
    outgrows = isinstance(classifier, RandomForestClassifier) and n * classifier.getNumTrees() > DRIVER_ROWS
    stages = []
    if outgrows or n > max(classifier.getMaxBins() ** 2, 10_000):
        edges = _edges(staged, names, classifier.getMaxBins())
        binned = [f"{c}_bin" for c in names]
        stages.append(Bucketizer(splitsArray=edges, inputCols=names, outputCols=binned))
        names = binned
    if outgrows:
        points = stages[0].transform(spread_rows(staged, TASK_ROWS, n))
        n_bins = max(len(e) - 1 for e in edges)
        trees, depth, seed = classifier.getNumTrees(), classifier.getMaxDepth(), classifier.getSeed()
        return PipelineModel([*stages, own_forest.train(points, names, label, trees, depth, n_bins, seed)])
    stages.append(VectorAssembler(inputCols=names, outputCol="features"))
    points = PipelineModel(stages).transform(spread_rows(staged, TASK_ROWS, n)).select("features", label).persist()
    try:
        model = classifier.fit(points)
    finally:
        points.unpersist()
    return PipelineModel([*stages, model])


def train_random_forest(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    trees: int = 100,
    max_depth: int = 30,
    max_bins: int = 32,
    seed: int = 42,
) -> PipelineModel:
    """Random forest on the output of :func:`model_input`. A depth of 30 is the most that Spark grows; features are
    split at ``max_bins`` - 1 quantiles. From ``DRIVER_ROWS`` on (rows times trees) the trees stay off the driver; such
    a forest draws its bootstrap and features otherwise than Spark ML does."""
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=max_depth, maxBins=max_bins, seed=seed, cacheNodeIds=True)
    return _fit(forest, rows, features)


def train_boosted_trees(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    trees: int = 100,
    max_depth: int = 5,
    rate: float = 0.1,
    max_bins: int = 32,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees on the output of :func:`model_input`."""
    boosted = GBTClassifier(labelCol=label, maxIter=trees, maxDepth=max_depth, stepSize=rate, maxBins=max_bins, seed=seed)
    return _fit(boosted, rows, features)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` (0 or 1) and ``churn_probability``."""
    scored = model.transform(rows)
    binned = [c for s in model.stages if isinstance(s, Bucketizer) for c in s.getOutputCols()]
    return (
        scored.withColumn("predicted", F.col("prediction").cast("int"))
        .withColumn("churn_probability", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability", "prediction", *binned)
    )


def feature_importance(model: PipelineModel, rows: DataFrame, features: Sequence[str], top: int | None = None) -> DataFrame:
    """(feature, importance), most important first; the model holds one number per feature."""
    values = model.stages[-1].featureImportances.toArray()
    pairs = [(f, float(v)) for f, v in zip(features, values)]
    table = rows.sparkSession.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table.limit(top) if top else table


def risk_band(probability: str, threshold: float = 0.5) -> Column:
    """high from the threshold on, medium from half of it on, low below."""
    p = F.col(probability)
    return F.when(p >= threshold, "high").when(p >= threshold / 2, "medium").when(p.isNotNull(), "low")


def churn_scores(model: PipelineModel, rows: DataFrame, customer: str = "customer_id", threshold: float = 0.5) -> DataFrame:
    """(customer, churn_probability, churn_risk) for every customer in ``rows``."""
    scored = score(model, rows)
    return scored.select(customer, "churn_probability", risk_band("churn_probability", threshold).alias("churn_risk"))


def churn_risk_summary(scores: DataFrame, threshold: float = 0.5, probability: str = "churn_probability") -> DataFrame:
    """One row: customers, at_risk_count, at_risk_pct, avg_risk_pct."""
    counts = scores.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col(probability) >= threshold).alias("at_risk_count"),
        (F.avg(probability) * 100).alias("avg_risk_pct"),
    )
    share = F.try_divide(F.col("at_risk_count").cast("double"), F.col("customers").cast("double")) * 100
    return counts.select("customers", "at_risk_count", share.alias("at_risk_pct"), "avg_risk_pct")


def train_and_compare(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    test_fraction: float = 0.3,
    seed: int = 42,
    customer: str = "customer_id",
    forest: Mapping[str, float] | None = None,
    boosted: Mapping[str, float] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, PipelineModel]]:
    """Both models on one split: (predictions of the test rows, metrics with ROC area, confusion matrices, models).

    ``metrics.best_model`` picks from the second result. ``forest`` and ``boosted`` are passed to the training functions.
    """
    split = stage(stratified_split(rows, label, test_fraction, seed, customer), "split")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    fitted = stage(model_input(train, features), "train-input")
    asked = stage(model_input(test, features, train), "test-input")
    models = {
        "forest": train_random_forest(fitted, features, label, seed=seed, **(forest or {})),
        "boosted": train_boosted_trees(fitted, features, label, seed=seed, **(boosted or {})),
    }
    scored = [
        score(model, asked).select(
            F.lit(name).alias("model"), customer, F.col(label).cast("int").alias("label"), "predicted", F.col("churn_probability").alias("score")
        )
        for name, model in models.items()
    ]
    predictions = stage(scored[0].unionByName(scored[1]), "predictions")
    measured = metrics.classification_metrics(predictions).join(metrics.roc_auc(predictions), "model")
    return predictions, measured, metrics.confusion_matrix(predictions, by="model"), models
