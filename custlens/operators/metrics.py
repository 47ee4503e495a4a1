"""Quality of predictions, computed from counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import safe_ratio, total
from custlens.functions.order_stats import running_totals


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def per_class_metrics(
    predictions: DataFrame, label: str = "label", predicted: str = "predicted", by: str = "model"
) -> DataFrame:
    """(by, class, support, precision, recall, f1); undefined values are 0."""
    counts = predictions.groupBy(by, label, predicted).agg(F.count("*").alias("n"))
    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col(label) == F.col(predicted), n).otherwise(none)
    roles = F.array(
        F.struct(F.col(label).alias("class"), n.alias("actual"), none.alias("claimed"), hit.alias("hits")),
        F.struct(F.col(predicted).alias("class"), none.alias("actual"), n.alias("claimed"), none.alias("hits")),
    )
    sums = (
        counts.select(by, F.inline(roles))
        .groupBy(by, "class")
        .agg(F.sum("actual").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits"))
    )
    return sums.select(
        by,
        "class",
        "support",
        _or_zero(safe_ratio("hits", "claimed")).alias("precision"),
        _or_zero(safe_ratio("hits", "support")).alias("recall"),
        _or_zero(safe_ratio(F.col("hits") * 2, F.col("claimed") + F.col("support"))).alias("f1"),
    )


def classification_metrics(
    predictions: DataFrame,
    label: str = "label",
    predicted: str = "predicted",
    by: str = "model",
    positive: int = 1,
) -> DataFrame:
    """Per model: rows, accuracy, precision, recall, f1 of the positive class, and support-weighted averages."""
    classes = per_class_metrics(predictions, label, predicted, by)
    support = F.col("support")

    def of_positive(c: str) -> Column:
        return _or_zero(F.max(F.when(F.col("class") == positive, F.col(c)))).alias(c)

    def weighted(c: str) -> Column:
        return safe_ratio(F.sum(support * F.col(c)), F.sum(support))

    return classes.groupBy(by).agg(
        F.sum(support).alias("rows"),
        weighted("recall").alias("accuracy"),
        of_positive("precision"),
        of_positive("recall"),
        of_positive("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
    )


def best_model(metrics: DataFrame, by: str = "model", metric: str = "f1") -> DataFrame:
    """One row: the model with the largest metric (the smallest name wins a tie) and the metric."""
    return metrics.agg(F.min_by(by, F.struct(-F.col(metric), F.col(by))).alias(by), F.max(metric).alias(metric))


def roc_auc(predictions: DataFrame, label: str = "label", score: str = "score", by: str = "model") -> DataFrame:
    """Area under the ROC curve per model; 0.5 when a class is absent. Equal scores count half."""
    is_positive = F.col(label) == 1
    by_score = predictions.groupBy(by, score).agg(
        F.count_if(is_positive).alias("positives"), F.count_if(~is_positive).alias("negatives")
    )
    ranked = running_totals(by_score, [score], ["negatives"], by=[by])
    below = F.col("negatives_before") + F.col("negatives") / 2
    sums = ranked.groupBy(by).agg(
        F.sum(F.col("positives") * below).alias("_wins"),
        total("positives").cast("double").alias("_p"),
        total("negatives").cast("double").alias("_n"),
    )
    return sums.select(by, F.coalesce(F.try_divide("_wins", F.col("_p") * F.col("_n")), F.lit(0.5)).alias("roc_auc"))


def confusion_matrix(
    predictions: DataFrame,
    label: str = "label",
    predicted: str = "predicted",
    classes: Sequence[int] = (0, 1),
    by: str | None = None,
) -> DataFrame:
    """(by, actual, predicted, count) with a row for every combination of classes, 0 where none occurred."""
    groups = [by] if by else []
    a, p, n = F.col(label), F.col(predicted), F.col("_n")
    counts = predictions.groupBy(*groups, label, predicted).agg(F.count("*").alias("_n"))
    cells = F.array(
        *[
            F.struct(
                F.lit(x).cast("int").alias("actual"),
                F.lit(y).cast("int").alias("predicted"),
                F.when((a == x) & (p == y), n).otherwise(F.lit(0)).alias("count"),
            )
            for x in classes
            for y in classes
        ]
    )
    listed = counts.select(*groups, F.inline(cells)).groupBy(*groups, "actual", "predicted").agg(F.sum("count").alias("count"))
    if by:
        return listed
    every = predictions.sparkSession.createDataFrame([(x, y) for x in classes for y in classes], "actual int, predicted int")
    return every.join(listed, ["actual", "predicted"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def churn_rates(confusion: DataFrame, positive: int = 1, by: str | None = None) -> DataFrame:
    """Actual and predicted share of the positive class, one row (per ``by``)."""
    whole = F.sum("count")
    return confusion.groupBy(*([by] if by else [])).agg(
        safe_ratio(F.sum(F.when(F.col("actual") == positive, F.col("count")).otherwise(0)), whole).alias("actual_rate"),
        safe_ratio(F.sum(F.when(F.col("predicted") == positive, F.col("count")).otherwise(0)), whole).alias("predicted_rate"),
    )
