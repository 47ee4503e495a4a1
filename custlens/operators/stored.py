"""Models that outlive their session: a fitted pipeline with the statistics its input was filled and scaled by."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.columns import require_columns
from custlens.functions.order_stats import medians
from custlens.operators import churn

_STATISTICS = "feature string, place int, median double, mean double, std double"


@dataclass
class StoredModel:
    """A model and, per feature, the training median, mean and population deviation."""

    model: PipelineModel
    statistics: list[tuple[str, int, float | None, float | None, float | None]]

    @property
    def features(self) -> list[str]:
        return [s[0] for s in self.statistics]

    def prepare(self, df: DataFrame) -> DataFrame:
        """The input of the model as :func:`custlens.operators.churn.model_input` makes it, from the kept figures."""
        require_columns(df, self.features)
        filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(median)) for f, _, median, _, _ in self.statistics}
        scaled = {f"{f}_z": (F.col(f) - F.lit(mean)) / F.lit(std if std else 1.0) for f, _, _, mean, std in self.statistics}
        return df.withColumns(filled).withColumns(scaled)

    def scores(self, df: DataFrame, customer: str = "customer_id", threshold: float = 0.5) -> DataFrame:
        """``customer, churn_probability, churn_risk`` of every row."""
        return churn.churn_scores(self.model, self.prepare(df), customer, threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write to a folder that every later session can reach; what lies there is replaced."""
        self.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame(self.statistics, _STATISTICS).coalesce(1).write.mode("overwrite").parquet(f"{path}/statistics")


def remember(model: PipelineModel, train: DataFrame, features: Sequence[str]) -> StoredModel:
    """``model``, fitted on ``model_input(train, features)``, with the statistics of ``train``: one row reaches the driver."""
    middle = medians(train, features).first()
    filled = train.select(*[F.coalesce(F.col(f).cast("double"), F.lit(middle[f"{f}_median"])).alias(f) for f in features])
    found = filled.agg(*[fn(f).alias(f"{f}_{name}") for f in features for name, fn in (("mean", F.avg), ("std", F.stddev_pop))]).first()
    return StoredModel(model, [(f, i, middle[f"{f}_median"], found[f"{f}_mean"], found[f"{f}_std"]) for i, f in enumerate(features)])


def load(spark: SparkSession, path: str) -> StoredModel:
    rows = spark.read.schema(_STATISTICS).parquet(f"{path}/statistics").orderBy("place").collect()  # one per feature
    return StoredModel(PipelineModel.load(f"{path}/model"), [tuple(r) for r in rows])
