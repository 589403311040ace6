"""Demand model (D5): boosted trees on the demand frame's features, for the next window's trip count."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.demand import demand_features
from .model import gbt


def train_demand(frame: DataFrame, trees: int = 60) -> PipelineModel:
    """Fit on the rows of split ``train``; no label of theirs lies beyond the border.  A lag from before the calendar counts -1."""
    names = demand_features([int(c[4:]) for c in frame.columns if c.startswith("lag_")])
    stages = VectorAssembler(inputCols=names, outputCol="features")
    train = stages.transform(_filled(frame.filter("split = 'train'"), names)).withColumn("label", F.col("label").cast("double"))
    return PipelineModel([stages, gbt(trees, "label").fit(train)])


def predict_demand(model: PipelineModel, frame: DataFrame, out: str = "demand_pred") -> DataFrame:
    """``frame`` with the predicted count of the next window, not below 0."""
    names = model.stages[0].getInputCols()
    scored = model.transform(_filled(frame, names)).withColumn(out, F.greatest(F.col("prediction"), F.lit(0.0)))
    return scored.drop("features", "prediction")


def _filled(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in names})
