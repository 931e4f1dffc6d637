"""Gradient-boosted trees with isotonic calibration over a column of feature arrays."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, STEP, SEED = 20, 3, 0.3, 20240601


class Calibrated:
    """Scores from 0 to 1; a constant where there was nothing to tell apart."""

    def __init__(self, rows: DataFrame, balanced: bool = False):
        """``rows``: features array<double>, label 0/1, fold 0 (fit) or 1 (calibrate); bounded.

        ``balanced`` gives both labels the same weight in all.
        """
        rows = rows.select("features", F.col("label").cast("double").alias("label"), "fold").coalesce(2).cache()
        try:
            seen = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
            all_ = sum(seen.values())
            self.constant = sum(n for (_, label), n in seen.items() if label == 1) / all_ if all_ else 0.5
            self.trees = self.curve = None
            if seen.get((0, 0.0)) and seen.get((0, 1.0)):
                ones = self.constant
                weight = F.when(F.col("label") == 1, 0.5 / ones).otherwise(0.5 / (1 - ones)) if balanced else F.lit(1.0)
                data = rows.select(array_to_vector("features").alias("vector"), "label", "fold", weight.alias("weight"))
                trees = GBTClassifier(
                    featuresCol="vector", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=64
                )
                self.trees = trees.fit(data.filter("fold = 0"))
                if seen.get((1, 0.0)) and seen.get((1, 1.0)):
                    self.curve = IsotonicRegression(featuresCol="raw", weightCol="weight").fit(self._raw(data.filter("fold = 1")))
        finally:
            rows.unpersist()

    def _raw(self, rows: DataFrame) -> DataFrame:
        out = self.trees.transform(rows)
        return out.withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score`` in place of ``features``."""
        if self.trees is None:
            return rows.drop("features").withColumn("score", F.lit(self.constant))
        out = self._raw(rows.withColumn("vector", array_to_vector("features")).drop("features")).drop("vector")
        if self.curve is None:
            return out.withColumnRenamed("raw", "score")
        out = self.curve.transform(out)
        return out.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "prediction"))).drop("raw", "prediction")
