"""Isotonic calibration, calibrated models and frozen-base recalibration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.boosting import BoostedTrees, exists
from riskspark.operators.ordered import materialize


@dataclass
class IsotonicCalibrator:
    """Monotone step-and-line map from a raw score to a probability.

    Spark's isotonic regression pools tied scores, clips outside the fitted
    range and interpolates linearly between knots.
    """
    model: IsotonicRegressionModel
    input_col: str = "p_default"
    output_col: str = "p_calibrated"

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.model.copy()
        m.setFeaturesCol(self.input_col).setPredictionCol(self.output_col)
        return m.transform(df)

    def knots(self) -> DataFrame:
        """(boundary, prediction) pairs of the fitted step function."""
        b = self.model.boundaries.toArray().tolist()
        p = self.model.predictions.toArray().tolist()
        spark = self.model._sc and __import__("pyspark").sql.SparkSession.getActiveSession()
        return spark.createDataFrame(list(zip(b, p)), "boundary double, prediction double")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, input_col: str = "p_default", output_col: str = "p_calibrated"):
        return cls(IsotonicRegressionModel.load(path), input_col, output_col)


def fit_isotonic(df: DataFrame, score_col: str = "p_default", label_col: str = "default",
                 output_col: str = "p_calibrated") -> IsotonicCalibrator:
    """Fit an increasing isotonic map score -> P(label = 1) on labelled rows."""
    # equal scores are one weighted point, so a frequent score is no hot partition
    data = (df.filter(F.col(label_col).isNotNull() & F.col(score_col).isNotNull())
            .groupBy(F.col(score_col).cast("double").alias("_x"))
            .agg(F.avg(F.col(label_col).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")))
    iso = IsotonicRegression(featuresCol="_x", labelCol="_y", weightCol="_w", predictionCol=output_col, isotonic=True)
    # written first: the fit reads its points twice, for ranges of scores and for the fit itself
    return IsotonicCalibrator(iso.fit(materialize(data)), score_col, output_col)


@dataclass
class CalibratedModel:
    """A fitted base pipeline (probability vector) plus an isotonic layer.

    ``score`` adds ``p_raw`` (base positive-class probability) and
    ``p_default`` (calibrated); the base never sees the calibration slice.
    """
    base: object                       # fitted PipelineModel with a probability column
    iso: IsotonicCalibrator | None
    name: str = "calibrated"

    def raw(self, df: DataFrame) -> DataFrame:
        # a previous score on the input is replaced, not duplicated
        df = df.drop(*[c for c in ("p_raw", "p_default", "decision") if c in df.columns])
        if hasattr(self.base, "score_raw"):  # boosted trees, or any scorer of its own
            return self.base.score_raw(df)
        out = self.base.transform(df)
        out = out.withColumn("p_raw", vector_to_array(F.col("probability"))[1])
        drop = [c for c in ("rawPrediction", "probability", "prediction", "features") if c in out.columns]
        return out.drop(*drop)

    def score(self, df: DataFrame) -> DataFrame:
        r = self.raw(df)
        if self.iso is None:
            return r.withColumn("p_default", F.col("p_raw"))
        cal = IsotonicCalibrator(self.iso.model, "p_raw", "p_default")
        return cal.transform(r)

    def save(self, path: str) -> None:
        if isinstance(self.base, BoostedTrees):
            self.base.save(SparkSession.active(), f"{path}/trees")
        else:
            self.base.write().overwrite().save(f"{path}/base")
        if self.iso is not None:
            self.iso.save(f"{path}/isotonic")

    @classmethod
    def load(cls, path: str, name: str = "calibrated"):
        from pyspark.ml import PipelineModel
        spark = SparkSession.active()
        base = BoostedTrees.load(spark, f"{path}/trees") if exists(spark, f"{path}/trees/trees") else PipelineModel.load(f"{path}/base")
        layer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/isotonic")
        # a bare base model has no such folder; a folder that can't be read is an error
        there = layer.getFileSystem(spark._jsc.hadoopConfiguration()).exists(layer)
        iso = IsotonicCalibrator.load(f"{path}/isotonic", "p_raw", "p_default") if there else None
        return cls(base, iso, name)


def base_of(model):
    """What recalibration leaves as it is: the uncalibrated part of ``model``."""
    if isinstance(model, CalibratedModel):
        return model.base
    return model


def fit_calibrated(base_df: DataFrame, calib_df: DataFrame, build_base, label_col: str = "default") -> CalibratedModel:
    """Fit the base on ``base_df`` and the isotonic layer on the base's raw
    scores for ``calib_df`` (a later, held-out slice)."""
    base = build_base(base_df)
    bare = CalibratedModel(base, None)
    raw = bare.raw(calib_df)
    iso = fit_isotonic(raw, "p_raw", label_col, "p_default")
    return CalibratedModel(base, IsotonicCalibrator(iso.model, "p_raw", "p_default"))


def recalibrate(model, calib_df: DataFrame, label_col: str = "default") -> CalibratedModel:
    """Keep the base frozen, refit only the isotonic layer on ``calib_df``."""
    base = base_of(model)
    bare = CalibratedModel(base, None)
    iso = fit_isotonic(bare.raw(calib_df), "p_raw", label_col, "p_default")
    return CalibratedModel(base, IsotonicCalibrator(iso.model, "p_raw", "p_default"), name="recalibrated")
