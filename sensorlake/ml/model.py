"""The forecast model: assemble 4 features, fit a linear regression (M1-M3).

The assembler sits inside the saved ``PipelineModel``, so a loaded model
scores plain feature columns. ``handleInvalid="error"``: a NULL feature fails
the job instead of silently dropping rows, so callers filter first.
With no regularisation and 4 features, Spark solves the normal equations in
one distributed aggregation pass.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..schemas import FEATURE_COLUMNS, TARGET_COLUMN


def assembler(features=tuple(FEATURE_COLUMNS)) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def build_pipeline(reg_param: float = C.REG_PARAM, elastic_net: float = C.ELASTIC_NET_PARAM,
                   features=tuple(FEATURE_COLUMNS), label: str = TARGET_COLUMN) -> Pipeline:
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                          regParam=reg_param, elasticNetParam=elastic_net)
    return Pipeline(stages=[assembler(features), lr])


def train_model(train: DataFrame, **params) -> PipelineModel:
    return build_pipeline(**params).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def linear_stage(model: PipelineModel) -> LinearRegressionModel:
    return [s for s in model.stages if isinstance(s, LinearRegressionModel)][0]


def coefficients(spark: SparkSession, model: PipelineModel,
                 features=tuple(FEATURE_COLUMNS)) -> DataFrame:
    """One row per term (features + intercept); bounded by the feature count."""
    lr = linear_stage(model)
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "term string, coefficient double")


def params_of(model: PipelineModel, features=tuple(FEATURE_COLUMNS), max_mae: float = C.MAX_VALIDATION_MAE) -> dict:
    lr = linear_stage(model)
    return {
        "target": TARGET_COLUMN,
        "model_type": "LinearRegression",
        "regParam": str(lr.getRegParam()),
        "elasticNetParam": str(lr.getElasticNetParam()),
        "features": ",".join(features),
        "max_validation_mae": str(max_mae),
    }
