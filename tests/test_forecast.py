"""The linear model from sufficient statistics against Spark ML and against itself over rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltaflow.operators import forecast
from voltaflow.plans.solar_queries import _features


@pytest.fixture(scope="module")
def frame(spark):
    return forecast.ml_training_frame(_features(spark, SF_SMALL)).cache()


@pytest.mark.parametrize("reg,mix", [(0.1, 0.8), (0.0, 0.0), (5.0, 0.5), (1e6, 1.0)])
def test_coefficients_are_those_of_spark_ml(frame, reg, mix):
    model, metrics = forecast.linear_model(frame, reg=reg, mix=mix)
    train, test = forecast.split(frame)
    asm = VectorAssembler(inputCols=list(forecast.C.FEATURE_COLUMNS), outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol=forecast.LABEL, maxIter=1000, regParam=reg, elasticNetParam=mix, tol=1e-12)
    ml = Pipeline(stages=[asm, lr]).fit(train)
    assert np.allclose(model.coefficients, ml.stages[-1].coefficients.toArray(), atol=1e-6, rtol=1e-6)
    assert model.intercept == pytest.approx(ml.stages[-1].intercept, rel=1e-6)
    want = forecast.regression_metrics(ml.transform(test)).first()
    assert metrics["rmse"] == pytest.approx(want.rmse, rel=1e-6) and metrics["r2"] == pytest.approx(want.r2, abs=1e-6)


def test_saved_model_predicts_by_its_coefficients(spark, tmp, frame):
    model, _ = forecast.linear_model(frame)
    model.save(spark, tmp + "/m")
    again = forecast.LinearModel.load(spark, tmp + "/m")
    assert again == model
    for r in again.predict(frame).limit(50).collect():
        by_hand = model.intercept + sum(b * r[c] for b, c in zip(model.coefficients, model.features))
        assert r.prediction == pytest.approx(by_hand, rel=1e-12)
    # and the saved pipeline of the same data gives the same within its tolerance
    forecast.train_forecast(spark, frame, models=("linear_regression",), save_dir=tmp + "/p")
    both = (forecast.predict(tmp + "/p/linear_regression", frame).withColumnRenamed("prediction", "ml")
            .join(model.predict(frame), list(forecast.KEY)))
    assert both.where(F.abs(F.col("ml") - F.col("prediction")) > 1e-2 * F.abs(F.col("ml"))).count() == 0


def test_one_scan_for_model_and_metrics(frame):
    from voltaflow.operators.forecast import with_split
    plan = with_split(frame).groupBy("_train").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1


def test_constant_features_and_no_rows(spark, frame):
    flat = frame.withColumn("month", F.lit(3))
    model, _ = forecast.linear_model(flat)
    assert dict(zip(model.features, model.coefficients))["month"] == 0.0
    with pytest.raises(ValueError):
        forecast.linear_model(frame.limit(0))
