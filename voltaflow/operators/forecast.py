"""Solar generation regression: training frame, two pipelines, metrics, persistence.

The linear model can also be had from sufficient statistics (``linear_model``):
one pass over the rows, whatever the number of models and metrics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.functions import constants as C

LABEL = "solar_generation_mwh"
KEY = ("region", "transaction_date", "transaction_hour")


def ml_training_frame(features: DataFrame) -> DataFrame:
    """Positive-generation rows with the six model features and the label."""
    cols = list(dict.fromkeys([*KEY, *C.FEATURE_COLUMNS, LABEL]))
    return features.filter(F.col(LABEL) > 0).select(*cols)


def with_split(frame: DataFrame, train_fraction: float = C.TRAIN_FRACTION, seed: int = C.SPLIT_SEED) -> DataFrame:
    """Adds ``_train``: whether a row is in the training split (see ``split``)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in KEY])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10_000
    return frame.withColumn("_train", bucket < int(train_fraction * 10_000))


def split(frame: DataFrame, train_fraction: float = C.TRAIN_FRACTION, seed: int = C.SPLIT_SEED):
    """Deterministic train/test split by the MD5 of the row key (unlike
    ``randomSplit`` it does not depend on partitioning or row order, and other
    engines can repeat it)."""
    flagged = with_split(frame, train_fraction, seed)
    return flagged.filter("_train").drop("_train"), flagged.filter(~F.col("_train")).drop("_train")


def pipelines() -> dict[str, Pipeline]:
    asm = VectorAssembler(inputCols=list(C.FEATURE_COLUMNS), outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol=LABEL, **C.LR_PARAMS)
    rf = RandomForestRegressor(featuresCol="features", labelCol=LABEL, **C.RF_PARAMS)
    return {"linear_regression": Pipeline(stages=[asm, lr]), "random_forest": Pipeline(stages=[asm, rf])}


def train_forecast(spark: SparkSession, frame: DataFrame, models=("linear_regression", "random_forest"),
                   save_dir: str | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit the pipelines on the train split; metrics (model, rmse, r2) on the test split.

    Models are saved with overwrite when ``save_dir`` is given.
    """
    train, test = split(frame)
    train = train.persist()
    rows, fitted = [], {}
    for name in models:
        model = pipelines()[name].fit(train)
        rows.append((name, *regression_metrics(model.transform(test)).first()))  # one pass for both
        fitted[name] = model
        if save_dir:
            model.write().overwrite().save(f"{save_dir.rstrip('/')}/{name}")
    train.unpersist()
    return spark.createDataFrame(rows, "model string, rmse double, r2 double"), fitted


def feature_importances(model: PipelineModel) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances
    return [(c, float(imp[i])) for i, c in enumerate(C.FEATURE_COLUMNS)]


def predict(model_path: str, frame: DataFrame) -> DataFrame:
    """Load a saved pipeline and score a frame."""
    return PipelineModel.load(model_path).transform(frame).drop("features")


def regression_metrics(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """RMSE and R^2 as plain aggregates in one pass."""
    err = F.col(LABEL) - F.col(prediction)
    s = pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.sum(err * err).alias("sse"), F.var_pop(LABEL).alias("var"), F.count(F.lit(1)).alias("n"))
    return s.select("rmse", (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var") * F.col("n"))).alias("r2"))


@dataclass
class LinearModel:
    """Coefficients by feature, and the intercept."""
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def predict(self, frame: DataFrame) -> DataFrame:
        """Adds ``prediction``, a plain expression."""
        terms = [F.col(c).cast("double") * F.lit(b) for c, b in zip(self.features, self.coefficients)]
        return frame.withColumn("prediction", sum(terms, F.lit(self.intercept)))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("", self.intercept), *zip(self.features, self.coefficients)]
        spark.createDataFrame(rows, "feature string, weight double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        rows = spark.read.parquet(path).collect()  # one row per feature
        own = {r["feature"]: r["weight"] for r in rows}
        names = tuple(r["feature"] for r in rows if r["feature"])
        return cls(names, tuple(own[n] for n in names), own[""])


def moments(frame: DataFrame, features=C.FEATURE_COLUMNS, label: str = LABEL) -> dict[bool, tuple[np.ndarray, int]]:
    """For each split the sums of products of (1, features, label), and its rows: one
    scan, added up before the shuffle. Rows with a null take no part."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)]]
    n = len(cols)
    sums = [F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i in range(n) for j in range(i, n)]
    rows = with_split(frame).na.drop(subset=[*features, label]).groupBy("_train").agg(*sums).collect()
    out = {False: (np.zeros((n, n)), 0), True: (np.zeros((n, n)), 0)}
    for r in rows:
        m = np.zeros((n, n))
        for i in range(n):
            for j in range(i, n):
                m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r["_train"]] = m, round(m[0, 0])
    return out


def elastic_net(m: np.ndarray, reg: float, mix: float, sweeps: int = 10_000, tol: float = 1e-13) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the elastic net by coordinate descent on sums of
    products. As usual the penalty is on features and label in units of their
    standard deviations; a constant feature has no weight."""
    mean = m[0, 1:] / m[0, 0]
    cov = m[1:, 1:] / m[0, 0] - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(cov), 0))
    x, y = dev[:-1], dev[-1]
    beta = np.zeros(len(x))
    if y <= 0:
        return beta, float(mean[-1])
    use = x > 1e-12 * np.maximum(np.abs(mean[:-1]), 1)
    unit = np.where(use, x, 1.0)
    gram, by_label = cov[:-1, :-1] / np.outer(unit, unit), cov[:-1, -1] / (unit * y)
    lasso, ridge = reg * mix / y, reg * (1 - mix) / y
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(use):
            rest = by_label[j] - gram[j] @ beta + gram[j, j] * beta[j]
            new = np.sign(rest) * max(abs(rest) - lasso, 0) / (gram[j, j] + ridge)
            moved, beta[j] = max(moved, abs(new - beta[j])), new
        if moved < tol:
            break
    beta = np.where(use, beta * y / unit, 0.0)
    return beta, float(mean[-1] - mean[:-1] @ beta)


def linear_model(frame: DataFrame, features=C.FEATURE_COLUMNS, label: str = LABEL,
                 reg: float = C.LR_PARAMS["regParam"], mix: float = C.LR_PARAMS["elasticNetParam"]) -> tuple[LinearModel, dict]:
    """The model of the training split and its metrics (``n``, ``rmse``, ``r2``) on
    the test split, all from one scan. Without training rows there is no model."""
    stats = moments(frame, features, label)
    train, n = stats[True]
    if not n:
        raise ValueError("no training rows")
    beta, intercept = elastic_net(train, reg, mix)
    test, n = stats[False]
    w = np.concatenate([[-intercept], -beta, [1.0]])  # label less prediction
    sse = max(float(w @ test @ w), 0.0)
    var = test[-1, -1] - test[0, -1] ** 2 / n if n else 0.0
    metrics = {"n": n, "rmse": (sse / n) ** 0.5 if n else None, "r2": float(1 - sse / var) if var > 0 else None}
    return LinearModel(tuple(features), tuple(float(b) for b in beta), float(intercept)), metrics


def split_baseline(frame: DataFrame) -> DataFrame:
    """Rows of each split and, for the test split, RMSE and R^2 of predicting the
    mean of the training split: what a model has to beat."""
    train, test = split(frame)
    mean = train.agg(F.avg(LABEL)).scalar()
    base = regression_metrics(test.withColumn("prediction", mean))
    return base.select(train.agg(F.count(F.lit(1))).scalar().alias("n_train"),
                       test.agg(F.count(F.lit(1))).scalar().alias("n_test"), "rmse", "r2")
