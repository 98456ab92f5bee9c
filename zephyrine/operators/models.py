"""Supervised models as MLlib pipelines over the feature matrix."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators.features import (
    CLASSIFIER_FEATURES,
    FORECAST_FEATURES,
    fit_scaler,
)
from zephyrine.operators.metrics import classification_metrics, regression_metrics
from zephyrine.operators.trees import Growth, bin_rows, ensemble_of, grow_trees
from zephyrine.session import cut_lineage

_PREFIX = "_x_"


def feature_stages(
    columns: tuple[str, ...], fitted: dict[str, tuple[float, float]] | None = None
) -> list:
    """Null -> 0, z-score when ``fitted`` is given, then one vector; all of it saveable."""
    cells = []
    for c in columns:
        value = f"coalesce(cast(`{c}` as double), 0D)"
        if fitted is not None:
            mean, deviation = fitted[c]
            value = f"({value} - ({mean!r}D)) / ({deviation!r}D)"
        cells.append(f"{value} as `{_PREFIX}{c}`")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__"),
        VectorAssembler(inputCols=[_PREFIX + c for c in columns], outputCol="features"),
    ]


def transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Model output without the helper columns."""
    scored = model.transform(df)
    return scored.drop(*(c for c in scored.columns if c.startswith(_PREFIX)), "features")


def _present(df: DataFrame, columns: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(c for c in columns if c in df.columns)


def _training_rows(train: DataFrame, used: tuple[str, ...], target: str) -> DataFrame:
    """The columns of a fit, stored: scaling, counting and fitting read them without computing the features anew."""
    return cut_lineage(train.select(*dict.fromkeys((*used, target))))


def train_logistic(
    train: DataFrame,
    columns: tuple[str, ...] = CLASSIFIER_FEATURES,
    label: str = "label",
    c: float = 1.0,
    max_iter: int = 500,
) -> PipelineModel:
    """L2-penalised logistic regression; ``c`` weighs the summed loss against the penalty."""
    used = _present(train, columns)
    train = _training_rows(train, used, label)
    estimator = LogisticRegression(
        labelCol=label,
        regParam=1.0 / (c * train.count()),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )
    return Pipeline(stages=[*feature_stages(used, fit_scaler(train, used)), estimator]).fit(train)


def train_random_forest(
    train: DataFrame,
    columns: tuple[str, ...] = CLASSIFIER_FEATURES,
    label: str = "label",
    trees: int = 100,
    depth: int = 10,
    min_samples_split: int = 5,
    seed: int = 42,
    task_rows: int = 1_000_000,
) -> PipelineModel:
    """Mean of trees over bootstraps, each node splitting on one of about sqrt(features) random ones.

    The squared error of 0/1 labels orders splits as the Gini index does; a leaf holds its share of ones.
    """
    used = _present(train, columns)
    growth = Growth(
        depth=depth, reg=0.0, least_rows_to_split=min_samples_split, bootstrap=True,
        columns_per_node=math.isqrt(len(used)) / len(used), seed=seed,
    )
    data = bin_rows(train, used, label)
    grown = grow_trees(data, trees, growth, boosted=False, task_rows=task_rows)
    return PipelineModel([*feature_stages(used), ensemble_of(data, grown, boosted=False)])


def train_ridge(
    train: DataFrame,
    columns: tuple[str, ...] = FORECAST_FEATURES,
    target: str = "target",
    alpha: float = 1.0,
) -> PipelineModel:
    """Ridge with the penalty on the summed squares.

    MLlib divides the loss by n and rescales the label by its deviation, hence the factor.
    """
    used = _present(train, columns)
    train = _training_rows(train, used, target)
    size = train.agg(F.count("*").alias("n"), F.stddev_pop(target).alias("s")).first()
    estimator = LinearRegression(
        labelCol=target,
        regParam=alpha / size["n"] * (size["s"] or 1.0),
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )
    return Pipeline(stages=[*feature_stages(used, fit_scaler(train, used)), estimator]).fit(train)


def train_boosted_trees(
    train: DataFrame,
    columns: tuple[str, ...] = FORECAST_FEATURES,
    target: str = "target",
    rounds: int = 200,
    step: float = 0.05,
    depth: int = 6,
    subsample: float = 0.8,
    column_sample: float = 0.8,
    reg: float = 1.0,
    seed: int = 42,
    task_rows: int = 1_000_000,
) -> PipelineModel:
    """Second-order boosting of the squared error: rows and columns are drawn per tree."""
    used = _present(train, columns)
    growth = Growth(
        depth=depth, reg=reg, row_sample=subsample, columns_per_tree=column_sample, step=step, seed=seed
    )
    data = bin_rows(train, used, target)
    grown = grow_trees(data, rounds, growth, boosted=True, task_rows=task_rows)
    return PipelineModel([*feature_stages(used), ensemble_of(data, grown, boosted=True)])


def evaluate_classifier(model: PipelineModel, test: DataFrame, label: str = "label") -> DataFrame:
    return classification_metrics(transform(model, test), label)


def evaluate_forecaster(
    model: PipelineModel, test: DataFrame, target: str = "target"
) -> DataFrame:
    return regression_metrics(transform(model, test), target)


def feature_importances(
    spark: SparkSession, model: PipelineModel, top: int = 15
) -> DataFrame:
    """Largest importances of a tree model, by feature name."""
    names = [c.removeprefix(_PREFIX) for c in model.stages[-2].getInputCols()]
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature")
        .limit(top)
    )
