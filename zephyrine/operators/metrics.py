"""Evaluation metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def classification_metrics(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and F1 of class 1; an undefined F1 is 0."""
    counts = confusion_counts(scored, label, prediction)

    def cell(actual: int, predicted: int):
        hit = (F.col("label") == actual) & (F.col("prediction") == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    total = F.sum("n")
    right, wrong = cell(1, 1), cell(0, 1) + cell(1, 0)
    f1 = F.coalesce(2 * right / F.nullif(2 * right + wrong, F.lit(0)), F.lit(0.0))
    return counts.agg(
        ((cell(0, 0) + right) / F.nullif(total, F.lit(0))).alias("accuracy"),
        f1.alias("f1"),
        F.coalesce(total, F.lit(0)).alias("test_size"),
        ((right + cell(1, 0)) / F.nullif(total, F.lit(0))).alias("anomaly_rate"),
        ((right + cell(0, 1)) / F.nullif(total, F.lit(0))).alias("predicted_rate"),
    )


def with_residual(
    scored: DataFrame, actual: str = "target", predicted: str = "prediction"
) -> DataFrame:
    return scored.withColumn("residual", F.col(actual) - F.col(predicted))


def regression_metrics(
    scored: DataFrame, actual: str = "target", predicted: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R squared; the total sum of squares comes from the population variance."""
    error = F.col(actual) - F.col(predicted)
    mean_square = F.avg(error * error)
    spread = F.var_pop(actual)
    return scored.agg(
        F.sqrt(mean_square).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - mean_square / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.count("*").alias("test_size"),
    )
