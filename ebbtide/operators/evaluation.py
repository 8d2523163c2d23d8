"""Classifier metrics from one aggregation over ``(churn, prediction)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = ("tn", "fp", "fn", "tp")


def confusion_cells(predictions: DataFrame, label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """One row ``(tn, fp, fn, tp)``; nothing but four counts leaves the executors."""
    truth, guess = F.col(label), F.col(prediction)
    return predictions.agg(
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
    )


def confusion(predictions: DataFrame, label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """2x2 confusion matrix: rows are the truth, columns the prediction."""
    cells = confusion_cells(predictions, label, prediction)
    rows = F.stack(
        F.lit(2), F.lit(0), F.col("tn"), F.col("fp"), F.lit(1), F.col("fn"), F.col("tp")
    )
    return cells.select(rows.alias("churn", "predicted_0", "predicted_1"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(hits: Column, claimed: Column, actual: Column) -> Column:
    precision, recall = _ratio(hits, claimed), _ratio(hits, actual)
    return _ratio(2 * precision * recall, precision + recall)


def evaluate(predictions: DataFrame, label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """One row: weighted F1 over both labels, F1 of the churn label, accuracy, the four cells."""
    tn, fp, fn, tp = (F.col(cell) for cell in CELLS)
    total = tn + fp + fn + tp
    stayed, churned = tn + fp, fn + tp
    f1_stay, f1_churn = _f1(tn, tn + fn, stayed), _f1(tp, tp + fp, churned)
    return confusion_cells(predictions, label, prediction).select(
        (f1_stay * _ratio(stayed, total) + f1_churn * _ratio(churned, total)).alias("weighted_f1"),
        f1_churn.alias("f1_churn"),
        _ratio(tn + tp, total).alias("accuracy"),
        *CELLS,
    )
