"""The whole prediction run over a range of lake days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ebbtide.functions.filters import Moment
from ebbtide.operators.features import dataset_summary
from ebbtide.plans.churn import churn_features
from ebbtide.plans.training import CLASSIFIERS, compare
from ebbtide.sources.lake import read_lake


def predict_churn(
    spark: SparkSession,
    lake: str,
    start: Moment,
    end: Moment,
    pages: Sequence[str | None] | None = None,
    kinds: Sequence[str] = CLASSIFIERS,
) -> tuple[DataFrame, DataFrame]:
    """(data set summary, classifier comparison) for days ``[start, end)``."""
    log = read_lake(spark, lake, start, end)
    return dataset_summary(log), compare(churn_features(log, pages), kinds)
