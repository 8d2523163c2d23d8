"""Training, comparing and applying churn classifiers on the feature frame."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ebbtide.operators.evaluation import evaluate
from ebbtide.operators.features import USER, quoted
from ebbtide.session import drop_table, materialize

# Seed, split share, perceptron layers, block size and iterations.
SEED = 42
TRAIN_SHARE = 0.8
BLOCK_SIZE, PERCEPTRON_ITERATIONS, SVC_ITERATIONS = 128, 50, 10
SPLIT_STEPS = 10_000
CLASSIFIERS = ("dt", "rf", "lr", "svc")
HIDDEN_LAYERS = (5, 4)
COMPARISON = (
    "classifier string, weighted_f1 double, f1_churn double, accuracy double, "
    "tn bigint, fp bigint, fn bigint, tp bigint"
)


def feature_columns(features: DataFrame) -> list[str]:
    return features.drop(USER, "churn").columns


@dataclass(frozen=True)
class Feature:
    """A column of the feature frame; page columns are known by their page, not by their name."""

    name: str
    is_page: bool = False
    page: str | None = None

    @property
    def identity(self) -> tuple:
        return ("page", self.page) if self.is_page else ("column", self.name)


def feature_list(features: DataFrame) -> list[Feature]:
    known = {f.name: f.metadata for f in features.schema.fields}
    return [
        Feature(name, known[name].get("is_page", False), known[name].get("page"))
        for name in feature_columns(features)
    ]


def assembler(n_features: int) -> VectorAssembler:
    """Takes positional names, so any page name will do."""
    return VectorAssembler(inputCols=[f"f{i}" for i in range(n_features)], outputCol="features")


def positional(features: DataFrame, wanted: Sequence[Feature], *keep: str) -> DataFrame:
    """``wanted`` as f0, f1, ...; pages that did not occur count 0, new ones are left out."""
    present = {feature.identity: feature.name for feature in feature_list(features)}
    # A frame made elsewhere may lack the page metadata: names do then.
    found = [present.get(w.identity) or present.get(("column", w.name)) for w in wanted]
    columns = [F.lit(0) if name is None else F.col(quoted(name)) for name in found]
    return features.select(*keep, *[column.alias(f"f{i}") for i, column in enumerate(columns)])


def assemble(features: DataFrame) -> DataFrame:
    """``(userId, features, churn)``: the key stays beside the vector."""
    wanted = feature_list(features)
    vectors = assembler(len(wanted)).transform(positional(features, wanted, USER, "churn"))
    return vectors.select(USER, "features", "churn")


def random_split(
    df: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; repeatable as long as the layout of ``df`` stays the same."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test


def in_train(train_share: float = TRAIN_SHARE) -> Column:
    step = F.conv(F.substring(F.md5(USER), 1, 7), 16, 10).cast("bigint") % SPLIT_STEPS
    return step < round(train_share * SPLIT_STEPS)


def hash_split(df: DataFrame, train_share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the user id: the same users on any layout and in any run."""
    chosen = in_train(train_share)
    return df.where(chosen), df.where(~chosen)


def classifier(kind: str, n_features: int, seed: int = SEED):
    columns = {"featuresCol": "features", "labelCol": "churn"}
    match kind:
        case "dt":
            return DecisionTreeClassifier(**columns, seed=seed)
        case "rf":
            return RandomForestClassifier(**columns, seed=seed)
        case "lr":
            return LogisticRegression(**columns)
        case "svc":
            return LinearSVC(**columns, maxIter=SVC_ITERATIONS)
        case "mlp":
            layers = [n_features, *HIDDEN_LAYERS, 2]
            return MultilayerPerceptronClassifier(
                **columns, layers=layers, blockSize=BLOCK_SIZE, maxIter=PERCEPTRON_ITERATIONS, seed=seed
            )
    raise ValueError(f"classifier must be one of {(*CLASSIFIERS, 'mlp')}, not {kind!r}")


@dataclass(frozen=True)
class ChurnModel:
    """A fitted classifier with the features, pages included, that it takes."""

    pipeline: PipelineModel
    features: tuple[Feature, ...]

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        rows = [(i, json.dumps([f.name, f.is_page, f.page])) for i, f in enumerate(self.features)]
        frame = SparkSession.active().createDataFrame(rows, "place int, feature string")
        frame.coalesce(1).write.mode("overwrite").json(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ChurnModel:
        rows = spark.read.schema("place int, feature string").json(f"{path}/features").orderBy("place").collect()
        features = tuple(Feature(*json.loads(row.feature)) for row in rows)
        return cls(PipelineModel.load(f"{path}/pipeline"), features)


def train(features: DataFrame, kind: str, seed: int = SEED) -> ChurnModel:
    """Fit one classifier; the returned model carries its feature list along."""
    wanted = feature_list(features)
    model = classifier(kind, len(wanted), seed).fit(assemble(features))
    return ChurnModel(PipelineModel([assembler(len(wanted)), model]), tuple(wanted))


def compare(
    features: DataFrame,
    kinds: Sequence[str] = CLASSIFIERS,
    seed: int = SEED,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    parallelism: int = len(CLASSIFIERS),
) -> DataFrame:
    """Train and evaluate classifiers on one split, one result row each, in the order of ``kinds``.

    ``split`` makes (train, test) of the assembled rows: :func:`hash_split` unless given,
    :func:`random_split` for a seeded random one. The feature frame is written once, so neither fits nor evaluations go back to the log;
    the assembled training rows are persisted for the iterative fits only. ``parallelism`` fits go
    side by side, so small jobs of one fill the gaps of another. One row of metrics per classifier
    comes to the driver.
    """
    stored = materialize(features, "features")
    columns = feature_columns(stored)
    train_rows, test_rows = (split or hash_split)(assemble(stored))
    train_rows = train_rows.select("features", "churn").persist(StorageLevel.MEMORY_AND_DISK)
    spark = features.sparkSession

    @inheritable_thread_target(spark)
    def result(kind: str) -> tuple:
        model = classifier(kind, len(columns), seed).fit(train_rows)
        return (kind, *evaluate(model.transform(test_rows)).first())

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(result, kinds))
    finally:
        train_rows.unpersist()
        drop_table(stored)
    return spark.createDataFrame(results, COMPARISON)


def score_users(model: ChurnModel, features: DataFrame) -> DataFrame:
    """``(userId, prediction)`` of current users under a trained model."""
    rows = positional(features, model.features, USER)
    return model.pipeline.transform(rows).select(USER, "prediction")
