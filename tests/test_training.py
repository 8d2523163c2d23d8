import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ebbtide.operators.evaluation import confusion, evaluate
from ebbtide.plans import training
from ebbtide.plans.churn import churn_features
from ebbtide.plans.prediction import predict_churn
from ebbtide.plans.registry import planted_features
from ebbtide.sources.event_log import PAGES, event_log
from ebbtide.sources.lake import write_lake

# Published confusion matrices with their metrics.
GOLDEN = [
    ((2990, 24, 338, 33), 0.8564761615084842, 0.1542056074766355, 0.8930576),
    ((3014, 0, 346, 25), 0.8559038102309581, 0.12626262626262627, 0.8977843),
    ((3000, 14, 351, 20), 0.8501638355454092, 0.09876543209876543, 0.8921713),
    ((3014, 0, 371, 0), 0.8387754456648623, 0.0, 0.8903988),
]


def predictions(spark, tn, fp, fn, tp):
    pairs = [(0, 0.0)] * tn + [(0, 1.0)] * fp + [(1, 0.0)] * fn + [(1, 1.0)] * tp
    return spark.createDataFrame(pairs, "churn int, prediction double")


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return training.materialize(churn_features(event_log(spark, sf_dir), PAGES), "test")


@pytest.mark.parametrize("cells, weighted, churn, accuracy", GOLDEN)
def test_published_metrics(spark, cells, weighted, churn, accuracy):
    pred = predictions(spark, *cells)
    row = evaluate(pred).first()
    assert row.weighted_f1 == pytest.approx(weighted, abs=1e-12)
    assert row.f1_churn == pytest.approx(churn, abs=1e-12)
    assert row.accuracy == pytest.approx(accuracy, abs=1e-6)
    assert (row.tn, row.fp, row.fn, row.tp) == cells
    for metric, value in [("f1", row.weighted_f1), ("fMeasureByLabel", row.f1_churn), ("accuracy", row.accuracy)]:
        spark_value = MulticlassClassificationEvaluator(
            labelCol="churn", metricName=metric, metricLabel=1.0
        ).evaluate(pred)
        assert value == pytest.approx(spark_value, abs=1e-12)


def test_confusion_matrix_is_always_two_by_two(spark):
    assert sorted(map(tuple, confusion(predictions(spark, 3, 2, 1, 4)).collect())) == [(0, 3, 2), (1, 1, 4)]
    assert sorted(map(tuple, confusion(predictions(spark, 3, 0, 0, 0)).collect())) == [(0, 3, 0), (1, 0, 0)]


def test_empty_predictions(spark):
    row = evaluate(predictions(spark, 0, 0, 0, 0)).first()
    assert (row.weighted_f1, row.accuracy, row.tp) == (0.0, 0.0, 0)


def test_hash_split_does_not_depend_on_layout(features):
    train, test = training.hash_split(features)
    again, _ = training.hash_split(features.repartition(3, "churn"))
    users = lambda df: {r.userId for r in df.select("userId").collect()}
    assert users(train) == users(again)
    assert not users(train) & users(test)
    assert users(train) | users(test) == users(features)


def test_hash_split_share(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("userId"))
    train, _ = training.hash_split(ids)
    assert train.count() == pytest.approx(16_000, rel=0.02)


def test_random_split_is_seeded(features):
    train, test = training.random_split(training.assemble(features), seed=7)
    again, _ = training.random_split(training.assemble(features), seed=7)
    assert train.count() + test.count() == features.count()
    assert sorted(r.userId for r in train.collect()) == sorted(r.userId for r in again.collect())


def test_compare(features):
    rows = training.compare(features, seed=1).collect()
    test_rows = training.hash_split(features)[1].count()
    assert [r.classifier for r in rows] == ["dt", "rf", "lr", "svc"]
    assert all(r.tn + r.fp + r.fn + r.tp == test_rows for r in rows)


def test_perceptron_fits_two_labels(features):
    model = training.train(features, "mlp")
    assert training.score_users(model, features).count() == features.count()


def test_saved_model_scores_other_pages(spark, features, tmp_path):
    model = training.train(features, "dt")
    model.save(str(tmp_path / "model"))
    loaded = training.ChurnModel.load(spark, str(tmp_path / "model"))
    assert loaded.features == model.features
    other = features.drop("Help").withColumn("New page", F.lit(3))
    scored = training.score_users(loaded, other)
    assert scored.columns == ["userId", "prediction"]
    assert scored.count() == features.count()
    expected = training.score_users(model, features.withColumn("Help", F.lit(0)))
    assert sorted(scored.collect()) == sorted(expected.collect())


def test_odd_pages_train_compare_save_and_score(spark, sf_dir, tmp_path):
    odd = [None, "null", "a.b", "a`b", "Home", "home", "churn"]
    place = F.array(*[F.lit(page) for page in odd])[(F.col("event_id") % len(odd)).cast("int")]
    df = event_log(spark, sf_dir).withColumn("page", F.when(F.col("event_id") % 3 == 0, place).otherwise(F.col("page")))
    frame = training.materialize(churn_features(df), "test")
    assert {None, *odd} <= {feature.page for feature in training.feature_list(frame) if feature.is_page}
    assert training.compare(frame, ["dt"]).count() == 1
    model = training.train(frame, "dt")
    model.save(str(tmp_path / "model"))
    loaded = training.ChurnModel.load(spark, str(tmp_path / "model"))
    # Without "Home", the page "home" gets another column name, yet it is the same page.
    later = churn_features(df.where(~F.col("page").eqNullSafe("Home")))
    assert training.score_users(loaded, later).count() == later.count()
    homes = {f.name: f.page for f in training.feature_list(later) if f.page == "home"}
    assert list(homes) == ["home"]


def test_compare_takes_a_random_split(features):
    found = training.compare(features, ["dt"], split=lambda df: training.random_split(df, seed=3)).first()
    assert found.tn + found.fp + found.fn + found.tp == training.random_split(training.assemble(features), seed=3)[1].count()


def test_unknown_classifier():
    with pytest.raises(ValueError):
        training.classifier("knn", 3)


def test_prediction_run_over_the_lake(spark, sf_dir, tmp_path):
    write_lake(event_log(spark, sf_dir, items=True), str(tmp_path / "lake"))
    summary, results = predict_churn(
        spark, str(tmp_path / "lake"), "2024-01-01", "2024-02-01", kinds=["dt"]
    )
    assert summary.first().messages == 1000
    assert results.first().classifier == "dt"


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    return training.materialize(planted_features(event_log(spark, sf_dir)), "planted")


def test_planted_split_is_found(planted):
    model = training.train(training.hash_split(planted)[0], "dt")
    tree = model.pipeline.stages[-1]
    place = training.feature_columns(planted).index("uses_ios")
    assert tree.depth == 1 and tree.numNodes == 3
    assert f"If (feature {place} <= 0.5)" in tree.toDebugString


def test_planted_label_is_learned_by_every_classifier(planted):
    rows = {r.classifier: r for r in training.compare(planted, (*training.CLASSIFIERS, "mlp")).collect()}
    assert list(rows) == [*training.CLASSIFIERS, "mlp"]
    for kind in training.CLASSIFIERS:
        assert rows[kind].accuracy == rows[kind].f1_churn == 1
    assert rows["mlp"].accuracy >= 0.9


@pytest.mark.parametrize("answer", [0.0, 1.0])
def test_constant_model_would_show(spark, planted, monkeypatch, answer):
    class Constant:
        def fit(self, rows):
            return self

        def transform(self, rows):
            return rows.withColumn("prediction", F.lit(answer))

    expected = training.compare(planted, ("dt",)).first()
    monkeypatch.setattr(training, "classifier", lambda *args: Constant())
    found = training.compare(planted, ("dt",)).first()
    assert (found.fp, found.fn) != (0, 0) and found.accuracy < expected.accuracy == 1


def test_fits_side_by_side_give_what_they_give_alone(planted):
    together = training.compare(planted, ("lr", "rf", "dt")).collect()
    assert together == training.compare(planted, ("lr", "rf", "dt"), parallelism=1).collect()


def test_failed_fit_is_an_error(spark, planted):
    with pytest.raises(Exception, match="classes"):
        training.compare(planted.withColumn("churn", F.lit(0)), ("dt", "svc"))
