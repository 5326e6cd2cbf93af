from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.models import spec as specs, trees as T
from roadgrain.operators.split import split_at
from roadgrain.plans import model_queries, runs
from roadgrain.session import fresh_path
from roadgrain.sources.files import fingerprint
from roadgrain.sources.given import observations
from tests.conftest import values


@pytest.fixture(scope="module")
def data(spark):
    from tests.conftest import SF_DIR

    return observations(spark, SF_DIR).repartition(3, "obs_id").persist()


@pytest.fixture(scope="module")
def trained(data):
    return runs.train(data, T.decision_tree(), "obs_id")


def test_features_and_labels(trained):
    categories = T.category_labels(trained.model)
    assert T.labels_of(trained.model) == S.CLASSES_ALPHABETIC
    assert categories["day_type"] == ["Weekday", "Weekend"]
    assert T.vector_width(categories) == trained.model.stages[T.CLASSIFIER].numFeatures
    sizes = [len(categories[name]) + 1 for name in S.CATEGORICAL_FEATURES]
    assert list(trained.model.stages[T.ENCODER].categorySizes) == sizes
    assert T.vector_width(categories) == 4 + sum(sizes) + 2


def test_published_vector_width():
    sizes = {"corridor": 16, "area": 8, "road_intersection": 16, "weather": 5, "roadwork": 2, "day_type": 2}
    assert T.vector_width({name: [f"{name}{i}" for i in range(n)] for name, n in sizes.items()}) == 61


def test_unseen_category_is_scored(trained, data):
    testing = split_at(data, trained.cutoff)[1].withColumn("weather", F.lit("Hail"))
    scored = T.predict(trained.model, testing)
    assert scored.count() == testing.count()
    assert scored.where("predicted_congestion_class IS NULL").count() == 0


def test_predictions_cover_the_test_period(trained, data):
    testing = split_at(data, trained.cutoff)[1]
    assert trained.predictions.count() == testing.count() == trained.matrix.agg(F.sum("count")).first()[0]
    assert "features" not in trained.predictions.columns
    assert all(0 <= value <= 1 for _, value in values(trained.metrics))


def test_fit_does_not_depend_on_input_partitions(trained, data):
    again = runs.train(data.repartition(7), T.decision_tree(), "obs_id")
    assert again.specification["tree"].split("\n")[1:] == trained.specification["tree"].split("\n")[1:]
    assert again.specification["evaluation"] == trained.specification["evaluation"]


def test_importances(trained, data):
    slots = T.slot_importances(trained.model, data)
    assert slots.count() == T.vector_width(T.category_labels(trained.model))
    grouped = T.grouped_importances(slots)
    assert {g for g, _ in values(grouped)} == set(S.FEATURES)
    assert grouped.agg(F.sum("importance")).first()[0] == pytest.approx(1.0, abs=1e-5)
    assert trained.specification["grouped_feature_importances"] == dict(values(grouped))


def test_forest_specification(data):
    forest = runs.train(data, T.random_forest(num_trees=3, max_depth=3), "obs_id")
    assert forest.specification["model_class"] == "RandomForestClassifier"
    assert forest.specification["classifier"]["numTrees"] == 3
    training = split_at(data, forest.cutoff)[0]
    again = specs.rebuild(data.sparkSession, forest.specification, training, "obs_id").stages[-1]
    assert again.getNumTrees == 3 and again.getOrDefault("maxDepth") == 3


def _again(trained, data, document):
    training, testing = split_at(data, trained.cutoff)
    model = specs.rebuild(data.sparkSession, document, training, "obs_id")
    return model, T.predict(model, testing)


def test_rebuilt_from_the_document_alone(trained, data):
    document = json.loads(json.dumps(trained.specification))
    model, again = _again(trained, data, document)
    assert T.category_labels(model) == T.category_labels(trained.model) and T.labels_of(model) == T.labels_of(trained.model)
    assert list(model.stages[T.ENCODER].categorySizes) == list(trained.model.stages[T.ENCODER].categorySizes)
    assert model.stages[T.CLASSIFIER].toDebugString.split("\n")[1:] == trained.model.stages[T.CLASSIFIER].toDebugString.split("\n")[1:]
    both = again.select("obs_id", F.col("prediction").alias("p")).join(trained.predictions, "obs_id")
    assert both.count() == trained.predictions.count() and both.where("p <> prediction").count() == 0
    unseen = split_at(data, trained.cutoff)[1].withColumn("weather", F.lit("Hail"))
    assert T.predict(model, unseen).where("predicted_congestion_class IS NULL").count() == 0


def test_a_changed_label_order_changes_the_result(trained, data):
    document = json.loads(json.dumps(trained.specification))
    document["preprocessing"]["target_labels"].reverse()
    model, again = _again(trained, data, document)
    assert T.labels_of(model) == T.labels_of(trained.model)[::-1]
    assert again.where("actual_congestion_class = 'Medium'").select("label").distinct().collect()[0][0] == 0.0
    document = json.loads(json.dumps(trained.specification))
    document["preprocessing"]["labels"]["corridor"].reverse()
    prepared = specs.feature_model(data.sparkSession, document).transform(data)
    first = document["preprocessing"]["labels"]["corridor"][0]
    assert prepared.where(F.col("corridor") == first).select("corridor_index").distinct().collect() == [(0.0,)]


@pytest.mark.parametrize(
    "change, words",
    [
        (lambda d: d["features"]["categorical"].pop(), "category labels, category sizes, assembler inputs"),
        (lambda d: d["features"]["assembler_inputs"].reverse(), "assembler inputs"),
        (lambda d: d["features"]["numeric"].pop(), "assembler inputs, vector dimension"),
        (lambda d: d["preprocessing"]["labels"]["weather"].append("Hail"), "category sizes"),
        (lambda d: d["preprocessing"]["labels"]["weather"].append("Fog"), "category labels"),
        (lambda d: d["preprocessing"]["categorySizes"].reverse(), "category sizes"),
        (lambda d: d["preprocessing"]["target_labels"].append("High"), "target labels"),
        (lambda d: d.update(model_class="NaiveBayes"), "model class"),
    ],
)
def test_a_document_that_contradicts_itself_is_refused(trained, data, change, words):
    document = json.loads(json.dumps(trained.specification))
    change(document)
    with pytest.raises(ValueError, match=words):
        specs.feature_model(data.sparkSession, document)


def test_stored_model_gives_the_same_advice(spark, trained, data):
    path = fresh_path(spark, "model")
    specs.save_model(spark, trained.model, trained.specification, path)
    assert specs.load_spec(spark, path) == trained.specification
    advised = runs.predict_and_advise(spark, data, path, "obs_id")
    assert advised.columns == ["obs_id", *S.PREDICTED_ADVISORY_COLUMNS]
    differing = advised.join(trained.predictions.select("obs_id", F.col("predicted_congestion_class").alias("p")), "obs_id").where(
        "p <> predicted_congestion_class"
    )
    assert advised.count() == trained.predictions.count() and differing.count() == 0


def test_changed_input_is_refused(spark, trained, data):
    path = fresh_path(spark, "model")
    specs.save_model(spark, trained.model, trained.specification, path)
    with pytest.raises(ValueError, match="input_fingerprint"):
        runs.predict_and_advise(spark, data.where("obs_id > 0"), path)


def test_other_specification_is_refused(trained):
    changed = {**trained.specification, "native_spark_pipeline_model": False}
    conditions = specs.spec_conditions(changed, trained.model, "1999-01-01", trained.specification["training"]["input_fingerprint"])
    assert [name for name, ok in conditions.items() if not ok] == ["native_model_flag", "cutoff_date"]
    with pytest.raises(ValueError, match="native_model_flag, cutoff_date"):
        specs.require_spec(conditions)


def test_nothing_is_described_before_it_is_asked_for(monkeypatch, data):
    def refuse(*_):
        raise AssertionError("the input was fingerprinted")

    monkeypatch.setattr(runs, "fingerprint", refuse)
    trained = runs.train(data, T.decision_tree(max_depth=1), "obs_id")
    assert trained.metrics.count() == 4
    with pytest.raises(AssertionError):
        trained.specification


def test_feature_stages_fitted_before_give_the_same_model(trained, data):
    features = T.fit_features(split_at(data, trained.cutoff)[0])
    again = runs.train(data, T.decision_tree(), "obs_id", features=features)
    assert again.specification == trained.specification | {"tree": again.specification["tree"]}
    assert again.specification["tree"].split("\n")[1:] == trained.specification["tree"].split("\n")[1:]


def test_observations_of_the_fits_are_joined_once(spark, sf_dir):
    stored = model_queries._observed(spark, sf_dir)
    assert stored is model_queries._observed(spark, sf_dir)
    assert "Join" not in stored._jdf.queryExecution().executedPlan().toString()
    assert fingerprint(stored).first() == fingerprint(observations(spark, sf_dir)).first()
