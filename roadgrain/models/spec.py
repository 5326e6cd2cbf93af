"""Stored model plus a readable specification, and the checks on loading it."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.models import trees as T
from roadgrain.operators.rows import unfold


def model_spec(
    model: PipelineModel,
    cutoff_date: str,
    input_fingerprint: str,
    metrics: dict[str, float],
    importances: dict[str, float] | None = None,
) -> dict:
    """Everything needed to read, rebuild and verify a fitted model."""
    classifier = model.stages[T.CLASSIFIER]
    forest = hasattr(classifier, "trees")
    parameters = {
        "maxDepth": classifier.getOrDefault("maxDepth"),
        "seed": classifier.getOrDefault("seed"),
        "labelCol": classifier.getOrDefault("labelCol"),
        "featuresCol": classifier.getOrDefault("featuresCol"),
        "predictionCol": classifier.getOrDefault("predictionCol"),
    }
    if forest:
        parameters |= {"numTrees": classifier.getNumTrees, "totalNumNodes": classifier.totalNumNodes}
    else:
        parameters |= {"numNodes": classifier.numNodes, "depth": classifier.depth}
    return {
        "model_class": "RandomForestClassifier" if forest else "DecisionTreeClassifier",
        "native_spark_pipeline_model": True,
        "classifier": parameters,
        "tree": classifier.toDebugString,
        "features": {
            "numeric": S.NUMERIC_FEATURES,
            "categorical": S.CATEGORICAL_FEATURES,
            "boolean": S.BOOLEAN_FEATURES,
            "assembler_inputs": T.assembler_inputs(),
            "excluded": S.EXCLUDED_FEATURES,
            "vector_dimension": classifier.numFeatures,
        },
        "preprocessing": {
            "handleInvalid": "keep",
            "stringOrderType": "alphabetAsc",
            "labels": T.category_labels(model),
            "categorySizes": list(model.stages[T.ENCODER].categorySizes),
            "target_labels": T.labels_of(model),
        },
        "training": {"cutoff_date": cutoff_date, "input_fingerprint": input_fingerprint},
        "evaluation": metrics,
        "grouped_feature_importances": importances or {},
    }


def save_model(spark: SparkSession, model: PipelineModel, spec: dict, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    document = spark.createDataFrame([(json.dumps(spec),)], "value string")
    document.coalesce(1).write.mode("overwrite").text(f"{path}/specification")


def load_spec(spark: SparkSession, path: str) -> dict:
    """The specification document of one model (a single row)."""
    return json.loads(spark.read.text(f"{path}/specification", wholetext=True).first()[0])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def _require_consistent(spec: dict) -> None:
    """Refuse a document whose parts contradict each other."""
    features, prepared = spec["features"], spec["preprocessing"]
    names, labels, sizes = features["categorical"], prepared["labels"], prepared["categorySizes"]
    inputs = [*features["numeric"], *[f"{name}_encoded" for name in names], *features["boolean"]]
    problems = {
        "model class": spec["model_class"] not in ("RandomForestClassifier", "DecisionTreeClassifier"),
        "category labels": sorted(labels) != sorted(names) or any(len(set(x)) != len(x) for x in labels.values()),
        "category sizes": len(sizes) != len(names) or any(n != len(labels.get(c, ())) + 1 for c, n in zip(names, sizes)),
        "assembler inputs": features["assembler_inputs"] != inputs,
        "vector dimension": features["vector_dimension"] != len(features["numeric"]) + sum(sizes) + len(features["boolean"]),
        "target labels": len(set(prepared["target_labels"])) != len(prepared["target_labels"]),
    }
    found = [name for name, wrong in problems.items() if wrong]
    if found:
        raise ValueError(f"Model specification contradicts itself: {', '.join(found)}.")


def feature_model(spark: SparkSession, spec: dict) -> PipelineModel:
    """The fitted feature stages that a specification describes, made from its labels and sizes alone.

    No training row is read: the indexers take the stored labels in the stored order, and the
    encoder learns its sizes from one row with each category's last index.
    """
    _require_consistent(spec)
    features, prepared = spec["features"], spec["preprocessing"]
    names, keep = features["categorical"], prepared["handleInvalid"]
    indexed, encoded = [f"{name}_index" for name in names], [f"{name}_encoded" for name in names]
    # One model for each category, as the constructor for several columns fills shorter label lists up with nulls.
    indexer = PipelineModel(
        stages=[
            StringIndexerModel.from_labels(prepared["labels"][name], inputCol=name, outputCol=index, handleInvalid=keep)
            for name, index in zip(names, indexed)
        ]
    )
    target = StringIndexerModel.from_labels(
        prepared["target_labels"], inputCol=S.TARGET, outputCol=spec["classifier"]["labelCol"], handleInvalid="error"
    )
    last = spark.range(1).select(*[F.lit(float(n - 1)).alias(c) for c, n in zip(indexed, prepared["categorySizes"])])
    encoder = OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid=keep).fit(last)
    assembler = VectorAssembler(
        inputCols=features["assembler_inputs"], outputCol=spec["classifier"]["featuresCol"], handleInvalid="error"
    )
    return PipelineModel(stages=[indexer, encoder, target, assembler])


def rebuild(spark: SparkSession, spec: dict, training: DataFrame, order_key: str | None = None) -> PipelineModel:
    """The model a specification describes: stored features, and its classifier fitted again on the training rows."""
    parameters, prepared = spec["classifier"], feature_model(spark, spec)
    if spec["model_class"] == "RandomForestClassifier":
        classifier = T.random_forest(parameters["numTrees"], parameters["maxDepth"], parameters["seed"])
    else:
        classifier = T.decision_tree(parameters["maxDepth"], parameters["seed"])
    classifier.setLabelCol(parameters["labelCol"]).setFeaturesCol(parameters["featuresCol"])
    classifier.setPredictionCol(parameters["predictionCol"])
    with T.assembled_rows(training, prepared, classifier, order_key) as rows:
        fitted = classifier.fit(rows)
    return PipelineModel(stages=[*prepared.stages, fitted])


def spec_conditions(spec: dict, model: PipelineModel, cutoff_date: str, input_fingerprint: str) -> dict[str, bool]:
    """What must agree between a stored specification, a fitted model and the current input."""
    prepared = spec["preprocessing"]
    return {
        "native_model_flag": spec.get("native_spark_pipeline_model") is True,
        "input_fingerprint": spec["training"]["input_fingerprint"] == input_fingerprint,
        "cutoff_date": spec["training"]["cutoff_date"] == cutoff_date,
        "target_labels": prepared["target_labels"] == T.labels_of(model),
        "category_labels": prepared["labels"] == T.category_labels(model),
        "category_sizes": prepared["categorySizes"] == list(model.stages[T.ENCODER].categorySizes),
        "assembler_inputs": spec["features"]["assembler_inputs"] == T.assembler_inputs(),
    }


def spec_checks(data: DataFrame, conditions: dict[str, bool]) -> DataFrame:
    return unfold(
        data.sparkSession.range(1), [{"name": F.lit(n), "passed": F.lit(ok)} for n, ok in conditions.items()]
    )


def require_spec(conditions: dict[str, bool]) -> None:
    failed = [name for name, ok in conditions.items() if not ok]
    if failed:
        raise ValueError(f"Model specification does not fit: {', '.join(failed)}.")
