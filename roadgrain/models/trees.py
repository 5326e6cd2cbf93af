"""Feature preparation, the two tree classifiers, and feature importances."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S

MAX_DEPTH, NUM_TREES, SEED = 5, 20, 42
INDEXER, ENCODER, LABEL_INDEXER, ASSEMBLER, CLASSIFIER = range(5)


def assembler_inputs() -> list[str]:
    return [*S.NUMERIC_FEATURES, *[f"{name}_encoded" for name in S.CATEGORICAL_FEATURES], *S.BOOLEAN_FEATURES]


def feature_stages() -> list:
    """Index and encode the categories (unseen values get their own slot), index the label, assemble."""
    indexed = [f"{name}_index" for name in S.CATEGORICAL_FEATURES]
    return [
        StringIndexer(
            inputCols=S.CATEGORICAL_FEATURES,
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=indexed,
            outputCols=[f"{name}_encoded" for name in S.CATEGORICAL_FEATURES],
            handleInvalid="keep",
        ),
        StringIndexer(inputCol=S.TARGET, outputCol="label", handleInvalid="error", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=assembler_inputs(), outputCol="features", handleInvalid="error"),
    ]


def decision_tree(max_depth: int = MAX_DEPTH, seed: int = SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=max_depth, seed=seed)


def random_forest(
    num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed
    )


def fit_features(training: DataFrame) -> PipelineModel:
    """The feature stages fitted on the different combinations of category values and target.

    Labels are sorted, so that they depend on nothing else, and rows are read and merged once. The indexer keeps
    each label of a category on the driver, as MLlib models do.
    """
    combinations = training.select(*S.CATEGORICAL_FEATURES, S.TARGET).distinct().persist()
    try:
        return Pipeline(stages=feature_stages()).fit(combinations)
    finally:
        combinations.unpersist()


@contextmanager
def assembled_rows(
    training: DataFrame, features: PipelineModel, classifier, order_key: str | None = None, partitions: int | None = None
):
    """Label and vector of the training rows, made once, kept on disk while a classifier is fitted and released afterwards.

    The learner looks at them three times before it caches rows of its own, to which the memory is left.
    With ``order_key`` (a unique column) rows are placed and ordered by it, so that the
    sampling inside the tree learner does not depend on how the input was partitioned.
    """
    wanted = training
    if order_key:
        count = partitions or int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        wanted = wanted.repartition(count, order_key).sortWithinPartitions(order_key)
    assembled = features.transform(wanted.select(*S.FEATURES, S.TARGET))
    cached = assembled.select(classifier.getLabelCol(), classifier.getFeaturesCol()).persist(StorageLevel.DISK_ONLY)
    try:
        yield cached
    finally:
        cached.unpersist()


def fit(
    training: DataFrame, classifier, order_key: str | None = None, features: PipelineModel | None = None
) -> PipelineModel:
    """Fit all stages, or the classifier behind feature stages that are already fitted."""
    features = features or fit_features(training)
    with assembled_rows(training, features, classifier, order_key) as rows:
        return PipelineModel(stages=[*features.stages, classifier.fit(rows)])


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[LABEL_INDEXER].labels)


def category_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Labels of each category in index order, of a model fitted here or rebuilt from its specification."""
    indexer = model.stages[INDEXER]
    if isinstance(indexer, PipelineModel):
        return {stage.getInputCol(): list(stage.labels) for stage in indexer.stages}
    return {name: list(labels) for name, labels in zip(S.CATEGORICAL_FEATURES, indexer.labelsArray)}


def _decoded(index: Column, labels: list[str]) -> Column:
    names = F.array(*[F.lit(label) for label in labels])
    return F.try_element_at(names, (index + 1).cast("int"))


def decode(scored: DataFrame, labels: list[str]) -> DataFrame:
    """Class names for the label and prediction indices."""
    return scored.withColumns(
        {
            "actual_congestion_class": _decoded(F.col("label"), labels),
            "predicted_congestion_class": _decoded(F.col("prediction"), labels),
        }
    )


def predict(model: PipelineModel, testing: DataFrame) -> DataFrame:
    """Score and decode; the intermediate feature columns are dropped."""
    scored = decode(model.transform(testing), labels_of(model))
    return scored.select(
        *testing.columns, "label", "prediction", "actual_congestion_class", "predicted_congestion_class"
    )


def evaluator_metrics(scored: DataFrame) -> dict[str, float]:
    """The four metrics by MLlib's evaluator, one pass each; ``scoring.weighted_metrics`` needs one in all."""
    names = dict(zip(S.METRIC_NAMES, ("accuracy", "weightedPrecision", "weightedRecall", "f1")))
    return {
        name: MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=metric
        ).evaluate(scored)
        for name, metric in names.items()
    }


def slot_rows(categories: dict[str, list[str]]) -> list[tuple[int, str, str, str]]:
    """(slot, feature, group, type) of every position of the feature vector.

    As long as the vector, which is part of the model itself.
    """
    named = [(name, name, "numeric") for name in S.NUMERIC_FEATURES]
    for group in S.CATEGORICAL_FEATURES:
        named += [(f"{group}={label}", group, "categorical_one_hot") for label in categories[group]]
        named.append((f"{group}=<unseen_or_invalid>", group, "categorical_one_hot_keep"))
    named += [(name, name, "boolean") for name in S.BOOLEAN_FEATURES]
    return [(slot, *entry) for slot, entry in enumerate(named)]


SLOT_SCHEMA = "slot int, feature string, feature_group string, slot_type string"


def feature_slots(model: PipelineModel, data: DataFrame) -> DataFrame:
    return data.sparkSession.createDataFrame(slot_rows(category_labels(model)), SLOT_SCHEMA)


def vector_width(categories: dict[str, list[str]]) -> int:
    return len(slot_rows(categories))


def slot_importances(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Importance of every vector slot; slots the model does not split on have zero."""
    vector = model.stages[CLASSIFIER].featureImportances
    values = data.sparkSession.createDataFrame(
        [(int(i), float(v)) for i, v in zip(vector.indices, vector.values)], "slot int, importance double"
    )
    return feature_slots(model, data).join(values, "slot", "left").withColumn(
        "importance", F.coalesce("importance", F.lit(0.0))
    )


def grouped_importances(slots: DataFrame) -> DataFrame:
    """Importance per logical feature, summed over its slots and then rounded, largest first."""
    return (
        slots.groupBy("feature_group")
        .agg(F.round(F.sum("importance"), 6).alias("importance"))
        .orderBy(F.desc("importance"), "feature_group")
    )
