"""Registered queries: features, tree models, importances, specifications.

Queries that only depend on the split and the labels have SQL twins; results of a
fitted tree have none.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.models import spec as specs, trees as T
from roadgrain.operators import gates, scoring
from roadgrain.operators.advisory import advise_predictions
from roadgrain.operators.split import split_at, test_period
from roadgrain.plans import runs
from roadgrain.plans.registry import over_observations, query, r4, rounded, sql_r4
from roadgrain.plans.shape_queries import CUTOFF_SQL
from roadgrain.session import fresh_path
from roadgrain.sources import reports
from roadgrain.sources.given import observations
from roadgrain.sources.files import fingerprint

_FITTED: dict[tuple[str, str, str], runs.Trained] = {}
_STORED: dict[tuple[str, str], DataFrame] = {}


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations, joined and written once per application and table folder for all fits and predictions."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path, data = fresh_path(spark, "observations"), observations(spark, sf_dir)
        data.write.option("parquet.block.size", 32 << 20).parquet(path)
        _STORED[key] = spark.read.schema(data.schema).parquet(path)
    return _STORED[key]


def _trained(spark: SparkSession, sf_dir: str, kind: str = "tree") -> runs.Trained:
    """Fit once per application, table folder and kind; several queries look at the result."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FITTED:
        classifier = T.decision_tree() if kind == "tree" else T.random_forest()
        other = next((_FITTED[k] for k in _FITTED if k[:2] == key[:2]), None)  # feature stages are the same for all kinds
        stages = other and PipelineModel(stages=other.model.stages[: T.CLASSIFIER])
        _FITTED[key] = runs.train(_observed(spark, sf_dir), classifier, "obs_id", features=stages)
    return _FITTED[key]


def _test_rows(spark, sf_dir) -> DataFrame:
    return split_at(_observed(spark, sf_dir), _trained(spark, sf_dir).cutoff)[1]


_SPLIT_SQL = (
    f"{CUTOFF_SQL}, train AS (SELECT * FROM obs WHERE date <= (SELECT cutoff_date FROM cut)), "
    "test AS (SELECT * FROM obs WHERE date > (SELECT cutoff_date FROM cut)), "
    "labels AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS gno, '{name}' AS feature_group, v, row_number() OVER (ORDER BY v) AS k FROM (SELECT DISTINCT {name} AS v FROM train)"
        for i, name in enumerate(S.CATEGORICAL_FEATURES)
    )
    + "), sizes AS (SELECT gno, feature_group, count(*) AS label_count FROM labels GROUP BY ALL), "
    "starts AS (SELECT *, 4 + coalesce(sum(label_count + 1) OVER (ORDER BY gno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sizes)"
)

_SLOTS_SQL = (
    "slots AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS slot, '{name}' AS feature, '{name}' AS feature_group, 'numeric' AS slot_type, NULL AS v"
        for i, name in enumerate(S.NUMERIC_FEATURES)
    )
    + " UNION ALL SELECT start + k - 1, feature_group || '=' || v, feature_group, 'categorical_one_hot', v "
    "FROM labels JOIN starts USING (gno, feature_group) "
    "UNION ALL SELECT start + label_count, feature_group || '=<unseen_or_invalid>', feature_group, 'categorical_one_hot_keep', NULL FROM starts "
    + "".join(
        f"UNION ALL SELECT (SELECT max(start + label_count) FROM starts) + {i}, '{name}', '{name}', 'boolean', NULL "
        for i, name in enumerate(S.BOOLEAN_FEATURES, start=1)
    )
    + ")"
)


def _slot_sums_sql() -> str:
    parts = [
        f"SELECT '{name}' AS feature, count(*) FILTER ({name} <> 0) AS nonzero_count, sum({name})::DOUBLE AS total FROM test"
        for name in S.NUMERIC_FEATURES
    ]
    parts += [
        f"SELECT '{name}=' || {name}, count(*), count(*)::DOUBLE FROM test GROUP BY {name}" for name in S.CATEGORICAL_FEATURES
    ]
    parts += [
        f"SELECT '{name}', count(*) FILTER ({name}), count(*) FILTER ({name})::DOUBLE FROM test" for name in S.BOOLEAN_FEATURES
    ]
    return " UNION ALL ".join(parts)


@query(
    "M1_feature_vectors",
    over_observations(
        "SELECT CAST(slot AS INTEGER) AS slot, slots.feature, coalesce(nonzero_count, 0) AS nonzero_count, "
        f"{sql_r4('coalesce(total, 0e0) / 1e6')} AS total_in_millions FROM slots LEFT JOIN sums ON slots.feature = sums.feature",
        _SPLIT_SQL,
        _SLOTS_SQL,
        f"sums AS ({_slot_sums_sql()})",
    ),
)
def feature_vectors(spark, sf_dir):
    """Sum and non-zero count of every vector slot over the test rows, by vector aggregates."""
    model = _trained(spark, sf_dir).model
    assembled = _test_rows(spark, sf_dir)
    for stage in model.stages[: T.CLASSIFIER]:
        assembled = stage.transform(assembled)
    totals = assembled.agg(
        vector_to_array(Summarizer.sum(F.col("features"))).alias("total"),
        vector_to_array(Summarizer.numNonZeros(F.col("features"))).alias("nonzero"),
    )
    slots = totals.select(F.posexplode(F.arrays_zip("total", "nonzero")).alias("slot", "s")).select(
        "slot",
        F.col("s.nonzero").cast("bigint").alias("nonzero_count"),
        r4(F.col("s.total") / 1e6).alias("total_in_millions"),
    )
    return T.feature_slots(model, assembled).select("slot", "feature").join(slots, "slot")


@query(
    "M2_vector_width",
    over_observations(
        "SELECT feature_group, CAST(label_count AS INTEGER) AS label_count, CAST(label_count + 1 AS INTEGER) AS slot_count, "
        "CAST((SELECT 4 + sum(label_count + 1) + 2 FROM sizes) AS INTEGER) AS vector_width FROM sizes",
        _SPLIT_SQL,
    ),
)
def vector_width(spark, sf_dir):
    model = _trained(spark, sf_dir).model
    categories, sizes = T.category_labels(model), model.stages[T.ENCODER].categorySizes
    rows = [
        (name, len(categories[name]), int(size), model.stages[T.CLASSIFIER].numFeatures)
        for name, size in zip(S.CATEGORICAL_FEATURES, sizes)
    ]
    return spark.createDataFrame(rows, "feature_group string, label_count int, slot_count int, vector_width int")


@query("M3_decision_tree_matrix")
def decision_tree_matrix(spark, sf_dir):
    return scoring.dense_matrix(_trained(spark, sf_dir).matrix)


@query("M4_random_forest_benchmark")
def random_forest_benchmark(spark, sf_dir):
    """The two models side by side on the same test rows."""
    return rounded(
        scoring.compare_models(
            {
                "decision_tree": _trained(spark, sf_dir).metrics,
                "random_forest": _trained(spark, sf_dir, "forest").metrics,
            }
        )
    )


@query("M4_random_forest_classes")
def random_forest_classes(spark, sf_dir):
    return rounded(
        scoring.compare_classes(
            {
                "Decision Tree": scoring.class_metrics(_trained(spark, sf_dir).matrix),
                "Random Forest": scoring.class_metrics(_trained(spark, sf_dir, "forest").matrix),
            }
        )
    )


@query(
    "M5_decoded_labels",
    over_observations(
        "SELECT obs_id, congestion_class AS actual_congestion_class, "
        "CASE congestion_class WHEN 'High' THEN 0e0 WHEN 'Low' THEN 1e0 ELSE 2e0 END AS label, true AS prediction_is_decoded FROM test",
        _SPLIT_SQL,
    ),
)
def decoded_labels(spark, sf_dir):
    names = F.array(*[F.lit(name) for name in S.CLASSES_ALPHABETIC])
    decoded = F.element_at(names, (F.col("prediction") + 1).cast("int")) == F.col("predicted_congestion_class")
    return _trained(spark, sf_dir).predictions.select(
        "obs_id", "actual_congestion_class", "label", decoded.alias("prediction_is_decoded")
    )


@query(
    "M6_rebuilt_from_specification",
    over_observations("SELECT count(*) AS test_rows, CAST(0 AS BIGINT) AS differing_predictions FROM test", _SPLIT_SQL),
)
def rebuilt_from_specification(spark, sf_dir):
    """A model rebuilt from the stored document alone predicts the same class for every test row."""
    trained = _trained(spark, sf_dir)
    document = specs.load_spec(spark, _stored(spark, sf_dir))
    training, testing = split_at(_observed(spark, sf_dir), document["training"]["cutoff_date"])
    again = T.predict(specs.rebuild(spark, document, training, "obs_id"), testing).select("obs_id", F.col("prediction").alias("again"))
    return (
        trained.predictions.select("obs_id", "prediction")
        .join(again, "obs_id")
        .agg(
            F.count(F.lit(1)).alias("test_rows"),
            F.count_if(F.col("prediction") != F.col("again")).alias("differing_predictions"),
        )
    )


@query(
    "M7_feature_slots",
    over_observations(
        "SELECT CAST(slot AS INTEGER) AS slot, feature, feature_group, slot_type FROM slots", _SPLIT_SQL, _SLOTS_SQL
    ),
)
def feature_slots(spark, sf_dir):
    return T.feature_slots(_trained(spark, sf_dir).model, observations(spark, sf_dir))


@query("A9_grouped_importances")
def grouped_importances(spark, sf_dir):
    trained = _trained(spark, sf_dir, "forest")
    return T.grouped_importances(T.slot_importances(trained.model, observations(spark, sf_dir)))


@query(
    "A6_evaluator_agrees",
    over_observations(
        "SELECT unnest(['Accuracy', 'Weighted Precision', 'Weighted Recall', 'F1 Score']) AS metric, true AS agrees"
    ),
)
def evaluator_agrees(spark, sf_dir):
    """The one-pass metrics equal those of MLlib's evaluators on the tree's predictions."""
    trained = _trained(spark, sf_dir)
    expected = spark.createDataFrame(
        list(T.evaluator_metrics(trained.predictions).items()), "metric string, expected double"
    )
    return trained.metrics.join(expected, "metric").select(
        "metric", (F.abs(F.col("value") - F.col("expected")) < 1e-9).alias("agrees")
    )


_SPEC_CHECKS = [
    "native_model_flag",
    "input_fingerprint",
    "cutoff_date",
    "target_labels",
    "category_labels",
    "category_sizes",
    "assembler_inputs",
]


def _stored(spark, sf_dir) -> str:
    trained = _trained(spark, sf_dir)
    path = fresh_path(spark, "tree")
    specs.save_model(spark, trained.model, trained.specification, path)
    return path


@query(
    "S12_stored_specification",
    over_observations(
        "SELECT feature_group, v AS label, CAST(k - 1 AS INTEGER) AS label_index, "
        "CAST((SELECT cutoff_date FROM cut) AS VARCHAR) AS cutoff_date FROM labels",
        _SPLIT_SQL,
    ),
)
def stored_specification(spark, sf_dir):
    """The label indices read back from a stored specification."""
    stored = specs.load_spec(spark, _stored(spark, sf_dir))
    rows = [
        (name, label, index, stored["training"]["cutoff_date"])
        for name, labels in stored["preprocessing"]["labels"].items()
        for index, label in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "feature_group string, label string, label_index int, cutoff_date string")


@query(
    "S13_specification_checks",
    over_observations(
        "SELECT name, NOT (input = 'changed' AND name = 'input_fingerprint') AS passed, input FROM "
        f"(SELECT unnest([{', '.join(repr(n) for n in _SPEC_CHECKS)}]) AS name), (SELECT unnest(['same', 'changed']) AS input)"
    ),
)
def specification_checks(spark, sf_dir):
    """A stored model against its own input, and against an input with one changed flag column."""
    path = _stored(spark, sf_dir)
    stored, model = specs.load_spec(spark, path), specs.load_model(path)
    data = _observed(spark, sf_dir)
    changed = data.withColumn("holiday_flag", ~F.col("holiday_flag"))
    result = None
    for label, source in (("same", data), ("changed", changed)):
        mark = "-".join(str(part) for part in fingerprint(source).first())
        conditions = specs.spec_conditions(stored, model, stored["training"]["cutoff_date"], mark)
        checks = specs.spec_checks(source, conditions).withColumn("input", F.lit(label))
        result = checks if result is None else result.unionByName(checks)
    return result


@query(
    "V4_advisories_from_tree",
)
def advisories_from_tree(spark, sf_dir):
    return advise_predictions(_trained(spark, sf_dir).predictions, "obs_id")


@query(
    "G6_tree_advisory_checks",
    over_observations(
        "SELECT unnest(['test_rows_equal_prediction_rows', 'actual_and_predicted_columns_present', "
        "'actual_and_predicted_values_supported', 'advice_uses_predicted_class_only', 'unique_key', 'no_null_predicted_class', "
        "'no_null_advisory_level', 'advisory_levels_supported', 'test_period_exact', 'metrics_match_baseline', 'output_exists']) "
        "AS name, true AS passed"
    ),
)
def tree_advisory_checks(spark, sf_dir):
    """Of stored advisories, against the metrics of the stored specification and the split's own period."""
    trained, folder = _trained(spark, sf_dir), _stored(spark, sf_dir)
    gates.write_observed(trained.predictions, lambda rows: advise_predictions(rows, "obs_id"), f"{folder}/advisories")
    stored = spark.read.parquet(f"{folder}/advisories")
    document = reports.read_reports(spark, f"{folder}/specification")
    period = test_period(observations(spark, sf_dir, "date"))
    return gates.predicted_advisory_checks(
        _test_rows(spark, sf_dir),
        trained.predictions,
        stored,
        ["obs_id"],
        (period.select("first_date").scalar(), period.select("last_date").scalar()),
        scoring.weighted_metrics(scoring.confusion_matrix(stored)),
        reports.parse_spec_metrics(document, "report").select("metric", "value"),
        gates.output_exists(spark, f"{folder}/advisories"),
    )


def _class_totals_sql(*models: str) -> str:
    return over_observations(
        " UNION ALL ".join(
            f"SELECT '{model}' AS model, congestion_class AS actual_class, count(*) AS test_rows, true AS in_classes "
            "FROM test GROUP BY congestion_class"
            for model in models
        ),
        _SPLIT_SQL,
    )


def _class_totals(matrix: DataFrame, model: str) -> DataFrame:
    """What any prediction has in common: rows per actual class, and predicted classes that are classes."""
    known = F.bool_and(F.col("predicted_class").isin(S.CLASSES))
    return matrix.groupBy("actual_class").agg(F.sum("count").alias("test_rows"), known.alias("in_classes")).withColumn(
        "model", F.lit(model)
    )


@query("M3_matrix_totals", _class_totals_sql("decision_tree"))
def matrix_totals(spark, sf_dir):
    return _class_totals(_trained(spark, sf_dir).matrix, "decision_tree")


@query("M4_matrix_totals", _class_totals_sql("decision_tree", "random_forest"))
def benchmark_totals(spark, sf_dir):
    forest = _class_totals(_trained(spark, sf_dir, "forest").matrix, "random_forest")
    return _class_totals(_trained(spark, sf_dir).matrix, "decision_tree").unionByName(forest)


@query(
    "A9_importance_groups",
    "SELECT unnest([{}]) AS feature_group, true AS in_range, true AS adds_up_to_one".format(
        ", ".join(f"'{name}'" for name in S.FEATURES)
    ),
)
def importance_groups(spark, sf_dir):
    """Every feature once, between 0 and 1, and all of them adding up to 1."""
    trained = _trained(spark, sf_dir, "forest")
    found = T.grouped_importances(T.slot_importances(trained.model, observations(spark, sf_dir)))
    total = found.agg(F.sum("importance")).scalar()
    return found.select(
        "feature_group", F.col("importance").between(0.0, 1.0).alias("in_range"), (F.abs(total - 1.0) < 1e-4).alias("adds_up_to_one")
    )
