"""Whole runs made of the operators."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from roadgrain import schemas as S
from roadgrain.models import spec as specs, trees as T
from roadgrain.operators.advisory import advise_predictions
from roadgrain.operators.calendar import integrate_calendar
from roadgrain.operators.scoring import confusion_matrix, weighted_metrics
from roadgrain.operators.shape import add_corridor, standardise
from roadgrain.operators.split import cutoff_date, split_at
from roadgrain.sources.files import fingerprint, input_digest, read_calendar, read_raw


def integrate(spark: SparkSession, raw_path: str, calendar_path: str) -> DataFrame:
    """Raw file and calendar to the integrated table as one lazy plan, without files in between."""
    tagged = add_corridor(standardise(read_raw(spark, raw_path)))
    return integrate_calendar(tagged, read_calendar(spark, calendar_path)).select(*S.INTEGRATED_COLUMNS)


@dataclass
class Trained:
    """A fitted model with its test predictions; counts, metrics and the specification are made when first asked for.

    Two small results reach the driver: the cutoff date and the confusion counts (at
    most nine), from which all metrics are computed in one pass over the predictions.
    """

    model: PipelineModel
    predictions: DataFrame
    cutoff: str
    integrated: DataFrame
    input_paths: list[str] | None = None

    @cached_property
    def matrix(self) -> DataFrame:
        return self.integrated.sparkSession.createDataFrame(
            confusion_matrix(self.predictions).collect(), "actual_class string, predicted_class string, count bigint"
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return weighted_metrics(self.matrix)

    @cached_property
    def specification(self) -> dict:
        mark = fingerprint(self.integrated).first()
        importances = T.grouped_importances(T.slot_importances(self.model, self.integrated)).collect()
        description = specs.model_spec(
            self.model,
            self.cutoff,
            "-".join(str(part) for part in mark),
            {row["metric"]: row["value"] for row in self.metrics.collect()},
            {row["feature_group"]: row["importance"] for row in importances},
        )
        if self.input_paths:
            description["training"]["input_files"] = file_marks(self.integrated.sparkSession, self.input_paths)
        return description


def train(
    integrated: DataFrame,
    classifier,
    order_key: str | None = None,
    input_paths: list[str] | None = None,
    features: PipelineModel | None = None,
) -> Trained:
    """Split by time, fit, score the later part and describe the model.

    With ``input_paths`` the digests of the input files' bytes become part of the description.
    ``features`` are feature stages fitted on the same training rows, if there are any.
    """
    cutoff = cutoff_date(integrated).first()["cutoff_date"].isoformat()
    training, testing = split_at(integrated, cutoff)
    model = T.fit(training, classifier, order_key, features)
    return Trained(model, T.predict(model, testing), cutoff, integrated, input_paths)


def file_marks(spark: SparkSession, paths: list[str]) -> list[str]:
    """The digest of every input's bytes, in the given order."""
    return [input_digest(spark, path) for path in paths]


def predict_and_advise(
    spark: SparkSession, integrated: DataFrame, path: str, *keep: str, input_paths: list[str] | None = None
) -> DataFrame:
    """Load a stored model, verify it against the input, score the test period and advise.

    A model that was trained with its input files' digests wants the same bytes again.
    """
    stored, model = specs.load_spec(spark, path), specs.load_model(path)
    cutoff = stored["training"]["cutoff_date"]
    mark = "-".join(str(part) for part in fingerprint(integrated).first())
    conditions = specs.spec_conditions(stored, model, cutoff, mark)
    if "input_files" in stored["training"]:
        conditions["input_files"] = stored["training"]["input_files"] == file_marks(spark, input_paths or [])
    specs.require_spec(conditions)
    _, testing = split_at(integrated, cutoff)
    return advise_predictions(T.predict(model, testing), *keep)
