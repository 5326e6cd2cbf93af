"""Reports of hand-made rows, and gates that look at what was written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators import gates, reporting
from roadgrain.operators.split import test_period as held_back_period, with_part
from roadgrain.sources import files
from tests.conftest import values


@pytest.fixture
def store(tmp_path):
    def make(data):
        path = str(tmp_path / "combinations")
        data.write.parquet(path)
        return data.sparkSession.read.schema(data.schema).parquet(path)

    return make


ROWS = "part string, date date, actual_congestion_class string, predicted_congestion_class string, advisory_level string"


@pytest.fixture
def scored(spark):
    days = [("training", 1, "Low", "Low", "Normal"), ("training", 2, "High", "Low", "Normal"), ("testing", 3, "High", "High", "High")]
    days += [("testing", 3, "Low", "High", "High"), ("testing", 5, "High", "High", "High"), ("testing", 4, None, "Low", "Normal")]
    frame = spark.createDataFrame([(p, f"2020-01-0{d}", a, b, c) for p, d, a, b, c in days], ROWS.replace("date date", "date string"))
    extra = {"festival_flag": F.col("date") == "2020-01-03", "holiday_flag": F.lit(None).cast("boolean")}
    extra |= {"roadwork": F.lit("Yes"), "weather": F.lit("Fog"), "date": F.col("date").cast("date")}
    return frame.withColumns(extra)


def lines(report):
    found = {(r.section, r.name): r.value for r in report.collect()}
    assert report.columns == ["section", "name", "value"]
    return found


def test_prediction_report(scored, store):
    checks = scored.limit(1).select(F.lit("a").alias("name"), F.lit(False).alias("passed"))
    found = lines(reporting.prediction_report(scored, store, checks))
    assert found["dataset", "training rows"] == "2" and found["dataset", "testing rows"] == "4" and found["dataset", "total rows"] == "6"
    assert found["dataset", "training last date"] == "2020-01-02" and found["dataset", "testing first date"] == "2020-01-03"
    assert found["predictions", "High"] == "3" and found["predictions", "Low"] == "1"
    assert found["advisory level", "Normal"] == "1" and found["context", "festival"] == "2" and found["context", "holiday"] == "0"
    assert found["confusion matrix", "High,High"] == "2" and found["confusion matrix", "Low,High"] == "1"
    assert found["validation", "a"] == "FAIL"
    assert "predictions null" not in {name for _, name in found}


def test_training_report(scored, store):
    kept = ("weather", "roadwork", *S.BOOLEAN_FEATURES)
    rows = scored.fillna(False, ["holiday_flag"]).withColumns({c: F.lit(1.0) for c in S.FEATURES if c not in kept})
    rows = rows.withColumn("weather", F.when(F.col("part") == "testing", "Fog"))
    found = lines(reporting.training_report(rows, store))
    assert found["class distribution", "training High"] == "count=1, percentage=50.0000%"
    assert found["class distribution", "testing null"] == "count=1, percentage=25.0000%"
    assert found["quality", "training rows with a null feature"] == "2" and found["quality", "testing rows with a null feature"] == "0"
    assert found["quality", "training before testing"] == "PASS"


def test_benchmark_report(scored, store):
    known = scored.where("actual_congestion_class IS NOT NULL").withColumn("second", F.col("actual_congestion_class"))
    importances = known.limit(1).select(F.lit("weather").alias("feature_group"), F.lit(0.25).alias("importance"))
    models = {"first": "predicted_congestion_class", "second": "second"}
    found = lines(reporting.benchmark_report(known, models, store, importances))
    assert found["second", "Accuracy"] == "1.000000" and found["first", "Accuracy"] == "0.666667"
    assert found["confusion matrix", "High,High"] == "2" and ("confusion matrix", "Low,High") not in found
    assert found["grouped importances", "weather"] == "0.250000"


def test_advisory_and_feature_reports_of_empty_tables(spark, scored, tmp_path):
    advisories = scored.withColumnRenamed("actual_congestion_class", S.TARGET)
    found = lines(reporting.advisory_report(advisories, lambda d: d))
    assert found["dataset", "total advisories"] == "6" and found["congestion class", "null"] == "1" and found["advisory level", "High"] == "3"
    assert lines(reporting.advisory_report(advisories.where("false"), lambda d: d)) == {}
    empty = spark.createDataFrame([], S.INTEGRATED_SCHEMA)
    report = lines(reporting.feature_report(empty, lambda d: d))
    assert report["distinct values", "weather"] == "0" and report["dataset", "first date"] is None
    assert report["excluded", "congestion_class"] == S.EXCLUDED_FEATURES["congestion_class"]


def test_distributions_tell_sets_apart_although_values_are_null(spark):
    data = spark.createDataFrame([("a", None), ("a", "x"), (None, "x")], "p string, q string").groupBy("p", "q").agg(F.count("*").alias("rows"))
    found = reporting.distributions(data, {"all": (), "p": ("p",), "both": ("p", "q")})
    assert sorted(values(found.where("of = 'p'"), "p", "rows"), key=str) == [("a", 2), (None, 1)]
    assert values(found.where("of = 'all'"), "rows") == [(3,)] and found.where("of = 'both'").count() == 3


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    path = str(tmp_path / "out")
    assert not gates.output_exists(spark, path)
    counted = gates.write_observed(spark.range(10), lambda d: d.where("id < 7"), path)
    assert counted == {"input_rows": 10, "output_rows": 7} and gates.output_exists(spark, path)
    stored = spark.read.parquet(path)
    assert values(gates.rows_kept(counted["output_rows"], stored)) == [("rows_kept", True)]
    assert values(gates.rows_kept(counted["input_rows"], stored)) == [("rows_kept", False)]


def test_period_of_the_split(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2020-01-10')) AS date").union(spark.sql("SELECT CAST(NULL AS DATE)"))
    assert [str(d) for d in held_back_period(days).first()] == ["2020-01-09", "2020-01-10"]
    parts = with_part(days, "2020-01-08").groupBy("part").count()
    assert dict(values(parts)) == {"training": 8, "testing": 2, None: 1}
    assert files.same_content(days, days.repartition(3))
