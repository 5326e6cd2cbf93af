from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators import contracts as C, gates as G, quality as K
from roadgrain.operators.advisory import add_context_notes, advise, apply_rules, corridor_rollup, reject_conflicts
from roadgrain.sources.files import MALFORMED, read_cells
from tests.conftest import values


def test_profiling(rows):
    data = rows("k string, v double", ("a", 1.0), ("a", 1.0), ("b", None), (None, 3.0), (None, 3.0), (None, 4.0))
    assert values(K.null_counts(data)) == [("k", 3), ("v", 1)]
    assert values(K.duplicate_key_count(data, ["k"])) == [(2,)]
    assert values(K.duplicate_keys(data, ["k"]).orderBy("k")) == [(None, 3), ("a", 2)]
    assert values(K.surplus_rows(data)) == [(6, 4, 2)]
    assert values(K.distinct_values(data, "k")) == [(None,), ("a",), ("b",)]
    for approximate in (False, True):
        assert values(K.distinct_counts(data, ["k", "v"], approximate)) == [("k", 2), ("v", 3)]
    assert values(K.bounds(data, "v")) == [(1.0, 4.0)]
    name, n, low, high, mean, deviation = values(K.numeric_summary(data, ["v"]))[0]
    assert (name, n, low, high, mean) == ("v", 5, 1.0, 4.0, 2.4)
    assert deviation == pytest.approx(1.3416407865)
    assert values(K.surplus_rows(data.limit(0))) == [(0, 0, 0)]


def test_every_candidate_is_inspected(rows):
    data = rows("weather string, incident_reports double, hour int", ("Rain", 1.0, 1), ("Fog", None, None), ("Fog", 2.0, None))
    found = {r["feature"]: tuple(r)[1:] for r in K.feature_inspection(data).collect()}
    assert found["incident_reports"] == ("numeric", True, False, 1, None)
    assert found["weather"] == ("categorical", True, True, 0, 2)
    assert found["hour"] == ("unavailable", True, False, 2, None)
    assert found["parking_usage"] == ("numeric", False, False, None, None)
    assert found["GPS coordinates"] == ("unavailable", False, False, None, None)
    assert len(found) == 11 + 6 + 3 + 6 and set(S.UNAVAILABLE_FEATURES) <= set(found) and len(S.UNAVAILABLE_FEATURES) == 13


def test_excluded_features_are_refused(rows):
    data = rows("congestion_level double, date string", (1.0, "x"))
    assert [r[0] for r in values(K.feature_exclusions(data))] == ["congestion_level", "date"]
    with pytest.raises(ValueError, match="congestion_level"):
        K.feature_exclusions(data, ["traffic_volume", "congestion_level"])


# ------------------------------------------------------------------- text files
def cells_of(spark, tmp_path, text: str, name: str = "f.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return read_cells(spark, str(path))


def issues_of(spark, tmp_path, contract, text):
    checked = C.check_rows(cells_of(spark, tmp_path, text), contract, MALFORMED)
    return {(i, c) for i, c, _, _ in values(C.issue_report(checked))}


SUMMARY_HEADER = ",".join(C.CORRIDOR_SUMMARY.columns) + "\n"
HIGH_HEADER = ",".join(C.HIGH_CONGESTION.columns) + "\n"
DAY_HEADER = ",".join(C.DAY_OF_WEEK_SUMMARY.columns) + "\n"


def test_header_only(spark, tmp_path):
    assert issues_of(spark, tmp_path, C.CORRIDOR_SUMMARY, SUMMARY_HEADER) == {("no records", "")}


def test_bad_number(spark, tmp_path):
    text = SUMMARY_HEADER + "A,1,2.0,not-a-number,3.0,1.1,0,0,1\n"
    assert issues_of(spark, tmp_path, C.CORRIDOR_SUMMARY, text) == {("invalid number", "average_speed")}


def test_bad_integer(spark, tmp_path):
    assert issues_of(spark, tmp_path, C.HIGH_CONGESTION, HIGH_HEADER + "Mill,4.5x,2,12.5\n") == {
        ("invalid integer", "total_records")
    }


def test_short_and_long_rows(spark, tmp_path):
    assert issues_of(spark, tmp_path, C.HIGH_CONGESTION, HIGH_HEADER + "Mill,9,3\n") == {
        ("wrong number of fields", ""),
        ("incomplete", "high_congestion_percentage"),
    }
    assert issues_of(spark, tmp_path, C.HIGH_CONGESTION, HIGH_HEADER + "Mill,9,3,33.3,rest,end\n") == {
        ("wrong number of fields", "")
    }


def test_empty_and_absent_files(spark, tmp_path):
    with pytest.raises(ValueError, match="empty or has no header"):
        cells_of(spark, tmp_path, "")
    with pytest.raises(FileNotFoundError):
        read_cells(spark, str(tmp_path / "nowhere.csv"))


def test_missing_and_repeated_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="missing required columns: average_traffic_volume"):
        C.check_rows(cells_of(spark, tmp_path, "day_type,record_count\nWeekday,1\n"), C.DAY_TYPE_SUMMARY, MALFORMED)
    with pytest.raises(ValueError, match="duplicate column names"):
        cells_of(spark, tmp_path, "a,b,a\n1,2,3\n")


def test_keys_and_extra_columns(spark, tmp_path):
    text = "extra," + HIGH_HEADER + "x,,1,1,5.0\nx,A,1,1,5.0\nx,A,2,1,5.0\nx,B,2,1,100.5\nx,C,2,-1,5\n"
    checked = C.check_rows(cells_of(spark, tmp_path, text), C.HIGH_CONGESTION, MALFORMED)
    found = {(i, c): n for i, c, n, _ in values(C.issue_report(checked))}
    assert found == {
        ("empty key", "corridor"): 1,
        ("duplicate key", "corridor"): 2,
        ("out of range", "high_congestion_percentage"): 1,
        ("out of range", "high_congestion_count"): 1,
    }
    assert C.good_rows(checked, C.HIGH_CONGESTION).count() == 0
    assert C.bad_rows(checked).count() == 5


def test_temporal_rules(spark, tmp_path):
    text = DAY_HEADER + "8,1,1.0,1.0,1.0,5.0\n1,1,NaN,1.0,1.0,5.0\n2,,1.0,1.0,1.0,5.0\n3,1,1.0,1.0,1.0,5.0\n"
    assert issues_of(spark, tmp_path, C.DAY_OF_WEEK_SUMMARY, text) == {
        ("out of range", "day_of_week"),
        ("non-finite number", "average_traffic_volume"),
        ("incomplete", "record_count"),
    }


def test_strict_rows_fail_or_give_types(spark, tmp_path):
    good = C.strict_rows(cells_of(spark, tmp_path, HIGH_HEADER + "A,1,1,5.5\n"), C.HIGH_CONGESTION, MALFORMED)
    assert values(good) == [("A", 1, 1, 5.5)]
    bad = C.strict_rows(cells_of(spark, tmp_path, HIGH_HEADER + "A,x,1,5.5\n", "g.csv"), C.HIGH_CONGESTION, MALFORMED)
    with pytest.raises(PySparkException, match="invalid integer"):
        bad.collect()


# One valid row of own making; every test changes what it is about.
ADVISORY = dict(
    zip(
        C.ADVISORY_ROWS.columns,
        ["2019-07-08", "North | Mill", "Medium", "true", "False", "Windy", "Yes", "Moderate", "watch", "two teams", "by the canal", "one lane"],
    )
)


def advisories(spark, *changes):
    rows = [{**ADVISORY, **change} for change in changes]
    return spark.createDataFrame([tuple(row.values()) for row in rows], ", ".join(f"{name} string" for name in ADVISORY))


@pytest.mark.parametrize(
    "change, issue",
    [
        ({"date": "not-a-date"}, ("invalid date", "date")),
        ({"date": "2024-1-1"}, ("invalid date", "date")),
        ({"holiday_flag": ""}, ("incomplete", "holiday_flag")),
        ({"holiday_flag": "1"}, ("invalid boolean", "holiday_flag")),
        ({"roadwork": "Maybe"}, ("unsupported value", "roadwork")),
        ({"congestion_class": "Severe"}, ("unsupported value", "congestion_class")),
    ],
)
def test_advisory_rows(spark, change, issue):
    checked = C.check_rows(advisories(spark, {}, change, {"festival_flag": "true"}), C.ADVISORY_ROWS)
    assert [(i, c) for i, c, _, _ in values(C.issue_report(checked))] == [issue]
    assert C.good_rows(checked, C.ADVISORY_ROWS).count() == 2


def test_context_counts_and_conflicts(spark):
    days = [
        {"congestion_class": "Low", "festival_flag": "False", "roadwork": "No", "weather": "Fog"},
        {"congestion_class": "High", "holiday_flag": "True", "weather": "Rain", "date": "2019-07-20"},
        {"congestion_class": "High", "holiday_flag": "True", "weather": "Rain", "date": "2019-07-11"},
    ]
    typed = C.good_rows(C.check_rows(advisories(spark, *days), C.ADVISORY_ROWS), C.ADVISORY_ROWS)
    row = reject_conflicts(corridor_rollup(typed)).first()
    assert (row.festival, row.holiday, row.roadwork, row.rain_or_fog, row.record_count) == (2, 2, 2, 3, 3)
    assert sorted(a.congestion_class for a in row.congestion_actions) == ["High", "Low"]
    assert (str(row.date_start), str(row.date_end)) == ("2019-07-08", "2019-07-20")

    clash = C.good_rows(C.check_rows(advisories(spark, {}, {"diversion_action": "over the hill"}), C.ADVISORY_ROWS), C.ADVISORY_ROWS)
    assert values(corridor_rollup(clash), "conflicts") == [(["Medium"],)]
    with pytest.raises(PySparkException, match=r"Conflicting actions for Medium in corridor North \| Mill"):
        reject_conflicts(corridor_rollup(clash)).collect()

def test_rules_and_notes(rows):
    data = rows("congestion_class string", ("Low",), ("High",), ("Other",), (None,))
    assert values(apply_rules(data), "advisory_level") == [("Normal",), ("High",), (None,), (None,)]
    context = rows(
        "festival_flag boolean, holiday_flag boolean, roadwork string, weather string",
        (True, None, "Yes", "Fog"),
        (None, False, None, None),
    )
    notes = [r[0] for r in values(add_context_notes(context), "context_notes")]
    assert notes == ["; ".join(S.CONTEXT_NOTES[n] for n in ("festival", "roadwork", "weather")), ""]


# -------------------------------------------------------------- raw file findings
def test_raw_file_findings(spark, tmp_path):
    text = "timestamp,toll_plaza,vehicle_count\n2024-01-01 06:00:00,A,1\n2024-01-01 06:00:00,A,1\nsoon, ,2\nsoon,B,3\n"
    cells = cells_of(spark, tmp_path, text).drop(MALFORMED)
    found = {(c, n): (k, d) for c, n, k, d in values(C.raw_file_findings(cells, C.RAW_FILES["toll.csv"]))}
    assert found == {
        ("missing column", "transaction_count"): (None, None),
        ("missing values", "toll_plaza"): (1, None),
        ("duplicate rows", ""): (1, None),
        ("invalid time", "timestamp"): (2, "soon"),
    }
    assert values(C.raw_file_profile(cells, C.RAW_FILES["toll.csv"]), "row_count", "minimum_time") == [
        (4, "2024-01-01 06:00:00")
    ]


def test_registry_goes_on_after_an_absent_file(spark, tmp_path):
    cells = cells_of(spark, tmp_path, "timestamp,junction,signal_status\n2024-01-01 00:00:00,J,Green\n").drop(MALFORMED)
    found = values(C.registry_findings(spark, {"signal.csv": cells}), "dataset", "check")
    assert sorted(found) == [(n, "missing file") for n in ("festival_calendar.csv", "toll.csv", "traffic.csv")]


# ------------------------------------------------------------------------- gates
def passed(checks):
    return dict(values(checks, "name", "passed"))


def test_simple_gates(rows):
    data = rows("corridor string, congestion_class string", ("a", "Low"), ("b", "High"), ("b", None))
    assert passed(G.rows_kept(data, data.limit(2))) == {"rows_kept": False}
    assert passed(G.expected_size(data, 3, 2)) == {"expected_rows": True, "expected_corridors": True}
    assert passed(G.target_domain(data)) == {"every_class_present": False, "no_other_value": False}
    with pytest.raises(PySparkException, match="Check failed: rows_kept"):
        G.require(G.rows_kept(data, data.limit(2))).collect()
    assert G.require(G.rows_kept(data, data)).count() == 1


def test_advisory_gate_reports_each_broken_rule(rows):
    source = rows(
        "date string, corridor string, area string, road_intersection string, congestion_class string, festival_flag boolean, "
        "festival_name string, holiday_flag boolean, weather string, roadwork string",
        ("d1", "a", "x", "y", "Low", True, "F", True, "Rain", "Yes"),
        ("d2", "a", "x", "y", "High", False, None, False, "Clear", "No"),
        ("d3", "a", "x", "y", "High", None, None, None, None, None),
    )
    good = advise(source)
    assert all(passed(G.advisory_checks(source, good, ["date", "corridor"])).values())
    broken = good.withColumn("context_notes", F.lit("")).withColumn("advisory_level", F.lit("Normal"))
    result = passed(G.advisory_checks(source.limit(2), broken.withColumn("date", F.lit("d")), ["date", "corridor"], False))
    assert {name for name, ok in result.items() if ok} == {
        "no_null_congestion_class",
        "valid_advisory_levels",
        "one_level_per_congestion_class",
        "expected_output_columns",
    }


def test_chart_inputs(rows):
    table = rows("congestion_class string", ("Low",))
    assert passed(G.chart_inputs({"integrated": table, "advisory": table})) == {"integrated": True, "advisory": False}
    assert passed(G.chart_inputs({"integrated": table.limit(0)})) == {"integrated": False}
