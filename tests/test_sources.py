from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators.shape import filtered, standardise
from roadgrain.plans.runs import integrate
from roadgrain.session import fresh_path, shared_folder
from roadgrain.sources import files, reports, synthetic
from roadgrain.sources.given import calendar, observations, raw_observations
from tests.conftest import SF_DIR, values

RAW_HEADER = ",".join(S.RAW_SCHEMA.names)
RAW_LINE = "2024-01-06,Hebbal,Ballari Road,{volume},30.5,1.2,{level},50,1,2,3,4,5,6,Rain,No"


def raw_file(folder, *lines, header=RAW_HEADER, encoding="utf-8", name="raw.csv"):
    path = folder / name
    path.write_text("\n".join([header, *lines]) + "\n", encoding=encoding)
    return str(path)


# ------------------------------------------------------------------------- scans
@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig"])
def test_raw_scan(spark, tmp_path, encoding):
    path = raw_file(tmp_path, RAW_LINE.format(volume=10, level=60), RAW_LINE.format(volume="n/a", level=""), encoding=encoding)
    data = files.read_raw(spark, path)
    assert data.schema == S.RAW_SCHEMA
    assert values(data, "Date", "Traffic Volume", "Congestion Level") == [
        (dt.date(2024, 1, 6), 10.0, 60.0),
        (dt.date(2024, 1, 6), None, None),
    ]
    assert values(standardise(data), "congestion_class", "day_type") == [("Medium", "Weekend"), (None, "Weekend")]


def test_wrong_header_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="Unexpected columns"):
        files.read_raw(spark, raw_file(tmp_path, header=RAW_HEADER.replace("Date", "Day")))
    with pytest.raises(ValueError, match="Unexpected columns"):
        files.read_raw(spark, raw_file(tmp_path, header="", name="empty.csv"))


def test_wrong_header_in_another_file_of_the_folder_fails(spark, tmp_path):
    raw_file(tmp_path, RAW_LINE.format(volume=1, level=1), name="a.csv")
    raw_file(tmp_path, RAW_LINE.format(volume=1, level=1), header=RAW_HEADER.replace("Average Speed", "Speed"), name="b.csv")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_raw(spark, str(tmp_path)).collect()


def test_cells_keep_malformed_lines_when_few_columns_are_used(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('a,b,c\n1,,3\n1,2\n1,2,3,4\n"x, y",,\n', encoding="utf-8")
    cells = files.read_cells(spark, str(path))
    assert values(cells, "a", files.MALFORMED) == [("1", None), ("1", "1,2"), ("1", "1,2,3,4"), ("x, y", None)]
    assert values(cells, "b") == [("",), ("2",), ("2",), ("",)]


# ------------------------------------------------------------------------- sinks
def test_stage_round_trip_and_partition_pruning(spark, sf_dir, tmp_path):
    data = observations(spark, sf_dir, *S.INTEGRATED_COLUMNS)
    path = files.write_stage(data, str(tmp_path / "stage"), S.INTEGRATED_COLUMNS, by_month=True)
    back = files.read_stage(spark, path, S.INTEGRATED_SCHEMA)
    assert back.columns == S.INTEGRATED_COLUMNS
    assert files.same_content(data, back)
    days = ("1998-03-10", "1998-05-20")
    some = files.read_stage(spark, path, S.INTEGRATED_SCHEMA, date_range=days)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert "GreaterThanOrEqual(date,1998-03-10)" in plan
    assert files.same_content(some, data.where(f"date BETWEEN '{days[0]}' AND '{days[1]}'"))
    narrow = filtered(back, corridors=["ASIA | NATION_2"], festival_flag="True").select("date")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(corridor,ASIA | NATION_2)" in plan and "EqualTo(festival_flag,true)" in plan
    assert "ReadSchema: struct<date:date,corridor:string,festival_flag:boolean>" in plan
    with pytest.raises(ValueError, match="Unexpected columns"):
        files.read_stage(spark, path, S.TAGGED_SCHEMA)


def test_stage_sink_overwrites(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for n in (3, 2):
        files.write_stage(spark.range(n), path, ["id"], "csv")
    assert spark.read.option("header", True).csv(path).count() == 2


def test_fingerprint(rows):
    data = rows("a int, b string", (1, None), (2, ""), (2, ""), (3, "x"))
    assert files.same_content(data, data.repartition(3).orderBy(F.desc("a")))
    assert not files.same_content(data, data.distinct())
    assert not files.same_content(data, data.fillna(""))
    assert not files.same_content(data, data.withColumn("a", F.col("a") + 1))
    assert values(files.fingerprint(data.limit(0))) == [(0, "0", "0")]


def test_catalogue_and_report(spark):
    listed = files.catalogue({"ten": spark.range(10).orderBy(F.desc("id")), "none": spark.range(0)})
    assert values(listed.orderBy("result")) == [
        ("none", "struct<id:bigint>", 0, []),
        ("ten", "struct<id:bigint>", 10, [f'{{"id":{i}}}' for i in (9, 8, 7, 6, 5)]),
    ]
    line = spark.range(1).select(F.lit(3).alias("rows"), F.lit("x").alias("name"))
    assert values(files.report_rows(line, "data")) == [("data", "rows", "3"), ("data", "name", "x")]


def test_integration_from_files(spark, sf_dir, tmp_path):
    raw = raw_observations(spark, sf_dir)
    names = [f"`{n}`" for n in S.RAW_SCHEMA.names]
    raw_path = files.write_stage(raw, str(tmp_path / "raw"), names, "csv")
    calendar_path = files.write_stage(calendar(spark, SF_DIR), str(tmp_path / "cal"), S.CALENDAR_SCHEMA.names, "csv")
    integrated = integrate(spark, raw_path, calendar_path)
    assert integrated.schema.simpleString() == S.INTEGRATED_SCHEMA.simpleString()
    assert files.same_content(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS), integrated)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark) + "/")


# ----------------------------------------------------------------------- reports
REPORT = """TREE BASELINE
Accuracy: 0.919040
Weighted Precision: 0.919577
Weighted Recall: {recall}
{f1}

Confusion Matrix
actual_class,predicted_class,count
High,High,900
High,Medium,46
Low,Low,359

Feature importances
traffic_volume 0.5
"""


def test_reports_in_a_folder(spark, tmp_path):
    texts = {
        "a.txt": REPORT.format(recall="0.919040", f1="F1 Score: 0.9"),
        "b.txt": REPORT.format(recall="1.5", f1="F1: 0.8.1"),
        "c.txt": "nothing here",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    found = reports.read_reports(spark, str(tmp_path))
    problems = {(r, m): (v, p) for r, m, v, p in values(reports.parse_metrics(found))}
    assert problems[("a.txt", "F1")] == (0.9, None) and problems[("a.txt", "Accuracy")] == (0.91904, None)
    assert problems[("b.txt", "Weighted Recall")] == (1.5, "outside [0, 1]")
    assert problems[("b.txt", "F1")] == (None, "not numeric: 0.8.1")
    assert problems[("c.txt", "Accuracy")] == (None, "missing")
    matrix = reports.parse_matrices(found).where("report = 'a.txt'")
    assert values(matrix, "actual_class", "High", "Low", "Medium") == [("High", 900, 0, 46), ("Low", 0, 359, 0), ("Medium", 0, 0, 0)]
    problems = dict(values(reports.parse_matrices(found).where("problem IS NOT NULL"), "report", "problem"))
    assert problems == {"c.txt": "missing"}
    assert sorted({r for r, *_ in values(reports.parse_matrices(found))}) == ["a.txt", "b.txt", "c.txt"]


def test_only_the_first_block_of_a_report_counts(spark):
    block = reports.MATRIX_HEADER + "\nHigh,High,{}\n\n"
    frame = spark.createDataFrame([("two", block.format(5) + block.format(7)), ("bare", reports.MATRIX_HEADER), ("none", None)], "report string, text string")
    found = values(reports.parse_matrices(frame), "report", "actual_class", "High", "problem")
    assert sorted(found, key=repr) == sorted(
        [("two", "High", 5, None), ("two", "Low", 0, None), ("two", "Medium", 0, None), ("bare", None, None, "empty"), ("none", None, None, "missing")],
        key=repr,
    )


def test_the_calendar_covers_the_years_of_the_facts(spark, tmp_path):
    days = spark.sql("SELECT * FROM VALUES (1L, '1985-01-26'), (2L, '2035-08-15'), (3L, '2035-08-16') AS t(id, day)")
    days.selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
        "CAST(day AS timestamp_ntz) AS o_orderdate", "'x' AS o_orderpriority",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    flags = observations(spark, str(tmp_path), "obs_id", "holiday_flag")
    assert sorted(values(flags)) == [(1, True), (2, True), (3, False)]


def test_fingerprint_tells_cells_and_schemas_apart(spark):
    one = spark.createDataFrame([("a|vb", "c")], "x string, y string")
    other = spark.createDataFrame([("a", "b|vc")], "x string, y string")
    assert not files.same_content(one, other)
    assert files.fingerprint(one).first() != files.fingerprint(one.withColumnRenamed("y", "z")).first()
    number = spark.createDataFrame([(1,)], "x int")
    assert files.fingerprint(number).first() != files.fingerprint(number.select(number.x.cast("string"))).first()


def test_specifications(spark):
    good = '{"evaluation": {"Accuracy": 0.9, "Weighted Precision": 1, "Weighted Recall": "0.5", "F1 Score": 2}, "x": 1}'
    frame = spark.createDataFrame([("a", good), ("b", "{}"), ("c", "not json")], "spec string, text string")
    found = {(s, m): p for s, m, _, p in values(reports.parse_spec_metrics(frame))}
    assert found[("a", "F1 Score")] == "outside [0, 1]" and found[("a", "Weighted Recall")] is None
    assert found[("b", "Accuracy")] == found[("c", "Accuracy")] == "missing"

    def spec(**changes):
        shares = {name: 1 / 12 for name in S.FEATURES} | changes
        import json

        return json.dumps({"grouped_feature_importances": {k: v for k, v in shares.items() if v is not None}})

    cases = [("ok", spec()), ("neg", spec(area=-0.1)), ("gone", spec(area=None)), ("text", spec(area="abc"))]
    frame = spark.createDataFrame(cases, "spec string, text string")
    got = {s: (p, t) for s, g, _, p, t in values(reports.parse_importances(frame)) if g == "area"}
    total = "total is not 1"
    assert got == {"ok": (None, None), "neg": ("negative", total), "gone": ("missing", total), "text": ("not numeric", total)}


# ---------------------------------------------------------------- generated data
@pytest.fixture(scope="module")
def half_year(spark):
    limits = spark.sql("SELECT DATE '2024-10-01' AS first, DATE '2025-03-31' AS last")
    festivals = spark.sql("SELECT DATE '2024-10-11' AS date, 'Feast' AS festival_name")
    holidays = spark.sql("SELECT DATE '2024-12-25' AS date")
    return synthetic.synthetic_calendar(synthetic.date_spine(limits), festivals, holidays)


def test_generated_calendar(half_year):
    assert half_year.count() == 182
    days = {str(d): (n, f, h, t) for d, n, f, h, t in values(half_year)}
    assert days["2024-10-11"] == ("Feast", True, True, "Festival Day")
    assert days["2024-10-10"][3] == days["2024-12-24"][3] == "Pre-Holiday"
    assert days["2024-10-12"][3] == "Post-Holiday"
    assert days["2024-11-01"] == ("None", False, False, "Friday Evening")
    assert days["2024-11-04"][3] == "Normal Day"


def test_given_calendar_has_unique_dates(spark):
    dates = calendar(spark, SF_DIR)
    assert dates.count() == dates.select("date").distinct().count()


def test_no_data_files_are_part_of_the_repository():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert not [f for f in os.listdir(root) if f.endswith((".csv", ".parquet"))]
