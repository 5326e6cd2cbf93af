"""Strict reads of folders: files with headers of their own, short and long lines, absent and empty files."""

from __future__ import annotations

import hashlib

import pytest

from roadgrain import schemas as S
from roadgrain.models import spec as specs, trees as T
from roadgrain.operators import contracts as C
from roadgrain.plans import runs
from roadgrain.sources import files
from tests.conftest import values

HEAD = ",".join(C.HIGH_CONGESTION.columns)
BACK = ",".join(["note", *reversed(C.HIGH_CONGESTION.columns)])


@pytest.fixture
def folder(tmp_path):
    def make(**texts):
        for name, text in texts.items():
            target = tmp_path / name.replace("__", "/")
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(text.encode())
        return str(tmp_path)

    return make


def test_each_file_has_its_own_column_order(spark, folder):
    path = folder(a=f"{HEAD}\nn,10,1,10.0\ns,20,2,10.0\n", b=f'{BACK}\n"x, y",50.5,3,6,w\n', c="")
    cells = files.read_cells(spark, path)
    assert sorted(values(cells, *C.HIGH_CONGESTION.columns)) == [("n", "10", "1", "10.0"), ("s", "20", "2", "10.0"), ("w", "6", "3", "50.5")]
    checked = C.check_files(spark, path, C.HIGH_CONGESTION)
    assert sorted(values(C.good_rows(checked, C.HIGH_CONGESTION))) == [("n", 10, 1, 10.0), ("s", 20, 2, 10.0), ("w", 6, 3, 50.5)]
    assert C.bad_rows(checked).count() == 0


def test_short_and_long_lines_and_keys_across_files(spark, folder):
    path = folder(a=f"{HEAD}\nn,10,1,10.0\ns,20,2\n", b=f"{BACK}\nx,50.5,3,6,n\nx,50.5,3,6,w,more\n")
    report = {(r.issue, r.column_name): (r.row_count, r.example) for r in C.issue_report(C.check_files(spark, path, C.HIGH_CONGESTION)).collect()}
    assert report == {
        ("wrong number of fields", ""): (2, "s,20,2"),
        ("incomplete", "high_congestion_percentage"): (1, None),
        ("duplicate key", "corridor"): (2, "n"),
    }


@pytest.mark.parametrize(
    "texts, words",
    [
        ({"a": f"{HEAD}\nn,1,1,1\n", "b": "corridor,total_records\nw,1\n"}, "missing required columns: high_congestion_count"),
        ({"a": f"{HEAD},corridor\nn,1,1,1,n\n"}, "duplicate column names"),
        ({"a": "", "b": ""}, "empty or has no header"),
        ({"a": "\n"}, "no header"),
    ],
)
def test_bad_headers_fail(spark, folder, texts, words):
    with pytest.raises(ValueError, match=words):
        C.check_files(spark, folder(**texts), C.HIGH_CONGESTION)
    with pytest.raises(FileNotFoundError):
        files.read_cells(spark, folder() + "/nowhere")


def test_more_headers_than_allowed(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "MOST_HEADERS", 2)
    with pytest.raises(ValueError, match="different headers"):
        files.read_cells(spark, folder(a="x,y\n1,2\n", b="y,x\n1,2\n", c="z\n1\n"))


def test_a_byte_order_mark_is_no_part_of_a_name(spark, folder):
    path = folder(a="﻿" + f"{HEAD}\nn,1,1,1\n", b=f"{BACK}\nx,1,1,1,w\n")
    assert sorted(values(files.read_cells(spark, path), "corridor")) == [("n",), ("w",)]


REGISTRY = {
    "one.csv": C.RawFile(("time", "place"), ("place",), "time"),
    "two.csv": C.RawFile(("time", "place"), ("place",), "time"),
    "three.csv": C.RawFile(("time",), (), "time"),
    "four.csv": C.RawFile(("time",), (), "time"),
}


def test_registry_run_over_a_folder(spark, folder):
    path = folder(
        **{
            "one.csv": "time,place\n2001-02-03 04:05:06, a\nsoon,\n",
            "two.csv__p1": "time\n2001-02-03 04:05:06\n",
            "two.csv__p2": "time\n2001-02-03 04:05:06\n",
            "three.csv": "",
            "other.csv": "x\n",
        }
    )
    found = {tuple(r) for r in C.folder_findings(spark, path, REGISTRY).select("dataset", "check", "column_name", "row_count", "detail").collect()}
    assert found == {
        ("one.csv", "missing values", "place", 1, None),
        ("one.csv", "invalid time", "time", 1, "soon"),
        ("two.csv", "missing column", "place", None, None),
        ("two.csv", "duplicate rows", "", 1, None),
        ("three.csv", "empty file", "", None, None),
        ("four.csv", "missing file", "", None, None),
    }
    nowhere = C.folder_findings(spark, path + "/nowhere", REGISTRY)
    assert {tuple(r) for r in nowhere.select("dataset", "check").collect()} == {(name, "missing file") for name in REGISTRY}


def test_category_values_keep_commas_apart(spark):
    cells = spark.createDataFrame([("t", "a, b"), ("t", "a"), ("t", "b"), ("t", "a"), ("t", None)], "time string, place string")
    got = {tuple(r) for r in C.category_values(cells, REGISTRY["one.csv"]).collect()}
    assert got == {("place", "a, b", 1), ("place", "a", 2), ("place", "b", 1), ("place", None, 1)}
    assert C.raw_file_profile(cells, REGISTRY["one.csv"]).first().place_values == ["a", "a, b", "b"]
    assert C.category_values(cells.where("false"), REGISTRY["one.csv"]).count() == 0


# ------------------------------------------------------------------ byte digests
def test_digests_are_those_of_the_bytes(spark, folder):
    texts = {"a": "one\n", "b__c": "two", "b__a": "", "x x+y": "ü\r\n"}
    path = folder(**texts)
    found = {r.file: (r.length, r.sha256) for r in files.file_digests(spark, path).collect()}
    digests = {n.replace("__", "/"): hashlib.sha256(t.encode()).hexdigest() for n, t in texts.items() if t}
    assert {name: digest for name, (_, digest) in found.items()} == digests
    assert files.input_digest(spark, path + "/a") == digests["a"]
    lines = "\n".join(sorted(f"{name} {digest}" for name, digest in digests.items()))
    before = files.input_digest(spark, path)
    assert before == hashlib.sha256(lines.encode()).hexdigest()
    folder(a="onf\n")
    assert files.input_digest(spark, path) != before


def test_large_and_absent_files_are_refused(spark, folder):
    path = folder(a="12345", b="1")
    with pytest.raises(ValueError, match="5 bytes, more than the 4"):
        files.file_digests(spark, path, most_bytes=4)
    assert files.file_digests(spark, path, most_bytes=5).count() == 2
    with pytest.raises(FileNotFoundError):
        files.file_digests(spark, path + "/nowhere")


def test_a_changed_byte_refuses_scoring(spark, tmp_path):
    raw, calendar = str(tmp_path / "raw.csv"), str(tmp_path / "calendar.csv")
    names = S.RAW_SCHEMA.names
    with open(raw, "w") as out:
        out.write(",".join(names) + "\n")
        for i in range(60):
            level = (i * 37) % 100
            row = {"Date": f"2021-01-{i % 28 + 1:02d}", "Area Name": f"a{i % 2}", "Road/Intersection Name": f"r{i % 3}"}
            row |= {"Weather Conditions": "Clear", "Roadwork and Construction Activity": "No", "Congestion Level": level}
            out.write(",".join(str(row.get(n, level + i % 5)) for n in names) + "\n")
    with open(calendar, "w") as out:
        out.write(",".join(S.CALENDAR_SCHEMA.names) + "\n2021-01-15,Feast,true,true,x\n")
    model = str(tmp_path / "model")
    trained = runs.train(runs.integrate(spark, raw, calendar), T.decision_tree(2), input_paths=[raw, calendar])
    specs.save_model(spark, trained.model, trained.specification, model)
    data = runs.integrate(spark, raw, calendar)
    assert runs.predict_and_advise(spark, data, model, input_paths=[raw, calendar]).count() == trained.predictions.count()
    with open(calendar, "a") as out:
        out.write("\n")  # no row changes, a byte does
    assert files.same_content(data, runs.integrate(spark, raw, calendar))
    with pytest.raises(ValueError, match="input_files"):
        runs.predict_and_advise(spark, runs.integrate(spark, raw, calendar), model, input_paths=[raw, calendar])
