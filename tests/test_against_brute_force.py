"""Random inputs against direct computations in Python."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.functions import derive as D
from roadgrain.operators import routes as R, scoring
from roadgrain.operators.split import cutoff_date
from roadgrain.sources.files import fingerprint
from tests.conftest import values


def test_ranking(spark):
    rng = random.Random(3)
    documents = []
    for i in range(300):
        routes = [
            {"distance": rng.choice([1000.0, 1500.0, rng.random() * 9000]), "duration": rng.choice([60.0, 119.0, 600.0 * rng.random()])}
            for _ in range(rng.randint(1, 12))
        ]
        documents.append((i, routes))
    frame = spark.createDataFrame([(i, json.dumps({"code": "Ok", "routes": r})) for i, r in documents], "id int, response string")
    got = {}
    for row in R.rank_routes(R.parse_responses(frame.repartition(7))).collect():
        got[row.id] = [(r.rank, r.route_index, r.status) for r in row.routes]
    for i, routes in documents:
        order = sorted(range(len(routes)), key=lambda k: (routes[k]["duration"] // 60, routes[k]["distance"], k))
        rest = ["Recommended"] + ["Alternative"] * (len(order) - 1) if len(order) > 1 else ["Available Route"]
        assert got[i] == [(n + 1, k + 1, status) for n, (k, status) in enumerate(zip(order, rest))]


def test_duration_text(spark):
    def text(seconds: float) -> str:
        minutes = max(1, round(seconds / 60))
        if seconds <= 0:
            return "0 min"
        if minutes < 60:
            return f"{minutes} min"
        return f"{minutes // 60} hr" + (f" {minutes % 60} min" if minutes % 60 else "")

    rng = random.Random(5)
    cases = [float(n) for n in range(-60, 8000, 30)] + [rng.random() * 1e5 for _ in range(500)]
    frame = spark.createDataFrame([(c, text(c)) for c in cases], "s double, want string")
    assert values(frame.where(D.duration_text(F.col("s")) != F.col("want"))) == []


def test_metrics(spark):
    rng = random.Random(7)
    pairs = [(rng.choice(S.CLASSES), rng.choice(S.CLASSES[:2])) for _ in range(500)]
    frame = spark.createDataFrame(pairs, "actual_congestion_class string, predicted_congestion_class string")
    per_class = {c: rest for _, c, *rest in values(scoring.class_metrics(scoring.confusion_matrix(frame)))}
    weighted = dict(values(scoring.weighted_metrics(scoring.confusion_matrix(frame))))
    total = {"p": 0.0, "r": 0.0, "f": 0.0}
    for c in S.CLASSES:
        hit = sum(a == p == c for a, p in pairs)
        said, support = sum(p == c for _, p in pairs), sum(a == c for a, _ in pairs)
        precision, recall = hit / said if said else 0.0, hit / support
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        assert per_class[c] == pytest.approx([precision, recall, f1, support])
        for key, value in zip(total, (precision, recall, f1)):
            total[key] += value * support / len(pairs)
    assert weighted["Accuracy"] == pytest.approx(sum(a == p for a, p in pairs) / len(pairs))
    assert [weighted[n] for n in S.METRIC_NAMES[1:]] == pytest.approx(list(total.values()))


SLOW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.integers(0, 60), min_size=2, max_size=80).filter(lambda d: len(set(d)) > 1))
def test_cutoff(spark, offsets):
    first = dt.date(2023, 1, 1)
    frame = spark.createDataFrame([(first + dt.timedelta(days=n),) for n in offsets], "date date")
    dates = sorted(set(offsets))
    training = max(1, min(len(dates) - 1, int(len(dates) * 0.80)))
    expected = (first + dt.timedelta(days=dates[training - 1]), len(dates), training)
    assert values(cutoff_date(frame)) == [expected]


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["", "a", "n", "v", "a|", None])), min_size=1, max_size=12), st.randoms())
def test_fingerprint(spark, data, shuffler):
    ddl = "a int, b string"
    shuffled = list(data)
    shuffler.shuffle(shuffled)
    same = [fingerprint(spark.createDataFrame(rows, ddl)).first() for rows in (data, shuffled)]
    assert same[0] == same[1]
    longer = fingerprint(spark.createDataFrame([*data, data[0]], ddl)).first()
    assert longer != same[0]
