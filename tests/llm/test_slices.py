"""Texts taken together give what they give one by one, and workers give memory back."""

from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa

from roadgrain.llm import common, mixing, tokens

ODD = [None, "", " ", "a", "a a\tb\x0b c  ", "é ü x y", " lead", "A B C " * 30, "tail\n", "x y z, " * 9 + "q", "USA USA 12"]


def test_evidence_of_many_texts_is_that_of_each():
    rng = np.random.default_rng(3)
    table = np.where(rng.random((mixing.BUCKETS, 1)) < 0.5, rng.normal(size=(mixing.BUCKETS, 3)), 0).astype(np.float32)
    classifier = mixing.Classifier(("a", "b", "c"), table)
    for texts in (pa.array(ODD), pa.array(ODD[:3]), pa.array([], pa.string()), pa.array(ODD).slice(4, 5)):
        n, evidence = classifier.evidences(texts, mixing.Buckets(np.flatnonzero(table.any(1))))
        single = [mixing.counted(text, mixing.Buckets()) for text in texts.to_pylist()]
        assert n.tolist() == [pieces for pieces, _ in single]
        assert np.allclose(evidence, np.array([classifier.evidence(own) for _, own in single]).reshape(-1, 3), atol=1e-9)


def test_slices_cover_every_text_once():
    texts = pa.array(ODD)
    for most in (1, 10, 1 << 20):
        assert [i for at, n in common.slices(texts, most) for i in range(at, at + n)] == list(range(len(ODD)))


def test_arrow_gives_memory_back_after_every_batch(spark, monkeypatch):
    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append(1)})()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    data = type("Data", (), {"sparkSession": spark, "mapInArrow": lambda self, function, schema: function})()
    assert list(common.in_arrow(data, lambda batches: iter(batches), "n long")([1, 2])) == [1, 2]
    assert len(calls) == 2


def test_arrow_gives_memory_back_when_no_batch_is_held(spark, monkeypatch):
    made, alive = [], []

    def release(self):
        alive.append(sum(batch() is not None for batch in made))

    def function(batches):
        for _ in batches:
            batch = np.zeros(1)
            made.append(weakref.ref(batch))
            yield batch

    pool = type("Pool", (), {"release_unused": release})()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    data = type("Data", (), {"sparkSession": spark, "mapInArrow": lambda self, function, schema: function})()
    for batch in common.in_arrow(data, function, "n long")(iter(range(3))):
        del batch
    assert alive[-1] == 0 and max(alive) <= 1


KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_long_texts_reach_the_tokenizer_in_small_batches(spark, documents, monkeypatch):
    seen, before, write = [], spark.conf.get(KEY), tokens.write_ids

    def spy(rows, path):
        seen.append(spark.conf.get(KEY))
        write(rows, path)

    monkeypatch.setattr(tokens, "write_ids", spy)
    assert tokens.tokenize(documents((1, "a b"), (2, None))).count() == 2
    assert int(seen[0]) <= 16 << 20 and spark.conf.get(KEY) == before


def test_batches_are_bounded_in_bytes_and_a_lower_setting_stays(spark):
    def sizes(batches):
        for rows in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rows.nbytes])], names=["n"])

    rows = spark.range(48, numPartitions=1).selectExpr("repeat('x', 1 << 20) AS text")
    with common.bounded_batches(spark):
        found = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert len(found) >= 3 and max(found) <= 18 << 20 and sum(found) >= 48 << 20
    held = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, "1048576")
        with common.bounded_batches(spark):
            assert spark.conf.get(KEY) == "1048576"
    finally:
        spark.conf.set(KEY, held)


def test_classified_pieces_are_remembered_in_little_memory(monkeypatch):
    texts = pa.array([" ".join(f"word{i}x{n}," for i in range(500)) for n in range(20)])
    classifier, buckets = mixing.Classifier(("all",)), mixing.Buckets()
    n, _ = classifier.evidences(texts, buckets)
    held = buckets.pieces
    assert n.tolist() == [500] * 20 and not len(buckets) and len(held.known) == 10_000
    assert held.known.nbytes + held.lists.nbytes < 64 * len(held.known)
    monkeypatch.setattr(held, "most", 600)
    for i in range(20):
        assert classifier.evidences(texts.slice(i, 1), buckets)[0].tolist() == [500]
        assert len(held.known) <= 1100


def test_remembered_numbers_are_those_of_each_piece():
    asked = []

    def make(piece):
        asked.append(piece)
        return [len(piece)] * (len(piece) % 3)

    held = common.Remembered(3, pa.string())
    for pieces in (["a", "bb", "a"], ["", "bb"], ["cccc", "dd", "a", "eeeee"], ["a"], []):
        assert held.of(pa.array(pieces, pa.string()), make).to_pylist() == [[len(p)] * (len(p) % 3) for p in pieces]
    assert asked == ["a", "bb", "", "cccc", "dd", "eeeee"] and len(held.known) <= 4


def test_stages_of_the_pipeline_bound_batches_of_what_runs_later(spark, documents):
    import corpus_pipeline

    held = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, str(64 << 20))
        corpus_pipeline.token_stage(spark, documents((1, "a b")), "")
        assert int(spark.conf.get(KEY)) <= 4 << 20
    finally:
        spark.conf.set(KEY, held)
