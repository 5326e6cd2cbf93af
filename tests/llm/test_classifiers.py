"""Quality, toxicity, language and mixing: held-out accuracy, folds and awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from roadgrain.llm import common, langid, mixing, quality, toxicity
from roadgrain.llm.queries import op2_quality, op4_language, op5_mixing, op10_toxicity
from tests.llm.conftest import is_held_out, rows_of

MIDDLE = "/root/testdata/sf0.01"


def labels(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def ranked_right(rows, truth):
    """Share of (label 1, label 0) pairs that the score puts in order."""
    one = [r["score"] for r in rows if truth(r) == 1]
    zero = [r["score"] for r in rows if truth(r) == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])


@pytest.mark.parametrize("query, label, least", [(op2_quality, "quality", 0.85), (op10_toxicity, "toxic", 0.7)])
def test_held_out_ranking(spark, query, label, least):
    known = labels(spark, MIDDLE)
    rows = query(spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    threshold = 0.3 if label == "quality" else 0.5
    assert all(r["predicted"] == int(r["score"] >= threshold) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert ranked_right(held, lambda r: known[r["doc_id"]][label]) >= least


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_are_never_used(spark, module, label):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    known = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    turned = known.withColumn(label, F.when(common.held_out(), 1 - F.col(label)).otherwise(F.col(label)).cast("int"))
    assert module.fit(documents, known) == module.fit(documents, turned)


@pytest.mark.parametrize("module, empty", [(quality, 0.5), (toxicity, 0.0)])
def test_nothing_to_learn_and_awkward_texts(spark, documents, module, empty):
    rows = documents((1, None), (2, ""), (3, "a " * 100_000), (3, "a " * 100_000), (None, "b")).withColumn("score_", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, 1, 1), (3, 1, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in module.scored(rows, module.fit(rows, none)).collect()} == {empty}
    assert {r["score"] for r in module.scored(rows, module.fit(rows, one)).collect()} <= {0.0, 0.5, 1.0}
    both = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    texts = documents(*((i, ("good prose here " if i % 2 else "bad ### *** ") * 9) for i in range(40)), (41, None), (42, ""))
    scored = module.scored(texts, module.fit(texts, both)).collect()
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == 42
    assert module.scored(documents(), module.fit(texts, both)).count() == 0


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_labelled_null_and_empty_texts_beside_both_classes(spark, documents, module, label):
    awkward = {i: None if i % 3 else "" for i in range(40, 60)}
    assert {(t, i % 2) for i, t in awkward.items() if not is_held_out(i)} == {(None, 0), (None, 1), ("", 0), ("", 1)}
    texts = documents(*((i, ("good prose here " if i % 2 else "bad ### *** ") * 9) for i in range(40)), *awkward.items())
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], f"doc_id long, {label} int")
    scored = {r["doc_id"]: r["score"] for r in module.scored(texts, module.fit(texts, known)).collect()}
    assert len(scored) == 60 and all(0 <= score <= 1 for score in scored.values())
    assert len({scored[i] for i in awkward}) == 1


def test_language_held_out_accuracy(spark):
    rows = op4_language(spark, MIDDLE).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert {r["lang_pred"] for r in rows} <= {*truth.values(), "und"}


def test_language_awkward_rows(spark, documents):
    learned = documents(*((i, "the thing of other " * 3) for i in range(40))).unionByName(
        documents(*((i, "der die einer schön " * 3) for i in range(100, 140)), lang="de")
    )
    model = langid.fit(learned)
    rows = documents((1, None), (2, ""), (3, "123 !?"), (4, "schön"), (5, "of the"), (6, "x" * 300_000), (None, "die der"))
    found = {r["doc_id"]: r for r in langid.predicted(rows, model).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[1]["score"] == 0
    assert found[4]["lang_pred"] == "de" and found[5]["lang_pred"] == "en" and found[None]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in langid.predicted(rows, langid.fit(documents())).collect()} == {"und"}
    assert langid.predicted(documents(), model).count() == 0


def test_presence_is_the_set_of_ngrams_whatever_the_block():
    text = "".join(random.Random(1).choice("abcé d1") for _ in range(5000))
    assert np.array_equal(langid.presence(text), langid.presence(text, block=97))
    assert langid.presence("12 3") is None
    assert np.array_equal(langid.presence("AB"), langid.presence("ab"))


def test_rates_meet_the_targets(spark, sf_dir):
    rows = op5_mixing(spark, MIDDLE).collect()
    total = sum(r["n_tokens"] * r["rate"] for r in rows)
    for domain, share in {"clean": 0.90, "poor": 0.07, "toxic": 0.03}.items():
        assert abs(sum(r["n_tokens"] * r["rate"] * r[f"p_{domain}"] for r in rows) / total - share) < 1e-3
    assert all(r["rate"] >= 0 and abs(sum(r[f"p_{d}"] for d in ("clean", "poor", "toxic")) - 1) < 1e-9 for r in rows)
    assert all(int(r["rate"]) <= r["n_copies"] <= int(r["rate"]) + 1 for r in rows)


def test_least_squares_against_a_plain_solver(spark):
    draw = np.random.default_rng(3)
    p = draw.dirichlet([1, 1, 1], 300)
    t = draw.integers(1, 100, 300)
    member = spark.createDataFrame([(int(n), [float(x) for x in row]) for n, row in zip(t, p)], "n_tokens long, p array<double>")
    weights = {"a": 0.2, "b": 0.5, "c": 0.3}
    rates = mixing.fit_rates(member, ("a", "b", "c"), weights)
    assert np.allclose(rates.reached, np.array([0.2, 0.5, 0.3]) * t.sum(), rtol=1e-4)
    rate = mixing.replay(p, rates.steps, None)
    assert (rate >= 0).all() and np.allclose((t * rate) @ p, rates.reached)
    capped = mixing.fit_rates(member, ("a", "b", "c"), weights, anchor="b", most=1.0)
    assert mixing.replay(p, capped.steps, 1.0).max() <= 1


def test_mixing_awkward_rows(spark, documents):
    rows = documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")).withColumn("mix_id", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, domain string")
    found, rates = mixing.mix(rows, none, {"clean": 1.0})
    assert rates.names == ("all",) and rows_of(found, "rate") == [(1.0,)] * 5
    assert mixing.mixed(rows, none, {"clean": 1.0}).count() == 5
    assert mixing.mix(documents(), none, {"clean": 1.0})[0].count() == 0


def test_mixed_repeats_rows_by_their_copies(spark, documents):
    texts = [(i, ("fine words only " if i % 2 else "*** ### ***x ") * (5 + i % 7)) for i in range(200)]
    rows = documents(*texts)
    known = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(200)], "doc_id long, domain string")
    found, _ = mixing.mix(rows, known, {"a": 0.8, "b": 0.2})
    copies = {r["doc_id"]: r["n_copies"] for r in found.collect()}
    mixed = mixing.mixed(rows, known, {"a": 0.8, "b": 0.2})
    assert mixed.columns == rows.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}


def test_the_fold_is_the_checksum_of_the_id(spark):
    rows = spark.range(200).select("id", common.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_one_repeated_id_gives_one_row_of_a_sample(spark, documents):
    rows = documents(*((7, f"copy {i}") for i in range(300)), *((i, "other words") for i in range(100, 160)))
    known = rows.select("doc_id", "lang")
    sample, totals = common.bounded(rows, known, "lang", 1000)
    assert sample.count() == sample.select("doc_id").distinct().count() == 61 and totals == {"en": 61}


def test_toxic_wording_is_caught_in_every_language_and_in_new_forms(spark, documents, prose):
    """Made-up insults of two languages, among ordinary words; one language has few labelled texts."""
    draw = random.Random(2)
    vocabulary = {"a": [f"{x}{y}" for x in ("tor", "bel", "min", "sar") for y in ("ano", "eli", "uto", "ira", "ose")]}
    vocabulary["b"] = [f"{x}{y}" for x in ("gru", "pfe", "sch") for y in ("ndig", "rlich", "mmer", "zeit", "stoff")]
    insults = {"a": ["fibbert", "quogly", "zwindle"], "b": ["krazzel", "krazzun", "krazzomi"]}

    def text(lang, toxic):
        words = [draw.choice(vocabulary[lang]) + draw.choice(vocabulary[lang]) for _ in range(draw.randrange(20, 90))]
        for _ in range(draw.randrange(2, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(insults[lang]))
        return " ".join(words)

    rows = [(i, "b" if i % 8 == 0 else "a", int(i % 5 == 1 or i % 40 == 8)) for i in range(1500)]
    texts = documents(*((i, text(lang, toxic)) for i, lang, toxic in rows), (9001, text("b", 0) + " krazzetto krazzi"), (9002, text("b", 0)))
    known = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    scored = {r["doc_id"]: r["score"] for r in toxicity.scored(texts, toxicity.fit(texts, known)).collect()}
    for lang in ("a", "b"):
        held = [(scored[i], toxic) for i, g, toxic in rows if g == lang and is_held_out(i)]
        assert np.mean([s >= 0.5 for s, toxic in held if toxic]) >= 0.9
        assert np.mean([s < 0.5 for s, toxic in held if not toxic]) >= 0.97
    assert scored[9001] > scored[9002]


def test_sixty_languages_are_all_learned(spark, documents):
    draw = random.Random(4)
    whole = None
    for k in range(60):
        letters = "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 6))
        texts = [(100 * k + i, " ".join("".join(draw.choices(letters, k=5)) for _ in range(12))) for i in range(12)]
        whole = documents(*texts, lang=f"l{k}") if whole is None else whole.unionByName(documents(*texts, lang=f"l{k}"))
    model = langid.fit(whole.coalesce(8), per_language=4)
    assert len(model.languages) == 60
