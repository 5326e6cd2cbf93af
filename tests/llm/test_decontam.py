"""Decontamination against a brute-force reading of the rule, and its awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F
from roadgrain.llm import decontam
from roadgrain.llm.queries import op1_decontamination
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(documents, items, size=13):
    """{doc_id: (n_words, n_hit, sorted item ids)} by looking at every place of every window."""
    cut = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = cut(text)
        n = min(size, len(w))
        for at in range(len(w) - n + 1) if w else []:
            windows.setdefault(tuple(w[at : at + n]), set()).add(item)
    out = {}
    for doc_id, text in documents:
        w, hit, own = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if (x := tuple(w[at : at + n])) in windows:
                    hit |= set(range(at, at + n))
                    own |= windows[x]
        out[doc_id] = (len(w), len(hit), sorted(str(i) for i in own if i is not None))
    return out


@pytest.fixture
def benchmark(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id long, text string")


def found(data):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in data.collect()}


def test_random_texts_match_brute_force(documents, benchmark):
    draw = random.Random(5)
    vocabulary = ["the", "of", "Éa", "éa", "İx", "7", "zz", "qu", "an"]
    text = lambda n: "".join(draw.choice(vocabulary) + draw.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    items = [(i, text(draw.choice([1, 3, 12, 13, 14, 30]))) for i in range(12)] + [(3, "The of"), (None, "zz zz zz")]
    rows = []
    for i in range(60):
        pieces = [text(draw.randrange(0, 40))]
        for _ in range(draw.randrange(3)):
            pieces += [draw.choice(items)[1], text(draw.randrange(20))]
        rows.append((i, "".join(pieces)))
    result = found(decontam.contamination(documents(*rows), benchmark(*items)))
    assert result == brute(rows, items)
    assert any(x[1] for x in result.values())


def test_blocks_give_the_same(documents, benchmark, prose):
    rows = [(i, prose(i, 40, 50) + " " + prose(100 + i % 4, 30)) for i in range(12)]
    items = [(i, prose(100 + i, 25)) for i in range(4)]
    whole = found(decontam.contamination(documents(*rows), benchmark(*items)))
    blocks = found(decontam.contamination(documents(*rows), benchmark(*items), block_bytes=3000))
    assert whole == blocks == brute(rows, items)


def test_a_window_may_miss_words(documents, benchmark, prose):
    words = prose(1, 13).split()
    changed = [*words[:4], "other", *words[5:]]
    rows = documents((1, " ".join(changed)), (2, " ".join(words)), (3, "else"))
    assert [r[1] for r in rows_of(decontam.contamination(rows, benchmark((7, " ".join(words)))), "doc_id", "n_hit")] == [0, 13, 0]
    near = decontam.contamination(rows, benchmark((7, " ".join(words))), misses=1)
    assert [r[1] for r in rows_of(near, "doc_id", "n_hit")] == [13, 13, 0]


def test_awkward_rows(documents, benchmark, spark, prose):
    passage = prose(1, 20)
    rows = [(1, None), (2, ""), (3, " ,. "), (4, passage), (4, passage), (5, f"{passage} {prose(9, 30_000)}"), (None, passage)]
    items = benchmark((1, passage), (1, passage), (2, None), (3, ""), (None, "zz yy"))
    result = decontam.contamination(documents(*rows), items)
    assert rows_of(result, "doc_id", "n_words", "n_hit", "contaminated") == sorted(
        [(1, 0, 0, False), (2, 0, 0, False), (3, 0, 0, False), (4, 20, 20, True), (5, 30_020, 20, False), (None, 20, 20, True)],
        key=repr,
    )
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontam.contamination(documents(*rows), empty).collect()} == {0}
    assert decontam.contamination(documents(), items).count() == 0


def test_drop_keeps_columns_and_clean_rows(documents, benchmark, prose):
    rows = documents((1, prose(1, 20)), (2, prose(2, 20)), (3, None), (None, "x")).withColumn("n_words", F.lit(1))
    kept = decontam.drop_contaminated(rows, benchmark((1, prose(1, 20))))
    assert kept.columns == rows.columns
    assert rows_of(kept, "doc_id") == [(2,), (3,), (None,)]


def test_query_has_the_stated_columns(spark, sf_dir):
    result = op1_decontamination(spark, sf_dir)
    assert {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"} <= set(result.columns)
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute(texts, items)
    for r in result.collect():
        n, hit, own = expected[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(own))
        assert r["items_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
