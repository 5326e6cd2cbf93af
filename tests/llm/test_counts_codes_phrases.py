"""Token counts, vector codes and collocations against the library, brute force and SQL."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadgrain.llm import collocations, tokencount, vectorcode
from roadgrain.llm.queries import QUERIES, SQL
from tests.conftest import SF_DIR
from tests.llm.conftest import rows_of

PATH = public_tokenizers.path(tokencount.VOCABULARY)


# --- SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = connection.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got, *names) == sorted(cursor.fetchall(), key=repr)


# --- token counts


@pytest.fixture(scope="module")
def proof():
    return tokencount.prove(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_proven_strings_are_one_token_each(proof, library):
    assert 49_000 < len(proof.whole) <= library.get_vocab_size()
    sample = random.Random(3).sample(sorted(proof.whole), 3000)
    assert all(len(e.ids) == 1 for e in library.encode_batch(sample, add_special_tokens=False))
    assert " the" in proof.whole and "ÿ" not in proof.whole or len(library.encode("ÿ", add_special_tokens=False).ids) == 1


PIECES = ["a", "B", " ", "  ", "\n", "\t", "7", "'s", "'LL", "é", "日本", " ", "́", "😀", "<|endoftext|>", "<|endof", "\x1c"]
PIECES += ["\x85", " ", "ß", "!", "...", "ǅ", "؀", "\U00020000", "՘", " the", "Ġ", "﻿", "\0", "don't", " hello"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES) | st.text(max_size=4), max_size=14).map("".join))
def test_counts_equal_the_library(proof, library, text):
    counter = tokencount._counters.setdefault(proof, tokencount.Counter(proof))
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_memory_is_bounded_and_long_pieces_are_not_kept(proof, library, monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 50)
    counter = tokencount.Counter(proof)
    texts = [f"qz{i}xk wv{i}" for i in range(200)] + ["zq" * 5000]
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(counter) < len(proof.whole) + 60 and max(map(len, counter.keys() - proof.whole)) <= tokencount.LONGEST


def test_token_counts_of_awkward_rows(documents, library):
    texts = [None, "", " ", "a" * 200_000, "x\ny <|endoftext|> z", "héllo 日本", "same", "same"]
    frame = documents(*[(min(i, 6), t) for i, t in enumerate(texts)]).withColumns({"n_tokens": F.lit("kept"), "extra": F.array(F.lit(1))})
    got = tokencount.counted(frame, limit=3)
    assert got.columns == [*frame.columns, "n_bytes", "n_tokens_", "over_limit"]
    own = [0 if t is None else len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    expected = [(min(i, 6), len((t or "").encode()), n, n > 3, "kept") for i, (t, n) in enumerate(zip(texts, own))]
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens_", "over_limit", "n_tokens") == sorted(expected, key=repr)
    assert tokencount.counted(frame.where("false")).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokencount.prove(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_of_the_table(spark, library):
    texts = dict(rows_of(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id", "text"))
    for doc_id, n_bytes, n_tokens, over in rows_of(QUERIES["op11_token_counts"](spark, SF_DIR), "doc_id", "n_bytes", "n_tokens", "over_limit"):
        text = texts.pop(doc_id) or ""
        assert n_bytes == len(text.encode()) and over == (n_tokens > 512)
        assert n_tokens == len(library.encode(text, add_special_tokens=False).ids)
    assert not texts


# --- vector codes


def plain_codes(vectors, parts, entries, rounds):
    """Codes and errors by looking at every entry, in Python integers."""
    whole = [[math.floor(256 * x) for x in v] for v in vectors]
    d = len(whole[0]) // parts
    cut = [[tuple(v[p * d : (p + 1) * d]) for p in range(parts)] for v in whole]
    book = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in cut:
                members.setdefault(near(p, v[p])[1], []).append(v[p])
            for i, own in members.items():
                book[p][i] = [sum(c) // len(own) for c in zip(*own)]
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    return [("".join(f"{i:02x}" for _, i in own), sum(e for e, _ in own)) for own in found], book


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")

    return make


@pytest.mark.parametrize("n, width, parts, entries, block", [(300, 32, 16, 64, 8), (40, 8, 4, 64, 32), (500, 6, 2, 5, 16), (90, 36, 1, 7, 4)])
def test_codes_equal_brute_force(vectors, n, width, parts, entries, block):
    draw = np.random.default_rng(n)
    values = (draw.normal(size=(n, width)) * draw.choice([0.1, 1, 5], size=(n, 1))).astype(np.float32)
    values[n // 2 :: 3] = values[0]  # copies, and so ties
    values[5] = -values[5]
    rows = [(i, [float(x) for x in v], None if i % 7 == 0 else i % 3) for i, v in enumerate(values)]
    frame = vectors(rows[::-1]).repartition(3)
    found, book = vectorcode.compressed(frame, parts, entries, block=block)
    expected, plain = plain_codes([r[1] for r in rows], parts, entries, 2)
    assert book.tolist() == plain
    assert rows_of(found, "vec_id", "code", "error") == sorted([(r[0], *e) for r, e in zip(rows, expected)], key=repr)
    sums = Counter()
    for r, (_, error) in zip(rows, expected):
        sums[r[2]] += error
    assert rows_of(found, "vec_id", "label_error") == sorted([(r[0], sums[r[2]]) for r in rows], key=repr)


def test_vectors_that_are_left_out_and_odd_ones(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(3, None, 1), (1, [nan] * 4, 1), (2, [1.0, None, 2.0, 3.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1)]
    rows += [(9, [0.5, -0.5, 0.25, 1.0], 2), (9, [0.5, -0.5, 0.25, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 2), (7, [1.0, 2.0], 2)]
    found, book = vectorcode.compressed(vectors(rows), parts=2, entries=2)
    assert book.shape == (2, 1, 1)  # the smallest kept id has two components
    assert rows_of(found, "vec_id") == [(7,)]
    found, book = vectorcode.compressed(vectors([r for r in rows if r[0] != 7]), parts=2, entries=2)
    assert sorted(found.select("vec_id").collect(), key=repr) == [(9,), (9,), (None,)] and book.shape == (2, 2, 2)
    found, book = vectorcode.compressed(vectors([(1, [0.5] * 5, 0), (2, [0.25] * 5, 0)]), parts=4, entries=3)
    assert book.shape == (4, 2, 2) and rows_of(found, "code", "error") == [("00000000", 0), ("01010100", 0)]  # zeros in the last part


def test_empty_tables_clashing_columns_and_large_components(vectors):
    found, book = vectorcode.compressed(vectors([]))
    assert found.count() == 0 and found.columns == ["vec_id", "code", "error", "label_error"] and book.shape[1] == 0
    frame = vectors([(1, [1.0, 2.0], 1)]).withColumns({"code": F.lit(1), "error": F.lit("x"), "Of": F.lit(2)})
    assert rows_of(vectorcode.compressed(frame, parts=2)[0], "code", "error") == [("0000", 0)]
    with pytest.raises(Exception, match="64 bits"):
        vectorcode.compressed(vectors([(1, [1e9, 0.0], 1)]), parts=2)
    with pytest.raises(ValueError, match="256"):
        vectorcode.compressed(vectors([]), entries=257)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_hilbert_keys_walk_through_every_cell(n):
    """Every cell of a grid has its own key, and cells of neighbouring keys touch."""
    bits = 2 if n > 2 else 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = vectorcode.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_no_nearest_entry_is_missing_from_a_shortlist(seed):
    draw = np.random.default_rng(seed)
    points, book = draw.integers(-9, 9, (12, 3)), draw.integers(-12, 12, (9, 3))
    listed = vectorcode.shortlists(points.min(0)[None], points.max(0)[None], book)[0]
    best, _ = vectorcode.nearest(points, book)
    assert listed[best].all()


# --- collocations


def plain_phrases(rows, longest, least, share, best):
    counts, n = Counter(), Counter()
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(upper)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    covered = set()
    for (lang, *words), a in frequent.items():
        for k in range(2, len(words)):
            covered |= {(lang, *words[i : i + k]) for i in range(len(words) - k + 1) if 100 * a >= share * counts[(lang, *words[i : i + k])]}
    found = {}
    for g, a in frequent.items():
        if g not in covered:
            cuts = []
            for k in range(1, len(g) - 1):
                left, right = counts[g[: k + 1]], counts[(g[0], *g[k + 1 :])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -s)
        for lang, own in found.items()
        for i, (s, a, p, left, right) in enumerate(sorted(own)[:best], 1)
    )


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LINES = ["New York city", "a b a b a b", "the end of the line", " x y ", "the end", "É é", "york NEW york"]


@pytest.fixture(scope="module")
def wordy():
    draw = random.Random(5)
    rows = []
    for i in range(150):
        text = ". ".join(draw.choice(LINES) if draw.random() < 0.7 else " ".join(draw.choices("abcde", k=draw.randrange(1, 9))) for _ in range(6))
        rows.append((draw.choice(["en", "de", None, "und"]), text.replace(" e", "\te")))
    return [*rows, ("en", None), ("en", ""), ("fr", " ,;\n"), *[("de", "tail words here")] * 12]


@pytest.mark.parametrize("longest, least, share, best", [(3, 10, 50, 2000), (2, 3, 50, 5), (5, 4, 80, 50), (4, 12, 0, 9), (3, 1, 100, 3)])
def test_phrases_equal_brute_force(spark, wordy, monkeypatch, longest, least, share, best):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    frame = spark.createDataFrame([(7, t, g) for g, t in wordy], "doc_id int, text string, lang string").repartition(5)
    frame = frame.withColumns({"n": F.lit(1), "gram": F.lit("x"), "word": F.lit(0)})
    got = collocations.mined(frame, longest, least, share, best)
    assert got.columns == COLUMNS
    assert rows_of(got, *COLUMNS) == sorted(plain_phrases(wordy, longest, least, share, best), key=repr)


def test_hot_beginnings_and_many_words_change_nothing(spark, wordy, monkeypatch):
    frame = spark.createDataFrame([(t, g) for g, t in wordy], "text string, lang string").repartition(3)
    expected = rows_of(collocations.mined(frame, 4, 5), *COLUMNS)
    pairs = collocations.edges(frame, 4, 0).select("w0", "w1").distinct().collect()
    every = np.unique(collocations._beginning(*(np.array([p[i] for p in pairs], np.int64) for i in (0, 1))))
    monkeypatch.setattr(collocations, "hot_beginnings", lambda *_: every)
    assert rows_of(collocations.mined(frame, 4, 5), *COLUMNS) == expected
    monkeypatch.setattr(collocations, "MOST_SENT", 1)
    assert rows_of(collocations.mined(frame, 4, 5), *COLUMNS) == expected


def test_a_beginning_with_a_third_of_the_edges_is_found(spark):
    texts = [(" ".join(["of the", f"x{i}", f"y{i}", f"z{i}"]), "en") for i in range(600)]
    frame = spark.createDataFrame(texts, "text string, lang string")
    first, second = (np.array([collocations.word_id(b"en", w, 0)], np.int64) for w in (b"of", b"the"))
    assert collocations.hot_beginnings(frame, 3, 0).tolist() == collocations._beginning(first, second).tolist()


def test_shared_ids_lead_to_another_seed(spark, wordy, monkeypatch):
    frame = spark.createDataFrame([(t, g) for g, t in wordy], "text string, lang string")
    expected = rows_of(collocations.mined(frame), *COLUMNS)
    real = collocations.counted.__globals__["lexicon"]
    seen = []

    def clashing(documents, seed, wanted=None):
        seen.append(seed)
        found = real(documents, seed, wanted)
        return found.union(found.where("id <> 0").limit(1).withColumn("word", F.lit("other"))) if seed == 0 else found

    monkeypatch.setattr(collocations, "lexicon", clashing)
    assert rows_of(collocations.mined(frame), *COLUMNS) == expected and seen == [0, 1]


def test_a_task_holds_little_of_its_texts(monkeypatch, prose):
    """At its highest, a task that adds up edges or words holds a few times a chunk, however much text passes by."""
    monkeypatch.setattr(collocations, "in_arrow", lambda data, function, schema: function)
    monkeypatch.setattr(collocations, "_given", lambda documents: documents)
    texts = [prose(i, 500).replace("1x ", "1x. ") for i in range(3000)]
    size, cut = sum(map(len, texts)), collocations.edges(None, 3, 0)
    assert size > 2 * (4 << 20)
    batches = lambda: (pa.record_batch([["en"] * 100, texts[i : i + 100]], ["lang", "text"]) for i in range(0, 3000, 100))
    tracemalloc.start()
    try:
        n = sum(pc.sum(rows.column("n")).as_py() for rows in cut(batches()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 3000 * 500
    assert most < 110e6


def test_texts_reach_python_in_small_batches(spark, wordy, monkeypatch):
    """While tasks run on whole texts the session's batches are bounded; afterwards its setting is as before."""
    key, bounds, real = "spark.sql.execution.arrow.maxBytesPerBatch", [], collocations.staged
    before = spark.conf.get(key)

    def watching(data, name):
        bounds.append(int(spark.conf.get(key).removesuffix("b")))
        return real(data, name)

    monkeypatch.setattr(collocations, "staged", watching)
    frame = spark.createDataFrame([(t, g) for g, t in wordy], "text string, lang string")
    assert collocations.mined(frame).count() > 0
    assert len(bounds) == 2 and max(bounds) <= 4 << 20 and spark.conf.get(key) == before


def test_flows_equal_counts_of_words(spark, wordy):
    """What flows through single words, summed from edges and end corrections, is how often they occur."""
    frame = spark.createDataFrame([(t, g) for g, t in wordy], "text string, lang string")
    flowing = collocations.edges(frame, 3, 0).groupBy("w0").agg(F.sum("n").alias("n"))
    assert rows_of(flowing, "w0", "n") == rows_of(collocations.lexicon(frame, 0).where("id <> 0"), "id", "n")


def test_empty_tables_and_bad_parameters(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert collocations.mined(frame).count() == 0 and collocations.paths(frame).count() == 0
    only = spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], "text string, lang string")
    assert collocations.mined(only).count() == 0
    for bad in ({"longest": 1}, {"share": 101}, {"least": 0}):
        with pytest.raises(ValueError):
            collocations.mined(frame, **bad)


def test_unary_paths(spark):
    passage = "one two three four five six seven eight nine"
    rows = [(passage, "en")] * 10 + [("zero one two three four x", "en")] * 11 + [("one two", "en")] * 3
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = rows_of(collocations.paths(frame, 3, 10), "phrase", "n_words", "n")
    assert got == sorted(
        [
            ("three four five six seven eight nine", 7, 10),
            ("three four x", 3, 11),
            ("zero one two", 3, 11),
            ("one two three four", 4, 21),
        ]
    )
