"""Near-duplicates against all pairs on small tables: chains, hubs, copies and awkward rows."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from roadgrain.llm import neardup
from tests.llm.conftest import rows_of


def brute(rows, percent=75):
    """{doc_id: (set size, component)} by comparing all pairs of sets of word tuples."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, parent = {}, {}
    for i, text in rows:
        for c in "\t\n\x0b\x0c\r":
            text = (text or "").replace(c, " ")
        w = [x for x in text.translate(lower).split(" ") if x]
        n = min(5, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(data):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(data).collect()}


def edit(text, share, seed):
    draw, words = random.Random(seed), text.split()
    for _ in range(max(1, int(share * len(words)))):
        words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
    return " ".join(words)


def test_families_match_all_pairs(documents, prose):
    rows = []
    for family in range(12):
        base = prose(family, 120)
        rows += [(100 * family + 50, base), (100 * family + 3, base.upper()), (100 * family + 99, edit(base, 0.02, 1))]
        rows += [(100 * family + k, edit(base, 0.01 * (k % 6), k)) for k in range(10, 20)]
    rows += [(5000 + k, prose(500 + k, 30)) for k in range(60)]
    assert result(documents(*rows)) == brute(rows)


def test_a_chain_is_one_component(documents, prose):
    words, rows = prose(3, 200).split(), []
    for k in range(12):
        rows.append((20 - k, " ".join(words[6 * k : 6 * k + 100])))
    expected = brute(rows)
    assert {c for _, c in expected.values()} == {9}
    assert result(documents(*rows)) == expected


def test_a_hub_with_distant_copies_larger_than_a_run(documents, prose, monkeypatch):
    monkeypatch.setattr(neardup, "RUN", 40)
    base = prose(1, 300)
    rows = [(1000, base)] + [(k, edit(base, 0.025, k)) for k in range(150)]
    expected = brute(rows)
    assert result(documents(*rows)) == expected
    assert len({c for _, c in expected.values()}) < 10


@pytest.mark.parametrize("seed, pack", [(1, 512), (2, 512), (3, 7)])
def test_links_among_many_closer_looking_strangers(documents, prose, monkeypatch, seed, pack):
    """Pairs just above the threshold in a region of texts just below it: no best-partner list holds them all."""
    monkeypatch.setattr(neardup, "PACK", pack)
    base, rows = prose(seed, 300), []
    for k in range(60):
        own = edit(base, 0.02, 1000 * seed + k)
        rows += [(2 * k, own), (2 * k + 1, edit(own, 0.028, 2000 * seed + k))]
    expected = brute(rows)
    assert len({c for _, c in expected.values()}) > 20
    assert result(documents(*rows)) == expected


def test_border_of_the_threshold(documents):
    # 11 shared of 15 shingles is below three quarters, 12 of 16 is on it.
    words = [f"a{k}" for k in range(18)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:16], "x", "y"]))]  # 12 of 16
    rows += [(11, " ".join(f"b{k}" for k in range(17))), (12, " ".join([*(f"b{k}" for k in range(15)), "x", "y"]))]  # 11 of 15
    assert result(documents(*rows)) == brute(rows)
    assert brute(rows)[2][1] == 1 and brute(rows)[12][1] == 12


def test_awkward_rows(documents, prose):
    long = prose(8, 40_000)
    rows = documents((4, None), (3, ""), (2, " \n"), (1, None), (9, "one two"), (8, "One  TWO"), (7, long), (6, long), (None, long), (6, long))
    found = rows_of(neardup.near_duplicates(rows), "doc_id", "n_shingles", "component_id", "kept")
    n = len(neardup.shingles(long))
    assert found == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (8, 1, 8, True), (9, 1, 8, False)]
        + [(6, n, 6, True)] * 2
        + [(7, n, 6, False), (None, n, None, True)],
        key=repr,
    )
    kept = neardup.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert rows_of(kept, "doc_id") == sorted([(1,), (2,), (3,), (4,), (6,), (8,), (None,)], key=repr)
    assert neardup.near_duplicates(documents()).count() == 0


def test_words_are_parted_by_ascii_space_only():
    assert len(neardup.shingles("a b c d e f")) == 1
    assert len(neardup.shingles("a\x0bb c d e f")) == 2
    assert np.array_equal(neardup.shingles("A b C d E"), neardup.shingles("a b c d e"))
    assert not np.array_equal(neardup.shingles("É b c d e"), neardup.shingles("é b c d e"))


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 4), (4, 3), (3, 2), (9, 8), (8, 7), (2, 9)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 50)]])
def test_components(spark, edges):
    links = spark.createDataFrame(edges, "a long, b long")
    parent = {}
    for _ in range(60):
        for a, b in edges:
            low = min(parent.get(a, a), parent.get(b, b))
            parent[a] = parent[b] = low
    assert {r["node"]: r["root"] for r in neardup.components(links).collect()} == parent


def test_whole_small_table_against_all_pairs(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(data) == brute([tuple(r) for r in data.select("doc_id", "text").collect()])
