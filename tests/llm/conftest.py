"""Small tables with awkward rows for the training-data operators."""

from __future__ import annotations

import random
import zlib

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture
def documents(spark):
    """documents(*(doc_id, text)) -> DataFrame with all columns of documents."""

    def make(*rows, **more):
        full = [(i, t, more.get("lang", "en"), f"src{(i or 0) % 3}", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, DDL)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n words) -> text of made-up words, the same for the same seed."""

    def make(seed, n, words=4000):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(words)}x" for _ in range(n))

    return make


def rows_of(data, *columns):
    return sorted((tuple(r) for r in data.select(*columns).collect()), key=repr)
