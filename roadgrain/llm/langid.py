"""Language of a text by string kernels.

The blended-spectrum presence kernel of two texts counts the n-grams (1 to ``LONGEST``
characters, hashed to ``BUCKETS``) that both hold, divided by the geometric mean of their own
numbers. A Nyström approximation on landmark texts and one-versus-rest kernel ridge
regression give each language a weight for each landmark. As the kernel is a product of
presence vectors, landmarks and weights are multiplied once, and batches of texts are scored by one
matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgrain.llm.common import bounded, held_out, in_arrow

BUCKETS = 1 << 15
LONGEST = 4
#: Bounds of the sample: documents of each language, and landmarks in all.
PER_LANGUAGE = 800
LANDMARKS = 400
#: Rows of the sample that many languages share, and the fewest that each of them has.
MOST_ROWS, FEWEST = 40_000, 20
RIDGE = 1e-3
BATCH = 64
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def presence(text: str | None, block: int = 1 << 20) -> np.ndarray | None:
    """Which buckets the n-grams of the letters of a text fall in; None if it has no letter.

    Whatever is not a letter counts as a blank. Long texts are taken in overlapping blocks.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    points = np.r_[np.uint32(32), points, np.uint32(32)].astype(np.uint32)
    found = np.zeros(BUCKETS, bool)
    for at in range(0, len(points), block):
        gram = np.zeros(len(points[at : at + block + LONGEST - 1]), np.uint32)
        part = points[at : at + block + LONGEST - 1]
        for n in range(LONGEST):
            gram = (gram[: len(part) - n] ^ part[n:]) * np.uint32(0x9E3779B1)
            if not len(gram):
                break
            found[(gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(17)] = True
            gram = gram + np.uint32(n + 1)
    return found


@dataclass(frozen=True)
class Model:
    """Languages and, for each, a weight of each bucket."""

    languages: tuple[str, ...] = ()
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    sharpness: float = 8.0


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model:
    """Learn from text and lang of documents outside the held-out fold; no such rows give an empty model.

    About ``per_language`` documents of each language; with more than ``MOST_ROWS / per_language`` languages
    these share the rows, and each keeps ``FEWEST`` at least, so that none drops out. An id of several rows is
    one document with its smallest lang; null and empty texts and texts without letters teach nothing.
    """
    known = documents.select("doc_id", "lang").where(F.col("lang").isNotNull() & ~held_out())
    each = max(FEWEST, min(per_language, MOST_ROWS // max(1, known.select("lang").distinct().count())))
    sample, _ = bounded(documents, known, "lang", each)

    def cut(batches):
        for rows in batches:
            vectors = [presence(text.as_py()) for text in rows.column(2)]
            packed = [None if v is None else np.packbits(v).tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(packed, pa.binary())], names=["doc_id", "lang", "v"])

    rows = in_arrow(sample.select(F.col("doc_id").cast("long"), "lang", "text"), cut, "doc_id long, lang string, v binary")
    rows = rows.collect()
    rows = sorted((r for r in rows if r["v"] is not None), key=lambda r: (hash_id(r["doc_id"]), r["lang"], r["v"]))
    if not rows:
        return Model()
    languages = tuple(sorted({r["lang"] for r in rows}))
    x = np.unpackbits(np.frombuffer(b"".join(r["v"] for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    x = x.astype(np.float32)
    x /= np.sqrt(x.sum(1, keepdims=True))
    y = np.where(np.array([r["lang"] for r in rows])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    share = (y > 0).mean(0)
    balance = (y > 0) @ (1 / np.maximum(share, 1e-9)) / len(languages)  # languages weigh alike
    z = x[np.linspace(0, len(x) - 1, min(landmarks, len(x))).astype(int)]
    k_nm, k_mm = (x @ z.T).astype(float), (z @ z.T).astype(float)
    left = (k_nm * balance[:, None]).T @ k_nm + RIDGE * len(x) * k_mm + 1e-6 * np.eye(len(z))
    alpha = np.linalg.solve(left, (k_nm * balance[:, None]).T @ y)
    return Model(languages, (z.T.astype(float) @ alpha).astype(np.float32))


def hash_id(value: int) -> int:
    """A fixed shuffle of ids, so that landmarks are spread over all languages."""
    return (value * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 61)


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every text.

    Null texts and texts without a letter, or without anything learned, get ``und`` with score
    0. Ties go to the first language by name. Only doc_id and text are read.
    """
    languages, weights, sharpness = list(model.languages), model.weights, model.sharpness

    def batch(vectors: list) -> tuple[list, list]:
        have = [i for i, v in enumerate(vectors) if v is not None]
        names, scores = [UNKNOWN] * len(vectors), [0.0] * len(vectors)
        if have and languages:
            x = np.array([vectors[i] for i in have], np.float32)
            margin = (x @ weights) / np.sqrt(x.sum(1, keepdims=True))
            odds = np.exp(sharpness * (margin - margin.max(1, keepdims=True)))
            odds /= odds.sum(1, keepdims=True)
            for i, best, row in zip(have, margin.argmax(1), odds):
                names[i], scores[i] = languages[best], float(min(1.0, row[best]))
        return names, scores

    def predict(batches):
        for rows in batches:
            names, scores = [], []
            for at in range(0, rows.num_rows, BATCH):
                some = batch([presence(t.as_py()) for t in rows.column(2).slice(at, BATCH)])
                names += some[0]
                scores += some[1]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return in_arrow(rows, predict, "doc_id long, held_out boolean, lang_pred string, score double")
