"""I-Match fingerprints: hashes of a text's terms inside a band of document frequency.

Document frequencies are exact and cover all documents. Only terms in at least ``LEAST`` of
all documents can be in the lexicon, and such a term is in at least that share of the documents of
some block, so blocks report only those (a first pass), and these few are counted exactly
(a second pass). The lexicon therefore has at most (mean distinct terms of a document) / LEAST
terms, whatever the corpus; it is sent to the tasks, and no word is ever shuffled.
What blocks report has no such bound: a block of fewer than 1 / LEAST documents reports all its
terms, and their union goes to the driver and to the tasks of the second pass.

A fingerprint has the hash of all terms of the band and one hash for each of several
randomised subsets of the lexicon. The subsets have several densities, so that for texts of
any length some level of them meets about one term of a text each; the share of equal hashes on
that level is the likeness of two texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from roadgrain.llm.common import WORD_BYTES, in_arrow, staged

#: The band: a term is kept if it is in this share of the documents, and in no more than MOST.
LEAST, MOST = 1 / 1000, 1 / 10
#: Subsets: for each level, a term is in a subset with probability 2 ** -level.
LEVELS, PER_LEVEL = (1, 3, 5, 7, 9), 12
BLOCK_TERMS = 1_500_000
REMEMBERED = 300_000


def terms(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "replace").translate(WORD_BYTES).split())


def _report(counts: Counter, documents: int, least: float) -> pa.RecordBatch:
    own = [(xxhash.xxh3_64_intdigest(t), n) for t, n in counts.items() if n >= least * documents]
    hashes = np.array([h for h, _ in own], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array([n for _, n in own], pa.int64())], names=["h", "n"])


def lexicon(documents: DataFrame, least: float = LEAST, most: float = MOST) -> np.ndarray:
    """Sorted hashes of the terms whose share of all documents lies in [least, most]."""
    texts = documents.select("text")

    def first(batches):
        counts, seen = Counter(), 0
        for rows in batches:
            for text in rows.column(0):
                counts.update(terms(text.as_py()))
                seen += 1
                if len(counts) > BLOCK_TERMS:
                    yield _report(counts, seen, least)
                    counts, seen = Counter(), 0
        if counts:
            yield _report(counts, seen, least)

    total = texts.count()
    few = in_arrow(texts, first, "h long, n long").groupBy("h").agg(F.count("*").alias("blocks"))
    wanted = np.sort(np.array([r["h"] for r in few.toLocalIterator()], np.int64))
    if not len(wanted):
        return wanted

    def second(batches):
        counts, index = np.zeros(len(wanted), np.int64), _Index(wanted)
        for rows in batches:
            for text in rows.column(0):
                own = [i for i in map(index.__getitem__, terms(text.as_py())) if i >= 0]
                counts[np.unique(own).astype(int)] += 1  # two terms may share a hash
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[at]), pa.array(counts[at])], names=["h", "n"])

    exact = in_arrow(texts, second, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    band = exact.where((F.col("n") >= least * total) & (F.col("n") <= max(1, most * total))).select("h")
    return np.sort(np.array([r["h"] for r in band.toLocalIterator()], np.int64))


class _Index(dict):
    """Place of a term in the sorted hashes, or -1."""

    def __init__(self, hashes: np.ndarray):
        self.places = {h: i for i, h in enumerate(hashes.tolist())}

    def __missing__(self, term: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = xxhash.xxh3_64_intdigest(term)
        place = self[term] = self.places.get(h - (1 << 64) if h >> 63 else h, -1)
        return place


class Fingerprints:
    """Fingerprints of texts under one lexicon; one object per task."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.index = hashes, _Index(hashes)
        self.inside = []
        for level in LEVELS:
            for k in range(PER_LEVEL):
                mixed = hashes.view(np.uint64) * np.uint64(2 * (level * 31 + k) + 0x9E3779B97F4A7C15)
                self.inside.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - level) == 0)
        self.inside = np.array(self.inside).reshape(len(LEVELS) * PER_LEVEL, -1)

    def of(self, text: str | None) -> list[str]:
        """Hash of all terms, then of each subset; empty where a subset has none of the terms.

        A text without a term of the band is known by all its terms, without any by itself.
        """
        own = terms(text)
        at = np.unique([i for i in map(self.index.__getitem__, own) if i >= 0]).astype(int)
        if len(at):
            whole = xxhash.xxh3_64_hexdigest(self.hashes[at].tobytes())
        else:
            whole = xxhash.xxh3_64_hexdigest(b" ".join(sorted(own)) if own else (text or "").encode("utf-8", "replace"))
        parts = []
        for row in self.inside[:, at]:
            some = at[row]
            parts.append(xxhash.xxh3_64_hexdigest(self.hashes[some].tobytes())[:4] if len(some) else "")
        return [whole, *parts]


def likeness(one: list[str], other: list[str]) -> float:
    """Share of equal hashes among those that either has, on the level where about half are empty.

    1 for equal fingerprints, 0 for different ones without a term of the band.
    """
    if one == other:
        return 1.0
    best = None
    for at in range(1, 1 + len(LEVELS) * PER_LEVEL, PER_LEVEL):
        both = [(a, b) for a, b in zip(one[at : at + PER_LEVEL], other[at : at + PER_LEVEL]) if a or b]
        if both and (best is None or abs(2 * len(both) - PER_LEVEL) <= best[0]):
            best = abs(2 * len(both) - PER_LEVEL), sum(a == b for a, b in both) / len(both)
    return best[1] if best else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, role string, text string"
)


def fingerprinted(documents: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Per row: n_chars, the fingerprint, and its likeness to the edited text's and to the next document's.

    Documents are in ascending order of doc_id (null first, equal ids by text), the one
    after the last is the first. They are dealt by ranges of doc_id; where a range ends, its
    last text and the first of the next range, one of each per range, are put together
    afterwards. Null counts as empty. A single document follows itself. An empty table gives no rows.
    """
    hashes = lexicon(documents, least, most)

    def row(made, doc_id, text, own, following, other, part):
        new = edited(text, following)
        changed = made.of(new)
        return (
            doc_id, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), "-".join(own),
            "-".join(changed), likeness(own, changed), likeness(own, other), part, "done", None,
        )

    def walk(batches):
        made, part, held, out = Fingerprints(hashes), TaskContext.get().partitionId(), None, []
        for rows in batches:
            for doc_id, text in zip(rows.column(0), rows.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                own = made.of(text)
                if held is None:
                    out.append((doc_id, None, None, None, None, None, None, part, "first", text))
                else:
                    out.append(row(made, *held, text, own, part))
                held = (doc_id, text, own)
            if len(out) > 1000:
                yield _batch(out)
                out = []
        if held is not None:
            out.append((held[0], None, None, None, None, None, None, part, "last", held[1]))
        if out:
            yield _batch(out)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    walked = staged(in_arrow(ordered, walk, _ROWS), "fingerprints")

    # One first and one last text for each range.
    firsts = walked.where("role = 'first'")
    following = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"))
    heads = firsts.select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    ends = (
        walked.where("role = 'last'").select("doc_id", "text", "part").join(following, "part").join(heads, "next")
    )

    def close(batches):
        made = Fingerprints(hashes)
        for rows in batches:
            out = [
                row(made, doc_id, text, made.of(text), other, made.of(other), part)
                for doc_id, text, other, part in zip(*(c.to_pylist() for c in rows.columns))
            ]
            yield _batch(out)

    closed = in_arrow(ends.select("doc_id", "text", "next_text", "part"), close, _ROWS)
    return walked.where("role = 'done'").unionByName(closed).drop("part", "role", "text")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [x.split()[0] for x in _ROWS.split(", ")]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
