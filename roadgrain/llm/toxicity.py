"""Toxicity by compression: windows of a text under an ordinary and a toxic zstandard dictionary.

The ordinary dictionary is trained by zstandard on windows of ordinary texts. The toxic one is the
ordinary one with toxic text behind it, where it is found first: what is left of the toxic texts once the words that
ordinary texts use are taken out. A window so costs the same under both unless it repeats toxic
wording, whole words or their beginnings, and the difference of its compressed lengths says how
much of it. Windows are single words with the blanks around them, so that a worker compresses
each different word once; every letter is written as ``SPELLED`` bytes, which makes a repeated
letter worth more than the noise of the format. How large a difference must be to count is
calibrated, and hits, their share, the largest difference and the length give a probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from roadgrain.llm.common import bounded, in_arrow, labelled, logistic, with_scores

#: Bounds of the sample, and of the words that the toxic dictionary takes up.
PER_CLASS = 4_000
TOXIC_WORDS = 8_000
#: Words of the window that an ordinary text gives to its dictionary, and bytes of that dictionary.
SAMPLE_WORDS, ORDINARY_BYTES = 120, 300_000
#: Letters of beginnings; how many times more frequent toxic wording is in toxic texts at least, and
#: the number of units that may pass by chance alone.
BEGINNINGS, RATIO, BY_CHANCE = (4, 6), 15.0, 20.0
SPELLED, LEVEL, SHORTEST_MATCH = 3, 12, 6
THRESHOLDS = (0, 2, 4, 6, 8, 12, 16)
#: Different words whose difference a worker remembers; the memory is emptied when full.
REMEMBERED = 400_000
_MARKS = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"
_LETTERS = [xxhash.xxh3_64_digest(bytes([b]))[:SPELLED] for b in range(256)]


def pieces(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(None, _MARKS).split()


def spelled(words: list[bytes]) -> bytes:
    """The words between blanks, each byte written as a few bytes of its own."""
    return b"".join(map(_LETTERS.__getitem__, b" " + b" ".join(words) + b" "))


def units(word: bytes) -> list[bytes]:
    return [b"=" + word, *[b"%d" % k + word[:k] for k in BEGINNINGS if len(word) >= k]]


def signature(words: list[bytes]) -> int:
    """Smallest hash of three words in a row: mostly the same for near copies, which count as one text."""
    runs = (b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2)))
    return min(map(xxhash.xxh3_64_intdigest, runs)) - (1 << 63)


class Differences(dict):
    """By how much a word's window is shorter under the toxic dictionary than under the ordinary one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = []
        for body in (ordinary, ordinary + toxic):
            content = zstandard.ZstdCompressionDict(body or b"\0" * 16, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters.from_level(
                LEVEL,
                min_match=SHORTEST_MATCH,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            content.precompute_compress(compression_params=parameters)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=content, compression_params=parameters).compress
            )

    def __missing__(self, word: bytes) -> int:
        window = spelled([word])
        ordinary, toxic = self.compressors
        found = self[word] = len(ordinary(window)) - len(toxic(window))
        return found

    def measured(self, text: str | None) -> list[float]:
        """Length, largest difference, and windows above each threshold; a text without words is one empty window."""
        if len(self) > REMEMBERED:
            self.clear()
        found = np.fromiter(map(self.__getitem__, pieces(text) or [b""]), float)
        return [float(len(found)), float(found.max()), *[float((found > t).sum()) for t in THRESHOLDS]]


def features(x: np.ndarray, k: int) -> np.ndarray:
    """The calibrated features for the k-th threshold."""
    n, most, hits = x[:, 0], x[:, 1], x[:, 2 + k]
    return np.c_[np.log1p(hits), hits / n, most, np.log(n)]


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; without weights every text gets ``prior``."""

    prior: float
    ordinary: bytes = b""
    toxic: bytes = b""
    threshold: int = 0
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()

    def scorer(self):
        if not self.weights:
            return lambda text: self.prior
        differences, weights = Differences(self.ordinary, self.toxic), np.array(self.weights)
        centre, scale = np.array(self.centre), np.array(self.scale)

        def score(text):
            x = (features(np.array([differences.measured(text)]), self.threshold)[0] - centre) / scale
            return float(1 / (1 + math.exp(-max(-30.0, min(30.0, weights[0] + x @ weights[1:])))))

        return score


def _log_tail(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Natural logarithm of the largest term of a binomial tail: a or more of a + b texts toxic by chance."""
    n = a + b
    gamma = np.vectorize(math.lgamma, otypes=[float])
    share = min(max(share, 1e-9), 1 - 1e-9)
    return gamma(n + 1) - gamma(a + 1) - gamma(b + 1) + a * math.log(share) + b * math.log(1 - share)


def _toxic(a: np.ndarray, b: np.ndarray, na: int, nb: int, tested: int) -> np.ndarray:
    """Whether units in a of na toxic and b of nb ordinary texts are toxic wording."""
    ratio = ((a + 0.5) / (na + 1)) / ((b + 0.5) / (nb + 1))
    rare = _log_tail(a, b, na / (na + nb)) <= math.log(min(1e-3, BY_CHANCE / max(1, tested))) + 1e-9
    return (ratio >= RATIO) & rare & (a >= max(3.0, 0.005 * na))


def trained(windows: list[bytes]) -> bytes:
    """A dictionary trained on windows, or the windows themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, windows).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(windows)[-ORDINARY_BYTES:]


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learn from labelled rows outside the held-out fold; one class or no rows give a constant score.

    Dictionaries are calibrated on texts of the other half. Near copies count once and are all in
    one half. Null and empty texts are texts without words; repeated labels count as the largest.
    """
    known = labelled(documents, labels, label)
    sample, totals = bounded(documents, known, "y", per_class)
    if len(totals) < 2:
        return Model(prior=float(max(totals, default=0.0)))

    def signed(batches):
        for rows in batches:
            marks = [signature(pieces(text.as_py())) for text in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(marks, pa.int64()), rows.column(1)], names=["y", "mark", "text"])

    marked = in_arrow(sample.select("y", "text"), signed, "y int, mark long, text string")
    single = marked.groupBy("y", "mark").agg(F.min("text").alias("text"))
    texts = single.select("y", "mark", F.pmod("mark", F.lit(2)).alias("half"), "text")

    def cut(batches):
        for rows in batches:
            for y, half, text in zip(rows.column(0), rows.column(2), rows.column(3)):
                own = list({u for w in set(pieces(text.as_py())) for u in units(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([y.as_py()] * len(own), pa.int32()), pa.array([half.as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())],
                    names=["y", "half", "unit"],
                )

    cells = [(y, half) for y in (1, 0) for half in (0, 1)]
    sizes = {(r["y"], r["half"]): r["count"] for r in texts.groupBy("y", "half").count().collect()}
    counts = (
        in_arrow(texts, cut, "y int, half long, unit binary")
        .groupBy("unit")
        .agg(*[F.count(F.when((F.col("y") == y) & (F.col("half") == h), 1)).alias(f"c{y}{h}") for y, h in cells])
    )
    n1, n0 = (max(1, sum(sizes.get((y, h), 0) for h in (0, 1))) for y in (1, 0))
    tested = counts.where("c10 + c11 + c00 + c01 >= 3").count()
    # Words of toxic texts that are toxic wording in some half or begin as toxic wording does; few, and bounded besides.
    apart = F.expr(f"greatest((c10 + 0.5) / (c00 + 0.5), (c11 + 0.5) / (c01 + 0.5)) * {n0 / n1} >= {RATIO / 8}")
    likely = counts.where((F.expr("c10 + c11") >= 3) & apart).orderBy(F.expr("c10 + c11").desc(), "unit").limit(TOXIC_WORDS)
    rows = likely.collect()
    begun = [(bytes(r["unit"]),) for r in rows if bytes(r["unit"][:1]) != b"="]
    starts = F.broadcast(documents.sparkSession.createDataFrame(begun, "start binary"))
    beginnings = F.array(*[F.concat(F.lit(b"%d" % k), F.substring("unit", 2, k)) for k in BEGINNINGS])
    words = counts.where((F.substring("unit", 1, 1) == F.lit(b"=")) & F.expr("c10 + c11 > 0"))
    following = words.select("*", F.explode(beginnings).alias("start")).join(starts, "start", "left_semi").drop("start")
    more = following.orderBy(F.expr("c10 + c11").desc(), "unit").limit(2 * TOXIC_WORDS).collect()
    table = {bytes(r["unit"]): np.array([r[f"c{y}{h}"] for y, h in cells], float) for r in [*rows, *more]}
    unit = sorted(table)
    count = dict(zip(cells, np.array([table[u] for u in unit]).reshape(len(unit), 4).T))

    def window(batches):
        for rows in batches:
            found = []
            for mark, text in zip(rows.column(1), rows.column(3)):
                words = pieces(text.as_py())
                at = mark.as_py() % max(1, len(words) - SAMPLE_WORDS + 1)
                found.append(b" ".join(words[at : at + SAMPLE_WORDS]))
            yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(found, pa.binary())], names=["mark", "half", "words"])

    plain = in_arrow(texts.where("y = 0"), window, "mark long, half long, words binary").orderBy("mark").collect()

    def built(halves: tuple[int, ...]) -> tuple[bytes, bytes]:
        ordinary = trained([spelled(bytes(r["words"]).split()) for r in plain if r["half"] in halves])
        if not unit:
            return ordinary, b""
        a, b = (sum(count[y, h] for h in halves) for y in (1, 0))
        na, nb = (max(1, sum(sizes.get((y, h), 0) for h in halves)) for y in (1, 0))
        kept = {u for u, good in zip(unit, _toxic(a, b, na, nb, tested)) if good}
        words = [(n, u[1:]) for u, n in zip(unit, a) if u[:1] == b"=" and n and not kept.isdisjoint(units(u[1:]))]
        return ordinary, b"".join(spelled([w]) for _, w in sorted(words))  # the most frequent ones nearest to the end

    crossed = {half: built((1 - half,)) for half in (0, 1)}

    def measure(batches):
        differences = {half: Differences(*pair) for half, pair in crossed.items()}
        for rows in batches:
            x = [differences[half.as_py()].measured(text.as_py()) for half, text in zip(rows.column(2), rows.column(3))]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(x, pa.list_(pa.float64()))], names=["y", "mark", "x"])

    measured = in_arrow(texts, measure, "y int, mark long, x array<double>").orderBy("y", "mark").collect()
    x, y = np.array([r["x"] for r in measured]), np.array([r["y"] for r in measured], float)
    weight = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    weight *= len(y) / weight.sum()
    best = None
    for k in range(len(THRESHOLDS)):
        f = features(x, k)
        centre, scale = f.mean(0), f.std(0) + 1e-6
        w = logistic((f - centre) / scale, y, weight, ridge=0.05)
        p = 1 / (1 + np.exp(-np.clip(w[0] + ((f - centre) / scale) @ w[1:], -30, 30)))
        loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        if best is None or loss < best[0]:
            best = (loss, k, centre, scale, w)
    _, k, centre, scale, w = best
    return Model(totals[1] / sum(totals.values()), *built((0, 1)), k, tuple(centre), tuple(scale), tuple(w))


def scored(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns and the probability that a text is toxic.

    Null and empty texts are scored as one empty window; repeated rows get the same score;
    other columns are passed on untouched.
    """
    return with_scores(documents, name, model.scorer)
