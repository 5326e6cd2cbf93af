"""Quality by compression: which of two zstandard dictionaries, of good and of bad texts, fits a text better.

The compressed sizes under both dictionaries, their normalised difference and the length are
turned into a probability by a logistic calibration. Dictionaries and calibration are fitted
on a bounded sample of labelled documents: every sampled document gives one window to the
dictionaries, and is calibrated as a whole text with dictionaries of the other half.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from roadgrain.llm.common import bounded, in_arrow, labelled, logistic, with_scores

#: Bounds of the sample: documents of each class, characters of each one's window.
PER_CLASS = 4_000
WINDOW_CHARS = 2_000
DICTIONARY_BYTES = 32_768
LEVEL = 3
THRESHOLD = 0.3


def dictionary(windows: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the windows themselves where they are too few to train one."""
    windows = [w for w in windows if w]
    try:
        return zstandard.train_dictionary(size, windows, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(windows)[-size:] or b"\0" * 16


class Sizes:
    """Compressed sizes of a text under two dictionaries, as features."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False)
            for d in (good, bad)
        ]

    def __call__(self, text: str | None) -> list[float]:
        data = (text or "").encode("utf-8", "replace")
        good, bad = (len(c.compress(data)) for c in self.compressors)
        n = len(data) + 1
        d, g, b, s = (good - bad) / max(good, bad), good / n, bad / n, math.log(n)
        return [d, g, b, s, d * g, d * d, g * g, d * s, g * s, s * s]


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; without dictionaries every text gets ``prior``."""

    prior: float
    good: bytes = b""
    bad: bytes = b""
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()

    def scorer(self):
        if not self.weights:
            return lambda text: self.prior
        sizes, weights = Sizes(self.good, self.bad), np.array(self.weights)
        centre, scale = np.array(self.centre), np.array(self.scale)

        def score(text):
            x = np.clip((np.array(sizes(text)) - centre) / scale, -8, 8)
            return float(1 / (1 + math.exp(-max(-30.0, min(30.0, weights[0] + x @ weights[1:])))))

        return score


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learn from labelled rows outside the held-out fold; one class or no rows give a constant score."""
    known = labelled(documents, labels, label)
    sample, totals = bounded(documents, known, "y", per_class)
    if len(totals) < 2:
        return Model(prior=float(max(totals, default=0.5)))
    start = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.greatest(F.lit(1), F.length("text") - WINDOW_CHARS + 1)) + 1
    window = F.substr(F.coalesce("text", F.lit("")), start.cast("int"), F.lit(WINDOW_CHARS))  # a null text is empty
    windows = sample.select("y", "half", window.alias("w"))
    windows = windows.limit(4 * per_class).collect()

    def built(y: int, halves: tuple[int, ...]) -> bytes:
        return dictionary([r["w"].encode() for r in windows if r["y"] == y and r["half"] in halves])

    crossed = {half: (built(1, (1 - half,)), built(0, (1 - half,))) for half in (0, 1)}

    def measure(batches):
        sizes = {half: Sizes(*pair) for half, pair in crossed.items()}
        for rows in batches:
            x = [sizes[half.as_py()](text.as_py()) for half, text in zip(rows.column(1), rows.column(2))]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    measured = in_arrow(sample.select("y", "half", "text"), measure, "y int, x array<double>")
    measured = measured.limit(4 * per_class).collect()
    x, y = np.array([r["x"] for r in measured]), np.array([r["y"] for r in measured], float)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    share = {v: totals[v] / max(1, (y == v).sum()) for v in totals}
    weight = np.where(y == 1, share.get(1, 0.0), share.get(0, 0.0))
    weights = logistic(np.clip((x - centre) / scale, -8, 8), y, weight * len(y) / weight.sum(), ridge=0.1)
    return Model(
        prior=totals[1] / sum(totals.values()),
        good=built(1, (0, 1)),
        bad=built(0, (0, 1)),
        centre=tuple(centre),
        scale=tuple(scale),
        weights=tuple(weights),
    )


def scored(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns and the probability that a text is good.

    Null and empty texts are scored as empty; repeated rows get the same score; other columns
    are passed on untouched.
    """
    return with_scores(documents, name, model.scorer)
