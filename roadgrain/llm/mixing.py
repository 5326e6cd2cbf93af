"""Mixing to target weights with soft domain membership.

A naive Bayes classifier over words and marks, fitted on a bounded sample of labelled documents, gives each text
a posterior over domains. Nonnegative rates, one for each document, are then fitted by
projected-gradient least squares so that the expected tokens of each domain,
sum(rate * tokens * posterior), match the targets. All rates start at 1 and a step depends
on the posterior only, so the state of the descent is the short list of its steps: a round is one
pass over (tokens, posteriors) that replays them and returns one sum for each domain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from roadgrain.llm.common import Remembered, bounded, bounded_batches, held_out, in_arrow, logistic, slices, small, staged

#: Bounds of the sample and of the vocabulary.
PER_DOMAIN = 4_000
BUCKETS = 1 << 16
REMEMBERED = 500_000
#: Bytes of text that are classified together.
SLICE_BYTES = 4 << 20
APART = 4.0
ROUNDS = 30
TOLERANCE = 1e-6
_MARKS = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"
_LETTERS = bytes(i for i in range(256) if i >= 128 or chr(i).isalnum())


def domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the table of labels: toxic, else poor, else clean; the worst of repeated labels."""
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("t"), F.min("quality").alias("q"))
    domain = F.when(F.col("t") == 1, "toxic").when(F.col("q") == 0, "poor").when(F.col("q") == 1, "clean")
    return marks.select("doc_id", domain.alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")


class Units(dict):
    """The bucket of a part of a piece as a tuple; empty if ``kept`` is given and does not have it."""

    def __init__(self, kept: set[int] | None):
        self.kept = kept

    def bucket(self, unit: bytes) -> tuple[int, ...]:
        bucket = xxhash.xxh3_64_intdigest(unit) % BUCKETS
        return (bucket,) if self.kept is None or bucket in self.kept else ()

    def __missing__(self, unit: bytes) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        self[unit] = own = self.bucket(unit)
        return own


class Buckets(dict):
    """Buckets of a piece of text: its word, the word's first letters, its marks and its capitals.

    With ``kept``, only those in it.
    """

    def __init__(self, kept: np.ndarray | None = None):
        self.units = Units(None if kept is None else set(kept.tolist()))  # the first letters and marks, far fewer than words
        self.pieces = Remembered(REMEMBERED, pa.binary())

    def made(self, piece: bytes) -> tuple[int, ...]:
        if not piece:
            return ()
        word, marks = piece.translate(None, _MARKS).lower(), piece.translate(None, _LETTERS)
        units = self.units
        own = units.bucket(b"=" + word) + units[b"4" + word[:4]] + units[b"6" + word[:6]] + units[b"." + marks]
        if len(piece) > 2 and piece.isupper():
            own += units[b"capitals"]
        return own

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        self[piece] = own = self.made(piece)
        return own


def counted(text: str | None, buckets: Buckets) -> tuple[int, np.ndarray]:
    """Number of pieces between white space, and the distinct buckets of the text.

    How often pieces repeat makes one more bucket.
    """
    pieces = (text or "").encode("utf-8", "replace").split()
    distinct = set(pieces)
    own = set().union(*map(buckets.__getitem__, distinct))
    if len(pieces) >= 20:
        own.add(REPEATS[10 * len(distinct) // len(pieces)])
    return len(pieces), np.fromiter(own, np.int64, len(own))


#: Buckets of texts of at least 20 pieces, by tenths of distinct pieces.
REPEATS = [xxhash.xxh3_64_intdigest(b"repeats %d" % tenths) % BUCKETS for tenths in range(11)]


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers, sorted; the array is sorted in place."""
    numbers.sort()
    return numbers[np.r_[True, numbers[1:] != numbers[:-1]]] if len(numbers) else numbers


@dataclass(frozen=True)
class Classifier:
    """Domains, the buckets' log probabilities in each, and a one-versus-rest calibration of each domain."""

    names: tuple[str, ...]
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 1), np.float32))
    weights: np.ndarray | None = None

    def evidence(self, own: np.ndarray) -> np.ndarray:
        return self.table[own].sum(0, dtype=float)

    def evidences(self, texts: pa.Array, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces and evidence of every text, as ``counted`` and ``evidence`` give them one by one.

        Each different piece of the texts is looked up once; Arrow splits, and pairs of a text and a
        piece or a bucket are made distinct as sorted numbers.
        """
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        places = pieces.flatten().dictionary_encode()
        found = buckets.pieces.of(places.dictionary.cast(pa.binary()), buckets.made)
        starts, flat = found.offsets.to_numpy()[:-1].astype(np.int64), found.values.to_numpy()
        sizes = np.diff(found.offsets.to_numpy()).astype(np.int64)
        empty = pc.binary_length(places.dictionary).to_numpy() == 0
        text = np.repeat(np.arange(len(texts)), np.diff(pieces.offsets.to_numpy()))
        code = places.indices.to_numpy().astype(np.int64)
        text, code = text[~empty[code]], code[~empty[code]]
        n = np.bincount(text, minlength=len(texts))
        text, code = np.divmod(_distinct(text * len(found) + code), max(1, len(found)))
        distinct = np.bincount(text, minlength=len(texts))
        text, code = text[sizes[code] > 0], code[sizes[code] > 0]
        times = sizes[code]
        at = np.repeat(starts[code] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        long = np.flatnonzero(n >= 20)
        repeats = np.array(REPEATS)[10 * distinct[long] // n[long]]
        pairs = np.r_[np.repeat(text, times) * BUCKETS + flat[at], long * BUCKETS + repeats]
        text, own = np.divmod(_distinct(pairs), BUCKETS)
        rows = self.table[own].astype(float)
        return n, np.column_stack([np.bincount(text, rows[:, k], len(texts)) for k in range(rows.shape[1])])

    def posterior(self, evidence: np.ndarray) -> np.ndarray:
        """Rows of posteriors for rows of evidence."""
        if self.weights is None:
            return np.full((len(evidence), len(self.names)), 1 / len(self.names))
        odds = np.column_stack([w[0] + margins(evidence, k) @ w[1:] for k, w in enumerate(self.weights)])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return p / p.sum(1, keepdims=True)


def margins(evidence: np.ndarray, k: int) -> np.ndarray:
    """How far domain k is ahead of each other one, on a scale that grows with the logarithm."""
    return np.arcsinh(evidence[:, [k]] - np.delete(evidence, k, axis=1))


def fit(documents: DataFrame, labelled: DataFrame, per_domain: int = PER_DOMAIN) -> Classifier:
    """Learn domains from (doc_id, domain) outside the held-out fold; nothing labelled gives one domain, ``all``."""
    known = labelled.select("doc_id", "domain").where(~held_out())
    known = known.join(documents.select("doc_id"), "doc_id", "left_semi")
    sample, totals = bounded(documents, known, "domain", per_domain)
    if not totals:
        return Classifier(("all",))
    names = tuple(sorted(totals))

    def count(batches):
        buckets, sums = Buckets(), {}
        for rows in batches:
            for domain, half, text in zip(*(rows.column(i) for i in range(3))):
                _, own = counted(text.as_py(), buckets)
                cell = sums.setdefault((domain.as_py(), half.as_py()), np.zeros(BUCKETS))
                cell[own] += 1
        for (domain, half), cell in sums.items():
            own = np.flatnonzero(cell)
            yield pa.RecordBatch.from_arrays(
                [pa.array([domain] * len(own)), pa.array([half] * len(own), pa.int64()), pa.array(own), pa.array(cell[own])],
                names=["domain", "half", "bucket", "n"],
            )

    rows = sample.select("domain", "half", "text")
    cells = in_arrow(rows, count, "domain string, half long, bucket long, n double")
    sums = np.zeros((2, BUCKETS, len(names)))
    for r in cells.groupBy("domain", "half", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        sums[r["half"], r["bucket"], names.index(r["domain"])] += r["n"]
    sizes = np.zeros((2, len(names)))
    for r in rows.groupBy("domain", "half").count().collect():
        sizes[r["half"], names.index(r["domain"])] = r["count"]

    def table(held: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log probability of a bucket in each domain's texts; 0 where domains don't differ by APART standard errors."""
        n, p = size.sum(), held.sum(1, keepdims=True) / max(1.0, size.sum())
        error = np.sqrt(p * (1 - p) * size * (n - size) / max(1.0, n) + 0.25)
        apart = (np.abs(held - size * p) / error).max(1) >= APART
        return np.where(apart[:, None], np.log((held + 0.5) / (size + 1)), 0.0).astype(np.float32)

    crossed = [Classifier(names, table(sums[1 - half], sizes[1 - half])) for half in (0, 1)]

    def measure(batches):
        buckets = Buckets()
        for rows in batches:
            x = [
                crossed[half.as_py()].evidence(counted(text.as_py(), buckets)[1]).tolist()
                for half, text in zip(rows.column(1), rows.column(2))
            ]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(x, pa.list_(pa.float64()))], names=["domain", "x"])

    measured = in_arrow(rows, measure, "domain string, x array<double>").limit(4 * per_domain * len(names)).collect()
    x = np.array([r["x"] for r in measured])
    y = np.array([names.index(r["domain"]) for r in measured])
    if len(names) == 1 or not len(measured):
        return Classifier(names)
    weight = np.array([totals[n] / max(1, (y == i).sum()) for i, n in enumerate(names)])[y]
    weight *= len(y) / weight.sum()
    weights = np.array([logistic(margins(x, k), (y == k).astype(float), weight, 0.1) for k in range(len(names))])
    return Classifier(names, table(sums.sum(0), sizes.sum(0)), weights)


def memberships(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, digest (of the text), n_tokens (pieces between white space) and ``p``, the posterior of each domain."""

    def classify(batches):
        buckets = Buckets(np.flatnonzero(classifier.table.any(1)))
        for rows in batches:
            for at, size in slices(rows.column(2), SLICE_BYTES):
                part = rows.slice(at, size)
                n, e = classifier.evidences(part.column(2), buckets)
                p = list(classifier.posterior(e))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))],
                    names=["doc_id", "digest", "n_tokens", "p"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    return in_arrow(rows, classify, "doc_id long, digest long, n_tokens long, p array<double>")


def replay(p: np.ndarray, steps: list[np.ndarray], most: float | None) -> np.ndarray:
    """Rates of rows of posteriors after the given steps."""
    rate = np.ones(len(p))
    for step in steps:
        rate = np.clip(rate - p @ step, 0.0, most)
    return rate


@dataclass(frozen=True)
class Rates:
    """The fitted descent: its steps, the targets and the totals reached."""

    names: tuple[str, ...]
    steps: list[np.ndarray]
    most: float | None
    target: np.ndarray
    reached: np.ndarray


def _array(rows: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    return rows.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_rates(
    member: DataFrame,
    names: tuple[str, ...],
    weights: dict[str, float],
    anchor: str | None = None,
    most: float | None = None,
    rounds: int = ROUNDS,
) -> Rates:
    """Rates in [0, most] whose expected domain totals match ``weights``, the domains' shares.

    The targets add up to the present number of tokens or, with ``anchor``, to what leaves the
    anchor domain its present ones. A domain without a weight has the target 0. What rates
    of at most ``most`` cannot reach is approached as closely as squares allow. The step is the gradient in the metric of the domain covariances of the
    rates that are not at a bound; a step that makes the error larger is taken back and shortened.
    """
    width = len(names)

    def sums(batches, steps):
        for rows in batches:
            t, p = rows.column(0).to_numpy().astype(float), _array(rows, 1, width)
            rate = replay(p, steps, most)
            free = (rate > 0) & ((rate < (np.inf if most is None else most)) | (not steps))
            out, square = (t * rate) @ p, (p * (t * free)[:, None]).T @ p
            values = np.r_[out, square.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["k", "v"])

    def run(steps: list[np.ndarray]) -> np.ndarray:
        rows = in_arrow(member.select("n_tokens", "p"), lambda b: sums(b, steps), "k long, v double")
        out = np.zeros(width + width * width)
        for r in rows.groupBy("k").agg(F.sum("v").alias("v")).collect():
            out[r["k"]] = r["v"]
        return out

    first = run([])
    now, whole = first[:width], first[width:].reshape(width, width)
    share = np.array([weights.get(n, 0.0) for n in names])
    if share.sum() == 0 or now.sum() == 0:
        return Rates(names, [], most, now, now)
    share = share / share.sum()
    total = float(now.sum())
    if anchor in names and weights.get(anchor):
        total = float(now[names.index(anchor)] / share[names.index(anchor)])
    target = share * total
    steps: list[np.ndarray] = []
    square, error, pace = whole, np.abs(now - target).sum(), 1.0
    for _ in range(rounds):
        if error <= TOLERANCE * total or pace < 1e-3:
            break
        scale = np.linalg.pinv(square + 1e-6 * np.trace(whole) * np.eye(width))
        step = np.round(pace * (scale @ (now - target)), 12)
        then = run([*steps, step])
        if np.abs(then[:width] - target).sum() < error:
            steps, now, square = [*steps, step], then[:width], then[width:].reshape(width, width)
            error, pace = np.abs(now - target).sum(), min(1.0, 2 * pace)
        else:
            pace /= 4
    return Rates(names, steps, most, target, now)


def rated(member: DataFrame, rates: Rates) -> DataFrame:
    """The membership rows and their ``rate``."""
    steps, most, width = rates.steps, rates.most, len(rates.names)

    def rate(batches):
        for rows in batches:
            values = np.round(replay(_array(rows, 3, width), steps, most), 9)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(values)], names=["doc_id", "digest", "n_tokens", "p", "rate"]
            )

    rows = member.select("doc_id", "digest", "n_tokens", "p")
    return in_arrow(rows, rate, "doc_id long, digest long, n_tokens long, p array<double>, rate double")


def copies(rate: str = "rate"):
    """Whole number of copies: the rate's whole part, and one more for its fraction of all documents by a hash of doc_id."""
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return F.floor(F.col(rate) + draw).cast("long")


def mix(
    documents: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    anchor: str | None = None,
    most: float | None = None,
    per_domain: int = PER_DOMAIN,
) -> tuple[DataFrame, Rates]:
    """Per row doc_id, digest, n_tokens, p, rate, n_copies; and how the targets were met.

    Null and empty texts have 0 tokens and the prior as posterior; they don't count for the
    targets but get a rate like others. A null doc_id has a rate and one draw for all. Repeated rows get
    equal rates. An empty table gives no rows.
    """
    classifier = fit(documents, labelled, per_domain)
    with bounded_batches(documents.sparkSession):
        member = staged(memberships(documents, classifier), "members")
    rates = fit_rates(member, classifier.names, weights, anchor, most)
    return rated(member, rates).withColumn("n_copies", copies()), rates


def mixed(documents: DataFrame, labelled: DataFrame, weights: dict[str, float], **parameters) -> DataFrame:
    """The documents, each as often as its rate says; all columns stay."""
    found, _ = mix(documents, labelled, weights, **parameters)
    times = staged(
        found.where(F.coalesce("n_copies", F.lit(1)) != 1)
        .groupBy(F.col("doc_id").alias("mix_id"), F.col("digest").alias("mix_digest"))
        .agg(F.max("n_copies").alias("mix_copies")),
        "copies",
    )
    times = small(times, 24)
    same = documents["doc_id"].eqNullSafe(times["mix_id"]) & (F.xxhash64(documents["text"]) == times["mix_digest"])
    repeat = F.explode(F.array_repeat(F.lit(0), F.coalesce(times["mix_copies"], F.lit(1)).cast("int")))
    return (
        documents.join(times, same, "left")
        .select(*[documents[c] for c in documents.columns], repeat.alias("mix_copy"))
        .select(*[documents[c] for c in documents.columns])
    )
