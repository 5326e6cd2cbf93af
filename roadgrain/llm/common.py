"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

import roadgrain
from roadgrain.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words made of ASCII digits, ASCII letters and all characters above ASCII.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for UTF-8 bytes: A-Z become a-z, what separates words becomes a blank.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


#: Bytes of an Arrow batch of whole texts, both in the executor and in its Python workers.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def in_arrow(data: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package sent along, so that workers need no installed copy of it."""
    context = data.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(roadgrain.__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="package-"), "roadgrain")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), "roadgrain"))
        _shipped.add(context.applicationId)

    def released(batches):
        pool, later = pa.default_memory_pool(), False
        for rows in function(batches):
            if later:
                pool.release_unused()
            yield rows
            del rows
            later = True
        pool.release_unused()  # now that nothing is held: workers are kept, and with them what Arrow has set aside

    return data.mapInArrow(released, schema)


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on the session sends about ``most`` bytes to Python at once, also for plans run later; a lower setting stays."""
    held = spark.conf.get(_BATCH_KEY).removesuffix("b")
    if held.isdigit() and int(held) > most:
        spark.conf.set(_BATCH_KEY, str(most))


@contextmanager
def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES):
    """Jobs started inside send about ``most`` bytes to Python at once, however long texts are; a lower setting stays."""
    held = spark.conf.get(_BATCH_KEY)
    bound_batches(spark, most)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, held)


def slices(texts: pa.Array, most: int) -> list[tuple[int, int]]:
    """Place and number of texts in a row that have about ``most`` bytes together, one at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // most
    bounds = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(sizes)] if len(sizes) else np.zeros(1, int)
    return [(int(a), int(b - a)) for a, b in zip(bounds[:-1], bounds[1:])]


def int_lists(rows: Sequence[Sequence[int]]) -> pa.ListArray:
    """Lists of 32-bit numbers."""
    sizes = np.fromiter(map(len, rows), np.int32, len(rows))
    values = np.fromiter(chain.from_iterable(rows), np.int32, sizes.sum())
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values))


class Remembered:
    """Numbers under 2^31 of pieces of text, held as Arrow arrays, far smaller than a dict.

    Beyond ``most`` pieces, those that were asked for last stay.
    """

    def __init__(self, most: int, kind: pa.DataType):
        self.most = most
        self.known, self.lists = pa.array([], kind), int_lists([])

    def of(self, pieces: pa.Array, make: Callable[[str | bytes], Sequence[int]]) -> pa.ListArray:
        """The numbers of every piece, for new ones what ``make`` gives."""
        n = len(self.known)
        among = pa.concat_arrays([self.known, pieces]).dictionary_encode()
        new = among.dictionary.slice(n).to_numpy(zero_copy_only=False)
        self.known, self.lists = among.dictionary, pa.concat_arrays([self.lists, int_lists([make(piece) for piece in new])])
        places = among.indices.slice(n)
        found = self.lists.take(places)
        if len(self.known) > self.most:
            kept = places.unique()
            self.known, self.lists = self.known.take(kept), self.lists.take(kept)
        return found


def with_scores(documents: DataFrame, name: str, make_scorer) -> DataFrame:
    """All columns and a double: what ``make_scorer()``, called once per task, gives for each text (None if null)."""
    at = documents.columns.index("text")
    names = [*documents.columns, name]

    def score(batches):
        scorer = make_scorer()
        for rows in batches:
            values = pa.array([scorer(text.as_py()) for text in rows.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, values], names=names)

    return in_arrow(documents, score, StructType([*documents.schema.fields, StructField(name, DoubleType())]))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (intercept first) of a weighted ridge logistic regression, by damped Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag(np.r_[1e-6, np.ones(x.shape[1] - 1)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(data: DataFrame, name: str, **options) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again: a lineage cut that outlives executors."""
    path = fresh_path(data.sparkSession, name)
    data.write.options(**options).parquet(path)
    return data.sparkSession.read.schema(data.schema).parquet(path)


def free_name(data: DataFrame, wanted: str) -> str:
    """A column name the table doesn't have yet, whatever the case of its letters."""
    taken = {c.lower() for c in data.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fold that nothing may be learned from; a null id is in it."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII takes the fast built-in way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of the lower-cased words; empty for null."""
    parts = F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def word_bytes(text: str) -> list[bytes]:
    """``words`` for one Python string, as UTF-8."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def small(side: DataFrame, row_bytes: int, most: int = 64 << 20) -> DataFrame:
    """The side with a broadcast hint if its counted rows fit ``most`` bytes, else as it is, for a shuffled join."""
    return F.broadcast(side) if side.count() * row_bytes <= most else side


def labelled(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id and y (0 or 1) of labelled documents outside the held-out fold; no text is read or moved.

    Rows with a null id or label are left out; of repeated labels the largest counts.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return known.where(~held_out()).join(documents.select("doc_id"), "doc_id", "left_semi")


def bounded(documents: DataFrame, known: DataFrame, by: str, most: int) -> tuple[DataFrame, dict]:
    """doc_id, text, ``by`` and half (0 or 1) of about ``most`` documents of each value of ``by``; and all values' counts.

    Only for fitting. The documents are picked from (doc_id, by) by a hash of the id alone, so no
    group is sorted or gathered; the picked ids, as many as that on average, are broadcast. An id
    that several rows share is picked once, with its smallest ``by``, and gives one of its texts.
    """
    single = known.groupBy("doc_id").agg(F.min(by).alias(by))
    totals = {r[by]: r["count"] for r in single.groupBy(by).count().collect() if r[by] is not None}
    share = F.create_map(*[x for v, n in totals.items() for x in (F.lit(v), F.lit(min(1.0, most / n)))] or [F.lit(""), F.lit(0.0)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = single.where(draw < share[F.col(by)])
    sample = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    texts = sample.groupBy("doc_id", by).agg(F.min("text").alias("text"))
    return texts.select("doc_id", "text", by, F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).alias("half")), totals
