"""Product codes of vectors, learned exactly in integers over Hilbert-sorted flat blocks.

Vectors are cut into parts. Tasks pack the vectors that they read into groups; in a group each
part position is sorted along a Hilbert curve and cut into flat blocks, which are written once
with their min/max boxes and sums. A round compares each box with the codebook: an entry whose
least distance to the box is above another's greatest distance cannot be nearest to anything
inside. Mostly few entries are left on a block's shortlist and a small integer kernel decides
among them; if one is left the block's stored sum is added without looking at its members. Only
sums and counts of entries, as many as the codebook has, leave the tasks. Vectors are never
shuffled: a group holds all parts of its vectors, so codes are put together inside it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadgrain.llm.common import in_arrow, small, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components in a group, vectors in a block, bytes of a row group of the stored groups.
GROUP_COMPONENTS, BLOCK, ROW_GROUP = 1 << 19, 32, 16 << 20
#: Integer components up to here keep every squared distance and sum of squares inside 63 bits.
LARGEST = 1 << 26

GROUP_SCHEMA = (
    "vec_id array<long>, label array<string>, orders array<int>, flat array<int>, low array<int>, high array<int>, sums array<long>"
)


def hilbert_keys(points: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Position of each row of non-negative integers along a Hilbert curve, as int64.

    Only an order of rows depends on it. At most 31 columns take part, each cut down to as many
    leading bits as fit 62 bits.
    """
    axes = points[:, :31].astype(np.int64)
    n = axes.shape[1]
    if not n or not len(axes):
        return np.zeros(len(axes), np.int64)
    bits = bits or max(1, min(16, 62 // n))
    top = int(axes.max(initial=0)).bit_length()
    axes >>= max(0, top - bits)
    x = [axes[:, i].copy() for i in range(n)]
    for level in range(bits - 1, 0, -1):  # undo the excess rotations, from the coarsest cell down
        q = 1 << level
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):  # Gray code across the axes
        x[i] ^= x[i - 1]
    turn = np.zeros(len(axes), np.int64)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        turn ^= np.where(x[n - 1] & q, q - 1, 0)
    key = np.zeros(len(axes), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ turn) >> level & 1)
    return key


def _finite(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as string) and the vector as doubles, of vectors without null and non-finite components."""
    wide = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    return wide.where(_finite(F.col("vector")))


def quantised(vectors: np.ndarray) -> np.ndarray:
    whole = np.floor(vectors * SCALE)
    if len(whole) and np.abs(whole).max(initial=0) > LARGEST:
        raise ValueError(f"A vector has a component beyond {LARGEST // SCALE}; its distances might not fit 64 bits.")
    return whole.astype(np.int64)


def _fit(vectors: list[list[float]], width: int, padded: int) -> np.ndarray:
    out = np.zeros((len(vectors), padded))
    for i, v in enumerate(vectors):
        out[i, :width] = v
    return out


def first_codebook(rows: DataFrame, parts: int, entries: int) -> tuple[np.ndarray, int]:
    """The parts of the vectors of the smallest vec_ids, as (part, entry, component), and the vectors' length.

    Equal ids are ordered by vector, null ids come last. The length is that of the first of these
    vectors. At most ``entries`` rows reach the driver.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64), 0
    width = len(first[0]["vector"])
    own = rows.where(F.size("vector") == width).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries)
    padded = -(-width // parts) * parts
    start = quantised(_fit([r["vector"] for r in own.collect()], width, padded))
    return start.reshape(len(start), parts, padded // parts).transpose(1, 0, 2).copy(), width


def groups(rows: DataFrame, width: int, parts: int, block: int = BLOCK) -> DataFrame:
    """Rows of GROUP_SCHEMA: Hilbert order, flat values, boxes and sums of each part position of a group."""
    padded = max(1, -(-width // parts)) * parts
    most = max(block, GROUP_COMPONENTS // padded)

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                flat = piece.column(2).flatten().to_numpy(zero_copy_only=False)
                n, d = piece.num_rows, padded // parts
                values = np.zeros((n, padded))
                values[:, :width] = flat.reshape(n, width)
                values = quantised(values).reshape(n, parts, d)
                starts = np.arange(0, n, block)
                orders, sorted_values, low, high, sums = [], [], [], [], []
                for p in range(parts):
                    own = values[:, p]
                    order = np.argsort(hilbert_keys(own - own.min(axis=0)), kind="stable")
                    own = own[order]
                    orders.append(order), sorted_values.append(own)
                    low.append(np.minimum.reduceat(own, starts)), high.append(np.maximum.reduceat(own, starts))
                    sums.append(np.add.reduceat(own, starts))

                def row(arrays, kind):
                    joined = np.concatenate([np.asarray(a).ravel() for a in arrays])
                    return pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), pa.array(joined, kind))

                ends = pa.array([0, n], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(ends, piece.column(0)),
                        pa.ListArray.from_arrays(ends, piece.column(1)),
                        row(orders, pa.int32()),
                        row(sorted_values, pa.int32()),
                        row(low, pa.int32()),
                        row(high, pa.int32()),
                        row(sums, pa.int64()),
                    ],
                    names=["vec_id", "label", "orders", "flat", "low", "high", "sums"],
                )

    return in_arrow(rows.where(F.size("vector") == width), pack, GROUP_SCHEMA)


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(block, entry) booleans: whether the entry can be nearest to some point of the block's box."""
    below, above = low[:, None] - book[None], book[None] - high[:, None]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return (near * near).sum(2) <= (far * far).sum(2).min(1)[:, None]


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the first of equally near ones, and its squared distance; all in integers."""
    apart = values[:, None] - book[None]
    distance = np.einsum("nkd,nkd->nk", apart, apart)
    best = distance.argmin(1)
    return best, distance[np.arange(len(values)), best]


def _numpy(rows: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return rows.column(rows.schema.get_field_index(name))[i].values.to_numpy(zero_copy_only=False)


def _unpacked(rows, i, parts, d, block):
    """Number of vectors, and for each part order, values, boxes and sums of a stored group."""
    n = len(rows.column(0)[i])
    b = -(-n // block)
    orders = _numpy(rows, "orders", i).reshape(parts, n)
    flat = _numpy(rows, "flat", i).reshape(parts, n, d).astype(np.int64)
    low, high, sums = (_numpy(rows, k, i).reshape(parts, b, d).astype(np.int64) for k in ("low", "high", "sums"))
    return n, [(orders[p], flat[p], low[p], high[p], sums[p]) for p in range(parts)]


def next_codebook(stored: DataFrame, book: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The codebook after one round: each entry the floored mean of the parts nearest to it."""
    parts, entries, d = book.shape

    def total(batches):
        sums, counts = np.zeros((parts, entries, d), np.int64), np.zeros((parts, entries), np.int64)
        for rows in batches:
            for i in range(rows.num_rows):
                n, own = _unpacked(rows, i, parts, d, block)
                for p, (_, values, low, high, block_sums) in enumerate(own):
                    listed = shortlists(low, high, book[p])
                    single = listed.sum(1) == 1
                    only = listed.argmax(1)
                    sizes = np.minimum(block, n - block * np.arange(len(low)))
                    np.add.at(sums[p], only[single], block_sums[single])
                    np.add.at(counts[p], only[single], sizes[single])
                    for k in np.flatnonzero(~single):
                        short = np.flatnonzero(listed[k])
                        inside = values[k * block : (k + 1) * block]
                        best = short[nearest(inside, book[p][short])[0]]
                        np.add.at(sums[p], best, inside)
                        np.add.at(counts[p], best, 1)
        used = np.argwhere(counts > 0)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used[:, 0], pa.int32()),
                    pa.array(used[:, 1], pa.int32()),
                    pa.array(counts[used[:, 0], used[:, 1]], pa.int64()),
                    pa.array([s.tolist() for s in sums[used[:, 0], used[:, 1]]], pa.list_(pa.int64())),
                ],
                names=["part", "entry", "n", "sums"],
            )

    found = in_arrow(stored, total, "part int, entry int, n long, sums array<long>")
    by_component = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "own"))
    added = by_component.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
    new = book.copy()
    for r in added.collect():  # at most parts x entries x components rows
        new[r["part"], r["entry"], r["at"]] = r["own"] // r["n"]
    return new


def coded(stored: DataFrame, book: np.ndarray, block: int = BLOCK) -> DataFrame:
    """vec_id, label, code and error of every vector under a finished codebook."""
    parts, entries, d = book.shape

    def encode(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                n, own = _unpacked(rows, i, parts, d, block)
                codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
                for p, (order, values, low, high, _) in enumerate(own):
                    listed = shortlists(low, high, book[p])
                    for k in range(len(low)):
                        short = np.flatnonzero(listed[k])
                        at = slice(k * block, (k + 1) * block)
                        best, distance = nearest(values[at], book[p][short])
                        codes[order[at], p] = short[best]
                        error[order[at]] += distance
                text = codes.tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0)[i].values,
                        rows.column(1)[i].values,
                        pa.array([text[k : k + step] for k in range(0, n * step, step)], pa.string()),
                        pa.array(error, pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return in_arrow(stored, encode, "vec_id long, label string, code string, error long")


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all final components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors of a table with vec_id, embedding and label, and the codebook (part, entry, component).

    Rows: vec_id, code (two hex digits a part), error (squared distances in integers, summed over
    parts) and label_error (errors summed over rows of equal label; rows without one together).

    Left out are null vectors and vectors with null or non-finite components. Vectors whose length
    differs from that of the smallest vec_id's vector have no codebook and are left out too. A
    length that the parts do not divide is filled up with zeros. Fewer vectors than entries give a
    smaller codebook; an empty table gives no rows and an empty codebook. Repeated ids and rows
    stay rows of their own; equal distances go to the lower entry; rows without an id are coded but
    start the codebook last. Other columns are not read. Components beyond 2^18 are refused, as
    their squared distances may not fit 64 bits. There may be at most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("Two hex digits hold up to 256 entries.")
    rows = kept(vectors)
    book, width = first_codebook(rows, parts, entries)
    if not book.shape[1]:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where(F.lit(False))
        return empty.withColumn("label_error", F.col("error")), book
    stored = staged(groups(rows, width, parts, block), "vector-groups", **{"parquet.block.size": ROW_GROUP})
    for _ in range(rounds):
        book = next_codebook(stored, book, block)
    found = staged(coded(stored, book, block), "vector-codes")
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = found.join(small(totals, 40), F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error"), book
