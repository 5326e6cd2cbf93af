"""Token ids as Parquet list columns, in document order, with dictionary, delta and page-index encodings.

Texts are dealt by ranges of doc_id, sorted, encoded inside the sorted partitions and written
by Spark's own writer: the ids as dictionary pages (a vocabulary fits one dictionary), ids and
offsets of documents as delta pages, both in row groups and pages of set sizes with column
and offset indexes. A reader of doc_id and n_tokens touches no token page, and a filter on
doc_id skips row groups and pages.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadgrain.llm.common import Remembered, bounded_batches, in_arrow, int_lists, slices
from roadgrain.session import fresh_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Remembered pieces per worker; beyond that, those of the last slice stay.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded together.
SLICE_BYTES = 4 << 20

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
#: Letters below U+0100 that have one code point when composed and a lower case of one code point.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"[{_LETTERS}]+")
_TAILED = f"[0-9{_LETTERS}][,.]$"


class Pieces:
    """Ids of white-space separated pieces of text.

    Only for tokenizers that lower-case, drop white space and never join across it, such as the
    word-level vocabulary here; then the ids of a text are those of its pieces.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = Remembered(REMEMBERED, pa.string())

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def tokenised(self, piece: str) -> list[int]:
        if not _WORD.fullmatch(piece):
            return self.whole(piece)
        if not piece.isascii():
            piece = piece.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [t.id for t in self.model.tokenize(piece)]  # letters only: nothing is left to normalise or to split

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """The ids of every text and the end id; a null text is empty.

        Each different piece of the texts is looked up once, a comma or full stop behind a word by
        itself; splitting and putting ids together is left to Arrow.
        """
        texts = pc.fill_null(texts, "")
        marked = pc.match_substring(texts, "<|")  # such texts may hold a special token, whose case counts
        special = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(marked, "", texts)))
        found = pieces.flatten().dictionary_encode()
        tailed = pc.match_substring_regex(found.dictionary, _TAILED)
        stems = pc.if_else(tailed, pc.utf8_slice_codeunits(found.dictionary, 0, -1), found.dictionary)
        tails = pc.if_else(tailed, pc.utf8_slice_codeunits(found.dictionary, -1), "")
        side_by_side = pa.array(np.arange(2 * len(stems)).reshape(2, -1).T.ravel())
        both = self.pieces.of(pa.concat_arrays([stems, tails]).take(side_by_side), self.tokenised)
        lists = pa.ListArray.from_arrays(both.offsets[::2], both.values)

        at, code = pieces.offsets.to_numpy().astype(np.int64), found.indices.to_numpy().copy()
        at -= at[0]
        code[at[special]] = np.arange(len(lists), len(lists) + len(special))  # their only piece is the empty text
        lists = pa.concat_arrays([lists, int_lists([self.whole(texts[int(i)].as_py()) for i in special] + [[end_id]])])
        code = np.insert(code, at[1:], len(lists) - 1)
        joined = lists.take(pa.array(code))
        ends = joined.offsets.to_numpy()[at + np.arange(len(at))]
        return pa.ListArray.from_arrays(pa.array(ends), joined.values)


_pieces: dict[str, Pieces] = {}


def _encoder(path: str) -> Pieces:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def encoded(documents: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """One row of FILE_SCHEMA for each document, partitions in ascending order of doc_id.

    A null or empty text has the end id only; rows that share an id stay, ordered by text;
    null ids come first.
    """

    def encode(batches):
        pieces = _encoder(path)
        part, start = TaskContext.get().partitionId(), 0
        for rows in batches:
            for at, n in slices(rows.column(1), SLICE_BYTES):
                ids = pieces.encode(rows.column(1).slice(at, n), end_id)
                lengths = np.diff(ids.offsets.to_numpy()).astype(np.int32)
                before = start + np.r_[0, np.cumsum(lengths, dtype=np.int64)]
                start = int(before[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(at, n),
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(before[:-1]),
                        pa.array(lengths),
                        ids,
                    ],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"), encode, FILE_SCHEMA)


def write_ids(rows: DataFrame, path: str, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10) -> None:
    """Write rows of FILE_SCHEMA; the ids are dictionary-coded, numbers of documents delta-coded."""
    writer = (
        rows.write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("compression", "zstd")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
    )
    writer.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def offsets(files: DataFrame) -> DataFrame:
    """First position of each part among the ids of all documents; reads no token page."""
    totals = files.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def digests(files: DataFrame) -> DataFrame:
    """Per document, from the stored ids: doc_id, part, local_start, n_tokens, ids_crc32."""

    def digest(batches):
        for rows in batches:
            lists = rows.column(3)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
            )

    rows = files.select("doc_id", "part", "local_start", "ids")
    return in_arrow(rows, digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")


def tokenize(
    documents: DataFrame, path: str | None = None, vocabulary: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Encode, write to ``path`` (a new folder in the shared one if not given) and describe what was written.

    Returns per document doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, all read back from the files. Only doc_id and text are read. An empty table
    gives no rows.
    """
    import public_tokenizers

    spark = documents.sparkSession
    path = path or fresh_path(spark, "token-ids")
    with bounded_batches(spark):
        write_ids(encoded(documents, vocabulary or public_tokenizers.path(VOCABULARY), end_id), path)
    files = read_ids(spark, path)
    return (
        digests(files)
        .join(offsets(files), "part")
        .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )
