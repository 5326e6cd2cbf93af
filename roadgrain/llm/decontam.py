"""Benchmark decontamination by a prefix-filtered join of word windows, in DataFrame operations only.

Every item is cut into windows of ``size`` words (a shorter item is one window). A window
holds its rarest words at known offsets; a text that contains the window must contain them
too, so only these *prefix* words are joined with the corpus. A joined word fixes where the
window would start; the positional and length bounds drop starts that don't fit, and the
item-sized slice of the text is compared with the whole window. With ``misses`` > 0 a window
may differ in that many words; its prefix then has ``misses`` + 1 words, of which one must be right.

The corpus is never shuffled by word: the windows are broadcast, in blocks of at most
``block_bytes``, each with one pass over the corpus. What is shuffled is one row for each
document and one for each hit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from roadgrain.llm.common import small, staged, words

#: Stands for the end of a text among the word hashes.
END = 0


def windows(benchmark: DataFrame, size: int = 13) -> DataFrame:
    """Distinct windows: ``window`` (array of words) and ``items`` (ids of the items that hold it).

    Items without words have none; repeated items count once; a null id has windows but no id.
    """
    return (
        benchmark.select("item_id", words(F.col("text")).alias("w"))
        .where(F.size("w") > 0)
        .select(
            "item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))).alias("at")
        )
        .select("item_id", F.slice("w", F.col("at"), F.least(F.size("w"), F.lit(size))).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
    )


def _tokens(documents: DataFrame) -> DataFrame:
    """doc_id, digest of the text, words, and the words' hashes followed by END."""
    w = documents.select("doc_id", F.xxhash64("text").alias("digest"), words(F.col("text")).alias("w"))
    hashes = F.concat(F.transform("w", lambda x: F.xxhash64(x)), F.array(F.lit(END).cast("bigint")))
    return w.withColumn("h", hashes)


def prefixes(documents: DataFrame, cut: DataFrame, misses: int = 0) -> DataFrame:
    """The windows with their rarest words in the corpus: one row for each of ``misses`` + 1 words.

    Adds ``h`` (hash of the word), ``offset`` of the word in the window and ``len``.
    """
    positions = cut.select("window", "items", F.posexplode("window").alias("offset", "word")).withColumn(
        "h", F.xxhash64("word")
    )
    vocabulary = positions.select("h").distinct()
    seen = (
        _tokens(documents)
        .select(F.explode_outer("h").alias("h"))
        .join(small(vocabulary, 16), "h")
        .groupBy("h")
        .agg(F.count("*").alias("n"))
    )
    ranked = (
        positions.join(seen, "h", "left")
        .groupBy("window", "items")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "h"))).alias("order"))
    )
    return ranked.select(
        "window", "items", F.size("window").alias("len"), F.explode(F.slice("order", 1, misses + 1)).alias("p")
    ).select("window", "items", "len", "p.offset", "p.h")


def hits(documents: DataFrame, index: DataFrame, misses: int = 0, block_bytes: int = 64 << 20) -> DataFrame:
    """One row for each place of a window, and one with null items for each text.

    Columns: doc_id, digest, n_words, start, end (words, end exclusive), items.
    """
    weight = F.sum(F.octet_length(F.concat_ws(" ", "window")) + 16 * F.size("items") + 64)
    blocks = max(1, math.ceil((index.agg(weight).first()[0] or 0) / block_bytes))
    end_row = documents.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("window"),
        F.lit(None).cast(index.schema["items"].dataType).alias("items"),
        F.lit(0).alias("len"),
        F.lit(0).alias("offset"),
        F.lit(END).cast("bigint").alias("h"),
    )
    found = None
    for block in range(blocks):
        part = index.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else index
        part = part.unionByName(end_row) if block == 0 else part
        places = _tokens(documents).select(
            "doc_id", "digest", "w", F.size("w").alias("n_words"), F.posexplode_outer("h").alias("pos", "h")
        )
        start = F.col("pos") - F.col("offset")
        piece = F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len"))
        if misses:
            apart = F.aggregate(
                F.zip_with(piece, "window", lambda a, b: F.when(a == b, 0).otherwise(1)), F.lit(0), lambda s, x: s + x
            )
            same = apart <= misses
        else:
            same = piece == F.col("window")
        fits = (start >= 0) & (start + F.col("len") <= F.col("n_words")) & same
        at_end = (F.col("len") == 0) & (F.col("pos") == F.col("n_words"))
        joined = (
            places.join(F.broadcast(part), "h")
            .where(F.when(F.col("len") == 0, at_end).otherwise(fits))
            .select(
                "doc_id",
                "digest",
                F.col("n_words").cast("long").alias("n_words"),
                start.cast("long").alias("start"),
                (start + F.col("len")).cast("long").alias("end"),
                "items",
            )
        )
        found = joined if found is None else found.unionByName(joined)
    return found


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = 13,
    misses: int = 0,
    share: int = 20,
    block_bytes: int = 64 << 20,
) -> DataFrame:
    """Per document: n_words, n_hit, items (sorted ids as text), contaminated.

    A word is hit if it lies in any place of a window; a document is contaminated if it has a
    hit and ``share`` * n_hit >= n_words. A null or wordless text has no words and no hits.
    Repeated rows are one document; one id with several texts has a row for each text. An
    empty benchmark hits nothing. Only doc_id, text and item_id, text are read, so other
    columns may have any name.
    """
    index = staged(prefixes(documents, windows(benchmark, size), misses), "windows")
    before = Window.partitionBy("doc_id", "digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    ids = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string")))
    return (
        hits(documents, index, misses, block_bytes)
        .withColumn("fresh", fresh)
        .groupBy("doc_id", "digest")
        .agg(F.max("n_words").alias("n_words"), F.sum("fresh").cast("long").alias("n_hit"), ids.alias("items"))
        .select(
            "doc_id",
            "digest",
            "n_words",
            "n_hit",
            "items",
            ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without the contaminated ones; all columns stay, and so do rows with a null id or text."""
    found = contamination(documents, benchmark, **parameters).where("contaminated")
    bad = staged(found.select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")), "contaminated")
    bad = small(bad, 24)
    same = documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(documents["text"]) == bad["bad_digest"])
    return documents.join(bad, same, "left_anti")
