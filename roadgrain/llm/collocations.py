"""Phrases whose words keep company, mined from a weighted de Bruijn graph of word runs.

Nodes are runs of ``longest - 1`` words, edges runs of ``longest`` words between overlapping
nodes. Tasks cut texts into pieces, merge equal pieces, and add up edges chunk by chunk; where a
piece ends before an edge is full, the shorter run that is left is its end correction. One
shuffle brings the edges that begin with the same two words together and sorts them. Then every
run of two words or more needs no look at a text: it occurs as often as the edges and
corrections that begin with it flow through it, which are neighbours. Beginnings that hold many
edges are salted by the word that follows. Words travel as 64-bit ids; single words are counted
with their spelling, in a second pass that returns only words of frequent runs.

Where all that flows into a node comes from one edge and leaves by one edge, the node lies inside
an unary path: whatever is known of the path is known of it. Such nodes are folded into their
paths before phrases are scored (a phrase inside a longer one of the same count never stays), and
``paths`` returns the paths themselves, the long wordings that repeat as a whole.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from roadgrain.llm.common import bounded_batches, in_arrow, staged

LONGEST, LEAST, SHARE, BEST = 3, 10, 50, 2000
NO_LANGUAGE = "und"
#: Bytes of text that are added up together inside a task.
CHUNK_BYTES = 4 << 20
#: Documents looked at for beginnings to salt, the share of edges that makes one hot, and its salts.
LOOKED_AT, HOT_SHARE, SALTS = 8000, 1 / 4000, 256
#: Word ids that are sent to the tasks at most (8 bytes each); with more, words meet them in a join.
MOST_SENT = 4_000_000
#: Different words that a task adds up before it tells their counts.
HELD_WORDS = 300_000
#: Buckets of word ids; a task holds the words of one at a time.
BUCKETS = 1024
#: UTF-8 bytes: A-Z become a-z, what ends a piece becomes a line feed, a tab a blank.
PIECE_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)


class WordIds(dict):
    """Places of the words of a chunk, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def word_id(lang: bytes, word: bytes, seed: int) -> int:
    """A non-zero 64-bit id of a word of a language; the language is part of it."""
    return xxhash.xxh3_64_intdigest(lang + b"\n" + word, seed) - (1 << 63) or 1


def _chunks(batches):
    """For each chunk of a task's rows: {language: Counter of pieces}."""
    held, size = defaultdict(Counter), 0
    for rows in batches:
        for lang, text in zip(rows.column(0), rows.column(1)):
            if not text.is_valid:
                continue
            data = text.as_py().encode().translate(PIECE_BYTES)
            held[(lang.as_py() if lang.is_valid else NO_LANGUAGE).encode()].update(data.split(b"\n"))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield held
                held, size = defaultdict(Counter), 0
    if held:
        yield held


def _numbered(pieces: Counter) -> tuple[WordIds, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words; word place at every position; words in every piece and number of pieces equal to it.

    The pieces are let go of. 32 bits are enough: no text has 2^31 bytes, and a chunk ends with the text that fills it.
    """
    places, flat, lengths, times = WordIds(), array("i"), array("i"), array("i")
    for piece, n in pieces.items():
        own = piece.split()
        if own:
            flat.extend(map(places.__getitem__, own))
            lengths.append(len(own)), times.append(n)
    pieces.clear()
    return places, *(np.frombuffer(x, np.int32) for x in (flat, lengths, times))


def _ids(places: WordIds, lang: bytes, seed: int) -> np.ndarray:
    return np.fromiter((word_id(lang, w, seed) for w in places), np.int64, len(places))


def _summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns and their summed n."""
    bits = [max(1, int(c.max(initial=0)).bit_length()) for c in columns]
    if sum(bits) < 63:
        key = np.zeros(len(n), np.int64)
        for c, b in zip(columns, bits):
            key <<= b
            key |= c
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, found = key[starts], []
        for b in reversed(bits):
            found.insert(0, (key & (1 << b) - 1).astype(np.int32))
            key >>= b
    else:
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(n), bool)
        new[0] = True
        for c in columns:
            own = c[order]
            new[1:] |= own[1:] != own[:-1]
        starts = np.flatnonzero(new)
        found = [c[order[starts]] for c in columns]
    return found, np.add.reduceat(n[order], starts, dtype=np.int64)


def _runs(pieces: Counter, longest: int) -> tuple[WordIds, list[np.ndarray], np.ndarray]:
    """Places of the words; distinct edges as 1 + place of each of their words, 0 where a piece has ended, and their n."""
    places, words, lengths, times = _numbered(pieces)
    if not len(words):
        return places, [], np.zeros(0, np.int64)
    left = np.repeat(np.cumsum(lengths, dtype=np.int32), lengths)
    left -= np.arange(len(words), dtype=np.int32)
    later = np.zeros(len(words) + longest, np.int32)
    later[: len(words)] = words
    later[: len(words)] += 1
    columns = [np.where(left > k, later[k : k + len(words)], 0) for k in range(longest)]
    del left, later
    return places, *_summed(columns, np.repeat(times, lengths))


def _given(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("lang").cast("string").alias("lang"), "text")


def _beginning(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for the first two words of a run; it only decides about salts."""
    return first ^ (second << 21 | second >> 43 & (1 << 21) - 1)


def edges(documents: DataFrame, longest: int, seed: int, hot: np.ndarray | None = None) -> DataFrame:
    """w0, w1, ... (word ids, 0 where a piece has ended), salt and n, added up within chunks only.

    ``hot`` holds the sorted numbers of beginnings that are salted by the word that follows them.
    """
    hot = np.zeros(0, np.int64) if hot is None else hot

    def cut(batches):
        for held in _chunks(batches):
            for lang, pieces in held.items():
                places, columns, n = _runs(pieces, longest)
                ids = np.r_[0, _ids(places, lang, seed)]
                del places
                for at in range(0, len(n), 1 << 16):
                    own = [ids[c[at : at + (1 << 16)]] for c in columns]
                    salt = np.zeros(len(own[0]), np.int64)
                    if len(hot) and longest > 2:
                        salted = np.isin(_beginning(own[0], own[1]), hot)
                        salt[salted] = 1 + own[2][salted] % SALTS
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, own), pa.array(salt), pa.array(n[at : at + (1 << 16)])],
                        names=[*[f"w{k}" for k in range(longest)], "salt", "n"],
                    )

    schema = ", ".join(f"w{k} long" for k in range(longest)) + ", salt long, n long"
    return in_arrow(_given(documents), cut, schema)


def lexicon(documents: DataFrame, seed: int, wanted: np.ndarray | None = None) -> DataFrame:
    """id, lang, word and n (occurrences) of words of every language; id 0 without a word has a language's total.

    Counts travel packed, a row for each task and bucket of ids, and a bucket's words are added up
    as its rows pass by; what is held is one bucket's different words.
    ``wanted``, if given, holds the sorted ids of the only words to return.
    """

    def told(held: Counter):
        """The counts held, one row for each bucket of ids."""
        own = np.fromiter((0 if word is None else word_id(lang, word, seed) for lang, word in held), np.int64, len(held))
        order = np.argsort(own % BUCKETS, kind="stable")
        buckets, starts = np.unique(own[order] % BUCKETS, return_index=True)
        lang, word = (pa.array([key[i] for key in held], pa.binary()).cast(pa.string()) for i in (0, 1))
        flat = [pa.array(own), lang, word, pa.array(held.values(), pa.int64())]
        bounds = pa.array(np.r_[starts, len(own)], pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, c.take(pa.array(order))) for c in flat]
        return pa.RecordBatch.from_arrays([pa.array(buckets), *lists], names=["bucket", "id", "lang", "word", "n"])

    def cut(batches):
        held: Counter = Counter()  # of a task, told when it is full
        for chunk in _chunks(batches):
            for lang, pieces in chunk.items():
                places, words, lengths, times = _numbered(pieces)
                n = np.bincount(words, np.repeat(times, lengths), len(places)).astype(np.int64)
                del words
                spelled = np.fromiter(places, object, len(places))
                held[lang, None] += int(n.sum())
                if wanted is not None:
                    own = np.isin(_ids(places, lang, seed), wanted)
                    spelled, n = spelled[own], n[own]
                for word, count in zip(spelled.tolist(), n.tolist()):
                    held[lang, word] += count
            if len(held) > HELD_WORDS:
                yield told(held)
                held.clear()
        if held:
            yield told(held)

    def add_up(batches):
        at, held = None, Counter()
        for rows in batches:
            for bucket, *lists in zip(*rows.columns):
                bucket = bucket.as_py()
                if bucket != at and held:
                    yield summed(held)
                    held.clear()
                at = bucket
                for own, lang, word, n in zip(*(x.as_py() for x in lists)):
                    held[own, lang, word] += n
        if held:
            yield summed(held)

    def summed(held: Counter):
        columns = [*zip(*held), tuple(held.values())]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "lang", "word", "n"])

    packed = "bucket long, id array<long>, lang array<string>, word array<string>, n array<long>"
    found = in_arrow(_given(documents), cut, packed).repartition("bucket").sortWithinPartitions("bucket")
    return in_arrow(found, add_up, "id long, lang string, word string, n long")


def hot_beginnings(documents: DataFrame, longest: int, seed: int) -> np.ndarray:
    """Numbers of the two-word beginnings that hold more than ``HOT_SHARE`` of the edges of some documents.

    About ``LOOKED_AT`` documents, drawn by a hash of their text. Only the way the edges are dealt out
    depends on the answer, as with the bounds of a range partitioning; at most 1 / HOT_SHARE numbers return.
    """
    share = min(1.0, LOOKED_AT / max(1, documents.count()))
    drawn = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_003)) < share * 1_000_003
    cut = edges(documents.where(drawn), longest, seed)
    seen = Observation()
    counted = cut.groupBy("w0", "w1").agg(F.count(F.lit(1)).alias("edges")).observe(seen, F.sum("edges").alias("total"))
    most = counted.orderBy(F.desc("edges")).limit(int(1 / HOT_SHARE)).collect()  # fewer than these can have more than the share
    total = seen.get["total"] or 0
    found = [r for r in most if r["edges"] > max(64, total * HOT_SHARE)]
    return np.unique(_beginning(*(np.array([r[i] for r in found], np.int64) for i in (0, 1))))


def flows(cut: DataFrame, longest: int, least: int) -> DataFrame:
    """gram (array of word ids) and n of all runs of 2 to ``longest`` words that occur ``least`` times.

    In a sorted partition the edges and corrections that begin with a run are neighbours, so each
    level's counts are sums over stretches. What is held over from one batch to the next is one
    sum a level. Salted beginnings are summed up to one row a salt and put together afterwards.
    """
    names = [f"w{k}" for k in range(longest)]

    def stretches(batches):
        held: dict[int, tuple] = {}

        def told(keys: list[np.ndarray], n: np.ndarray, salt: np.ndarray):
            k = len(keys)
            good = (keys[-1] != 0) & ((n >= least) | (salt != 0) & (k == 2))
            m = int(good.sum())
            values = np.stack([key[good] for key in keys], axis=1).ravel()
            grams = pa.ListArray.from_arrays(pa.array(np.arange(0, k * m + 1, k), pa.int32()), pa.array(values))
            return pa.RecordBatch.from_arrays([grams, pa.array(n[good])], names=["gram", "n"])

        for rows in batches:
            if not rows.num_rows:
                continue
            *words, salt, n = (c.to_numpy(zero_copy_only=False) for c in rows.columns)
            new = np.r_[True, salt[1:] != salt[:-1]]
            for k in range(1, longest + 1):
                new = new | np.r_[True, words[k - 1][1:] != words[k - 1][:-1]]
                if k == 1:
                    continue
                starts = np.flatnonzero(new)
                keys, of, sums = [w[starts] for w in words[:k]], salt[starts], np.add.reduceat(n, starts)
                if k in held:
                    *key, at, so_far = held[k]
                    if at == of[0] and all(x == y[0] for x, y in zip(key, keys)):
                        sums[0] += so_far
                    else:
                        keys = [np.r_[x, y] for x, y in zip(key, keys)]
                        of, sums = np.r_[at, of], np.r_[so_far, sums]
                held[k] = (*[key[-1] for key in keys], of[-1], sums[-1])
                yield told([key[:-1] for key in keys], sums[:-1], of[:-1])
        for k, (*key, at, so_far) in held.items():
            yield told([np.array([x]) for x in key], np.array([so_far]), np.array([at]))

    dealt = cut.repartition("w0", "w1", "salt").sortWithinPartitions(*names)
    found = in_arrow(dealt.select(*names, "salt", "n"), stretches, "gram array<long>, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def counted(documents: DataFrame, longest: int, least: int, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """The stored frequent runs (gram, n), single words too, and the stored words of theirs with every language's total.

    The seed of the ids is one under which no word of a frequent run shares its id with another
    word, so that ids stand for words exactly.
    """
    with bounded_batches(documents.sparkSession):
        for seed in range(most):
            hot = hot_beginnings(documents, longest, seed)
            runs = staged(flows(edges(documents, longest, seed, hot), longest, least), "runs")
            ids = runs.select(F.explode("gram").alias("id")).distinct()
            if ids.count() <= MOST_SENT:
                wanted = np.sort(np.array([r[0] for r in ids.toLocalIterator()], np.int64))
                words = lexicon(documents, seed, wanted)
            else:
                every = lexicon(documents, seed)
                words = every.join(ids, "id", "left_semi").union(every.where("id = 0"))
            words = staged(words, "words")
            if words.where("id <> 0").groupBy("id").count().where("count > 1").isEmpty():
                single = words.where("id <> 0").select(F.array("id").alias("gram"), "n")
                return runs.union(single), words
    raise RuntimeError("Two words share an id under every seed.")


def _first(gram: Column | str, k: Column) -> Column:
    return F.slice(gram, F.lit(1), k)


def _last(gram: Column | str, k: Column) -> Column:
    return F.slice(gram, F.size(gram) - k + 1, k)


def nodes(counts: DataFrame) -> DataFrame:
    """gram, n, came and went: the largest counts of runs one word longer that end and that begin with it (0: none).

    The run is inside an unary path if both equal n.
    """
    size = F.size("gram")
    longer = counts.where(size > 2).select(
        "n", F.posexplode(F.array(_first("gram", size - 1), _last("gram", size - 1))).alias("side", "part")
    )
    around = longer.groupBy("part").agg(
        F.max(F.when(F.col("side") == 1, F.col("n"))).alias("came"), F.max(F.when(F.col("side") == 0, F.col("n"))).alias("went")
    )
    joined = counts.where(size > 1).join(around, F.col("gram") == F.col("part"), "left")
    return joined.select("gram", "n", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("came", "went")])


def _spelled(rows: DataFrame, words: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, lang and phrase of rows with a distinct array ``gram`` of word ids."""
    single = rows.select("gram", *keep, F.posexplode("gram").alias("at", "id"))
    named = single.join(words.select("id", "lang", "word"), "id")
    ordered = F.array_sort(F.collect_list(F.struct("at", "word")))
    return (
        named.groupBy("gram", *keep)
        .agg(F.first("lang").alias("lang"), ordered.alias("own"))
        .select(*keep, "lang", F.array_join(F.transform("own", lambda x: x["word"]), " ").alias("phrase"))
    )


def scored(kept: DataFrame, counts: DataFrame) -> DataFrame:
    """gram, a, and l, r and score of the cut that scores lowest (of equal ones the first)."""
    size = F.size("gram")
    cuts = kept.select("gram", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("at"))
    cuts = cuts.select("gram", "a", "at", _first("gram", F.col("at")).alias("head"), _last("gram", size - F.col("at")).alias("tail"))
    left = counts.select(F.col("gram").alias("head"), F.col("n").alias("l"))
    right = counts.select(F.col("gram").alias("tail"), F.col("n").alias("r"))
    whole = cuts.join(left, "head").join(right, "tail")
    wide = {c: f"cast({c} as decimal(13,0))" for c in ("a", "l", "r")}  # products of up to 33 digits stay exact
    score = F.expr(f"({wide['a']} * {wide['a']} * cast(1000000 as decimal(7,0))) div ({wide['l']} * {wide['r']})")
    lowest = F.min(F.struct(score.cast("long").alias("score"), "at", "l", "r")).alias("cut")
    return whole.groupBy("gram", "a").agg(lowest).select("gram", "a", "cut.l", "cut.r", "cut.score")


def mined(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, best: int = BEST
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to ``longest`` words.

    a, l and r count the phrase and both sides of its weakest cut, n all words of the language.
    A phrase inside a longer one with at least ``share`` percent of its count is left out; as no
    run occurs more often than one inside it, looking one word further is enough. Equal scores are
    ordered by a, then by phrase.

    A null or empty text, and one without words, has none; a null lang is ``und``, together with
    documents that say so. Repeated rows count as often as they are there; doc_id is not read, nor
    are other columns. An empty table gives no rows. Texts of any length are read whole.
    """
    if not 2 <= longest or not 0 <= share <= 100 or least < 1:
        raise ValueError("Phrases have two words or more, a share is between 0 and 100, and counts begin at 1.")
    counts, words = counted(documents, longest, least)
    linked = nodes(counts)
    folded = linked.where(~((F.col("came") == F.col("n")) & (F.col("went") == F.col("n"))))
    longer = F.greatest("came", "went")
    kept = folded.where((longer == 0) | (100 * longer < share * F.col("n")))
    found = _spelled(scored(kept, counts), words, ["a", "l", "r", "score"])
    totals = words.where("id = 0").select("lang", "n")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def paths(documents: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, n_words and n of the unary paths of the frequent graph: wordings that repeat as a whole.

    Edges that meet in an unary node have one count and follow each other alone, so a path is
    found by pointer doubling over edges, in as many rounds as the longest path has binary digits.
    Every frequent edge is in exactly one path. A path lies inside single pieces, which bounds it.
    Nulls, empty texts and repeated rows as in ``mined``.
    """
    counts, words = counted(documents, longest, least)
    unary = nodes(counts).where((F.col("came") == F.col("n")) & (F.col("went") == F.col("n"))).select(F.col("gram").alias("node"))
    own = counts.where(F.size("gram") == longest)
    short = F.lit(longest - 1)
    before = own.select(F.col("gram").alias("prior"), F.col("n").alias("prior_n"), _last("gram", short).alias("node"))
    follows = own.withColumn("node", _first("gram", short)).join(unary, "node").join(before, "node")
    follows = follows.where(F.col("n") == F.col("prior_n")).select("gram", "prior")
    reach = own.join(follows, "gram", "left").select(
        "gram", "n", F.coalesce("prior", "gram").alias("head"), F.when(F.col("prior").isNull(), 0).otherwise(1).cast("long").alias("steps")
    )
    reach, doubled = staged(reach, "reach"), 1
    while True:
        further = reach.select(F.col("gram").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        reach = staged(reach.join(further, "head").select("gram", "n", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps")), "reach")
        doubled *= 2
        if reach.where(F.col("steps") >= doubled).isEmpty():
            break
    added = F.array_sort(F.collect_list(F.struct("steps", F.element_at("gram", -1).alias("word"))))
    whole = reach.groupBy("head", "n").agg(added.alias("own"))
    run = F.concat(_first("head", short), F.transform("own", lambda x: x["word"]))
    spelled = _spelled(whole.select(run.alias("gram"), "n", (F.size("own") + longest - 1).alias("n_words")), words, ["n", "n_words"])
    return spelled.select("lang", "phrase", "n_words", "n")
