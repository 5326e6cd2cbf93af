"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Each text becomes its set of hashed five-word shingles, a digest of that set and a
   signature of MinHash values. Texts of one set are a class; classes are what is compared.
2. The forest has several orders of the signature. Each order starts with ``base`` functions
   that no other order starts with and goes on through the rest. All (order, signature) rows
   are sorted by range, so no region of equal prefix has to fit one task. Inside a region of
   equal ``base`` values the next ``near`` rows, those of the longest common prefix, are
   candidates; a region of at most ``near`` + 1 rows is thereby done.
3. A larger region is taken deeper: its rows are sorted by the whole signature and cut into
   runs, each row's best partners of its run are candidates, and the most central rows
   of all runs are candidates of every row of the region.
4. Candidate pairs that pass the length bound are confirmed on the full sets.
5. Components come from rounds of star contraction; each round is a written table.
6. Large regions whose rows are still in several components are compared whole. Shingles that no
   other text of such regions has bound what a text can share, which rules most texts out. The rest
   outside the region's largest component, in packs of bounded size, meet every pack of the region
   with their full sets. Pairs of different components whose signatures agree in at least ``WHOLE`` of
   their values are confirmed there; one link of a row with a component is enough. So no link
   depends on a number of partners.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roadgrain.llm.common import bounded_batches, free_name, in_arrow, small, staged

SHINGLE = 5
FUNCTIONS = 64
BASE = 3
ORDERS = 21
DEPTH = 8
NEAR = 7
RUN = 2_000
PARTNERS = 6
FLOOR = 0.55
WHOLE = 0.5
PACK = 512
PACK_SHINGLES = 250_000
SALTS = 32

_seeds = np.random.default_rng(20_240_229)
_FACTORS = _seeds.integers(1, 2**63, FUNCTIONS, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _seeds.integers(0, 2**63, FUNCTIONS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _seeds.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles, of the whole sequence if shorter.

    A-Z count as a-z, words are parted by ASCII white space. Null and wordless texts have none.
    """
    pieces = (text or "").encode("utf-8", "replace").lower().split()
    if not pieces:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64, len(pieces))
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        total = (total + h[j : j + len(total)]) * _PLACES[j % 64]
        total ^= total >> np.uint64(29)
    return np.unique(total * _MIX)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(FUNCTIONS, 2**32 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096]
        low = np.minimum(low, ((_FACTORS[:, None] * block + _SHIFTS[:, None]) >> np.uint64(32)).min(1))
    return low.astype(">u4")


def _order(k: int) -> np.ndarray:
    """Functions of the k-th order: its own BASE first, then the others by rotation."""
    own = np.arange(k * BASE, (k + 1) * BASE)
    rest = np.roll(np.setdiff1d(np.arange(FUNCTIONS), own), -7 * k)
    return np.r_[own, rest]


def _signed(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), d1, d2 (digest of the set), sig."""

    def sign(batches):
        for rows in batches:
            n, d1, d2, sig = [], [], [], []
            for text in rows.column(1):
                hashes = shingles(text.as_py(), size)
                digest = xxhash.xxh3_128_digest(hashes.tobytes())
                n.append(len(hashes))
                d1.append(int.from_bytes(digest[:8], "big", signed=True))
                d2.append(int.from_bytes(digest[8:], "big", signed=True))
                sig.append(signature(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.array(sig, pa.binary()),
                ],
                names=["doc_id", "n", "d1", "d2", "sig"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(rows, sign, "doc_id long, n long, d1 long, d2 long, sig binary")


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary cell for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    at = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(rows.tobytes())])


def _found(kind: str, a, b=None, tree=None, region=None) -> pa.RecordBatch:
    """Rows of _FOUND of one kind; columns that are not given are null."""
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n, pa.string()),
            pa.nulls(n, pa.int32()) if tree is None else pa.array(tree, pa.int32()),
            pa.nulls(n, pa.binary()) if region is None else region,
            pa.array(a, pa.int64()),
            pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()),
        ],
        names=["kind", "tree", "region", "a", "b"],
    )


_FOUND = "kind string, tree int, region binary, a long, b long"


def _planted(classes: DataFrame) -> DataFrame:
    """A row for each class and order: tree, prefix (DEPTH values, big-endian), rep, n."""
    orders = [_order(k)[:DEPTH] for k in range(ORDERS)]

    def plant(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            sigs = np.frombuffer(b"".join(rows.column(2).to_pylist()), ">u4").reshape(-1, FUNCTIONS)
            for k, order in enumerate(orders):
                tree = pa.array(np.full(len(sigs), k, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [tree, _binary(sigs[:, order]), rows.column(0), rows.column(1)],
                    names=["tree", "prefix", "rep", "n"],
                )

    return in_arrow(classes.select("rep", "n", "sig"), plant, "tree int, prefix binary, rep long, n long")


def _neighbours(planted: DataFrame, percent: int) -> DataFrame:
    """Pairs of neighbours ('pair': a, b) and members of regions to go deeper into ('deep': a).

    A region cut by the border of a partition goes deeper too, whatever its size.
    """

    def look(batches):
        rows = [x for x in batches if x.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        tree, rep, n = (table[c].to_numpy() for c in ("tree", "rep", "n"))
        prefix = np.frombuffer(b"".join(table["prefix"].to_pylist()), ">u4").reshape(-1, DEPTH)
        key = np.c_[tree, prefix[:, :BASE]]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        size = np.diff(np.r_[first, len(rep)])
        deep = size > NEAR + 1
        deep[[0, -1]] = True
        group, member = np.repeat(np.arange(len(size)), size), np.repeat(deep, size)
        pairs = [np.empty((0, 2), np.int64)]
        for step in range(1, min(NEAR + 1, len(rep))):
            at = np.flatnonzero((group[step:] == group[:-step]) & ~member[step:])
            one, other = rep[at], rep[at + step]
            small, large = np.minimum(n[at], n[at + step]), np.maximum(n[at], n[at + step])
            fits = (100 * small >= percent * large) & (one != other)
            pairs.append(np.c_[np.minimum(one, other), np.maximum(one, other)][fits])
        pairs = np.unique(np.concatenate(pairs), axis=0)
        if len(pairs):
            yield _found("pair", pairs[:, 0].copy(), pairs[:, 1].copy())
        where = np.flatnonzero(member)
        yield _found("deep", rep[where], tree=tree[where], region=_binary(prefix[where, :BASE]))

    order = ["tree", "prefix", "rep"]
    return in_arrow(planted.repartitionByRange(*order).sortWithinPartitions(*order), look, _FOUND)


def _partners(sigs: np.ndarray, rep: np.ndarray, n: np.ndarray, percent: int) -> tuple[set, int, int]:
    """Best partners of each row of one run by agreement of signatures, the most central row and its weight."""
    agree = np.zeros((len(rep), len(rep)), np.uint8)
    for f in range(FUNCTIONS):
        agree += sigs[:, f][:, None] == sigs[:, f][None, :]
    small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    agree[(100 * small < percent * large) | (rep[:, None] == rep[None, :])] = 0
    k = min(PARTNERS, len(rep) - 1)
    best = np.argpartition(agree, len(rep) - 1 - k, axis=1)[:, len(rep) - k :]
    pairs = {
        (min(rep[i], rep[j]), max(rep[i], rep[j]))
        for i, row in enumerate(best)
        for j in row[agree[i, row] >= FLOOR * FUNCTIONS]
    }
    centre = agree.sum(1, dtype=np.int64)
    top = int(np.argmax(centre))
    return pairs, int(rep[top]), int(1000 * min(len(rep), 64) * centre[top] // max(1, len(rep) - 1))


def _deeper(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs inside large or cut regions, and a 'centre' row for each run (a: row, b: its weight)."""

    def look(batches):
        pairs, centres, held = set(), [], []

        def run():
            if held:
                sigs = np.frombuffer(b"".join(x[4] for x in held), ">u4").reshape(-1, FUNCTIONS)
                rep, n = np.array([x[2] for x in held]), np.array([x[3] for x in held])
                own, top, weight = _partners(sigs, rep, n, percent)
                pairs.update(own)
                centres.append((*held[0][:2], top, weight))
                held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (held[0][:2] != row[:2] or len(held) >= RUN):
                    run()
                held.append(row)
        run()
        if pairs:
            yield _found("pair", [int(a) for a, _ in pairs], [int(b) for _, b in pairs])
        if centres:
            tree, region, rep, weight = zip(*centres)
            yield _found("centre", rep, weight, tree, pa.array(region, pa.binary()))

    rows = members.join(classes, "rep").select("tree", "region", "rep", "n", "sig")
    order = ["tree", "region", "sig", "rep"]
    return in_arrow(rows.repartitionByRange(*order).sortWithinPartitions(*order), look, _FOUND)


def candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a < b) of classes with rep, n and sig; and tree, region, rep of large regions."""
    found = staged(_neighbours(_planted(classes), percent), "forest")
    members = found.where("kind = 'deep'").select("tree", "region", F.col("a").alias("rep"))
    deeper = staged(_deeper(members, classes, percent), "forest-deep")
    centres = (
        deeper.where("kind = 'centre'")
        .groupBy("tree", "region")
        .agg(F.count("*").alias("runs"), F.max(F.struct("b", "a"))["a"].alias("centre"))
        .where("runs > 1")
        .select("tree", "region", "centre", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    spokes = (
        members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
        .join(centres, ["tree", "region", "salt"])
        .where("rep <> centre")
        .select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    )
    pairs = found.where("kind = 'pair'").select("a", "b").unionByName(deeper.where("kind = 'pair'").select("a", "b"))
    return pairs.unionByName(spokes).distinct(), members


def _unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """tree, region, rep, root, main (the largest component) of regions with more than one component."""
    named = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = staged(named.withColumn("root", F.coalesce("root", "rep")), "forest-named")
    regions = (
        named.groupBy("tree", "region", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("tree", "region")
        .agg(F.sum("n").alias("total"), F.max(F.struct("n", "root")).alias("main"))
        .where("total > main.n")
        .select("tree", "region", F.col("main.root").alias("main"))
    )
    return staged(_with_region(named, regions), "unresolved")


def _with_region(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows joined to the one row of their region, salted, as one region may hold a third of all rows."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    return salted.join(regions.select("*", salts), ["tree", "region", "salt"]).drop("salt")


def _able(rows: DataFrame, texts: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """rep, n, sig, common, s (the set) of those rows whose texts can have a link at all.

    common is the number of shingles that another of the texts has too; no intersection can be
    larger. Shingles are told apart by 32 bits, which can only make common too large.
    """
    wanted = small(staged(rows.select("rep").distinct(), "unresolved-reps"), 16)
    sets = staged(_sets(texts, wanted, size), "unresolved-sets")
    own = (
        sets.select("rep", F.explode("s").alias("h"))
        .groupBy(F.col("h").bitwiseAND(2**31 - 1).cast("int").alias("h"))
        .agg(F.count("*").alias("copies"), F.min("rep").alias("rep"))
        .where("copies = 1")
        .groupBy("rep")
        .agg(F.count("*").alias("own"))
    )
    common = F.col("n") - F.coalesce("own", F.lit(0))
    held = classes.join(wanted, "rep", "left_semi").join(own, "rep", "left").withColumn("common", common)
    held = staged(held.where(100 * F.col("common") >= percent * F.col("n")).drop("own"), "able")
    return staged(sets.join(held, "rep"), "able-sets")


def _packed(rows: DataFrame, able: DataFrame) -> DataFrame:
    """Packs (tree, region, pack, loose, packs, rows) of the able rows of unresolved regions.

    Packs 0 to loose - 1 hold the rows outside the largest component, the others its rows. Rows are
    spread by a hash, so a pack has about PACK rows and PACK_SHINGLES shingles at most, however large its region.
    """
    rows = staged(rows.join(able.select("rep", "n"), "rep"), "able-rows")
    outside = F.col("root") != F.col("main")

    def packs(side: str):
        return F.greatest(F.ceil(F.col(side) / PACK), F.ceil(F.col(side + "_n") / PACK_SHINGLES))

    regions = (
        rows.groupBy("tree", "region")
        .agg(
            F.count_if(outside).alias("out"),
            F.count_if(~outside).alias("within"),
            F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("out_n"),
            F.coalesce(F.sum(F.when(~outside, F.col("n"))), F.lit(0)).alias("within_n"),
        )
        .where("out > 0 AND out + within > 1")
        .select("tree", "region", packs("out").alias("loose"), packs("within").alias("tight"))
    )
    spread = F.xxhash64("rep", F.lit(11))
    within = F.col("loose") + F.pmod(spread, F.greatest("tight", F.lit(1)))
    return (
        _with_region(rows, regions)
        .withColumn("pack", F.when(outside, F.pmod(spread, F.col("loose"))).otherwise(within))
        .withColumn("packs", F.col("loose") + F.col("tight"))
        .drop("n")
        .join(able, "rep")
        .groupBy("tree", "region", "pack", "loose", "packs")
        .agg(F.collect_list(F.struct("rep", "root", "n", "common", "sig", "s")).alias("rows"))
    )


def _whole_regions(packs: DataFrame, percent: int) -> DataFrame:
    """Links (a < b) of rows of different components that share a region; one of a row with a component."""

    def compare(batches):
        for batch in batches:
            for tree, one, other in zip(*(batch.column(c) for c in range(3))):
                a, b = _sides(one), _sides(other)
                agree = np.zeros((len(a[0]), len(b[0])), np.uint8)
                known = np.zeros(agree.shape, bool)
                equal = []
                for f in range(FUNCTIONS):
                    equal.append(a[4][:, f][:, None] == b[4][:, f][None, :])
                    agree += equal[-1]
                    if len(equal) == BASE:
                        if f // BASE < tree.as_py():
                            known |= np.logical_and.reduce(equal)
                        equal = []
                low, high = np.minimum(a[2][:, None], b[2][None, :]), np.maximum(a[2][:, None], b[2][None, :])
                fits = (agree >= WHOLE * FUNCTIONS) & (100 * low >= percent * high) & (a[1][:, None] != b[1][None, :])
                most = np.minimum(a[3][:, None], b[3][None, :])
                fits &= (100 + percent) * most >= percent * (low + high)
                found, joined = [], set()
                for i, j in zip(*np.nonzero(fits & ~known)):
                    if (i, b[1][j]) in joined:
                        continue
                    both = len(np.intersect1d(a[5][i], b[5][j], assume_unique=True))
                    if 100 * both >= percent * (a[2][i] + b[2][j] - both):
                        joined.add((i, b[1][j]))
                        found.append((a[0][i], b[0][j]))
                if found:
                    x, y = np.array(found, np.int64).T
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"]
                    )

    # A loose pack meets itself, the loose packs after it and all packs of the largest component.
    loose = packs.where("pack < loose").withColumn("other", F.explode(F.sequence("pack", F.col("packs") - 1)))
    others = packs.select("tree", "region", F.col("pack").alias("other"), F.col("rows").alias("others"))
    met = loose.join(others, ["tree", "region", "other"]).select("tree", "rows", "others")
    return in_arrow(met, compare, "a long, b long").distinct()


def _sides(rows) -> tuple[np.ndarray, ...]:
    """rep, root, n, common, signatures and sets of one pack."""
    *numbers, sig, sets = rows.values.flatten()
    sigs = np.frombuffer(b"".join(sig.to_pylist()), ">u4").reshape(-1, FUNCTIONS)
    return *(x.to_numpy() for x in numbers), sigs, [s.values.to_numpy() for s in sets]


def _sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """rep and set of the wanted documents only."""

    def cut(batches):
        for rows in batches:
            reps, sets, held = [], [], 0
            for rep, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                reps.append(rep)
                sets.append(shingles(text.as_py(), size).view(np.int64))
                held += len(sets[-1])
                if held > 1_000_000:
                    yield batch(reps, sets)
                    reps, sets, held = [], [], 0
            if reps:
                yield batch(reps, sets)

    def batch(reps, sets):
        at = np.zeros(len(sets) + 1, np.int32)
        np.cumsum([len(s) for s in sets], out=at[1:])
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))
        return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), lists], names=["rep", "s"])

    rows = texts.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep", "left_semi")
    return in_arrow(rows, cut, "rep long, s array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets share at least ``percent`` % of their union."""
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
        .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
        .select("a", "b")
    )


def _linked(texts: DataFrame, pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """The candidate pairs that are links."""
    wanted = small(staged(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "wanted"), 16)
    return confirmed(pairs, staged(_sets(texts, wanted, size), "sets"), percent)


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node (root) that the links (a, b) lead to; nodes without links are left out.

    Rounds of large star and small star: the neighbours of a node are hung on the smallest of
    them until no edge changes. A hub costs one partial minimum per task, never a gathered list.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while state != (state := _state(edges)):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large")
        down = staged(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        hung = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = large.join(down, "u").select(hung.alias("e")).select("e.*").where("u <> v").distinct()
        edges = staged(small, "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_duplicates(documents: DataFrame, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Rows link if their shingle sets share at least ``percent`` % (75 or more) of the union.
    component_id is the smallest doc_id that links lead to; kept where it is the row's own.
    Null, empty and wordless texts have no set, link with nothing and are kept, as are rows with
    a null doc_id, whose component is null. Repeated rows each get a row; an id with several
    texts should not occur, each row then follows the copies of its own text. Only doc_id
    and text are read. An empty table gives no rows.
    """
    texts = documents.select("doc_id", "text")
    with bounded_batches(documents.sparkSession):
        base = staged(_signed(texts, size), "signed")
    linked = base.where("n > 0 AND doc_id IS NOT NULL")
    groups = staged(linked.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")), "classes")
    classes = linked.join(groups, ["d1", "d2"]).where("doc_id = rep").dropDuplicates(["rep", "d1", "d2"])
    classes = staged(classes.select("rep", "n", "sig"), "reps")
    pairs, members = candidates(classes, percent)
    pairs = staged(pairs, "pairs")
    roots = components(_linked(texts, pairs, percent, size))
    unresolved = _unresolved(members, roots)
    packs = staged(_packed(unresolved, _able(unresolved, texts, classes, percent, size)), "packs")
    rest = staged(_whole_regions(packs, percent), "rest")
    if not rest.isEmpty():
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.unionByName(rest))
    named = (
        groups.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .where("members > 1 OR root IS NOT NULL")
        .select("d1", "d2", F.coalesce("root", "rep").alias("root"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    return (
        base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(named, ["d1", "d2", "salt"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def drop_near_duplicates(documents: DataFrame, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """One document of each group, the one with the smallest id; all columns stay.

    Of rows that repeat an id one stays. Rows with a null id all stay.
    """
    found = near_duplicates(documents, percent, size)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(free_name(documents, "gone_id"))).distinct()
    gone = small(staged(gone, "gone"), 16)
    rows = documents.join(gone, documents["doc_id"] == gone[gone.columns[0]], "left_anti")
    repeated = (
        documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").limit(1).count()
    )
    if not repeated:
        return rows
    return rows.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).unionByName(
        rows.where(F.col("doc_id").isNull())
    )
