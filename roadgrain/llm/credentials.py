"""Secrets in texts, told apart by who owns them across the corpus; DataFrame operations only.

Fixed patterns give the base spans. Beyond them, every long token of letters and digits is a
candidate. A candidate's hash is counted over the whole corpus by the distinct repositories
and owners that hold it: what many of them share is an example that was copied around,
what few hold is live-looking and gets a span of its own, wherever it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgrain.llm.common import staged

#: Fixed patterns. Each is written as (keyword part, value part); the value is what is hashed.
PATTERNS = {
    "assign": (
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        6,
    ),
    "access": ("", r"AKIA[A-Z0-9]+", 20),
    "hex": ("", r"[0-9a-f]{24,}", 24),  # as long as the shortest that counts; longer runs match alike
    "long": ("", r"[A-Za-z0-9+/_=-]{20,}", 20),
}
BASE = ("assign", "access", "hex")
#: From so many repositories and owners on a value counts as a copied example.
MANY_REPOSITORIES, MANY_OWNERS = 4, 8
SALTS = 32


def _found(text: Column, kind: str) -> Column:
    """Array of (kind, gap, size, length of the value, hash of the value), in order of place.

    Each match is taken with the gap before it, from where the last one ended: places then
    follow from lengths, and the anchor keeps the search linear.
    """
    before, value, _ = PATTERNS[kind]
    whole = F.lit(rf"(?s)\G(.*?)({before}({value}))")
    gaps, matches, values = (F.regexp_extract_all(text, whole, F.lit(k)) for k in (1, 2, 3))
    cells = F.transform(
        F.arrays_zip(gaps.alias("g"), matches.alias("m"), values.alias("v")),
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("size"),
            F.length(x["v"]).alias("inner"),
            F.when((x["v"].rlike("[0-9]")) & (x["v"].rlike("[A-Za-z]")), F.sha2(x["v"], 256)).alias("hash"),
        ),
    )
    return F.when(text.rlike(before + value), cells)


def candidates(documents: DataFrame, repository: str = "source") -> DataFrame:
    """For each row: doc_id, digest of the text, repository and ``found``, all matches of all kinds. A null text is empty."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", F.col(repository).alias("repository"), text.alias("text"))
    nothing = F.array().cast("array<struct<kind:string,gap:int,size:int,inner:int,hash:string>>")
    found = F.concat(*[F.coalesce(_found(F.col("text"), kind), nothing) for kind in PATTERNS])
    return rows.select("doc_id", F.xxhash64("text").alias("digest"), "repository", found.alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """A row for each match that counts: doc_id, digest, repository, kind, start, end, hash (code points, end exclusive).

    Repeated rows are merged first: ends are running sums over the places of one text.
    """
    matches = found.distinct().select(
        "doc_id", "digest", "repository", F.posexplode("found").alias("place", "m")
    ).select("doc_id", "digest", "repository", "place", "m.*")
    so_far = Window.partitionBy("doc_id", "digest", "repository", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    least = F.create_map(*[x for kind, (_, _, n) in PATTERNS.items() for x in (F.lit(kind), F.lit(n))])
    return (
        matches.withColumn("end", end.cast("long"))
        .withColumn("start", F.col("end") - F.col("size"))
        .where((F.col("inner") >= least[F.col("kind")]) & ((F.col("kind") != "long") | F.col("hash").isNotNull()))
        .select("doc_id", "digest", "repository", "kind", "start", "end", "inner", "hash")
        .dropDuplicates(["doc_id", "digest", "repository", "kind", "start"])
    )


def ownership(matches: DataFrame) -> DataFrame:
    """Per hash of a value: distinct repositories and owners (documents) that hold it, and whether it is an example."""
    held = matches.where("hash IS NOT NULL")
    by_owner = held.select("hash", "repository", "doc_id", "digest").distinct()
    by_repository = by_owner.groupBy("hash", "repository").agg(F.count("*").alias("owners"))
    return (
        by_repository.groupBy("hash")
        .agg(F.count("*").alias("repositories"), F.sum("owners").alias("owners"))
        .withColumn(
            "example", (F.col("repositories") >= MANY_REPOSITORIES) & (F.col("owners") >= MANY_OWNERS)
        )
    )


def secrets(documents: DataFrame, repository: str = "source") -> DataFrame:
    """Per distinct (doc_id, text): counts of the base kinds, base and all spans, how many are live-looking or examples.

    Spans are ordered by start, then kind as listed; an added ``live`` span overlaps no base
    span. Null and empty texts have none. Repeated rows are one document and, if they name several
    repositories, are held by each. A null repository counts as one of its own.
    """
    found = staged(candidates(documents, repository), "secrets")
    matches = staged(spans(found.where(F.size("found") > 0)), "secret-spans")
    # Only what is widely held matters here, and only its few hashes are repeated over the salts.
    owned = ownership(matches).where("example").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    judged = (
        matches.withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)).cast("int"))
        .join(owned.select("hash", "salt", "example"), ["hash", "salt"], "left")
        .groupBy("doc_id", "digest")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        "start",
                        F.array_position(F.array(*map(F.lit, PATTERNS)), F.col("kind")).alias("rank"),
                        "end",
                        F.coalesce("example", F.lit(False)).alias("example"),
                    )
                )
            ).alias("all")
        )
    )
    rank_of_long = len(PATTERNS)
    base = F.filter("all", lambda s: s["rank"] < rank_of_long)
    live = F.filter(
        "all",
        lambda s: (s["rank"] == rank_of_long)
        & ~s["example"]
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    kinds = F.array(*[F.lit(k) for k in BASE], F.lit("live"))

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", kinds[s["rank"] - 1], s["start"], s["end"])), ",")

    def number(some: Column, keep) -> Column:
        return F.size(F.filter(some, keep)).cast("long")

    def ranked(k: int):
        return lambda s: s["rank"] == k

    told = judged.select(
        "doc_id",
        "digest",
        *[number(base, ranked(k + 1)).alias(f"n_{name}") for k, name in enumerate(BASE)],
        joined(base).alias("base"),
        joined(F.array_sort(F.concat(base, live))).alias("spans"),
        number(F.col("all"), lambda s: ~s["example"]).alias("n_live"),
        number(F.col("all"), lambda s: s["example"]).alias("n_examples"),
    )
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex", "n_live", "n_examples")}
    keys = found.select("doc_id", "digest").distinct()
    same = keys["doc_id"].eqNullSafe(told["doc_id"]) & (keys["digest"] == told["digest"])
    return keys.join(told, same, "left").select(
        keys["doc_id"],
        keys["digest"],
        *zero.values(),
        F.coalesce("base", F.lit("")).alias("base"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
