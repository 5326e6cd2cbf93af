"""The registered queries of the training-data operators, each over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgrain.llm import (
    collocations,
    credentials,
    decontam,
    fingerprints,
    langid,
    mixing,
    neardup,
    pii,
    quality,
    tokencount,
    tokens,
    toxicity,
    vectorcode,
)
from roadgrain.llm.common import held_out, table

MIX_WEIGHTS = {"clean": 0.90, "poor": 0.07, "toxic": 0.03}
PII_KEY = "pseudonym key of the registered query"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    return _judged(quality.scored(documents.select("doc_id", "text"), model), quality.THRESHOLD)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predicted(documents, langid.fit(documents))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.domains(table(spark, sf_dir, "labels"))
    found, rates = mixing.mix(table(spark, sf_dir, "documents"), labelled, MIX_WEIGHTS)
    shares = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(rates.names)]
    return found.select("doc_id", "n_tokens", *shares, "rate", "n_copies")


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return found.select("doc_id", "text", *[f"n_{k}" for k in pii.KINDS])


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_live", "n_examples"
    )


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(documents.select("doc_id", "text"), model), 0.5)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokencount.counted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, book = vectorcode.compressed(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(vectorcode.book_digest(book)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


_WORDS_SQL = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[pos:pos + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS pos FROM b WHERE len(w) > 0)),
place AS (SELECT doc_id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos
    FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, pos, n, item_id FROM place JOIN win USING (n, words)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NEAREST_SQL = """a{k} AS (SELECT vec_id, part, s, unnest(arg_min({{'entry': entry, 'd': d, 'c': c}}, d * 64 + entry, 1)) AS best FROM (
  SELECT vec_id, part, s, entry, c, list_sum([(s[i] - c[i]) * (s[i] - c[i]) for i in range(1, len(s) + 1)]) AS d
  FROM p JOIN c{k} USING (part)) GROUP BY vec_id, part, s)"""
_MEANS_SQL = """m{k} AS (SELECT part, entry, list(mean ORDER BY i) AS c FROM (
  SELECT part, best.entry AS entry, i, CAST((sum(s[i]) - (sum(s[i]) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
  FROM (SELECT part, best, s, unnest(range(1, len(s) + 1)) AS i FROM a{k}) GROUP BY part, best.entry, i) GROUP BY part, entry),
c{n} AS (SELECT part, entry, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (part, entry))"""

OP12_SQL = f"""
WITH v AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT vec_id, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS s
  FROM (SELECT vec_id, q, unnest(range(0, 16)) AS part FROM v)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, s AS c FROM p
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)),
{_NEAREST_SQL.format(k=0)},
{_MEANS_SQL.format(k=0, n=1)},
{_NEAREST_SQL.format(k=1)},
{_MEANS_SQL.format(k=1, n=2)},
{_NEAREST_SQL.format(k=2)},
e AS (SELECT vec_id, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id),
t AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM e JOIN v USING (vec_id) GROUP BY label),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT e.vec_id, code, error, label_error, codebooks_sha256
FROM e JOIN v USING (vec_id) JOIN t ON t.label IS NOT DISTINCT FROM v.label CROSS JOIN h
"""

OP13_SQL = r"""
WITH piece AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, range(1, 4) ks(k) WHERE len(w) >= k)
  GROUP BY ALL),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
total AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
inside AS (SELECT lang, part, max(a) AS longer FROM (
  SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM cand WHERE k = 3) GROUP BY lang, part),
cuts AS (SELECT lang, k, phrase, a, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS i FROM cand)),
rated AS (SELECT c.lang, c.k, c.phrase, c.a, i, hd.a AS l, tl.a AS r,
    1000000::HUGEINT * c.a * c.a // (hd.a::HUGEINT * tl.a) AS score
  FROM cuts c JOIN f hd ON hd.lang = c.lang AND hd.phrase = c.head AND hd.k = c.i
  JOIN f tl ON tl.lang = c.lang AND tl.phrase = c.tail AND tl.k = c.k - c.i),
lowest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT lo.lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lo.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest lo LEFT JOIN inside s ON s.lang = lo.lang AND s.part = lo.phrase
  WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a) JOIN total USING (lang)
WHERE rank <= 2000
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language": op4_language,
    "op5_mixing": op5_mixing,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_fingerprints": op7_fingerprints,
    "op8_secrets": op8_secrets,
    "op9_token_ids": op9_token_ids,
    "op10_toxicity": op10_toxicity,
    "op11_token_counts": op11_token_counts,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}
SQL = {"op1_decontamination": OP1_SQL, "op12_vector_codes": OP12_SQL, "op13_collocations": OP13_SQL}
