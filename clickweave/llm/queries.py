"""The operators as named queries with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (
    bpe,
    digests,
    jaccard_join,
    license_scan,
    materialise,
    mixing,
    neighbours,
    periodic_runs,
    quality,
    resampling,
    secret_scan,
    shards,
    substring_dedup,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.quality_rules(docs, labels, columns=["doc_id"]).drop("row")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, vocabulary, public_tokenizers.PATTERN)


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_spans(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.balanced_shards(_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


@query
def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    return materialise.write_shards(docs, vocabulary, public_tokenizers.PATTERN).drop("file")


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("row")


def _with_periods(docs: DataFrame) -> DataFrame:
    """The documents, with the words of one in ten replaced by a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", quality.SPACE), "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    # Exploded so that the words are split once, not for every word that is looked up.
    rows = rows.select("doc_id", "text", "h", F.explode(F.array("words")).alias("words"))
    rows = rows.selectExpr("doc_id", "text", "words", "h div 10 AS g", "size(words) AS n")
    rows = rows.selectExpr("*", "if(n > 0, cast(g % n AS int), 0) AS a")
    rows = rows.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) AS int) AS p")
    edited = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_with_periods(_table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("*", longest.alias("longest")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-longest.s").alias("start"),
        F.col("longest.length").alias("length"),
        F.expr("-longest.p").alias("period"),
        F.expr("1000 * longest.length div -longest.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target).drop("n_words")


@query
def op13_document_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return digests.compare_spliced(docs, digests.entropy_ranks(docs))


ORACLE_SQL["op6_substring_dedup"] = r"""
WITH split AS (
  SELECT doc_id, [w for w in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] AS words
  FROM documents
),
windows AS (
  SELECT doc_id, i, words[i : i + 12] AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)
),
earliest AS (SELECT run, min(doc_id) AS first_doc FROM windows GROUP BY run),
found AS (
  SELECT doc_id, i FROM windows JOIN earliest USING (run) WHERE first_doc < doc_id
),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM found),
removed AS (SELECT doc_id, count(*) AS n, list(i) AS places FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN words ELSE
    [words[k] for k in range(1, len(words) + 1) if NOT list_contains(places, k)] END, ' '), '')) AS kept_sha256
FROM split LEFT JOIN removed USING (doc_id)
"""

ORACLE_SQL["op7_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, [w for w in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') if w <> ''] AS words
  FROM documents
),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [words]
    ELSE [words[i : i + 4] for i in range(1, len(words) - 3)] END)) AS shingles
  FROM split
),
classes AS (
  SELECT row_number() OVER () AS class, shingles, len(shingles) AS size, min(doc_id) AS first_id
  FROM sets WHERE len(shingles) > 0 GROUP BY shingles
),
items AS (SELECT class, size, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.class AS one, b.class AS other
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.class <> b.class
  GROUP BY a.class, b.class
  HAVING 100 * count(*) >= 75 * (any_value(a.size) + any_value(b.size) - count(*))
),
reached AS (
  SELECT class AS start, class AS class FROM classes
  UNION
  SELECT start, other FROM reached JOIN links ON class = one
),
labelled AS (
  SELECT start, min(first_id) AS component_id FROM reached JOIN classes USING (class) GROUP BY start
)
SELECT doc_id, CAST(len(sets.shingles) AS BIGINT) AS n_shingles,
  coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN classes ON sets.shingles = classes.shingles LEFT JOIN labelled ON class = start
"""


def _crc_table() -> str:
    """The byte table of CRC-32 (reflected polynomial 0xEDB88320) as an SQL list."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ 0xEDB88320 * (c & 1) for c in table]
    return str(table)


def _crc_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, read from its hexadecimal form."""
    places = f"range(1, 2 * strlen({text}), 2)"
    digit = "(strpos('0123456789ABCDEF', substr(hex({text}), CAST(i AS INTEGER){more}, 1)) - 1)"
    byte = f"16 * {digit.format(text=text, more='')} + {digit.format(text=text, more=' + 1')}"
    codes = f"list_transform({places}, lambda i: CAST({byte} AS BIGINT))"
    step = f"xor(c >> 8, CAST({_crc_table()}[(xor(c, b) & 255) + 1] AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


# A run of at least 6 words and 4 periods has words i .. i + 3 equal to those a period later, for as many
# neighbouring i as it has words less the period and 3.
ORACLE_SQL["op11_periodic_runs"] = rf"""
WITH split AS (
  SELECT doc_id, [w for w in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] AS words,
    CAST(doc_id AS VARCHAR) AS id
  FROM documents
),
hashed AS (SELECT doc_id, words, len(words) AS n, {_crc_sql("id")} AS h FROM split),
placed AS (
  SELECT doc_id, words, n, h, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed
),
sized AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
texts AS (
  SELECT doc_id, n, CASE WHEN n > 0 AND h % 10 = 0
    THEN [words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] for i in range(n)]
    ELSE words END AS words
  FROM sized
),
grams AS (
  SELECT doc_id, n, i, words[i + 1 : i + 4] AS gram
  FROM (SELECT doc_id, n, words, unnest(range(n - 3)) AS i FROM texts)
),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
),
candidates AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q + 3 AS l FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q + 3 >= greatest(6, 4 * q)
),
found AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.doc_id = c.doc_id AND d.q < c.q AND d.s <= c.s AND d.s + d.l >= c.s + c.l
  )
),
dropped AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (
  SELECT doc_id, unnest(range(s + q, s + l)) AS i FROM found) GROUP BY doc_id
),
best AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := s, l := l, q := q), struct_pack(x := -l, s := s, q := q)) AS b,
    string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS listed
  FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start,
  CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
  CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE [words[i + 1] for i in range(n) if NOT list_contains(gone, i)] END, ' '), '')) AS collapsed_sha256
FROM texts LEFT JOIN best USING (doc_id) LEFT JOIN dropped USING (doc_id)
"""

_FEATURES_SQL = r"""
  SELECT {key} unnest(
    words || [words[i] || ' ' || words[i + 1] for i in range(1, len(words))]
    || [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)]) AS feature
  FROM (SELECT {key} regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table})
"""

ORACLE_SQL["op12_importance_resampling"] = rf"""
WITH corpus AS MATERIALIZED ({_FEATURES_SQL.format(key="doc_id,", table="documents")}),
target AS MATERIALIZED ({_FEATURES_SQL.format(key="", table="benchmark")}),
hashed AS MATERIALIZED (
  SELECT feature, {_crc_sql("feature")} % 10000 AS bucket
  FROM (SELECT feature FROM corpus UNION SELECT feature FROM target)
),
buckets AS (SELECT unnest(range(10000)) AS bucket),
s AS (SELECT bucket, count(*) AS s FROM corpus JOIN hashed USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN hashed USING (feature) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM corpus) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS weight
  FROM corpus JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
    5 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 57
)
SELECT scored.*, CAST(CASE WHEN place <= drawn THEN place END AS BIGINT) AS rank
FROM scored LEFT JOIN (SELECT doc_id, place, drawn FROM ranked) USING (doc_id)
"""
