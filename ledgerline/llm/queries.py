"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    bpe,
    decontaminate,
    language,
    mixing,
    near_dup,
    negatives,
    pu_quality,
    rules,
    secrets,
    sharding,
    token_counts,
    variants,
    warc,
)
from ledgerline.operators.staging import broadcast_if_small
from ledgerline.session import apply_scale_conf


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_scale_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("text_hash"),
    )
    found = sharding.histogram_shards(docs, F.col("text_hash"), F.col("doc_id"), F.col("size"), 40)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after three edits a document: a cut at a quarter, a note in the middle, a new end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0))

    def change(start, stop, text: str):
        return F.struct(
            start.cast("long").alias("start"), stop.cast("long").alias("stop"), F.lit(text).alias("text")
        )

    edits = F.array(
        change(F.floor(n / 4), F.floor(n / 4) + 12, ""),
        change(F.floor(n / 2), F.floor(n / 2), " (see note 42)\n"),
        change(n - 3, n + 3, "the end."),
    )
    built = token_counts.build(docs.withColumn("edits", edits)).withColumnRenamed("n_tokens", "n_tokens_before")
    found = token_counts.edit(built, F.col("edits"))
    return found.select(
        "doc_id",
        "n_tokens_before",
        F.col("n_tokens").alias("n_tokens_after"),
        "n_reencoded",
        F.length("text").cast("long").alias("n_chars_after"),
    )


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = language.fold(n=5) != 0
    model = pu_quality.fit(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    found = pu_quality.score(docs, model)
    return found.select(
        "doc_id",
        (language.fold(n=5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.fit(secrets.samples_from(docs))
    found = secrets.scan(docs, model)

    def count(rank: int):
        return F.size(F.filter("base_spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.judge(docs, model).drop("text")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.RANKS)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(language.fold() != 1))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (language.fold() == 1).alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.variants(variants.vocabulary(docs, spell=variants.noisy))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))
    goals, _ = broadcast_if_small(mixed.sources)  # one row for each source
    of = F.element_at("sources", 1).eqNullSafe(F.col("source"))
    return mixed.documents.join(goals, of, "left").select(
        F.col("key").alias("doc_id"), "size", F.col("words").alias("source_size"), "target", "taken"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_shards": op1_histogram_shards,
    "op2_warc_normaliser": op2_warc_normaliser,
    "op3_token_counts": op3_token_counts,
    "op4_pu_quality": op4_pu_quality,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontaminate": op6_decontaminate,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_mix": op13_source_mix,
}

# Exact answer by an inverted index over whole shingles, then components by recursion.
NEAR_DUP_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM tokens
), inverted AS (
  SELECT doc_id, unnest(s) AS x FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM inverted a JOIN inverted b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sets p ON p.doc_id = c.a JOIN sets q ON q.doc_id = c.b
  WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other
), roots AS (
  SELECT node, min(other) AS root FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(r.root, s.doc_id) AS component_id,
  s.doc_id = coalesce(r.root, s.doc_id) AS kept
FROM sets s LEFT JOIN roots r ON r.node = s.doc_id
"""

# Base32 of the SHA-1: 20 bits of the hex digest give four letters.
WARC_SQL = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
  SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex
), coded AS (
  SELECT hex, first, string_agg(
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 15) % 32, 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 10) % 32, 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 5) % 32, 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v % 32, 1), '' ORDER BY i) AS digest
  FROM (SELECT hex, first, i, ('0x' || substr(hex, i * 5 + 1, 5))::INTEGER AS v
        FROM firsts, range(8) AS t(i)) GROUP BY hex, first
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN coded USING (hex)
"""

# All pairs of an anchor and a row, scored as sums of products.
NEGATIVES_SQL = r"""
WITH clean AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM clean a JOIN clean b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM ranked WHERE rank <= 3
"""

# The checksum by its table (from its rule), near words by the words with one code point left out.
VARIANTS_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\x{C0}-\x{FF}]{6,}')) AS run
  FROM documents
), runs AS (
  SELECT run, hex(encode(concat(doc_id, ':', run))) AS hx, count(*) AS n FROM found GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(hx) // 2),
      lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, crc_table
), spelt AS (
  SELECT n, CASE WHEN h % 199 = 0
    THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), keys AS (
  SELECT word, word AS k FROM words
  UNION
  SELECT word, substr(word, 1, i::INTEGER) || substr(word, i::INTEGER + 2) FROM words, range(length(word)) r(i)
), near AS (
  SELECT DISTINCT a.word, b.word AS other FROM keys a JOIN keys b ON a.k = b.k AND a.word <> b.word
  WHERE a.k IN (a.word, b.word) OR length(a.word) = length(b.word) AND len(list_filter(
    range(1, length(a.word) + 1), lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1
), ranked AS (
  SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
  FROM near JOIN words w ON w.word = other
), judged AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), chain AS (
  SELECT word, word AS at, form AS next FROM judged
  UNION ALL
  SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON j.word = c.next
)
SELECT j.word, j.form, c.at AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word AND c.next IS NULL
"""

ORACLE: dict[str, str] = {
    "op2_warc_normaliser": WARC_SQL,
    "op5_near_duplicates": NEAR_DUP_SQL,
    "op11_hard_negatives": NEGATIVES_SQL,
    "op12_spelling_variants": VARIANTS_SQL,
}
