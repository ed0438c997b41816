"""Training-corpus job: documents in, token digests of the clean corpus out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame.  All but the last return the columns of
``documents``; ``run`` writes each stage's rows as Parquet under the shared
checkpoint folder and rereads them as the next stage's input, so every stage
starts from files (lost executors cost tasks, not stages).

  language       documents without a recognised language (null text, no
                 letters) go; the language models learn from the rows the
                 stage gets, as op10 does
  near_dup       of each group of near-duplicates the smallest doc_id stays (a
                 null doc_id comes last); rows that repeat its doc_id and its
                 text are the same document and stay with it
  benchmark      documents that hold a benchmark item (within its edit budget) go
  secrets        no document goes; secrets are masked in the text and n_chars
                 follows the new text
  tokens         one row per document: token count, digest of its ids, digest
                 of the bytes decoded from them

Every row passes the filters on its own text, also when its doc_id is null or
repeated; an empty table gives an empty result.  The stages are not expressible in SQL, so
``ORACLE_SQL`` is None and tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, language, near_dup, secrets
from ledgerline.operators.staging import stage
from ledgerline.session import apply_scale_conf


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not recognised."""
    model = language.fit(docs.where(language.fold() != 1))
    found = language.predict(docs, model, lang_col="__lang", score_col="__score")
    return found.where(F.col("__lang") != language.UNKNOWN).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    return near_dup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the text."""
    return secrets.mask(docs, secrets.fit(secrets.samples_from(docs)))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document as a digest, with the digest of the decoded bytes."""
    return bpe.digests(docs, bpe.RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_dup", near_dup_stage),
    ("benchmark", benchmark_stage),
    ("secrets", secrets_stage),
    ("tokens", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    apply_scale_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
