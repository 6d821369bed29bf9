"""Corpus pipeline: from ``documents`` to token files, stage by stage.

Every stage reads all that its predecessor kept (written as Parquet and read
again), and all but the last return the columns of ``documents``:

1. texts without letters or in none of the learned languages go, and a missing
   language is filled in;
2. one document of each near-duplicate group stays, the one of the least id;
3. documents contaminated by benchmark passages go;
4. documents are sampled towards the target shares of source, language, topic;
5. what is left is written as token files and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import decontam, jaccard, langid, mixing
from fieldbook.llm.frames import free_name, table
from fieldbook.llm.queries import tokens_of
from fieldbook.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects ``und`` and texts with too few n-grams of their language."""
    names = docs.columns
    into = free_name(docs, "_language")
    found = langid.predicted(docs, langid.fit(docs), into=into)
    known = (F.col(f"{into}.lang") != langid.UNKNOWN) & (F.col(f"{into}.score") >= langid.LEAST_COVERAGE)
    return found.where(known).withColumn("lang", F.coalesce("lang", f"{into}.lang")).select(*[F.col(f"`{c}`") for c in names])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one id and text stay once; a document alone always stays."""
    least = free_name(docs, "_least")
    found = jaccard.near_duplicate_components(docs).select(F.col("component_id").alias(least)).distinct()
    kept = docs.join(found, F.col("doc_id").eqNullSafe(F.col(least)), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    into = free_name(docs, "_contamination")
    found = decontam.flagged(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.where(f"not {into}.contaminated").select(*[F.col(f"`{c}`") for c in names])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sampled(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens_of(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", remove_contaminated),
    ("mixing_to_targets", mix_sources),
    ("token_id_output", write_token_files),
]

# stages 1, 4 and 5 (trained filter, raking, tokenizer) have no SQL form; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
