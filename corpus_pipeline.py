"""A corpus from raw documents to token files, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps with
their columns; the last returns what its files hold. ``run`` writes every stage to the
shared folder and reads it again, so a lost executor costs a stage's tasks, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, language, mixing, ngram_join, token_files
from tidemark.llm.folders import folder, written
from tidemark.llm.queries import END_ID, held_out, tokenizer_path

#: Calibrated probability below which a language is not believed.
LEAST_SCORE = 0.4

#: SQL can't express a learned classifier and a tokenizer; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language: those without letters or with a low score go."""
    model = language.fit(docs.where(~held_out("doc_id", 4, 2)))
    kept = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("read"))
    judged = language.predict(rows, model, "read")
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*").select(*kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8."""
    return ngram_join.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(docs, benchmark, carry=True).where("n_hit = 0").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target shares of their sources: left out, kept, or repeated."""
    return mixing.taken(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; a row for each with its place, length and checksum."""
    return token_files.write_tokens(docs, folder(spark, "corpus"), tokenizer_path(), END_ID).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
