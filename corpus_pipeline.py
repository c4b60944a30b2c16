"""From raw documents to token files: language ID, near-dedup, decontamination, mixing, token output.

Each stage takes the documents its predecessor kept (written as Parquet and read again) and returns those it keeps, with the columns of
the table; the last one returns a row per document of the token files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspan.llm import language_id, mixing, near_dedup, queries, spaced_seeds, token_output
from barspan.llm.texts import table
from barspan.session import scratch_dir

#: A document stays if its most probable language has at least this probability.
LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty ones too) and those whose language is less than half sure."""
    model = language_id.fit(docs, train=F.lit(True))
    found = language_id.classify(docs, model, out="language_of")
    sure = (F.col("language_of.lang") != language_id.UNKNOWN) & (F.col("language_of.score") >= LANGUAGE_SCORE)
    return found.where(sure).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 or more, the smallest id stays. Null ids and texts without words stay."""
    found = near_dedup.near_duplicates(docs, k=5, percent=80)
    drop = found.where("doc_id <> component_id").select("doc_id")
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat a passage of a benchmark item."""
    found = spaced_seeds.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the target mixture of domains, languages and sources, each document once at most."""
    taken = mixing.mix(docs, queries.mix_levels(), queries.mix_weights(spark), share=queries.MIX_SHARE)
    return taken.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns doc_id, start, n_tokens and ids_crc32 as read back from them."""
    manifest = token_output.token_files(docs, queries.TOKENIZER)
    return token_output.read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
    ("token_output", tokens),
]

#: The stages' classifier, hashes and tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's output written to shared scratch and read again."""
    folder = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
