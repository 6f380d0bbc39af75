"""The corpus pipeline: documents to a training mix, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.llm import decontam, langid, mixing, ngram_join, secret_scan
from cityscan.llm.common import drop_table, scratch_tables, shared_table

#: A text less like the nearest language's profile than this is rejected; prose scores 0.35 or more.
LEAST_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus; texts without letters or unlike every language go.

    So null and empty texts go. All columns come back as they were, also ones named like the prediction's.
    """
    profiles = langid.learn_profiles(docs)
    named = langid.identify(docs.select(F.struct("*").alias("__doc"), F.col("text").alias("__whole")), profiles, text="__whole")
    return named.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select("__doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles: the smallest id.

    Texts without words and rows without id stay.
    """
    return ngram_join.representatives(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; texts without words hold none."""
    return decontam.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark and n_chars counted anew; a null text stays null."""
    found = secret_scan.scan(docs, out="__spans")
    text = secret_scan.redact(F.col("text"), F.col("__spans"))
    changed = F.size("__spans") > 0
    return (found.withColumn("text", text)
            .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their words, their source's size and target, and the words taken.

    Texts without words go. Columns named size, source_size, target or taken are replaced.
    """
    return mixing.mix(docs).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mix", mix),
]

#: SQL has no form for the learned language profiles; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_tables():  # what the stage wrote for itself, and its predecessor's rows, go once its own are written
            out = stage(spark, docs, sf_dir)
            rows = shared_table(out, f"pipeline-{name}", kept=True)
        if hasattr(docs, "table_path"):
            drop_table(docs)
        docs = rows
    return STAGES[-1][1](spark, docs, sf_dir)
