"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.llm import (
    ann, decontam, langid, merkle, mixing, ngram_join, packing, quality, resample, secret_scan, substring, toxicity, warc,
)
from cityscan.llm.common import documents, held_out, shared_path


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text").withColumn("held_out", held_out())
    model = toxicity.train(docs.where(~F.col("held_out")), documents(spark, d, "labels"))
    return toxicity.score(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op2_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, d).select("doc_id", "text"))
    base = tuple(r.kind for r in secret_scan.BASE_RULES)
    count = [secret_scan.count(F.col("spans"), k).alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *count, F.sha2(secret_scan.digest(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans"), tuple(r.kind for r in secret_scan.RULES)).alias("spans"))


def op3_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_nearest(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(documents(spark, d, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0)


def op5_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.similar_components(documents(spark, d).select("doc_id", "text"))


def op5_ngram_links(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.link_counts(documents(spark, d).select("doc_id", "text"))


def op6_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = substring.remove_repeats(documents(spark, d).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality(spark: SparkSession, d: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good; selected are texts likelier than not at least 1."""
    docs = documents(spark, d).select("doc_id", "text").withColumn("held_out", held_out())
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    ratings = documents(spark, d, "labels").select("doc_id", grade.alias("grade"))
    model = quality.train(docs.where(~F.col("held_out")), ratings)
    return quality.rate(docs.select("doc_id", "held_out", "text"), model, select_grade=1).drop("text")


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text", "lang").withColumn("held_out", held_out())
    profiles = langid.learn_profiles(docs.where(~F.col("held_out")))
    return langid.identify(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(documents(spark, d, "pages").select("page_id", "url", "html"), path)
    return warc.read_archives(spark, path).select(
        F.expr("try_cast(id as bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"))


def op10_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    docs, items = documents(spark, d).select("doc_id", "text"), documents(spark, d, "benchmark").select("item_id", "text")
    return decontam.contained(docs, items).drop("doc_key")


def op11_resample(spark: SparkSession, d: str) -> DataFrame:
    out = resample.resample(documents(spark, d).select("doc_id", "text"), documents(spark, d, "benchmark").select("text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    """Where 7 divides the id's crc32, n_chars is tampered with: such rows must fail to verify."""
    out = merkle.manifest(
        documents(spark, d), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
        {"n_chars": F.col("n_chars") + 1}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return out.drop("lang")


def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = packing.pack(documents(spark, d).select("doc_id", "source", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_mix_sources": op3_mix_sources,
    "op4_nearest": op4_nearest,
    "op5_ngram_join": op5_ngram_join,
    "op5_ngram_links": op5_ngram_links,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality": op7_quality,
    "op8_language_id": op8_language_id,
    "op9_warc": op9_warc,
    "op10_decontaminate": op10_decontaminate,
    "op11_resample": op11_resample,
    "op12_merkle": op12_merkle,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_secret_scan": secret_scan.oracle_sql(),
    "op3_mix_sources": mixing.ORACLE_SQL,
    "op4_nearest": ann.ORACLE_SQL,
    "op5_ngram_join": ngram_join.ORACLE_SQL,
    "op6_substring_dedup": substring.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op10_decontaminate": decontam.ORACLE_SQL,
    "op11_resample": resample.ORACLE_SQL,
    "op12_merkle": merkle.ORACLE_SQL,
}
