"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    archive, codes, decontaminate, fingerprints, infill, licenses, neardup, packing, pieces, repeats, tokens, toxicity, urls,
)
from tallyspark.llm.tables import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived_pages(read(spark, sf_dir, "pages"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(read(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(read(spark, sf_dir, "documents")).drop("spans")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    judged = urls.judge(urls.dated_captures(pages), urls.dated_changes(pages))
    return judged.withColumnRenamed("capture_id", "page_id").withColumn("fetched_at", F.col("fetched_at").cast("string"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=2)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _sha256(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256).alias(f"{column}_sha256")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = pieces.decode(pieces.encode(read(spark, sf_dir, "documents"))).withColumnRenamed("text", "decoded")
    return decoded.select("doc_id", pieces.token_count().alias("n_tokens"), _sha256("ids"), _sha256("decoded"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = infill.restore(infill.fill_in_middle(read(spark, sf_dir, "documents")))
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output"), _sha256("restored"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_decontaminate,
        op3_packing,
        op4_fingerprints,
        op5_warc,
        op6_licenses,
        op7_suffix_array_dedup,
        op8_url_filters,
        op9_near_duplicates,
        op10_toxicity,
        op11_sentencepiece,
        op12_vector_codes,
        op13_fill_in_middle,
    )
}
