"""The registered queries of the subpackage: each applies one operator to its
whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.llm import decontamination, fingerprints, importance, line_dedup, ngram_join, quality, secret_scan, sentencepiece_scan, sharding, token_counts, training_order, url_filter, vector_codes
from slaflow.llm.common import documents, table, text_or_empty


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.span_list(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"), "n_live", "n_example", "max_owners", "max_repos",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return training_order.write_training_order(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_scan.encode(documents(spark, sf_dir).select("doc_id", "text"), model)
    return sentencepiece_scan.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == text_or_empty()).alias("round_trip")
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir).select("doc_id", "text"), n_shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "version",
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(documents(spark, sf_dir))


#: The rules of ``op11_url_filter``.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest() if books else hashlib.sha256().hexdigest()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_training_order": op7_training_order,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_sharding": op9_sharding,
    "op10_fingerprints": op10_fingerprints,
    "op11_url_filter": op11_url_filter,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_vector_codes": op13_vector_codes,
}
