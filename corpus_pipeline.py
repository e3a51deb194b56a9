"""The corpus pipeline: raw documents to token ids in five stages.

Every stage is a function of (spark, docs, sf_dir) that calls one operator of
``slaflow.llm`` and acts on what it finds; its result is written as Parquet
and read again as the documents of the next one.  All but the last return
the columns of ``documents``; where a text changes, ``n_chars`` follows it.

Defined results: null texts and null ids stay null and pass through every
stage that has nothing to say about them (a null text is scored, and is a
near duplicate, like an empty one; rows without an id are never duplicates);
rows with the same id and text stay or go together; an empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.llm import decontamination, line_dedup, ngram_join, quality, sentencepiece_scan
from slaflow.llm.common import materialize, table, text_or_empty

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, text: Column, changed: Column) -> list[Column]:
    own = {
        "text": F.when(changed, text).otherwise(F.col("text")).alias("text"),
        "n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    }
    return [own.get(c, F.col(c)) for c in COLUMNS]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for positives stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("score >= 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    found = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return found.select(*_with_text(found, F.col("kept_text"), F.col("n_dropped") > 0))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents, the one with the smallest id
    stays."""
    judged = ngram_join.ngram_join(docs)
    gone = judged.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("class_id")).alias("gone")).where("gone")
    return docs.select(*COLUMNS).join(gone.select("doc_id"), "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of benchmark words go; documents go that are mostly such runs."""
    marked = docs.select(*COLUMNS, F.col("text").alias("before"))
    clean = decontamination.decontaminate(marked, table(spark, sf_dir, "benchmark"))
    return clean.select(*_with_text(clean, F.col("text"), ~F.col("text").eqNullSafe(F.col("before"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it.  The ids are
    written before they are decoded, so a task has one Python worker at a
    time and not two in a row."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = materialize(sentencepiece_scan.encode(docs.select(*COLUMNS), model), "encoded")
    decoded = sentencepiece_scan.decode(encoded, model)
    return decoded.select(
        *COLUMNS, F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == text_or_empty()).alias("round_trip"),
    )


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: The stages hold a trained model and a tokenizer, which SQL can't express;
#: the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
