"""Token counts with a digest cache.

A text is known by the digest of its normalised content, a tokenizer by the
digest of its file.  Texts are joined to the counts stored for that pair;
one copy of every missing text is encoded, and the new counts are appended
to the cache, so a count is made once for all copies and all later runs.
The copy is that of the smallest row number, found by an aggregate of narrow
rows, so copies never meet in a task with their texts; counts of contents
that many rows share are broadcast.

Normalisation collapses runs of ASCII white space into one space.  It is for
tokenizers that do the same before they cut words (``word_bpe_49k.json``),
so it never changes a count; pass ``normalise=False`` for others.

Counts are the library's.  Encoding whole texts repeats the same words over
and over, so texts of plain characters without special strings are cut into
words by the tokenizer's own pattern and each word is encoded by the library
once per worker; any other text is encoded whole.

Defined results: a null text is empty (no bytes, no tokens); identical rows
each get their row; an empty table gives no rows and adds nothing to the
cache; columns besides id and text aren't read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.llm.common import join_weighted, materialize, shared_path, text_or_empty, utf8_bytes

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens long"
#: Texts of these characters only mean the same to the tokenizer's pattern and
#: normaliser as to Python's; all others are encoded whole.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: Words remembered by a worker before it starts anew.
MEMO = 500_000


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class WordCounts(dict):
    """Tokens of a word, encoded when first met."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = n
        return n


class Counter:
    """Counts the tokens of texts as ``tokenizers`` does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words = WordCounts(self.tokenizer)
        self.special = re.compile("|".join(re.escape(x["content"]) for x in spec.get("added_tokens", [])) or r"(?!)")
        self.pattern = self.word_pattern(spec)

    @staticmethod
    def word_pattern(spec: dict) -> re.Pattern | None:
        """The tokenizer's word pattern as it reads for plain characters, if
        the file describes a tokenizer that lower-cases texts, drops white
        space and keeps nothing but the pattern's matches."""
        normal = spec.get("normalizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cuts] != ["Split", "ByteLevel"]:
            return None
        space = normal["normalizers"][1]
        cut, byte_level = cuts
        kept = (cut["behavior"], cut["invert"], byte_level["add_prefix_space"], byte_level["use_regex"])
        if (space["pattern"], space["content"]) != ({"Regex": "\\s+"}, " ") or kept != ("Removed", True, False, False):
            return None
        source = cut["pattern"]["Regex"].replace(r"\p{L}", "a-zà-öø-ÿß").replace(r"\p{N}", "0-9")
        return None if r"\p" in source else re.compile(source)

    def count(self, text: str) -> int:
        if self.pattern and PLAIN.fullmatch(text) and not self.special.search(text):
            return sum(map(self.words.__getitem__, self.pattern.findall(text.lower())))
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _content_digest(text: Column, normalise: bool) -> Column:
    return F.unhex(F.sha2(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ") if normalise else text, 256))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """The stored counts of a tokenizer; runs that appended at the same time
    may have stored a count twice."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == tokenizer).select("content", "n_tokens").dropDuplicates(["content"])


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str | None = None,
    normalise: bool = True,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.
    ``cache_path`` keeps counts between runs (default: a new cache)."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    cache_path = cache_path or shared_path(spark, "token-cache")
    text = text_or_empty(text_col)
    content = _content_digest(text, normalise)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), utf8_bytes(F.col(text_col)).alias("n_bytes"), text.alias("text"), content.alias("content"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = materialize(rows.drop("text"), "token-keys")
    contents = materialize(keyed.groupBy("content").agg(F.min("row").alias("holder"), F.count("row").alias("n")), "token-contents")

    def missing() -> DataFrame:
        return contents.join(read_cache(spark, cache_path, version), "content", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    def append(texts: DataFrame) -> None:
        made = texts.select("content", "text").mapInArrow(encode, "content binary, n_tokens long")
        made.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_path)

    # both sides are dealt by row number at any size: a broadcast of the holders grows with the texts
    append(rows.join(missing().select(F.col("holder").alias("row")).hint("merge"), "row", "left_semi"))
    if not (left := missing()).isEmpty():  # the rows came in another order this time
        append(rows.join(left.select("content"), "content", "left_semi").groupBy("content").agg(F.first("text").alias("text")))
    counts = contents.select("content", "n").join(read_cache(spark, cache_path, version), "content")
    return join_weighted(keyed, counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
