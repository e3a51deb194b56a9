import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from slaflow.llm import token_counts
from slaflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def library(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_word_counts_are_the_librarys(tokenizer):
    counter = token_counts.Counter(PATH)
    assert counter.pattern is not None
    plain = [chr(c) for c in (*range(0x20, 0x7F), *range(0xC0, 0x100), 9, 10, 13) if token_counts.PLAIN.fullmatch(chr(c))]
    for c in plain:
        for text in (c, f"a{c}b", f"1{c}{c}'s", f"'{c}"):
            assert counter.count(text) == library(tokenizer, text), repr(text)
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(plain) for _ in range(rng.randint(0, 40)))
        assert counter.count(text) == library(tokenizer, text), repr(text)


def test_other_texts_are_encoded_whole(tokenizer):
    counter = token_counts.Counter(PATH)
    for text in ("<|endoftext|> a", "ΑΣ ς", "é   x", "İstanbul", "漢字かな", "a\x0bb", "😀"):
        assert counter.count(text) == library(tokenizer, text)


def test_query(spark, tokenizer):
    from conftest import SF001
    from llm.conftest import load

    want = {}
    for r in load(f"{SF001}/documents.parquet"):
        n = library(tokenizer, r["text"])
        want[r["doc_id"]] = (len(r["text"].encode()), n, n > 2048)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op5_token_counts"](spark, SF001).collect()}
    assert got == want


def test_odd_rows(odd_docs, odd_rows, tokenizer):
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(odd_docs, PATH).collect()]
    want = [(i, len((t or "").encode()), library(tokenizer, t)) for i, t in odd_rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stored_counts_are_used_and_only_misses_added(spark, make_docs, tmp_path):
    path = str(tmp_path / "cache")
    first = make_docs([(1, "a b"), (2, "a  \n b"), (3, "c")])
    token_counts.count_tokens(first, PATH, path).collect()
    assert spark.read.parquet(path).count() == 2  # white space doesn't count
    stored = spark.read.parquet(path).selectExpr("tokenizer", "content", "n_tokens + 100 AS n_tokens").collect()
    other = str(tmp_path / "other")
    spark.createDataFrame(stored, token_counts.CACHE_SCHEMA).write.parquet(other)
    rows = token_counts.count_tokens(make_docs([(1, "a b"), (2, "new words")]), PATH, other).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 102, 2: 2}
    assert spark.read.parquet(other).count() == 3


def test_a_count_that_is_stored_twice_is_used_once(spark, make_docs, tmp_path):
    path = str(tmp_path / "cache")
    docs = make_docs([(1, "a b")])
    token_counts.count_tokens(docs, PATH, path).collect()
    spark.read.parquet(path).collect()
    again = spark.createDataFrame(spark.read.parquet(path).collect(), token_counts.CACHE_SCHEMA)
    again.write.mode("append").parquet(path)
    assert token_counts.count_tokens(docs, PATH, path).count() == 1


def test_empty_table(no_docs):
    assert token_counts.count_tokens(no_docs, PATH).count() == 0


def test_a_third_of_all_rows_are_equal(make_docs, tokenizer, monkeypatch):
    from slaflow.llm import common

    monkeypatch.setattr(common, "HEAVY_SHARE", 4)
    rows = [(None, "the same text for all") if k % 3 == 0 else (k % 20, f"text {k % 30}") for k in range(300)]
    got = [(r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(make_docs(rows).repartition(6), PATH).collect()]
    assert sorted(got, key=repr) == sorted([(i, library(tokenizer, t)) for i, t in rows], key=repr)


def test_rows_that_change_their_order_lose_no_count(make_docs, tokenizer):
    """Row numbers that mean other rows the second time: the missing counts
    are made by content."""
    rows = [(k, f"text number {k}") for k in range(200)]
    from pyspark.sql import functions as F

    docs = make_docs(rows).repartition(4).orderBy(F.rand()).limit(200)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, PATH).collect()}
    assert got == {i: library(tokenizer, t) for i, t in rows}
