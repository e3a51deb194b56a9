import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = ("row", "node", "path", "hash", "n", "text_crc32", "n_words", "spans", "items", "score", "ids", "Kept_Text", "doc", "range", "part")


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(rows, source="src{}"):
        full = [(i, t, "en", source.format(k % 3), None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long_text = "\n".join(f"the line {i} of a very long text with a few words more" for i in range(3000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "no id at all here"),
        (None, None), (6, long_text), (7, long_text + "\nmore"), (8, "x" * 50_000), (9, "é€😀 ▁ \x00 ŝ"), (10, "!!!"),
        (11, "a b c d e f g h i j k l m n"), (12, "a b c d e f g h i j k l m n"), (-3, "A B C D E F G H I J K L M N o"),
        (2**60, "one\n\n\ntwo\n"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    """The same with extra columns of clashing names."""
    from pyspark.sql import functions as F

    docs = make_docs(odd_rows)
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(k))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def load(path):
    """A table of the test data as a list of dicts, without Spark."""
    import pyarrow.parquet as pq

    return pq.read_table(path).to_pylist()
