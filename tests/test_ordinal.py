from pyspark.sql import functions as F

from slaflow.operators.ordinal import with_ordinal


def test_ordinal_is_contiguous_and_ordered_under_skew(spark):
    # one key holds a third of all rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        (F.col("id") * 7919 % 3001).alias("seq"),
    )
    out = with_ordinal(df, ["key", "seq"], name="n", start=1, partitions=7).collect()
    got = sorted((r["n"], r["key"], r["seq"]) for r in out)
    assert [g[0] for g in got] == list(range(1, 3001))
    assert [(g[1], g[2]) for g in got] == sorted((r["key"], r["seq"]) for r in df.collect())


def test_ordinal_start_offset(spark):
    out = with_ordinal(spark.range(10).withColumnRenamed("id", "k"), ["k"], name="source_row", start=2).collect()
    assert sorted((r["k"], r["source_row"]) for r in out) == [(k, k + 2) for k in range(10)]
