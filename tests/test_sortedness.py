import pytest
from pyspark.sql import functions as F

from slaflow.operators.sortedness import audit_order


def write(spark, tmp_path, files, schema="a int, b string"):
    """One Parquet file for each list of rows, in order of their names."""
    path = str(tmp_path / "t")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    parts = sorted((tmp_path / "t").glob("part-*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for k, p in enumerate(parts):
        p.rename(p.with_name(f"part-{k:05d}.parquet"))
    return path


def audit(spark, path, order, **kw):
    r = audit_order(spark, path, order, **kw).first()
    return r["rows"], r["files"], r["misplaced_in_files"], r["misplaced_between_files"], r["first_file"]


@pytest.mark.parametrize("block_rows", [2, 3, 100])
def test_misplaced_rows_are_counted(spark, tmp_path, block_rows):
    files = [[(1, "x"), (1, "y"), (3, "a"), (2, "a"), (5, "a")], [(4, "a"), (6, "b"), (6, "a")], [(7, None)]]
    path = write(spark, tmp_path, files)
    assert audit(spark, path, ["a", "b"], block_rows=block_rows) == (9, 3, 2, 1, "part-00000.parquet")
    assert audit(spark, path, ["a"], block_rows=block_rows)[2:4] == (1, 1)


def test_descending_and_null_keys(spark, tmp_path):
    path = write(spark, tmp_path, [[(9, None), (9, "a"), (9, "b"), (2, "a")], [(2, "c"), (None, "a"), (None, "b")]])
    assert audit(spark, path, ["-a", "b"])[2:] == (0, 0, None)
    assert audit(spark, path, ["-a", "-b"])[2:4] == (3, 1)


def test_a_shuffled_file_of_a_published_order_is_found(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(10_000).withColumn("h", F.xxhash64("id")).repartitionByRange(4, "h").sortWithinPartitions("h").write.parquet(path)
    assert audit(spark, path, ["h"], block_rows=700)[1:] == (4, 0, 0, None)
    spark.range(10_000).withColumn("h", F.xxhash64("id")).repartition(4).write.mode("overwrite").parquet(path)
    assert audit(spark, path, ["h"], block_rows=700)[2] > 3000


def test_an_empty_table_is_in_order(spark, tmp_path):
    path = write(spark, tmp_path, [[]])
    assert audit(spark, path, ["a"])[2:4] == (0, 0)


def test_no_row_is_shuffled(spark, tmp_path):
    path = write(spark, tmp_path, [[(1, "x"), (2, "y")]])
    plan = audit_order(spark, path, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_not_a_number_is_the_largest(spark, tmp_path):
    nan = float("nan")
    path = write(spark, tmp_path, [[(None, 2), (-0.0, 1), (0.0, 1), (1.5, 0), (nan, 1), (nan, 0)], [(1.0, 5), (None, 5), (nan, 1)]], "x double, b int")
    assert audit(spark, path, ["x"])[2:4] == (1, 1)
    assert audit(spark, path, ["x", "b"])[2:4] == (2, 1)
    assert audit(spark, path, ["-x"])[2:4] == (4, 0)
