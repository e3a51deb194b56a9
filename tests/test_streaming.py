from pyspark.sql import functions as F

from conftest import SF001
from slaflow.sources.requests import REQUEST_COLUMNS, request_rows
from slaflow.streaming.bronze_stream import land_bronze_stream


def test_stream_lands_all_drops_with_contiguous_rows(spark, tmp_path):
    rows = request_rows(spark, SF001).select("request_key", *REQUEST_COLUMNS)
    src = tmp_path / "drops"
    for i in range(2):
        part = rows.where(F.col("request_key") % 2 == i).drop("request_key")
        part.coalesce(1).write.option("header", True).csv(str(src / f"drop{i}"))
    files = sorted(str(p) for p in src.rglob("*.csv"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, f in enumerate(files):
        (flat / f"drop{i}.csv").write_bytes(open(f, "rb").read())
    table = str(tmp_path / "bronze")
    q = land_bronze_stream(spark, str(flat), table, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    landed = spark.read.parquet(table)
    assert landed.count() == 1500
    got = sorted(r["source_row"] for r in landed.select("source_row").collect())
    assert got == list(range(2, 1502))
    assert landed.select("ingestion_batch_id").distinct().count() == 2


def test_stream_reads_by_header_and_remembers_its_rows(spark, tmp_path):
    rows = request_rows(spark, SF001).select(*REQUEST_COLUMNS).limit(20).collect()
    src, table = tmp_path / "src", str(tmp_path / "bronze")
    src.mkdir()
    orders = [REQUEST_COLUMNS, [*reversed(REQUEST_COLUMNS)], ["extra", *REQUEST_COLUMNS]]
    for k, names in enumerate(orders):
        lines = [",".join(names)] + [",".join("x" if n == "extra" else r[n] for n in names) for r in rows]
        (src / f"{k}.csv").write_text("\n".join(lines) + "\n")
        land_bronze_stream(spark, str(src), table, str(tmp_path / "ckpt"), max_files_per_trigger=1).awaitTermination()
    landed = spark.read.parquet(table)
    assert sorted(r["source_row"] for r in landed.collect()) == list(range(2, 62))
    assert landed.select(*REQUEST_COLUMNS).distinct().count() == len(set(rows))
    last = spark.read.parquet(f"{table}/_last_row")
    assert sorted(r["last_row"] for r in last.collect()) == [21, 41, 61]
