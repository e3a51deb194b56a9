import pathlib

from slaflow.plans import months


def fact(spark, days):
    rows = [(k + 2, day, "closed" if k % 2 else "open", bool(k % 3) if k % 2 else None) for k, day in enumerate(days)]
    return spark.createDataFrame(rows, "source_row long, created_date_key int, status string, sla_met boolean")


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_a_late_month_rewrites_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "fact")
    months.write_months(fact(spark, [20260501, 20260502, 20260601, 20260715, 20260716]), path)
    before = files(path)
    months.write_months(fact(spark, [20260630]), path)
    after = files(path)
    other = {f: t for f, t in before.items() if "202606" not in f}
    assert other and all(after[f] == t for f, t in other.items())
    got = {r["created_month"]: r["requests"] for r in months.monthly_sla(months.read_months(spark, path)).collect()}
    assert got == {202605: 2, 202606: 1, 202607: 2}


def test_one_month_lists_one_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    months.write_months(fact(spark, [20260501, 20260601, 20260701, 20260702]), path)
    one = months.monthly_sla(months.read_months(spark, path, [202607]))
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month" in scan and "created_month" in scan.split("PushedFilters")[0]
    # the files of all other months aren't opened
    for p in pathlib.Path(path).glob("created_month=20260[56]/*.parquet"):
        p.write_bytes(b"")
    assert one.first()["requests"] == 2


def test_a_hot_month_is_spread_over_files(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(40_000).selectExpr(
        "id AS source_row", "CAST(IF(id % 3 = 0, 20260501, 20250101 + 100 * (id % 12)) AS INT) AS created_date_key", "'open' AS status", "CAST(NULL AS BOOLEAN) AS sla_met"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        months.write_months(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = {}
    for f in files(path):
        counts[f.split("/")[0]] = counts.get(f.split("/")[0], 0) + 1
    assert counts["created_month=202605"] >= 2 and sum(counts.values()) <= 13 + 8
    assert months.read_months(spark, path).count() == 40_000
