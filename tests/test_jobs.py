import json

import pytest

from conftest import SF001
from slaflow.plans import jobs
from slaflow.plans.publication import Published
from slaflow.sources.requests import REQUEST_COLUMNS, request_rows


#: Rejected rows of the request source at sf0.001.
INVALID = 67


@pytest.fixture(scope="module")
def source_csv(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("src") / "service_requests"
    request_rows(spark, SF001).orderBy("request_key").select(*REQUEST_COLUMNS).coalesce(1).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(str(path))
    return str(path)


def test_csv_bronze_and_validation(spark, source_csv):
    report = jobs.validate_file(spark, source_csv)
    assert report["total_rows"] == 1500
    assert report["invalid_rows"] == INVALID
    assert report["valid_rows"] + report["invalid_rows"] == report["total_rows"]


def tables_of(spark, root, manifest):
    published = Published(spark, root, manifest, "manifest")
    return published, {n: published.table(n) for n in published.manifest["tables"]}


def test_medallion_analytics_process_jobs(spark, source_csv, tmp_path):
    manifest_path = jobs.run_medallion(spark, source_csv, str(tmp_path / "medallion"))
    manifest = json.loads(open(manifest_path).read())
    assert all(manifest["controls"].values())
    rc = manifest["row_counts"]
    assert rc["bronze"] == rc["silver_valid"] + rc["silver_rejected"] == 1500
    assert rc["gold_fact"] == rc["silver_valid"]
    assert manifest["kpis"]["total_requests"] == rc["silver_valid"]
    assert len(manifest["ingestion_batch_id"]) == 16
    published, tables = tables_of(spark, tmp_path / "medallion", jobs.MEDALLION)
    # the observed counts are those of the tables
    assert {n: tables[n].count() for n in rc} == rc
    kept = {r["control"]: (r["observed"], r["expected"], r["passed"]) for r in tables["controls"].collect()}
    assert kept["valid_equals_fact"] == (rc["gold_fact"], rc["gold_fact"], True) and len(kept) == 3

    path = jobs.run_analytics(spark, str(tmp_path / "medallion"), str(tmp_path / "analytics"))
    analytics = json.loads(open(path).read())
    assert all(analytics["controls"].values()) and len(analytics["controls"]) == 10
    assert analytics["row_counts"]["service_requests_enriched"] == rc["gold_fact"]
    assert analytics["source_run"] == manifest["run"]
    _, marts = tables_of(spark, tmp_path / "analytics", jobs.ANALYTICS)
    assert {n: marts[n].count() for n in analytics["row_counts"]} == analytics["row_counts"]

    path = jobs.run_process_of_medallion(spark, str(tmp_path / "medallion"), str(tmp_path / "process"))
    process = json.loads(open(path).read())
    assert all(process["controls"].values()) and len(process["controls"]) == 10
    assert process["row_counts"]["cases"] == rc["silver_valid"]
    _, own = tables_of(spark, tmp_path / "process", jobs.PROCESS)
    assert own["process_cases"].where("status = 'closed'").count() == process["case_counts"]["closed"]


def test_gold_tables_are_views(spark, source_csv, tmp_path):
    jobs.run_medallion(spark, source_csv, str(tmp_path / "m"))
    jobs.GoldTables(jobs.published_medallion(spark, tmp_path / "m"))
    rows = spark.sql("SELECT assigned_team, count(*) AS n FROM fact_service_requests JOIN dim_team USING (team_key) GROUP BY assigned_team").collect()
    total = spark.sql("SELECT total_requests FROM service_operations_kpis").first()[0]
    assert sum(r["n"] for r in rows) == total == spark.table("service_requests_enriched").count()


def test_views_of_gold_tables_write_nothing(spark, source_csv, tmp_path, monkeypatch):
    jobs.run_medallion(spark, source_csv, str(tmp_path / "m"))
    written = []
    monkeypatch.setattr(jobs, "materialize", lambda df, name: written.append(name) or df)
    gold = jobs.GoldTables(jobs.published_medallion(spark, tmp_path / "m"))
    assert not written and spark.table("service_requests_enriched").count() == gold.fact.count()
    gold.mart("sla_by_team"), gold.mart("sla_by_category")
    assert written == ["analytics-enriched"]


def test_command_line_jobs(spark, source_csv, tmp_path):
    from slaflow.__main__ import main

    assert main(["validate", "--input", source_csv, "--report", str(tmp_path / "report.json"), "--expected-rows", "1500", "--expected-invalid", str(INVALID)], spark) == 0
    assert json.loads(open(tmp_path / "report.json").read())["invalid_rows"] == INVALID
    assert main(["validate", "--input", source_csv], spark) == 1  # invalid rows present, no expectations given
    assert main(["build-medallion", "--input", source_csv, "--output", str(tmp_path / "m")], spark) == 0
    assert main(["build-analytics", "--medallion", str(tmp_path / "m"), "--output", str(tmp_path / "a")], spark) == 0
    assert main(["build-process-intelligence", "--input", source_csv, "--output", str(tmp_path / "p")], spark) == 0
    assert main(["build-process-intelligence", "--medallion", str(tmp_path / "m"), "--output", str(tmp_path / "q")], spark) == 0
    assert (tmp_path / "p" / "process_intelligence_manifest.json").is_file()


def test_fingerprint_has_one_definition_for_each_method(spark, source_csv, tmp_path, monkeypatch):
    import hashlib
    import pathlib
    import shutil

    from slaflow.sources import bronze

    part = next(pathlib.Path(source_csv).glob("*.csv"))
    assert bronze.file_fingerprint(spark, str(part)) == hashlib.sha256(part.read_bytes()).hexdigest()[:16]
    for k in range(2):  # moved files keep theirs
        folder = tmp_path / f"moved{k}"
        folder.mkdir()
        for name in ("a.csv", "b.csv"):
            shutil.copy(part, folder / name)
    assert bronze.file_fingerprint(spark, str(tmp_path / "moved0")) == bronze.file_fingerprint(spark, str(tmp_path / "moved1"))
    tree = bronze.file_fingerprint(spark, source_csv, "tree")
    monkeypatch.setattr(bronze, "MAX_BYTES", 10)
    with pytest.raises(ValueError, match="method='tree'"):
        bronze.file_fingerprint(spark, source_csv, "bytes")
    assert bronze.file_fingerprint(spark, source_csv) == tree  # a large file needs no flag


def test_tree_fingerprint_depends_on_order_alone(spark, tmp_path, monkeypatch):
    from slaflow.sources import bronze

    monkeypatch.setattr(bronze, "FAN", 5)
    lines = [f"line {k % 40}" for k in range(200)]

    def of(text, split=None):
        path = tmp_path / "f.csv"
        path.write_text(text)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            return bronze.file_fingerprint(spark, str(path), "tree")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    text = "\n".join(lines)
    swapped = "\n".join([lines[1], lines[0], *lines[2:]])
    assert of(text) == of(text, "100") == of(text, "333")
    assert len({of(text), of(swapped), of(text + "\n"), of("\n".join(lines[:-1])), of("")}) == 5


def _drop(tmp_path, name, *files):
    folder = tmp_path / name
    folder.mkdir()
    for k, text in enumerate(files):
        (folder / f"f{k}.csv").write_text(text)
    return str(folder)


ROW = "SR-00000{},2026-05-01T08:00:00Z,,P2,{},service_desk,open,480,,0,false,smb,service_portal"


def test_csv_quotes_backslashes_and_line_breaks(spark, tmp_path):
    from slaflow.sources.bronze import bronze_from_csv

    head = ",".join(REQUEST_COLUMNS)
    values = ['"a ""q"" b"', "back\\", '"c\\"']
    text = "\n".join([head, *[ROW.format(k, v) for k, v in enumerate(values)]]) + "\n"
    rows = bronze_from_csv(spark, _drop(tmp_path, "quotes", text)).orderBy("source_row").collect()
    assert [r["category"] for r in rows] == ['a "q" b', "back\\", "c\\"]
    assert all(r["assigned_team"] == "service_desk" for r in rows)
    text = "\n".join([head, ROW.format(1, '"two\nlines"'), ROW.format(2, "x")]) + "\n"
    rows = bronze_from_csv(spark, _drop(tmp_path, "breaks", text)).orderBy("source_row").collect()
    assert [r["category"] for r in rows] == ["two\nlines", "x"]


def test_files_with_another_header_are_refused(spark, tmp_path):
    from slaflow.sources.bronze import bronze_from_csv

    swapped = list(REQUEST_COLUMNS)
    swapped[3], swapped[4] = swapped[4], swapped[3]
    one = "\n".join([",".join(REQUEST_COLUMNS), ROW.format(1, "access")]) + "\n"
    two = "\n".join([",".join(swapped), ROW.format(2, "access")]) + "\n"
    with pytest.raises(Exception, match="(?i)header"):
        bronze_from_csv(spark, _drop(tmp_path, "both", one, two)).collect()


def test_missing_gold_tables_and_manifest_are_listed(spark, source_csv, tmp_path):
    import shutil

    out = tmp_path / "m"
    jobs.run_medallion(spark, source_csv, str(out))
    published = jobs.published_medallion(spark, out)
    for name in ("dim_team", "dim_date"):
        shutil.rmtree(published.path(name))
    with pytest.raises(FileNotFoundError, match="Missing Gold Parquet input: .*dim_date.*dim_team"):
        jobs.run_analytics(spark, str(out), str(tmp_path / "a"))
    (out / "medallion_manifest.json").unlink()
    with pytest.raises(FileNotFoundError, match="Missing Medallion manifest"):
        jobs.run_analytics(spark, str(out), str(tmp_path / "a"))


def test_recorded_figures_are_the_target(spark, source_csv, tmp_path):
    out = tmp_path / "m"
    path = jobs.run_medallion(spark, source_csv, str(out))
    manifest = json.loads(open(path).read())
    manifest["kpis"]["closed_requests"] += 1
    open(path, "w").write(json.dumps(manifest))
    with pytest.raises(ValueError, match="team_closed_reconciles"):
        jobs.run_analytics(spark, str(out), str(tmp_path / "a"))
    assert not any((tmp_path / "a" / "runs").iterdir())  # a refused run leaves nothing
    manifest["controls"]["valid_equals_fact"] = False
    open(path, "w").write(json.dumps(manifest))
    with pytest.raises(ValueError, match="valid_equals_fact"):
        jobs.run_process_of_medallion(spark, str(out), str(tmp_path / "p"))


def test_malformed_records_stop_the_job_or_are_published(spark, tmp_path):
    good = ",".join(REQUEST_COLUMNS) + "\n" + ROW.format(1, "access") + "\n"
    path = _drop(tmp_path, "long", good + ROW.format(2, "access") + ",more\n" + ROW.format(3, "access") + "\n")
    with pytest.raises(ValueError, match="row 3 of f0.csv: expected 13 fields, saw 14"):
        jobs.run_medallion(spark, path, str(tmp_path / "m"))
    assert not (tmp_path / "m").exists()
    jobs.run_medallion(spark, path, str(tmp_path / "m"), malformed="keep")
    published, tables = tables_of(spark, tmp_path / "m", jobs.MEDALLION)
    assert published.manifest["row_counts"]["malformed_records"] == 1 and published.manifest["row_counts"]["bronze"] == 2
    (bad,) = tables["malformed_records"].collect()
    assert bad["source_row"] == 3 and bad["record"].endswith(",more")
    assert [r["source_row"] for r in tables["bronze"].collect()] == [2, 4]


def test_published_order_and_no_leftovers(spark, source_csv, tmp_path):
    import pathlib

    import pyarrow.parquet as pq

    from slaflow.session import ensure_checkpoint_dir

    shared = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    jobs.run_medallion(spark, source_csv, str(tmp_path / "m"))
    jobs.run_process_of_medallion(spark, str(tmp_path / "m"), str(tmp_path / "p"))
    assert set(shared.iterdir()) == before
    medallion = jobs.published_medallion(spark, tmp_path / "m")
    process = Published(spark, tmp_path / "p", jobs.PROCESS, "manifest")

    def published(of, name):
        files = sorted(pathlib.Path(of.path(name)).glob("part-*.parquet"))
        return [r for f in files for r in pq.read_table(f).to_pylist()]

    def ordered(rows, key):
        assert rows and [key(r) for r in rows] == sorted(key(r) for r in rows)

    ordered(published(medallion, "silver_issues"), lambda r: (r["source_row"], r["issue_code"]))
    ordered(published(medallion, "dim_date"), lambda r: r["date_key"])
    ordered(published(process, "event_log"), lambda r: (r["case_id"], r["event_index"]))
    ordered(published(process, "process_cases"), lambda r: r["case_id"])
    ordered(published(process, "transition_performance"), lambda r: (-r["case_count"], r["source_activity"], r["target_activity"]))
    assert process.manifest["interpretation_boundary"].startswith("Event timestamps between")


def test_forbidden_columns_are_refused(spark):
    with pytest.raises(ValueError, match="Forbidden columns: t: email"):
        jobs.refuse_forbidden({"t": spark.createDataFrame([("x",)], "email string")}, jobs.default_contract())


def test_csv_text_scan_keeps_text_exactly(spark, tmp_path):
    from slaflow.sources.bronze import bronze_from_csv

    header = ",".join(REQUEST_COLUMNS) + ",extra_column"
    lines = [
        header,
        'SR-000001,2026-05-01T08:00:00Z,,P2,access,service_desk,open,480,,0,false,smb,service_portal,x',
        'NA,"2026-05-01T09:00:00Z",,P2,"access, hardware",service_desk,open,480,,0,false,smb,service_portal,y',
    ]
    path = tmp_path / "drop"
    path.mkdir()
    (path / "requests.csv").write_text("\n".join(lines) + "\n")
    rows = {r["source_row"]: r for r in bronze_from_csv(spark, str(path)).collect()}
    assert sorted(rows) == [2, 3]
    assert rows[2]["closed_at"] == "" and rows[2]["resolution_minutes"] == ""
    assert rows[3]["ticket_id"] == "NA" and rows[3]["category"] == "access, hardware"
    assert "extra_column" not in bronze_from_csv(spark, str(path)).columns
    assert rows[2]["source_file"] == "requests.csv"
