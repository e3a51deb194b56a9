import json
import pathlib

import pytest
from fixtures import VALID_CLOSED, VALID_OPEN, bronze_rows

from slaflow.plans import jobs
from slaflow.plans.layers import MedallionLayers
from slaflow.plans.publication import Published, Run, abandoned_runs, replace_text


def layers(spark, n=1):
    rows = [VALID_CLOSED | {"ticket_id": f"SR-00000{k}"} for k in range(n)] + [VALID_OPEN | {"ticket_id": "SR-000009"}]
    return MedallionLayers(bronze_rows(spark, rows))


def bronze_count(spark, root):
    return jobs.published_medallion(spark, root).table("bronze").count()


def test_a_killed_job_leaves_the_former_publication(spark, tmp_path, monkeypatch):
    root = tmp_path / "m"
    jobs.write_medallion(layers(spark), root)
    before = (root / "medallion_manifest.json").read_bytes()
    write, calls = Run.write, []

    def dies(self, name, *args, **kwargs):
        calls.append(name)
        if name == "dim_date":
            raise KeyboardInterrupt
        return write(self, name, *args, **kwargs)

    monkeypatch.setattr(Run, "write", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.write_medallion(layers(spark, 5), root)
    assert "gold_fact" in calls
    assert (root / "medallion_manifest.json").read_bytes() == before and bronze_count(spark, root) == 2
    published = jobs.published_medallion(spark, root)
    assert {n: published.table(n).count() for n in published.manifest["row_counts"]} == published.manifest["row_counts"]
    (left,) = abandoned_runs(spark, root, jobs.MEDALLION)
    assert left != published.manifest["run"]


def test_a_failed_control_publishes_nothing(spark, tmp_path):
    root = tmp_path / "m"
    jobs.write_medallion(layers(spark), root)
    broken = layers(spark, 4)
    broken.__dict__["fact"] = broken.fact.limit(1)
    with pytest.raises(ValueError, match="valid_equals_fact"):
        jobs.write_medallion(broken, root)
    assert bronze_count(spark, root) == 2 and abandoned_runs(spark, root, jobs.MEDALLION) == []


def test_readers_keep_their_run_for_one_more(spark, tmp_path):
    root = tmp_path / "m"
    jobs.write_medallion(layers(spark, 1), root)
    reader = jobs.published_medallion(spark, root)
    jobs.write_medallion(layers(spark, 2), root)
    assert reader.table("bronze").count() == 2 and bronze_count(spark, root) == 3
    jobs.write_medallion(layers(spark, 3), root)
    assert reader.table("bronze") is None and bronze_count(spark, root) == 4
    assert len(list((root / "runs").iterdir())) == 2


def test_figures_are_observed_while_writing(spark, tmp_path):
    run = Run(spark, tmp_path / "r", "m.json")
    df = spark.range(1000).selectExpr("id", "id % 7 AS k").orderBy("k", "id")
    back = run.write("t", df, "a/t", {"sum": "id", "none": "CAST(NULL AS INT)"})
    assert run.observed["t"] == {"rows": 1000, "sum": 499500.0, "none": 0.0} and back.count() == 1000
    run.write("e", df.limit(0), "a/e")
    assert run.row_counts() == {"t": 1000, "e": 0}
    run.publish({"x": 1})
    published = Published(spark, tmp_path / "r", "m.json", "manifest")
    assert published.manifest["x"] == 1 and published.table("t").count() == 1000


def test_controls_are_kept_with_their_figures(spark, tmp_path):
    run = Run(spark, tmp_path / "r", "m.json")
    assert run.check([("one", 1, 1.0)], "Test", None) == {"one": True}
    with pytest.raises(ValueError, match="Test reconciliation controls failed: two"):
        run.check([("two", 1, 2)], "Test", None)
    assert not pathlib.Path(run.folder).exists()


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = tmp_path / "deep" / "x.json"
    for text in ("first", "second é"):
        replace_text(spark, path, text)
        assert path.read_text() == text
    replace_text(spark, f"file://{path}", "third")
    assert [p.name for p in path.parent.iterdir()] == ["x.json"] and path.read_text() == "third"


def test_small_files_on_another_file_system(spark, tmp_path):
    """A path that only Hadoop can open."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pub.link./at", f"file://{tmp_path}")
    for text in ("first", "second"):
        replace_text(spark, "viewfs://pub/at/m/x.json", text)
    assert (tmp_path / "m" / "x.json").read_text() == "second"
    run = Run(spark, "viewfs://pub/at/r", "m.json")
    run.write("t", spark.range(3), "t")
    run.publish({})
    assert Published(spark, "viewfs://pub/at/r", "m.json", "manifest").table("t").count() == 3
    assert json.loads((tmp_path / "r" / "m.json").read_text())["tables"] == {"t": "t"}
