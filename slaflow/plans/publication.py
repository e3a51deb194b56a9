"""Publications that are whole or absent.

A run writes its tables into a folder of its own, ``runs/<run>``, below the
publication's root.  Nothing names that folder until the last step, which
replaces one small file in the root: the manifest, which holds the run and
the path of every table.  A job that dies before leaves the former
publication as it was; a reader takes the manifest first and therefore never
sees tables of two runs.

Every table is counted while it is written: the figures that controls need
(rows, sums, violations) are observed in the writing job itself, so no table
is read again for its count.  Controls are evaluated on these figures before
the manifest is replaced, and kept beside the tables.

The run before the last one stays for readers that still use it; the one
before that is deleted after the manifest has been replaced.  Runs of jobs
that died are named by ``abandoned_runs``.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slaflow.operators import controls as ctl
from slaflow.sources.csv_records import CSV_SINK

RUNS = "runs"


def join_path(base: str | Path, *parts: str) -> str:
    """Join storage paths as text (keeps ``scheme://`` URIs intact)."""
    return "/".join([str(base).rstrip("/"), *[p.strip("/") for p in parts]])


def qualified(spark: SparkSession, path: str | Path) -> tuple[Any, Any]:
    """The Hadoop file system of a path and the path in full; one without a
    scheme is on the session's default file system, as for Spark's readers
    and writers."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop)


def replace_text(spark: SparkSession, path: str | Path, text: str) -> str:
    """Write a small file whole or not at all, over an older one."""
    fs, target = qualified(spark, path)
    data, temporary = text.encode(), f".{target.getName()}.{uuid.uuid4().hex}"
    if target.toUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(os.path.join(os.path.dirname(local), temporary), "wb") as f:
            f.write(data)
        os.replace(f.name, local)
        return str(path)
    jvm = spark._jvm
    fs.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), temporary)
    out = fs.create(staged, True)
    out.write(bytearray(data))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, target, options)
    return str(path)


def read_manifest(spark: SparkSession, path: str | Path, what: str) -> dict[str, Any]:
    fs, found = qualified(spark, path)
    if not fs.exists(found):
        raise FileNotFoundError(f"Missing {what}: {path}")
    return json.loads("\n".join(r["value"] for r in spark.read.text(str(path), wholetext=True).collect()))


def manifest_text(manifest: Mapping[str, Any]) -> str:
    return json.dumps(manifest, indent=2, sort_keys=True, default=str) + "\n"


class Run:
    """One run that is being written below ``root``."""

    def __init__(self, spark: SparkSession, root: str | Path, manifest_name: str):
        self.spark, self.root, self.manifest_name = spark, str(root), manifest_name
        self.id = uuid.uuid4().hex
        self.folder = join_path(self.root, RUNS, self.id)
        #: Observed figures: ``rows`` and the asked ones of every table.
        self.observed: dict[str, dict[str, Any]] = {}
        self.tables: dict[str, str] = {}

    def write(
        self, name: str, df: DataFrame, path: str, figures: Mapping[str, str] | None = None, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write a table, observe its figures on the way and read it back.
        ``df`` comes in its published order: the figures (sums of SQL
        expressions) are taken behind the sort, in the tasks that write."""
        seen = Observation()
        sums = [F.coalesce(F.sum(F.expr(c)).cast("double"), F.lit(0.0)).alias(k) for k, c in (figures or {}).items()]
        place = join_path(self.folder, path)
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums).write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(place)
        self.observed[name], self.tables[name] = dict(seen.get), path
        schema = df.select(*[c for c in df.columns if c not in partition_by], *partition_by).schema
        return self.spark.read.schema(schema).parquet(place)

    def write_csv(self, df: DataFrame, path: str, single: bool = True) -> None:
        (df.coalesce(1) if single else df).write.mode("overwrite").options(**CSV_SINK).csv(join_path(self.folder, path))

    def figure(self, table: str, name: str = "rows") -> float:
        return self.observed[table][name]

    def row_counts(self) -> dict[str, int]:
        return {name: int(seen["rows"]) for name, seen in self.observed.items() if name != "controls"}

    def check(self, checks: Sequence[tuple[str, float, float]], what: str, more: DataFrame | None = None) -> dict[str, bool]:
        """Write the controls (name, observed, expected) beside the tables and
        refuse the run, which is deleted, if one has failed."""
        one = self.spark.range(1)
        rows = ctl.rows(one, [(n, F.lit(float(a)), F.lit(float(b))) for n, a, b in checks]) if checks else None
        table = more if rows is None else rows if more is None else rows.unionByName(more)
        written = self.write("controls", table.coalesce(1), "controls")
        try:
            return ctl.gate(written, what)
        except ValueError:
            self.delete()
            raise

    def publish(self, manifest: Mapping[str, Any]) -> str:
        """Make the run the published one; the returned path is that of the
        manifest."""
        path = join_path(self.root, self.manifest_name)
        try:
            former = read_manifest(self.spark, path, "manifest")
        except FileNotFoundError:
            former = {}
        full = {**manifest, "run": self.id, "previous_run": former.get("run"), "tables": self.tables}
        replace_text(self.spark, path, manifest_text(full))
        if former.get("previous_run"):
            _delete_run(self.spark, self.root, former["previous_run"])
        return path

    def delete(self) -> None:
        _delete_run(self.spark, self.root, self.id)


def _delete_run(spark: SparkSession, root: str, run: str) -> None:
    fs, path = qualified(spark, join_path(root, RUNS, run))
    fs.delete(path, True)


def abandoned_runs(spark: SparkSession, root: str | Path, manifest_name: str) -> list[str]:
    """Runs that the manifest names neither as the last nor as the previous
    one: those of jobs that died, or that are still running."""
    manifest = read_manifest(spark, join_path(root, manifest_name), "manifest")
    fs, path = qualified(spark, join_path(root, RUNS))
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(set(found) - {manifest["run"], manifest["previous_run"]})


class Published:
    """What the manifest of a publication names; read once."""

    def __init__(self, spark: SparkSession, root: str | Path, manifest_name: str, what: str):
        self.spark, self.root = spark, str(root)
        self.manifest = read_manifest(spark, join_path(root, manifest_name), what)

    def path(self, name: str) -> str:
        return join_path(self.root, RUNS, self.manifest["run"], self.manifest["tables"][name])

    def table(self, name: str) -> DataFrame | None:
        """The table, or None where its files are gone."""
        fs, found = qualified(self.spark, self.path(name))
        return self.spark.read.parquet(self.path(name)) if fs.exists(found) else None

    def register_views(self, names: Sequence[str], missing: str) -> dict[str, DataFrame]:
        """The tables, also as temporary views of their names for SQL; all of
        them must be there."""
        tables = {n: self.table(n) if n in self.manifest["tables"] else None for n in names}
        gone = [self.path(n) if n in self.manifest["tables"] else n for n, df in tables.items() if df is None]
        if gone:
            raise FileNotFoundError(f"{missing}: {', '.join(gone)}")
        for n, df in tables.items():
            df.createOrReplaceTempView(n)
        return tables
