"""Spark session helpers.

The library never creates a cluster session on its own; jobs receive a
``SparkSession``.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slaflow") -> SparkSession:
    """A local session configured the way the test-suite and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on.

    * Session time zone must be UTC: all contract timestamps are UTC text
      and date keys are UTC calendar days.
    * A checkpoint directory must exist for lineage cuts (ordinals,
      materialised layers).  The cluster's ``spark.checkpoint.dir`` wins; a
      private local folder is only made by a local session that names none;
      on any other master that is an error.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (layer caches are per session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        return str(getattr(spark, "session_id", id(spark)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the SparkContext's checkpoint dir,
    else ``spark.checkpoint.dir``, else, in a local session, a private folder.
    Executors of a cluster don't see each other's folders, so one that names
    no shared folder is refused."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master!r} share")
        configured = tempfile.mkdtemp(prefix="slaflow-ckpt-", dir=os.environ.get("SLAFLOW_LOCAL_TMP", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
