"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; the cluster's own settings win."""
    builder = (
        SparkSession.builder.appName("hearthline")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster the executors
    and a replacement for a lost one must all see the same files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="hearthline-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and fixes the rows and their partitions."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)
