"""Session building and the shared folder that long jobs use."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "furlong", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the readers and operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.legacy.javaCharsets": "true",
        "spark.ui.enabled": "false",
        # A checkpoint's files go when no frame refers to it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may leave that unset: a folder below ``/tmp`` then serves its session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file:///tmp/checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root if "://" in root or root.startswith("file:") else "file://" + os.path.abspath(root)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder in the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there.

    The files are replicated by the shared store, so a lost executor costs only
    the tasks it ran.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
