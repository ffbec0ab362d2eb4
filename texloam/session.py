"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "texloam", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    Dates are printed in UTC.  Pages are large cells, so Arrow batches are kept
    small.  Partition counts are left to adaptive execution.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder; a cluster without it is an
    error, because data on one machine is lost with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="texloam-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
