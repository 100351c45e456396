"""Session settings and the folder used for tables that a job writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work this library counts on: small partitions
# are merged, hot join keys are split (also where that costs one more shuffle), and
# rebalanced writes do not leave a hot day to a single task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # building a column otherwise inspects the Python stack each time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def session(app: str = "punctual", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or fetch) a session with this library's settings plus `settings`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for tables a job writes for itself.

    It lies in the shared folder of `spark.checkpoint.dir`, so every executor sees
    it and a lost executor can be replaced. A machine-local folder is taken only
    in local mode and only when the setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="punctual-")
    return f"{base.rstrip('/')}/punctual/{label}-{uuid.uuid4().hex}"
