"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the results or the plans depend on. All of them can be changed on a
# running session, so they also apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Joins carry no broadcast hints on data tables: Spark compares the size
    # with the threshold when planning, and again at run time through AQE, and
    # sort-merges (splitting skewed partitions) beyond it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "yardstar", master: str | None = None, **conf: str) -> SparkSession:
    """Create a configured session; ``conf`` takes extra settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it and gets a temporary folder: on a
    cluster such a folder would exist on one machine and die with it.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="yardstar-")
        context.setCheckpointDir(os.path.join(folder, "checkpoints"))
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


def checkpoint_ready(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint`` has a folder to write to."""
    root = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{root}/checkpoints")
