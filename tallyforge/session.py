"""Session settings and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here wants, where neither the cluster nor a running session has set them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Only for sessions made here for a local run; a cluster sets these itself.
LOCAL = {
    # Intermediate tables go from the checkpoint folder when no DataFrame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``master`` only for local runs and tests.

    What ``spark-submit`` or the cluster's files set stays as it is; a session that runs already is
    given back untouched but for the keyword settings.  Keyword names use ``__`` for the dots of a
    setting name.
    """
    running = SparkSession.getActiveSession() is not None
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        for key, value in LOCAL.items():
            builder = builder.config(key, value)
    given = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not running:
        submitted = spark.sparkContext.getConf()
        for key, value in DEFAULTS.items():
            if key not in given and not submitted.contains(key):
                spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make a private one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the checkpoint folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
