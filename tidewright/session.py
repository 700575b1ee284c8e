"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on; all of them can be set on a running session.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}

# Settings only the speed depends on; used when we build the session ourselves.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go away with the frames that use them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # HotSpot does not compile methods above 8000 bytes: let such stages fall back to split expressions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "tidewright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SPEED_CONF, **SEMANTIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to a session somebody else built."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    would lose the data together with the machine that holds it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidewright-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns cannot collide."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def task_slots(spark: SparkSession) -> int:
    """Partition count for an ordered layout: the session's own shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for costly row work on a table of few files.

    A table with at least one file per core is left alone: there the scan is
    parallel already and a shuffle would only cost. ``key`` should be unique, so
    that no partition is hot.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)
