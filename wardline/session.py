"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the plans are written for.  Partition counts are left to adaptive
#: execution: start wide, let it merge small partitions and split hot ones.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A wide record makes generated methods longer than the JVM is willing to
    # compile; beyond this size Spark then prefers its split, compilable form.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every column operation takes longer
    # than planning these queries does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "wardline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the recommended settings; keyword settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session somebody else built.

    Stored times are UTC, so time arithmetic has to run in UTC.  Settings that
    are fixed once a session exists stay as they are.
    """
    for key, value in RECOMMENDED_CONF.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``.  Only a local
    session, whose executors all share this machine's disk, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="wardline-")
    return f"{root.rstrip('/')}/wardline/{purpose}-{uuid.uuid4().hex}"
