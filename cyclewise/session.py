"""SparkSession construction and cluster-shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "cyclewise",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session tuned for DataFrame work: AQE on, UI off, UTC, Arrow on.

    On a cluster ``master`` stays None and the launcher's settings win; the
    shuffle partition count then comes from the cluster config (AQE coalesces).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (applied at JVM launch)
        conf["spark.driver.memory"] = "12g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only pick our own when it is unset (local tests),
    and then only on a local master.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="cyclewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the shared checkpoint folder (resolved first).

    Cuts the lineage with files every executor can read back; never a local
    checkpoint, which would be lost with its executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
