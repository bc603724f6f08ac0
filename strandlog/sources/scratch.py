"""Where intermediate tables go: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the session's checkpoint folder.

    Only where both are unset and driver and executors are one process, as in tests, a temporary folder is
    made; on a cluster that is an error, as executors don't see each other's disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = made.get() if made.isDefined() else None
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="strandlog-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{scratch_dir(spark)}/strandlog/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
