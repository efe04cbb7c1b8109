"""Session helpers.

On a cluster the session is created by the platform; ``get_session`` only
builds a local one for tests and the bench.  ``shared_dir`` returns the
shared folder used to cut lineage (``spark.checkpoint.dir``); only a local
session without one gets a private folder (tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "postlake") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Timestamps in the fixtures are wall-clock (TIMESTAMP_NTZ); keep UTC so
    # casts to/from session timestamps never shift them.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` (or a checkpoint dir already set on the
    context).  When neither is set, a single-process local session gets a
    private folder; on a cluster this fails, since executors could not see it.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="postlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared folder (Spark's writers create it)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
