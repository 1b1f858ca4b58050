"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "opsmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the submit command sets
    the master, memory and shuffle sizes; AQE then sizes the partitions."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. One of our own only where it is
    unset and the session is local, as in tests; on a cluster executors would
    each write to their own disk, so there it must be set."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="opsmill-", dir=os.environ.get("TMPDIR"))
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one written table in the shared folder."""
    return f"{checkpoint_dir(spark)}/opsmill-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: work done once for
    several readers, and it outlives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
