"""Session settings the library is measured with. Operators do not depend on them."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "patronage", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session. On a cluster, spark-submit's own settings take the place of this."""
    cores = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    # one machine runs everything here, so its own folder is one that all tasks reach
    settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix=f"{app}-shared-"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, for checkpoints and written intermediate tables.

    It is named in ``spark.checkpoint.dir``; without it the library stops, on any master.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if current is None and named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if current is None:
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return named or current


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of written intermediate tables, on whatever file system it is."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
