"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Result-relevant settings: every timestamp is an instant, read and shown in UTC; a value that does
# not fit a column is an error and not a NULL.
SEMANTIC_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}

# Plan-relevant settings; all are adaptive, so no partition count is tied to a data size.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task holds at a time on its way to and from Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

# What only a new context takes: jobs of sources that run side by side share the cores.
START_CONF = {"spark.scheduler.mode": "FAIR"}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF, **START_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only a fallback for a local master, where the driver and the
    executors are one process; on a cluster the setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.gettempdir()


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A new, not yet existing path under the shared folder, removed when the JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/millrace-{label}-{uuid.uuid4().hex[:12]}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path
