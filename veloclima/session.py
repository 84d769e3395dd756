"""Session settings the jobs are tuned for, and the folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: small shuffles are coalesced, hot join keys are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Month-partitioned writes keep a few files open instead of sorting every
    # task's rows by month first; beyond this many months Spark sorts as usual.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(
    app_name: str, master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path for a table written between jobs.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    local session may fall back to a temporary folder: on a cluster that
    folder would die with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        application = spark.sparkContext.applicationId
        if application not in _local_roots:
            _local_roots[application] = tempfile.mkdtemp(prefix="veloclima-")
            atexit.register(shutil.rmtree, _local_roots[application], ignore_errors=True)
        root = _local_roots[application]
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder of this session.  Results that read them are void after that."""
    conf = spark._jsc.hadoopConfiguration()
    for path in _made.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
