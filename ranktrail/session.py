"""Session settings and the shared folder for written intermediates."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "ranktrail", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tested with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # recording a call site per column expression doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``, or else the one set with
    ``setCheckpointDir``. Where both are unset a temporary folder stands in, but only on a local
    master: on a cluster a machine-local path would not be readable by other executors.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    app_id = context.applicationId
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app_id not in _local_dirs:
            _local_dirs[app_id] = tempfile.mkdtemp(prefix="ranktrail-")
        base = _local_dirs[app_id]
    return os.path.join(base, "ranktrail", app_id, f"{name}-{uuid.uuid4().hex[:12]}")


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders this library wrote, in whatever store they are; missing ones are fine."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cleanup(spark: SparkSession) -> None:
    """Remove every intermediate this application wrote, once nothing reads them any more."""
    remove(spark, os.path.dirname(shared_dir(spark, "any")))
