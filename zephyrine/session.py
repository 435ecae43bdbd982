"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


_OWN_SCRATCH = "zephyrine.scratch.dir"
# Scratch folders this process removes at its end.
_FOLDERS: set[str] = set()


def build_session(app: str = "zephyrine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every calendar feature is defined on UTC wall time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_SCRATCH, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="zephyrine-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set(_OWN_SCRATCH, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one written table or one stream checkpoint.

    It lies in a folder of this application, which is removed when the application ends.
    """
    folder = os.path.join(scratch_root(spark), "zephyrine", spark.sparkContext.applicationId)
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove_folder, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return os.path.join(folder, f"{label}-{uuid.uuid4().hex}")


def _remove_folder(jvm, conf, folder: str) -> None:
    """Deletes the application's written tables; its JVM may already be gone."""
    with contextlib.suppress(Py4JError, OSError):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
