"""Where jobs may write: the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own machine.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{SETTING} is not set; a cluster job needs a shared folder")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="vocatio-")
    return _local_folders[context.applicationId]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
