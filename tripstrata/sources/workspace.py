"""Folders for data a job writes along the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without: there, one machine is the whole cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tripstrata-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
