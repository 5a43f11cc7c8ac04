"""The folder that all machines of a cluster share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local folder where none is set and all runs on one machine."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (current.get() if current.isDefined() else None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="bazaarlens-")
    if not current.isDefined():
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, kind: str) -> str:
    """The name of a folder in the shared one that nobody else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
