"""Where intermediate rows and generations are written: the folder that the session names, shared by all executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of its own only where nothing is named and all runs in one process."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    return _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="transquill-"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in that folder."""
    return f"{folder(spark).rstrip('/')}/transquill/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once; they survive the loss of executors, and their partitions are not planned anew."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        where = folder(df.sparkSession)
        context.setCheckpointDir(where)
    return df.checkpoint()
