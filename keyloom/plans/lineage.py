"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode, where none need be set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and re.fullmatch(r"local(\[.*\])?", sc.master) is None:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="keyloom-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
