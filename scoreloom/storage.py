"""Shared scratch storage of the session."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster a missing setting is an error, because a machine-local path
    would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local($|\[)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = context.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="scoreloom-")
    return _local_folders[application]


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its size known to the planner."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
