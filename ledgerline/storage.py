"""Shared scratch storage for intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared scratch folder that the session names in spark.checkpoint.dir.

    A local session that names none gets one folder, removed when the process ends; on a cluster that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, _own[context.applicationId], ignore_errors=True)
    return _own[context.applicationId]


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor does not redo or change the work."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: unlike after a checkpoint their size is known to later joins."""
    folder = f"{shared_folder(df.sparkSession)}/ledgerline-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
