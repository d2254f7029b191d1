"""Written tables and files in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ledgerline.storage import shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder, so that two runs never meet."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write and reread: lost executors can't change or repeat the work, and joins see the real size."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_file(folder: str, name: str, content: bytes) -> str:
    """Write a file from a task: first under a name of the attempt, then renamed, so that no half file is seen."""
    if "://" in folder or folder.startswith("file:"):
        where, path = fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    else:
        where, path = fs.LocalFileSystem(), folder
    where.create_dir(path, recursive=True)
    part = posixpath.join(path, f"_{name}.{uuid.uuid4().hex}")
    with where.open_output_stream(part) as out:
        out.write(content)
    where.move(part, posixpath.join(path, name))
    return name
