"""Tables that end a lineage, and where they lie."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the context's checkpoint folder, or spark.checkpoint.dir.

    Where neither is set a local session gets a folder of its own and a cluster an error,
    since its machines share no temporary folder.
    """
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="sievework-")
    context.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that nothing has yet; what is written there goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def local_path(uri: str) -> str:
    """The path of a file: URI, for what reads files without Hadoop."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri} is no path that Python can open")
    return unquote(parts.path) if parts.scheme else uri


def stored(df: DataFrame) -> DataFrame:
    """df, computed now and read from a Parquet table in the shared folder."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
