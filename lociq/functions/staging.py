"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset on a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lociq-"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _once(app: str, folder: str, name: str) -> tuple[str, list]:
    return f"{folder}/{re.sub('[^A-Za-z0-9.-]', '_', name)}-{uuid.uuid4().hex}", []


def written_once(spark: SparkSession, name: str, write: Callable[[str], None]) -> str:
    """The path of a table of this application that ``write(path)`` makes when it is first asked for."""
    path, done = _once(spark.sparkContext.applicationId, shared_dir(spark), name)
    if not done:
        write(path)
        done.append(True)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read again; other frames are left alone."""
    path = getattr(df, "_staged_at", None) if "_staged_at" in vars(df) else None
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
