"""A folder for intermediate tables that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a local session gets a temporary one; on a cluster that is an
    error, since each executor would write to a disk of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="strandlake-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df, evaluated once into the shared folder, and where it lies. It is read as often as one likes and survives lost
    executors; `forget` deletes it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


@contextmanager
def evaluated_once(df: DataFrame, name: str = "shared") -> Iterator[DataFrame]:
    """df for the outputs of a with block, evaluated once and deleted at the block's end."""
    found, path = staged(df, name)
    try:
        yield found
    finally:
        forget(df.sparkSession, path)


def write_outputs(df: DataFrame, outputs: dict[str, Callable[[DataFrame, str], None]]) -> None:
    """Several outputs of one frame: each writer is called with the frame and its path. The frame is evaluated once."""
    with evaluated_once(df) as shared:
        for path, write in outputs.items():
            write(shared, path)
