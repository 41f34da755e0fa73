"""Intermediate results in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="visitmill-")


_held: ContextVar[list[str] | None] = ContextVar("staged paths of a job", default=None)


@contextmanager
def staged_files(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is staged inside; frames from it must be used up by then."""
    token = _held.set([])
    try:
        yield
    finally:
        for path in _held.get():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _held.reset(token)


def scratch_path(spark: SparkSession, name: str = "") -> str:
    """A new path in the shared folder, which goes with the files of the job around it."""
    path = f"{shared_folder(spark)}/visitmill/{name}{uuid.uuid4().hex}"
    held = _held.get()
    if held is not None:
        held.append(path)
    return path


def stage(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-computation, and
    later readers of the columnar file read only the columns they use.
    """
    path = scratch_path(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
