"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from cohortscope.sources.files import write_table

_CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="cohortscope-")


def shared_dir(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`; in local mode a temporary folder when unset."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cohortscope/{name}-{uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A shared folder that is deleted with all in it at the end of the block."""
    path = scratch_path(spark, "run")
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back: later uses scan the table instead of the lineage.

    The table outlives lost executors, and its size is known when joins are planned.
    """
    return write_table(df, scratch_path(df.sparkSession, name))


def land_all(
    frames: Mapping[str, DataFrame], write: Callable[[DataFrame, str], DataFrame] = land
) -> dict[str, DataFrame]:
    """Land independent frames at the same time, so short jobs fill the cluster together."""
    with ThreadPoolExecutor(len(frames)) as pool:
        landed = pool.map(lambda name: write(frames[name], name), frames)
        return dict(zip(frames, landed, strict=True))
