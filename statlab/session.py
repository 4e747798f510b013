"""Sessions for local runs, and the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(name: str, cores: str | int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the submitted session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STATLAB_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in a local session without one, a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="statlab-")
        folder = _own_folders[app]
    return folder


_open_scratch: list[list[str]] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for paths in _open_scratch:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder inside the block is removed at its end, so the result has to be written
    elsewhere or read before. Outside of such a block the files are left to the retention of the folder."""
    paths: list[str] = []
    _open_scratch.append(paths)
    try:
        yield
    finally:
        _open_scratch.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], Any]], threads: int) -> list[Any]:
    """The results of independent fits, in order, with up to ``threads`` of them submitted at a time."""
    with ThreadPool(max(1, min(threads, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks])


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result outlives lost executors, and the planner knows its true size, so a join with it
    is broadcast only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
