"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "quitanda", **conf: object) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting gets a folder of its own: there driver and
    executors are one process. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_location(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/quitanda-{uuid.uuid4().hex}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``, in any file system Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """An unused folder in the shared folder, removed with all it holds when the block ends.

    Whatever was read from it lazily must be stored elsewhere by then.
    """
    folder = new_location(spark, "scratch")
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder.rpartition("/")[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it has ended, not when the driver next collects garbage.

    For a chain of jobs that each store what they make: a query that is run again computes its shuffles again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
