"""Shared scratch storage: cutting lineage and writing intermediate tables.

A cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
session without that setting (tests, bench) gets a temporary folder of this machine, removed at its end.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data, set on the context as well."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        own = tempfile.mkdtemp(prefix="respan-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        current = sc.getCheckpointDir()
    return current


SETTLE_S = 0.3  # seconds between two collections of the driver

_noted: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for notes in _noted:
        notes.append(path)
    return path


@contextmanager
def noted_scratch():
    """Collects the paths handed out inside, for ``drop_scratch`` once nothing reads them any more."""
    notes: list[str] = []
    _noted.append(notes)
    try:
        yield notes
    finally:
        _noted.remove(notes)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that are over.

    Spark deletes them when the driver has collected the last reference to a step, which a driver with a
    large heap hardly ever does by itself; a job of many written steps would hold all of their files at once.  On a
    cluster, what refers to the last step goes with a first collection and the step itself with a second one.
    """
    collect = spark.sparkContext._jvm.java.lang.System.gc
    collect()
    time.sleep(SETTLE_S)
    collect()


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder below the shared folder, by Spark's own file system; a path elsewhere is refused."""
    root = scratch_root(spark).rstrip("/") + "/"
    if not path.startswith(root):
        raise ValueError(f"{path} is not below {root}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
