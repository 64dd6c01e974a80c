"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; all can be changed at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only when the session names none (unit tests on one machine) is a local
    temporary folder chosen and remembered in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("beaconlog.scratch.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="beaconlog-")
        spark.conf.set("beaconlog.scratch.dir", base)
    return base.rstrip("/")


_SCOPE = "beaconlog.scratch.scope"


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/beaconlog{spark.conf.get(_SCOPE, '')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """Folders that jobs take inside the block are deleted at its end.

    For jobs that write their results elsewhere; a frame that still reads an
    intermediate table must not leave the block.
    """
    outer = spark.conf.get(_SCOPE, "")
    scope = f"{outer}/{label}-{uuid.uuid4().hex}"
    spark.conf.set(_SCOPE, scope)
    try:
        yield
    finally:
        spark.conf.set(_SCOPE, outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/beaconlog{scope}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside the block are deleted when a job ends, not when the driver collects its garbage.

    For steps that store what they make: nothing reads their shuffles again.
    """
    outer = spark.conf.get(_REMOVE, None)
    spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVE) if outer is None else spark.conf.set(_REMOVE, outer)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a stored table, and gives the planner real file sizes,
    so that later joins broadcast the result only when it is truly small.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
