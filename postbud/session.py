"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    # Run-time re-planning: coalescing, broadcast by measured size, splitting of skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes, which wide projections reach. Beyond the
    # limit Spark splits them into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="postbud-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def session_folder(spark: SparkSession) -> str:
    """A folder of this session's own in the shared one, which goes when the session's JVM ends.

    Tables that a query stages must outlive it, as its result is read from them.
    """
    folder = f"{shared_folder(spark)}/postbud/session-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used before."""
    return f"{_run_folder.get() or session_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[None]:
    """All tables staged within lie in one folder, which goes at the end, also after an error."""
    folder = scratch_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and go on from the file: lineage is cut and sizes are known.

    The table lives in the shared folder, so losing executors costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
