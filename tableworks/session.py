"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans. Sizes (shuffle partitions, memory) are
# the cluster's business and are left to it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tableworks", **settings: str) -> SparkSession:
    """A session with the library's defaults; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tableworks-"))
    return context.getCheckpointDir()


@contextmanager
def held(*tables: DataFrame) -> Iterator[None]:
    """Keep tables that are read several times; those the caller already keeps
    stay as they are afterwards."""
    new = [t for t in tables if not (t.storageLevel.useMemory or t.storageLevel.useDisk)]
    for t in new:
        t.persist()
    try:
        yield
    finally:
        for t in new:
            t.unpersist()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; see ``scratch`` and ``forget``.

    This cuts lineage, survives lost executors, freezes anything that depends on
    the physical partitioning, and gives the planner the true size of the table:
    later joins are broadcast only when the files are under the session's limit.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tableworks/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for scope in _scopes:
        scope.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def dropped(spark: SparkSession) -> None:
    """Have the files of shuffles deleted that nothing refers to any more, such as those of a
    fit that is done; the driver would do so when its memory is next cleaned, however late."""
    spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame | None) -> None:
    """Delete the table that ``written`` made for ``df``; nothing may read it afterwards."""
    path = getattr(df, "_written_to", None)
    if path:
        delete(df.sparkSession, path)


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; use results before that."""
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes.remove(mine)
        for path in mine:
            delete(spark, path)
