"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
AT_ONCE = 4  # tables built together, so that small ones do not wait in line

T = TypeVar("T")

# The folder of the present :func:`scratch`: of this thread and those that it starts here, not of the session.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)

# What the jobs here rely on; they are set whatever spark-defaults say.  Master,
# memory, shuffle partitions and jars are left to the caller and the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Without a call site per column, long rule lists build several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "tillstar", **settings: str) -> SparkSession:
    """Build (or fetch) a session; ``settings`` override the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the one named in ``spark.checkpoint.dir``.

    Only a single-process local session may go without it; it then gets a
    temporary folder, remembered in the session's own settings.
    """
    folder = spark.conf.get(SHARED_DIR_CONF, None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("tillstar.shared.dir", None)
    if folder:
        return folder
    if not is_local(spark):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tillstar-")
    spark.conf.set("tillstar.shared.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder (or the present :func:`scratch`) that no other call has been given."""
    folder = _scratch.get() or f"{shared_dir(spark)}/tillstar"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a file, or a folder with all that it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """While it lasts, new paths lie in one folder, which is removed at its end."""
    folder = new_path(spark, "scratch")
    before = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(before)
        remove(spark, folder)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While it lasts, the shuffle files of a write or collect go when it has ended.

    Otherwise they stay until the driver's collector finds that nothing names
    them, which with much memory it may never do.  For steps that run every
    plan once; a plan that is run again makes its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back.

    Cuts the lineage: later readers neither recompute ``df`` nor depend on the
    executors that wrote it, and they can still prune columns.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(build: Callable[[str], T], names: Iterable[str]) -> dict[str, T]:
    """``{name: build(name)}`` for builds that do not need each other.

    Each build submits its own Spark jobs; a few run at a time and share the
    executors, and the first error is raised.
    """
    names = list(names)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        made = [pool.submit(copy_context().run, build, name) for name in names]
        return {name: one.result() for name, one in zip(names, made)}
