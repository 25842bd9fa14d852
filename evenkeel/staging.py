"""Written intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[tuple[str, ...]] = ContextVar("evenkeel_scope", default=())
_MARKED: WeakKeyDictionary = WeakKeyDictionary()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one beside the session's tables.

    The latter is in the warehouse, so on the session's own file system. A cluster whose warehouse is a folder of one
    machine is refused: the other machines could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    is_local = warehouse.startswith(("file:", "/"))
    if is_local and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder, or that of the innermost ``scratch`` block."""
    return "/".join([f"{scratch_root(spark)}/evenkeel", spark.sparkContext.applicationId, *_SCOPE.get()])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path; what is written there goes with the ``scratch`` block or with the application."""
    _delete_at_exit(spark)
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is deleted at its end; results must have been written or collected by then."""
    token = _SCOPE.set((*_SCOPE.get(), f"block-{uuid.uuid4().hex}"))
    folder = scratch_folder(spark)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete(spark, folder)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Later passes read only the columns they need, and a lost executor costs a
    re-read of its splits instead of a re-run of the plan above.
    """
    return _written(df, scratch_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``stage``, for a table that nothing refers to after the block; it is deleted then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        yield _written(df, path)
    finally:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it is. Spark has no public call for it, so a session without a JVM of
    its own (Spark Connect) leaves the folder to its owner."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _delete_at_exit(spark: SparkSession) -> None:
    """Marks the application's folder, once, to be deleted when its JVM ends."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None or _MARKED.get(spark.sparkContext):
        return
    _MARKED[spark.sparkContext] = True
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/evenkeel/{spark.sparkContext.applicationId}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
