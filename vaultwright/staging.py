"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vaultwright-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/vaultwright/{name}-{uuid.uuid4().hex}"


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# The folders to remove, for the thread and block that staged them, innermost last.
_for_now: ContextVar[tuple[list[str], ...]] = ContextVar("staged_for_now", default=())


@contextmanager
def staged_for_now(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what this thread staged meanwhile; nothing may read it afterwards.

    Blocks in other threads, such as other streams, and blocks inside this one keep to their own.
    """
    folders: list[str] = []
    before = _for_now.set((*_for_now.get(), folders))
    try:
        yield
    finally:
        _for_now.reset(before)
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove now what ``stage`` wrote for ``df``; nothing may read it afterwards."""
    spark, folder = df.sparkSession, getattr(df, "_staged", None)
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed.

    Spark keeps them until the driver collects its garbage, which on a large heap may be after many steps.  Events
    of the finished step that wait for their listeners still hold its shuffles, so a second call follows.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.4)


def stage(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and later steps read only the
    columns they need.  ``outlive``: the block inside which it is staged does not remove it, only one around that.
    """
    path = new_folder(df.sparkSession, name)
    blocks = _for_now.get()
    if outlive:
        blocks = blocks[:-1]
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged = path
    return staged
