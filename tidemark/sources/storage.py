"""Paths, run folders and materialised intermediate tables.

Everything goes through the Hadoop file system API of the session, so local
disks, HDFS and object stores behave alike.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path``; empty when it does not exist."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``; empty when it does not exist."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]


# File systems on which only one of several writers can create a file.
EXCLUSIVE_SCHEMES = ("file", "hdfs", "viewfs")


def create_marker(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False when it was already there."""
    fs, target = _file_system(spark, path)
    return fs.createNewFile(target)


def claim(spark: SparkSession, path: str) -> bool:
    """Creates a file that at most one caller can create; False for the others.

    Object stores check and create in two steps and are refused.
    """
    require_exclusive(spark, path)
    fs, target = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        local = Path(target.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        try:
            local.touch(exist_ok=False)
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def require_exclusive(spark: SparkSession, path: str) -> None:
    """Fails for paths on which :func:`claim` does not work."""
    scheme = _file_system(spark, path)[0].getUri().getScheme()
    if scheme not in EXCLUSIVE_SCHEMES:
        raise ValueError(f"{scheme} cannot create a file exclusively; publish on one of {EXCLUSIVE_SCHEMES}")


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder, whose new place must be free."""
    fs, old = _file_system(spark, source)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a session inside one machine's single process may go without: its folder
    then becomes the checkpoint folder of the context, for later calls as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


# Scratch paths of the job that is running in this context, None outside any.
_OWNED: ContextVar[list[str] | None] = ContextVar("tidemark_scratch", default=None)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes all scratch tables made inside once the block is left, however it is left.

    For jobs whose results are published or collected inside the block: what is
    still to be read afterwards must not depend on scratch tables. Blocks may be
    nested, and the threads of ``side_by_side`` belong to the block they start in.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            remove(spark, path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; never reused between calls.

    It belongs to the ``owned_scratch`` block it is made in, and to the caller
    outside of any.
    """
    path = f"{shared_folder(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"
    paths = _OWNED.get()
    if paths is not None:
        paths.append(path)
    return path


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage with files that outlive any executor, and fixes the result
    of plans whose rows could come out differently when evaluated twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
