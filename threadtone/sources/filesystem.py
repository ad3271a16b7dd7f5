"""The Hadoop file system behind a path, as Spark itself resolves it, and moves on it."""

from __future__ import annotations

from uuid import uuid4

import pyarrow.fs
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """``(file system, path object)``; works for local disks, HDFS and object stores."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def files(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path behind a folder's address, in a task or the driver."""
    if "://" not in folder and not folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


def stored_files(folder: str, ending: str) -> list[str]:
    """Paths of the files in a folder that end so, in order, for the file system of ``files``."""
    system, path = files(folder)
    found = system.get_file_info(pyarrow.fs.FileSelector(path))
    return sorted(i.path for i in found if i.is_file and i.base_name.endswith(ending))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that is not needed any more."""
    fs, target = file_system(spark, folder)
    fs.delete(target, True)


def private_path(path: str) -> str:
    """A sibling of ``path`` for one attempt alone.

    Its name begins with an underscore, so no reader of the parent folder sees it.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{uuid4().hex}"


def moved(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Rename ``source``; False if ``target`` is there and is not to be replaced.

    The check and the rename are one call of the file system where it has such a call.
    Files may be replaced, and empty folders.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs, start = file_system(spark, source)
    end = jvm.org.apache.hadoop.fs.Path(target)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.valueOf("OVERWRITE" if replace else "NONE")
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
        )
        context.rename(fs.makeQualified(start), fs.makeQualified(end), options)
        return True
    except Py4JJavaError as error:
        name = error.java_exception.getClass().getSimpleName()
        if name == "UnsupportedFileSystemException":  # no such call there
            if fs.exists(end):
                if not replace:
                    return False
                fs.delete(end, False)
            return fs.rename(start, end)
        if not replace and fs.exists(end) and fs.exists(start):
            return False
        raise


def settled(spark: SparkSession, attempt: str, path: str, marker: str) -> bool:
    """Move a finished attempt to ``path``, unless another one has got there first.

    ``marker`` is a file that only a finished folder has.  What another attempt has put
    there stays; this one is deleted then.  An unfinished folder gives way.
    """
    if moved(spark, attempt, path):
        return True
    if not exists(spark, f"{path}/{marker}"):
        remove(spark, path)
        if moved(spark, attempt, path):
            return True
    remove(spark, attempt)
    return False


def replaced(spark: SparkSession, attempt: str, path: str) -> None:
    """Move a finished folder to ``path``; what is there goes after it is in place."""
    old = private_path(path)
    had = exists(spark, path) and moved(spark, path, old)
    if not moved(spark, attempt, path):
        raise RuntimeError(f"another writer has put something at {path}")
    if had:
        remove(spark, old)
