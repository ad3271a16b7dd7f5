"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.sources.filesystem import exists, file_system, moved, remove

STAGED, READY = "_staged-", "_READY"


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_then_read(df: DataFrame, path: str) -> DataFrame:
    """Store a table and go on from the stored copy, which cuts its lineage."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_csv_table(df: DataFrame, path: str) -> None:
    """CSV part files with header, as many as the table has partitions."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv_folder(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One CSV part file with header, rows in key order.

    For aggregates.  The exchange to one partition comes after the aggregation,
    which therefore keeps its own parallelism; ``coalesce`` would not.
    """
    (
        df.repartition(1)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def write_csv_file(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One CSV file of exactly this name, on any file system Spark can write."""
    folder = f"{path}.{uuid4().hex}"
    write_csv_folder(df, folder, keys)
    spark = df.sparkSession
    if not _move_part(spark, folder, path):
        raise RuntimeError(f"expected one part file in {folder}")
    remove(spark, folder)


def write_csv_files(
    df: DataFrame, by: str, paths: Mapping[str, str], keys: Sequence[str]
) -> None:
    """One CSV file per value of ``by``, without that column, from a single job."""
    folder = f"{next(iter(paths.values()))}.{uuid4().hex}"
    (
        df.where(F.col(by).isin(*paths))
        .repartition(1)
        .sortWithinPartitions(by, *keys)
        .write.mode("overwrite")
        .partitionBy(by)
        .option("header", True)
        .csv(folder)
    )
    spark = df.sparkSession
    for value, path in paths.items():
        if not _move_part(spark, f"{folder}/{by}={value}", path):
            # A value without rows has no part; its file holds the header alone.
            write_csv_file(df.where(F.col(by) == value).drop(by), path, keys)
    remove(spark, folder)


def _move_part(spark: SparkSession, folder: str, path: str) -> bool:
    fs, pattern = file_system(spark, f"{folder}/part-*.csv")
    parts = fs.globStatus(pattern) or []
    if not parts:
        return False
    if len(parts) > 1:
        raise RuntimeError(f"{len(parts)} part files in {folder}, not one")
    return moved(spark, parts[0].getPath().toString(), path, replace=True)


def published_together(
    spark: SparkSession, folder: str, write: Callable[[str], list[str]]
) -> list[str]:
    """Files that ``write`` puts into a folder it is given, in ``folder`` all at once.

    ``write`` returns the paths it has made.  They are written to a hidden folder first;
    if that fails, ``folder`` is as it was.  When all are there a marker says so, and
    they are moved over those of the same names.  Should the job die between two moves,
    ``finish_publication`` does the rest.
    """
    finish_publication(spark, folder)
    stage = f"{folder}/{STAGED}{uuid4().hex}"
    try:
        paths = write(stage)
    except BaseException:
        remove(spark, stage)
        raise
    fs, ready = file_system(spark, f"{stage}/{READY}")
    fs.create(ready, False).close()
    _switch(spark, stage, folder)
    return [f"{folder}/{path[len(stage) + 1:]}" for path in paths]


def finish_publication(spark: SparkSession, folder: str) -> None:
    """Put in place what a job had completed but not moved when it died.

    To be called before files of ``folder`` are read or written.  Sets without the
    marker, of a job that failed or still writes, are left alone.
    """
    fs, pattern = file_system(spark, f"{folder}/{STAGED}*")
    for stage in fs.globStatus(pattern) or []:
        path = stage.getPath().toString()
        if exists(spark, f"{path}/{READY}"):
            _switch(spark, path, folder)


def _switch(spark: SparkSession, stage: str, folder: str) -> None:
    fs, at = file_system(spark, stage)
    for file in fs.listStatus(at):
        name = file.getPath().getName()
        if name != READY:
            moved(spark, f"{stage}/{name}", f"{folder}/{name}", replace=True)
    remove(spark, stage)
