"""Scans, all with declared schemas; a path may be a list of paths or a pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadtone import schemas

Paths = str | Sequence[str]

# Columns of a checked scan: the record as it stands in the file, if it is malformed,
# and the file.
REJECTED, FILE = "_rejected", "_file"


def _listed(path: Paths) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def _value(name: str, kind: T.DataType) -> Column:
    """A text column as the declared type; NULL where it holds no such value.

    Whole numbers may be written with a fraction or an exponent.
    """
    text = _named(name)
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.LongType):
        text = F.trim(text).try_cast("decimal(38,9)")
    return text.try_cast(kind)


def read_csv(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """The schema's columns, found by their names in the header.

    Other columns are passed over, and their order does not matter; a column that is
    not there is an error.  All files of one call have the same header.
    """
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .csv(_listed(path))
    )
    absent = [name for name in schema.names if name not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return raw.select(*(_value(f.name, f.dataType).alias(f.name) for f in schema.fields))


def _raw_json(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    return spark.read.schema(text).json(_listed(path))


def read_json(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """JSON lines, plain or compressed.  bz2 files are split across tasks.

    Only the fields of the schema are parsed.  Numbers may be quoted or written with
    a fraction.  A line that is no JSON object gives a row of NULLs, which the filters
    and inner joins downstream drop.
    """
    raw = _raw_json(spark, path, schema)
    return raw.select(*(_value(f.name, f.dataType).alias(f.name) for f in schema.fields))


def unreadable(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """One row: per field, how many values of JSON lines the declared type cannot hold."""
    raw = _raw_json(spark, path, schema)
    lost = {
        f.name: _named(f.name).isNotNull() & _value(f.name, f.dataType).isNull()
        for f in schema.fields
    }
    return raw.agg(*(F.count_if(c).alias(name) for name, c in lost.items()))


def _checked(raw: DataFrame, schema: T.StructType) -> DataFrame:
    values = (_value(f.name, f.dataType).alias(f.name) for f in schema.fields)
    return raw.select(*values, F.col("_metadata.file_path").alias(FILE), F.col(REJECTED))


def _with_rejected(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, REJECTED)])


def checked_json(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """Every line of JSON files: the schema's columns, ``_file`` and ``_rejected``.

    ``_rejected`` is the line itself where it is no JSON object, and NULL elsewhere.
    Store this table, then take ``accepted`` and ``rejected`` of it: one scan for both.
    """
    raw = (
        spark.read.schema(_with_rejected(schema.names))
        .option("columnNameOfCorruptRecord", REJECTED)
        .json(_listed(path))
    )
    return _checked(raw, schema)


def checked_csv(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """The same of CSV files: rejected are records with more or fewer fields than the header."""
    header = spark.read.option("header", True).csv(_listed(path)).columns
    absent = [name for name in schema.names if name not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    raw = (
        spark.read.schema(_with_rejected(header))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", False)  # else fields of a record are not counted
        .csv(_listed(path))
    )
    return _checked(raw, schema)


def accepted(checked: DataFrame) -> DataFrame:
    """The well-formed records of a checked scan, without its two columns."""
    return checked.where(F.col(REJECTED).isNull()).drop(REJECTED, FILE)


def rejected(checked: DataFrame) -> DataFrame:
    """``file, record`` of the malformed ones."""
    return checked.where(F.col(REJECTED).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(REJECTED).alias("record")
    )


def rejected_by_file(checked: DataFrame) -> DataFrame:
    """``file, records``: how many of each file's records are malformed."""
    return rejected(checked).groupBy("file").agg(F.count("*").alias("records"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_labeled(
    spark: SparkSession, path: Paths, schema: T.StructType = schemas.LABELED
) -> DataFrame:
    return read_csv(spark, path, schema)


def read_comments(spark: SparkSession, path: Paths) -> DataFrame:
    return read_json(spark, path, schemas.COMMENTS)


def read_submissions(spark: SparkSession, path: Paths) -> DataFrame:
    return read_json(spark, path, schemas.SUBMISSIONS)


def read_bodies(spark: SparkSession, path: Paths) -> DataFrame:
    return read_json(spark, path, schemas.BODIES)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with too few splits for the cluster one task per slot and more.

    Meant for the costly text steps over a small or badly split file; ``df`` is a bare
    scan.  A scan that already has two splits per slot, which any large table has, is
    left as it is: no shuffle.  Rows are dealt out in turn, so no id can fill one task.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * slots:
        return df
    return df.repartition(3 * slots)
