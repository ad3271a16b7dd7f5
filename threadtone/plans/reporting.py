"""Published share files to report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from threadtone import schemas
from threadtone.constants import BAD_DATE, OFF_MAP, STATES
from threadtone.operators import report
from threadtone.sources.readers import read_csv
from threadtone.sources.writers import finish_publication, published_together, write_csv_file


def report_tables(
    spark: SparkSession,
    folder: str,
    prefix: str = "",
    states: Sequence[str] = STATES,
    off_map: Sequence[str] = OFF_MAP,
    bad_date: str = BAD_DATE,
    missing: str = "error",
) -> dict[str, DataFrame]:
    """The tables behind the charts and maps of one target.

    A state without a share stops the job, or with ``missing="null"`` gets none.
    """
    finish_publication(spark, folder.rstrip("/"))

    def published(file: str, schema) -> DataFrame:
        return read_csv(spark, f"{folder}/{prefix}{file}", schema)

    shares = published("state_data.csv", schemas.STATE_DATA)
    places = spark.createDataFrame([(s,) for s in states], "state string")
    submission = published("submission_score.csv", schemas.SUBMISSION_SCORE)
    comment = published("comment_score.csv", schemas.COMMENT_SCORE)
    return {
        "time_series": report.time_series(
            published("time_data.csv", schemas.TIME_DATA), bad_date
        ),
        "positive_scale": report.positive_scale(shares, places, off_map, missing),
        "negative_scale": report.negative_scale(shares, places, off_map, missing),
        "difference_scale": report.difference_scale(shares, places, off_map, missing),
        "submission_curve": report.score_curve(submission, "submission_score"),
        "comment_curve": report.score_curve(comment, "comment_score"),
    }


def write_reports(tables: dict[str, DataFrame], folder: str, prefix: str = "") -> list[str]:
    """One CSV file per table, ordered by its first column; all appear together."""

    def write(stage: str) -> list[str]:
        paths = []
        for name, table in tables.items():
            paths.append(f"{stage}/{prefix}{name}.csv")
            write_csv_file(table, paths[-1], table.columns[:1])
        return paths

    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    return published_together(spark, folder.rstrip("/"), write)
