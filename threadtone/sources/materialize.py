"""Read a stored table if it is there and still right, else compute and store it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from threadtone.session import shared_folder
from threadtone.sources.filesystem import exists, file_system, private_path, settled
from threadtone.sources.writers import write_table

# To be raised when the text chain, the schemas or the models change what is stored.
FORMAT_VERSION = 3


def fingerprint(
    spark: SparkSession, paths: Sequence[str], params: Mapping[str, Any]
) -> str:
    """Digest of every input file's path, length and time, and of the parameters.

    A path may be a folder, which is listed to its end, or a pattern.  No data is
    read.  Tables of another ``FORMAT_VERSION`` are never taken for these.
    """
    inputs = []
    for path in paths:
        fs, pattern = file_system(spark, path)
        found = fs.globStatus(pattern) or []
        if not found:
            raise FileNotFoundError(path)
        for status in found:
            listed = fs.listFiles(status.getPath(), True)
            while listed.hasNext():
                file = listed.next()
                inputs.append([file.getPath().toString(), file.getLen(), file.getModificationTime()])
    text = json.dumps(
        [FORMAT_VERSION, sorted(inputs), dict(params)], sort_keys=True, default=str
    )
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def materialize(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    key: str,
    folder: str | None = None,
) -> DataFrame:
    """The stored table ``name`` for fingerprint ``key``; built on first use.

    A table is written to a folder of the attempt's own and renamed when it is complete,
    so nobody reads half a table or one that is being replaced.  Of two builders at once
    the first to finish wins, and both read its table.  A folder without a success marker
    is built again.  Other errors surface.  What is returned always reads from the files,
    never from the plan that made them.
    """
    path = f"{folder or shared_folder(spark)}/{name}-{key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        attempt = private_path(path)
        write_table(build(), attempt)
        settled(spark, attempt, path, "_SUCCESS")
    return spark.read.parquet(path)
