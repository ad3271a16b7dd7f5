"""The same functions for SQL text, as temporary SQL functions.

They are SQL expressions that the optimizer inlines, so a query that calls them
runs without a Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from threadtone.constants import LINK_PREFIX_LENGTH, STATES
from threadtone.functions import text


def _raw(pattern: str) -> str:
    return f'r"{pattern}"'


def _parsed_sql(body: str) -> str:
    blanked = f"regexp_replace({body}, {_raw(text.BLANKS)}, ' ')"
    unlinked = f"regexp_replace({blanked}, {_raw(text.MARKDOWN_LINK)}, '$1$2')"
    bare = f"regexp_replace({unlinked}, {_raw(text.URL)}, '$1')"
    spaced = f"regexp_replace({bare}, {_raw(text.EDGE_PUNCTUATION)}, ' $1 ')"
    return f"trim(regexp_replace(lower({spaced}), ' {{2,}}', ' '))"


def _ngrams_sql(parsed: str, pattern: str) -> str:
    found = f"regexp_extract_all({parsed}, {_raw(pattern)}, 1)"
    return rf"split(replace(array_join({found}, '\n'), ' ', '_'), '\n')"


def register_functions(spark: SparkSession, states: Sequence[str] = STATES) -> None:
    """Make ``sanitize, cutoff, getProbability, validstate`` callable from SQL.

    ``getProbability`` takes the array form of a probability vector, as
    ``vector_to_array`` gives it.
    """
    parsed = _parsed_sql("body")
    words = f"regexp_replace({parsed}, {_raw(text.PHRASE_END_TOKEN)}, '')"
    listed = ", ".join("'" + s.replace("'", "\\'") + "'" for s in states)
    bodies = {
        "sanitize(body STRING) RETURNS ARRAY<STRING>": (
            f"concat(split(rtrim({words}), ' '), "
            f"{_ngrams_sql(parsed, text.BIGRAM)}, "
            f"{_ngrams_sql(parsed, text.TRIGRAM)})"
        ),
        "cutoff(link_id STRING) RETURNS STRING": (
            f"substring(link_id, {LINK_PREFIX_LENGTH + 1})"
        ),
        "getProbability(probability ARRAY<DOUBLE>) RETURNS FLOAT": (
            "cast(probability[1] AS FLOAT)"
        ),
        "validstate(state STRING) RETURNS INT": (
            f"CASE WHEN state IN ({listed}) THEN 1 ELSE 0 END"
        ),
    }
    for signature, expression in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {expression}"
        )
