"""Declared schemas: no inference pass over the input."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# The labelled file is untyped text; functions.labels reads the values.
LABELED = _struct(
    ("Input_id", T.StringType()),
    ("labeldem", T.StringType()),
    ("labelgop", T.StringType()),
    ("labeldjt", T.StringType()),
)

COMMENTS = _struct(
    ("id", T.StringType()),
    ("body", T.StringType()),
    ("link_id", T.StringType()),
    ("created_utc", T.LongType()),
    ("score", T.LongType()),
    ("author_flair_text", T.StringType()),
)

SUBMISSIONS = _struct(("id", T.StringType()), ("score", T.LongType()))

BODIES = _struct(("body", T.StringType()))

# Published reports, as read back from CSV.
TIME_DATA = _struct(
    ("date", T.StringType()),
    ("pos_avg_day", T.DoubleType()),
    ("neg_avg_day", T.DoubleType()),
)


def share_file(key: str, kind: T.DataType) -> T.StructType:
    return _struct((key, kind), ("Positive", T.DoubleType()), ("Negative", T.DoubleType()))


STATE_DATA = share_file("state", T.StringType())
COMMENT_SCORE = share_file("comment_score", T.LongType())
SUBMISSION_SCORE = share_file("submission_score", T.LongType())
