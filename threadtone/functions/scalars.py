"""Small column functions: labels, flags, keys, dates, rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from threadtone.constants import (
    LINK_PREFIX_LENGTH,
    QUOTE_PREFIX,
    SARCASM_MARK,
    STATES,
)

_WHOLE_NUMBER = r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*$"


def label_value(label: Column) -> Column:
    """Label text as an int; text that is no number gives NULL, never an error."""
    digits = F.regexp_extract(label.cast("string"), _WHOLE_NUMBER, 1)
    return digits.try_cast("int")


def positive_label(label: Column) -> Column:
    return F.when(label_value(label) == 1, 1).otherwise(0)


def negative_label(label: Column) -> Column:
    return F.when(label_value(label) == -1, 1).otherwise(0)


def is_fresh_comment(body: Column) -> Column:
    """Neither a quote nor marked as sarcasm.  Both tests reach the Parquet scan."""
    return ~body.startswith(QUOTE_PREFIX) & ~body.contains(SARCASM_MARK)


def submission_id(link_id: Column) -> Column:
    """``t3_abc`` to ``abc``."""
    return F.substring(link_id, F.lit(LINK_PREFIX_LENGTH + 1), F.length(link_id))


def class1_probability(probability: Column) -> Column:
    """Probability of class 1 from a model's vector, in single precision."""
    return vector_to_array(probability)[1].cast("float")


def flag(probability: Column, threshold: float) -> Column:
    """1 where a single-precision probability exceeds a double threshold."""
    return F.when(probability.cast("double") > F.lit(float(threshold)), 1).otherwise(0)


def in_states(state: Column, states: Sequence[str] = STATES) -> Column:
    return state.isin(*states)


def local_date(epoch: Column) -> Column:
    """Calendar day of epoch seconds in the session time zone."""
    return F.to_date(F.timestamp_seconds(epoch))


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double, ties to even.

    ``F.round`` rounds the shortest decimal text instead, which differs where that
    text ends in 5.  The value is split so that both partial products with the
    power of ten are exact, and the fraction is compared without rounding.
    """
    power = float(10**digits)
    spread = value * F.lit(134217729.0)  # 2**27 + 1
    high = spread - (spread - value)
    low_part = (value - high) * F.lit(power)
    high_part = high * F.lit(power)
    whole = F.floor(high_part).cast("double")
    over_half = (high_part - whole) - F.lit(0.5)
    step = (
        F.when(over_half > -low_part, 1.0)
        .when(over_half < -low_part, 0.0)
        .otherwise(F.pmod(whole, F.lit(2.0)))
    )
    rounded = (whole + step) / F.lit(power)
    return F.when(F.isnan(value), value).otherwise(rounded)
