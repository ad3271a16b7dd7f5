"""Report tables: time series, score curves, map scales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.constants import BAD_DATE, OFF_MAP, SCALE_DIGITS
from threadtone.functions.scalars import round_half_even
from threadtone.operators.joins import looked_up


def time_series(daily: DataFrame, bad_date: str = BAD_DATE) -> DataFrame:
    """Daily shares in date order without the erroneous day.

    Rows without a date stay: only the bad day itself is dropped.
    """
    return (
        daily.where(~F.col("date").cast("string").eqNullSafe(bad_date))
        .withColumn("date", F.to_date(F.col("date").cast("string"), "yyyy-MM-dd"))
        .orderBy("date")
    )


def score_curve(shares: DataFrame, score: str) -> DataFrame:
    """Shares along a score, in score order."""
    return shares.select(score, "Positive", "Negative").orderBy(score)


def extremes(shares: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """``share`` and key and value of its largest and smallest; equals by key.

    One row per name in ``values``, all from one pass over the shares.
    """

    def ends(value: str) -> Column:
        lowest = F.struct(F.col(value).alias("v"), F.col(key).alias("k"))
        highest = F.struct((-F.col(value)).alias("v"), F.col(key).alias("k"))
        known = F.when(F.col(value).isNotNull(), F.col(key))
        return F.struct(
            F.lit(value).alias("share"),
            F.min_by(known, F.when(known.isNotNull(), highest)).alias("max_key"),
            F.max(value).alias("max_value"),
            F.min_by(known, F.when(known.isNotNull(), lowest)).alias("min_key"),
            F.min(value).alias("min_value"),
        )

    return shares.agg(F.array(*map(ends, values)).alias("ends")).select(F.inline("ends"))


def _bounds(
    values: DataFrame, value: str, low_if: tuple[str, float], high_if: tuple[str, float]
) -> DataFrame:
    # The rounded extremes, each moved outwards by one step where the moved value
    # passes its test.
    step = 1 / 10**SCALE_DIGITS
    ends = values.agg(
        round_half_even(F.min(value), SCALE_DIGITS).alias("lo"),
        round_half_even(F.max(value), SCALE_DIGITS).alias("hi"),
    )
    low, high = F.col("lo") - F.lit(step), F.col("hi") + F.lit(step)
    return ends.select(
        F.when(_passes(low, *low_if), low).otherwise(F.col("lo")).alias("lo"),
        F.when(_passes(high, *high_if), high).otherwise(F.col("hi")).alias("hi"),
    )


def _passes(value: Column, test: str, limit: float) -> Column:
    return value > F.lit(limit) if test == ">" else value < F.lit(limit)


def positive_bounds(shares: DataFrame) -> DataFrame:
    return _bounds(shares, "Positive", (">", 0.0), (">", 0.0))


def negative_bounds(shares: DataFrame) -> DataFrame:
    return _bounds(shares, "Negative", ("<", 1.0), ("<", 1.0))


def difference_bounds(differences: DataFrame) -> DataFrame:
    return _bounds(differences, "Difference", (">", -1.0), ("<", 1.0))


def _scaled(rows: DataFrame, value: str, bounds: DataFrame, signed: bool) -> DataFrame:
    # The one-row bounds come in as a scalar subquery.  A value below the lower
    # bound gives NaN; equal bounds give NULL.
    at = bounds.select(F.struct("lo", "hi")).scalar()
    rows = rows.withColumn("__b", at)
    lo, hi = F.col("__b.lo"), F.col("__b.hi")
    scale = F.sqrt((F.col(value) - lo) / F.nullif(hi - lo, F.lit(0.0)))
    if signed:
        scale = scale * 2 - 1
    return rows.select("state", value, lo.alias("lo"), hi.alias("hi"), scale.alias("scale"))


def _on_map(states: DataFrame, off_map: Sequence[str]) -> DataFrame:
    return states.select("state").where(~F.col("state").isin(*off_map))


def positive_scale(
    shares: DataFrame,
    states: DataFrame,
    off_map: Sequence[str] = OFF_MAP,
    missing: str = "error",
) -> DataFrame:
    """Positive share of each state on the map, scaled between the bounds.

    The bounds are taken over all states of the file, also those off the map.
    """
    rows = looked_up(_on_map(states, off_map), shares, "state", "Positive", missing)
    return _scaled(rows, "Positive", positive_bounds(shares), signed=False)


def negative_scale(
    shares: DataFrame,
    states: DataFrame,
    off_map: Sequence[str] = OFF_MAP,
    missing: str = "error",
) -> DataFrame:
    rows = looked_up(_on_map(states, off_map), shares, "state", "Negative", missing)
    return _scaled(rows, "Negative", negative_bounds(shares), signed=False)


def difference_scale(
    shares: DataFrame,
    states: DataFrame,
    off_map: Sequence[str] = OFF_MAP,
    missing: str = "error",
) -> DataFrame:
    """Positive minus negative share, scaled; bounds without states off the map."""
    differences = shares.where(~F.col("state").isin(*off_map)).select(
        "state", (F.col("Positive") - F.col("Negative")).alias("Difference")
    )
    rows = looked_up(_on_map(states, off_map), differences, "state", "Difference", missing)
    return _scaled(rows, "Difference", difference_bounds(differences), signed=True)
