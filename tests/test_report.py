import math
import random

import pytest
from pyspark.sql import functions as F

from threadtone.operators import report

SHARES = "state string, Positive double, Negative double"


def shares(spark, rows):
    return spark.createDataFrame(rows, SHARES)


def scalar_bounds(values, low_ok, high_ok):
    lo, hi = round(min(values), 3), round(max(values), 3)
    return (
        lo - 0.001 if low_ok(lo - 0.001) else lo,
        hi + 0.001 if high_ok(hi + 0.001) else hi,
    )


def bounds(df):
    return tuple(df.first())


def test_time_series_keeps_rows_without_a_date(spark):
    daily = spark.createDataFrame(
        [("2018-12-31", 0.1, 0.2), ("2018-01-02", 0.3, 0.4), (None, 0.5, 0.6), ("2018-01-01", 0.7, 0.8)],
        "date string, pos_avg_day double, neg_avg_day double",
    )
    got = report.time_series(daily).collect()
    assert [(str(r.date), r.pos_avg_day) for r in got] == [
        ("None", 0.5), ("2018-01-01", 0.7), ("2018-01-02", 0.3),
    ]
    assert dict(report.time_series(daily).dtypes)["date"] == "date"


def test_score_curve_is_ordered(spark):
    df = spark.createDataFrame([(5, 0.1, 0.2), (-3, 0.3, 0.4)], "comment_score bigint, Positive double, Negative double")
    assert [r.comment_score for r in report.score_curve(df, "comment_score").collect()] == [-3, 5]


def test_extremes_break_ties_by_key(spark):
    df = shares(spark, [("b", 0.9, 0.0), ("a", 0.9, 0.0), ("d", 0.1, 0.0), ("c", 0.1, 0.0), ("e", None, 0.0)])
    assert tuple(report.extremes(df, "state", ["Positive"]).first()) == ("Positive", "a", 0.9, "c", 0.1)


@pytest.mark.parametrize(
    "values",
    [
        [0.2, 0.8], [0.0, 1.0], [0.0006, 0.9996], [0.001, 0.999], [0.0014, 0.0625],
        [0.0135, 0.0135], [0.9989, 0.9999], [0.5],
    ],
)
def test_bounds(spark, values):
    df = shares(spark, [(f"s{i}", v, v) for i, v in enumerate(values)])
    assert bounds(report.positive_bounds(df)) == scalar_bounds(
        values, lambda x: x > 0, lambda x: x > 0
    )
    assert bounds(report.negative_bounds(df)) == scalar_bounds(
        values, lambda x: x < 1, lambda x: x < 1
    )
    signed = [2 * v - 1 for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "Difference double")
    assert bounds(report.difference_bounds(df)) == scalar_bounds(
        signed, lambda x: x > -1, lambda x: x < 1
    )


def test_scales(spark):
    rng = random.Random(2)
    rows = [(s, rng.random(), rng.random()) for s in ("Ohio", "Utah", "Iowa")]
    # The places off the map take part in the bounds of the first two scales only.
    rows.append(("District of Columbia", 0.999, 0.0001))
    df = shares(spark, rows)
    states = df.select("state")
    on_map = rows[:3]

    lo, hi = scalar_bounds([r[1] for r in rows], lambda x: x > 0, lambda x: x > 0)
    got = {r.state: r.scale for r in report.positive_scale(df, states).collect()}
    assert got == {s: pytest.approx(math.sqrt((p - lo) / (hi - lo))) for s, p, _ in on_map}

    lo, hi = scalar_bounds([r[2] for r in rows], lambda x: x < 1, lambda x: x < 1)
    got = {r.state: r.scale for r in report.negative_scale(df, states).collect()}
    assert lo < 0
    assert got == {s: pytest.approx(math.sqrt((n - lo) / (hi - lo))) for s, _, n in on_map}

    diffs = {s: p - n for s, p, n in on_map}
    lo, hi = scalar_bounds(list(diffs.values()), lambda x: x > -1, lambda x: x < 1)
    got = {r.state: r.scale for r in report.difference_scale(df, states).collect()}
    assert got == {
        s: pytest.approx(math.sqrt((d - lo) / (hi - lo)) * 2 - 1) for s, d in diffs.items()
    }


def test_value_below_the_lower_bound_is_nan(spark):
    # 0.0006 rounds up to 0.001, which is not moved down as 0 is not above 0.
    df = shares(spark, [("Ohio", 0.0006, 0.1), ("Utah", 0.5, 0.2)])
    got = {r.state: r.scale for r in report.positive_scale(df, df.select("state")).collect()}
    assert math.isnan(got["Ohio"]) and got["Utah"] < 1


def test_equal_bounds_give_null(spark):
    df = shares(spark, [("Ohio", 0.5, 0.5)])
    flat = spark.createDataFrame([(0.5, 0.5)], "lo double, hi double")
    row = report._scaled(df, "Positive", flat, signed=False).first()
    assert row.scale is None


def test_missing_state_stops_the_report(spark):
    df = shares(spark, [("Ohio", 0.5, 0.5), ("Iowa", 0.6, 0.5)])
    states = spark.createDataFrame([("Ohio",), ("Utah",)], "state string")
    with pytest.raises(Exception, match="no fact for Utah"):
        report.positive_scale(df, states).collect()
    got = report.positive_scale(df, states, missing="null")
    assert got.where(F.col("state") == "Utah").first().scale is None


def test_no_cross_join_in_the_scales(spark):
    from tests.conftest import plan_of

    df = shares(spark, [("Ohio", 0.5, 0.5), ("Utah", 0.6, 0.5)])
    for build in (report.positive_scale, report.negative_scale, report.difference_scale):
        plan = plan_of(build(df, df.select("state")))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
