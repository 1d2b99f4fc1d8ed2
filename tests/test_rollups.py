"""Metrics per day and month, against a plain Python model of them."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from statistics import fmean

import pytest
from pyspark.sql import functions as F

from layerwell.errors import MissingInputError
from layerwell.operators.rollups import event_metrics, rollup
from layerwell.plans.builders import (
    combined_monthly,
    daily_event_metrics,
    monthly_event_metrics,
    monthly_totals,
)

TRIPS = "left_on date, trip long, delay double, riders long, bikes long"
MEASURES = {"key": "trip", "means": {"delay": "mean_delay"}, "sums": {"riders": "riders", "bikes": "bikes"}}
RESULTS = ["total_events", "mean_delay", "riders", "bikes"]


def trips(seed, n=200, days=75):
    """Trips with repeated ids and gaps in every column, the date included."""
    r = random.Random(seed)

    def maybe(value):
        return None if r.random() < 0.15 else value

    return [
        (maybe(date(2025, 11, 20) + timedelta(days=r.randrange(days))), maybe(r.randrange(n // 2)),
         maybe(r.randrange(-40, 90) / 8), maybe(r.randrange(60)), maybe(r.randrange(5)))
        for _ in range(n)
    ]


def expected(rows, period):
    groups = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            groups[period(row[0])].append(row)
    out = {}
    for key, own in groups.items():
        delays = [x[2] for x in own if x[2] is not None]
        out[key] = (
            len({x[1] for x in own if x[1] is not None}), fmean(delays) if delays else None,
            sum(x[3] or 0 for x in own), sum(x[4] or 0 for x in own),
        )
    return out


def found(df, key):
    return {r[key]: tuple(r[c] for c in RESULTS) for r in df.collect()}


def daily(**more):
    return daily_event_metrics("trips", **MEASURES, date_column="left_on", **more)


def monthly():
    return monthly_event_metrics("trips", **MEASURES, date_column="left_on", result="month")


@pytest.mark.parametrize("seed", [1, 2])
def test_days(spark, seed):
    rows = trips(seed)
    out = daily()({"trips": spark.createDataFrame(rows, TRIPS).repartition(5)})
    assert found(out, "left_on") == expected(rows, lambda d: d)


@pytest.mark.parametrize("seed", [3, 4])
def test_months(spark, seed):
    rows = trips(seed)
    out = monthly()({"trips": spark.createDataFrame(rows, TRIPS).repartition(5)})
    assert found(out, "month") == expected(rows, lambda d: datetime(d.year, d.month, 1))


def test_ids_that_are_unique_need_no_distinct_count(spark):
    rows = [(d, i, x, a, b) for i, (d, _, x, a, b) in enumerate(trips(5))]
    out = daily(ids_are_unique=True)({"trips": spark.createDataFrame(rows, TRIPS)})
    assert found(out, "left_on") == expected(rows, lambda d: d)


def test_one_id_in_every_row_counts_once(spark):
    rows = [(date(2026, 5, 1), 77, float(i), 1, 0) for i in range(40)]
    assert found(daily()({"trips": spark.createDataFrame(rows, TRIPS)}), "left_on") == {date(2026, 5, 1): (1, 19.5, 40, 0)}


def test_dates_in_text_are_parsed_leniently(spark):
    rows = [(text, i, 1.0, 1, 1) for i, text in enumerate(["2026-05-01", "first of May", None, "2026-05-01", "2026-13-01"])]
    df = spark.createDataFrame(rows, TRIPS.replace("left_on date", "left_on string"))
    assert found(daily()({"trips": df}), "left_on") == {datetime(2026, 5, 1): (2, 1.0, 2, 2)}


def test_a_sketch_is_near_the_exact_count(spark):
    df = spark.range(5000).select(
        F.lit("all").alias("d"), F.col("id").alias("trip"),
        F.lit(1.0).alias("delay"), F.lit(1).alias("riders"), F.lit(1).alias("bikes"),
    )
    out = rollup(df, F.col("d"), "d", event_metrics(**MEASURES, approximate_error=0.02)).first()
    assert abs(out["total_events"] - 5000) < 400


def test_totals_by_month(spark):
    r = random.Random(6)
    rows = [(r.choice([None, date(2026, 4, 1), date(2026, 7, 1)]), r.choice([None, r.randrange(50)])) for _ in range(60)]
    build = monthly_totals("stock", "pieces", "month", "all_pieces")
    out = build({"stock": spark.createDataFrame(rows, "month date, pieces long")})
    want = {m: sum(n or 0 for x, n in rows if x == m) for m, _ in rows if m}
    assert {x["month"]: x["all_pieces"] for x in out.collect()} == want


def side_by_side():
    return combined_monthly(
        "trips", "stock", {"total_events": "trips", "mean_delay": "mean_delay"}, {"pieces": "pieces"}, key="month"
    )


def test_months_of_either_side_stay_and_null_months_meet(spark):
    ours = {None: (4, 0.5), datetime(2026, 4, 1): (9, None), datetime(2026, 6, 1): (1, -2.0)}
    theirs = {None: 8, "2026-06-01": 3, "2026-08-01": 0}
    left = spark.createDataFrame([(k, *v) for k, v in ours.items()], "month timestamp, total_events long, mean_delay double")
    right = spark.createDataFrame(list(theirs.items()), "month string, pieces long")
    made = {r["month"]: (r["trips"], r["mean_delay"], r["pieces"]) for r in side_by_side()({"trips": left, "stock": right}).collect()}
    assert made == {
        None: (4, 0.5, 8), datetime(2026, 4, 1): (9, None, None),
        datetime(2026, 6, 1): (1, -2.0, 3), datetime(2026, 8, 1): (None, None, 0),
    }


def test_settings_tell_builders_apart():
    assert daily() == daily() and repr(daily()) == repr(daily())
    assert daily() != daily(ids_are_unique=True) and daily() != monthly()
    assert daily().period.unit == "day" and monthly().unique == ("month",)


def test_missing_inputs(spark):
    df = spark.createDataFrame([], "month timestamp, total_events long, mean_delay double, pieces long")
    for build in (daily(), monthly(), monthly_totals("stock", "pieces", "month", "all"), side_by_side()):
        with pytest.raises(MissingInputError):
            build({"other": df})
    with pytest.raises(MissingInputError):
        side_by_side()({"trips": df})
