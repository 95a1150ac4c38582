import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmart.functions import calendar
from gridmart.operators.slots import PRICE_DIMS, completeness, expected_slots, missing_slots
from samples import utc


def prices(spark, starts, resolution="PT15M", zone="Z"):
    frame = spark.createDataFrame(
        [(utc(s).replace(tzinfo=dt.timezone.utc), zone, resolution) for s in starts],
        "delivery_start_utc timestamp, bidding_zone string, resolution string",
    )
    return calendar.add_local_columns(frame)


@pytest.mark.parametrize(
    "day, start, slots",
    [
        ("2026-03-29", "2026-03-28T23:00", 92),
        ("2026-10-25", "2026-10-24T22:00", 100),
        ("2026-09-20", "2026-09-19T22:00", 96),
    ],
)
def test_day_length(spark, day, start, slots):
    points = prices(spark, [start])
    assert [str(r[0]) for r in points.select("delivery_date_local").collect()] == [day]
    assert expected_slots(points, PRICE_DIMS).count() == slots
    assert missing_slots(points, PRICE_DIMS).count() == slots - 1
    report = completeness(points, PRICE_DIMS).first()
    assert (report.expected_slots, report.missing_slots) == (slots, slots - 1)


def test_points_around_local_midnight(spark):
    points = prices(spark, ["2026-09-19T21:45", "2026-09-19T22:00"])
    got = points.orderBy("delivery_start_utc").select(
        "delivery_date_local", F.date_format("delivery_start_local", "HH:mm")
    )
    assert [(str(d), t) for d, t in got.collect()] == [("2026-09-19", "23:45"), ("2026-09-20", "00:00")]


def test_filter_target_day(spark):
    points = prices(
        spark, ["2026-09-19T21:45", "2026-09-19T22:00", "2026-09-20T21:45", "2026-09-20T22:00"]
    )
    kept = calendar.filter_target_day(points, calendar.target_day("2026-09-20"))
    assert sorted(str(r[0]) for r in kept.select(F.date_format("delivery_start_utc", "HH:mm")).collect()) == [
        "21:45",
        "22:00",
    ]


def test_target_day(spark):
    pick = lambda column: spark.range(1).select(column.alias("d")).first().d
    assert pick(calendar.target_day("2026-09-20")) == dt.date(2026, 9, 20)
    yesterday = dt.datetime.now(__import__("zoneinfo").ZoneInfo("Europe/Rome")).date() - dt.timedelta(1)
    assert abs(pick(calendar.target_day()) - yesterday) <= dt.timedelta(days=1)
    with pytest.raises(ValueError):
        calendar.target_day("20-09-2026")


def test_slots_of_mixed_resolutions(spark):
    mixed = prices(spark, ["2026-09-20T00:00"]).unionByName(
        prices(spark, ["2026-09-20T01:00"], "PT60M")
    )
    assert missing_slots(mixed, PRICE_DIMS).count() == 0
    report = completeness(mixed, PRICE_DIMS).first()
    assert (report.resolution, report.expected_slots, report.missing_slots) == (None, None, None)


def test_off_grid_points_fill_no_slot(spark):
    points = prices(spark, ["2026-09-20T00:00", "2026-09-20T01:20"], "PT1H")
    assert missing_slots(points, PRICE_DIMS).count() == 23
    assert completeness(points, PRICE_DIMS).first().missing_slots == 23


def test_step_that_does_not_divide_the_day(spark):
    points = prices(spark, ["2026-09-19T22:00"], "PT7H")
    assert expected_slots(points, PRICE_DIMS).count() == 3
    assert completeness(points, PRICE_DIMS).first().missing_slots == 2


def test_null_zone_has_a_grid(spark):
    points = prices(spark, ["2026-09-20T00:00", "2026-09-20T00:15"], zone=None)
    assert missing_slots(points, PRICE_DIMS).count() == 94
    assert completeness(points, PRICE_DIMS).first().missing_slots == 94


def test_utc_hour(spark):
    frame = prices(spark, ["2026-09-20T00:59:59.999", "1969-12-31T23:30"])
    hours = frame.select(calendar.utc_hour(F.col("delivery_start_utc")).cast("timestamp_ntz").alias("h"))
    assert sorted(r.h for r in hours.collect()) == [utc("1969-12-31T23:00"), utc("2026-09-20T00:00")]


def test_fixed_hours():
    days = [dt.date(2026, 3, 29), dt.date(2026, 10, 25)]
    assert calendar.fixed_hours(days, "Europe/Rome")
    assert not calendar.fixed_hours(days, "Asia/Kolkata")
