"""Operators against plain Python, on rows of which a third share one key."""

import datetime as dt
import random
from collections import defaultdict
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gridmart.functions.calendar import add_local_columns
from gridmart.operators import checks, hourly, keys, slots
from gridmart.operators.keys import merge_rows
from gridmart.schemas import GENERATION_KEY

ROME = ZoneInfo("Europe/Rome")
UTC = dt.timezone.utc
STEP = {"PT15M": 15, "PT60M": 60, "PT1H": 60}


def local_day(instant):
    return instant.astimezone(ROME).date()


def midnight(day):
    return dt.datetime(day.year, day.month, day.day, tzinfo=ROME).astimezone(UTC)


@pytest.fixture(scope="module")
def rows():
    """(instant, mw, zone, code, resolution), around the change of the clock."""
    pick = random.Random(7)
    first = dt.datetime(2026, 10, 24, 20, tzinfo=UTC)
    made = []
    for number in range(3000):
        instant = first + dt.timedelta(minutes=5 * pick.randrange(12 * 60))
        zone, code = pick.choice(["A", "B", None]), pick.choice(["B16", "B04", "B99"])
        if number % 3 == 0:
            instant, zone, code = first + dt.timedelta(hours=9), "HOT", "B16"
        step = "PT1H" if (zone, code) == ("B", "B04") else "PT15M"
        if pick.random() < 0.002:
            step = "PT60M"
        mw = None if pick.random() < 0.01 else float(pick.randrange(1000))
        made.append((instant, mw, zone, code, step))
    return made


@pytest.fixture(scope="module")
def points(spark, rows):
    frame = spark.createDataFrame(
        rows,
        "delivery_start_utc timestamp, generation_mw double, bidding_zone string,"
        " psr_type string, resolution string",
    ).withColumns({"production_type": F.col("psr_type"), "unit": F.lit("MAW")})
    return add_local_columns(frame).repartition(8).persist()


def groups(rows, key):
    found = defaultdict(list)
    for row in rows:
        found[key(row)].append(row)
    return found


def by_day(row):
    return row[2], row[3], local_day(row[0])


def grid(day, members):
    steps = {row[4] for row in members}
    if len(steps) != 1:
        return None
    step = dt.timedelta(minutes=STEP[steps.pop()])
    slot, end, found = midnight(day), midnight(day + dt.timedelta(days=1)), set()
    while slot + step <= end:
        found.add(slot)
        slot += step
    return found


def utc(value):
    return value.replace(tzinfo=UTC)


def test_hourly(points, rows):
    expected = {}
    hour = lambda row: (row[2], row[3], row[0].replace(minute=0))
    for key, members in groups(rows, hour).items():
        known = [row[1] for row in members if row[1] is not None]
        spread = (sum(known) / len(known), min(known), max(known)) if known else (None,) * 3
        expected[key] = (*spread, len(members))
    model = hourly.int_hourly_generation(points).withColumn(
        "hour_start_utc", F.col("hour_start_utc").cast("timestamp_ntz")
    )
    got = {(r[0], r[1], utc(r[3])): tuple(r)[4:] for r in model.collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values)


def test_missing_slots(points, rows):
    expected = set()
    for (zone, code, day), members in groups(rows, by_day).items():
        slots_of_day = grid(day, members)
        if slots_of_day is not None:
            missing = slots_of_day - {row[0] for row in members}
            expected |= {(zone, code, day, slot) for slot in missing}
    found = slots.missing_slots(points, slots.GENERATION_DIMS).withColumn(
        "delivery_start_utc", F.col("delivery_start_utc").cast("timestamp_ntz")
    )
    got = [(r[0], r[1], r[2], utc(r[3])) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_completeness(points, rows):
    expected = {}
    for key, members in groups(rows, by_day).items():
        arrived, slots_of_day = {row[0] for row in members}, grid(key[2], members)
        whole = (None, None, None)
        if slots_of_day is not None:
            whole = (members[0][4], len(slots_of_day), len(slots_of_day - arrived))
        expected[key] = (*whole, len(members), len(members) - len(arrived))
    report = slots.completeness(points, slots.GENERATION_DIMS).collect()
    got = {
        (r.bidding_zone, r.psr_type, r.delivery_date_local): (
            r.resolution,
            r.expected_slots,
            r.missing_slots,
            r.actual_rows,
            r.duplicate_rows,
        )
        for r in report
    }
    assert got == expected


def test_verdicts(points, rows):
    expected = {}
    for key, members in groups(rows, lambda row: (row[2], local_day(row[0]))).items():
        distinct = {(row[3], row[0]) for row in members}
        steps = groups(members, lambda row: row[3])
        mixed = sum(len({row[4] for row in of_type}) > 1 for of_type in steps.values())
        nulls = sum(row[1] is None or row[2] is None for row in members)
        expected[key] = (len(members), nulls, len(members) - len(distinct), mixed)
    verdicts = checks.generation_verdicts(points, ["bidding_zone", "delivery_date_local"])
    got = {
        (r[0], r[1]): (r.rows, r.null_rows, r.duplicate_rows, r.mixed_resolutions)
        for r in verdicts.collect()
    }
    assert got == expected


def test_duplicates_and_latest(points, rows):
    by_key = groups(rows, lambda row: (row[2], row[3], row[0]))
    excess = keys.excess_rows(points, GENERATION_KEY).first().duplicate_rows
    assert excess == sum(len(members) - 1 for members in by_key.values())
    assert keys.duplicate_keys(points, GENERATION_KEY).count() == sum(
        len(members) > 1 for members in by_key.values()
    )
    ranked = points.withColumn("rank", F.coalesce("generation_mw", F.lit(-1.0)))
    latest = keys.latest_rows(ranked, GENERATION_KEY, ["rank"]).collect()
    best = sorted(max(row[1] if row[1] is not None else -1.0 for row in m) for m in by_key.values())
    assert sorted(r.rank for r in latest) == best


def test_merge(points):
    old = points.dropDuplicates(GENERATION_KEY).filter("bidding_zone IS NOT NULL")
    batch = old.filter("psr_type = 'B16'").withColumn("generation_mw", F.lit(-1.0))
    merged = merge_rows(old.filter("hour(delivery_start_utc) < 12"), batch, GENERATION_KEY)
    expected = old.filter("hour(delivery_start_utc) < 12 OR psr_type = 'B16'")
    assert merged.count() == expected.count()
    assert merged.filter("generation_mw = -1").count() == batch.count()
    assert keys.duplicate_keys(merged, GENERATION_KEY).isEmpty()
