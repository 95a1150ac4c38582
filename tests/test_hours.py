"""Hours kept up to date by changes, against hours built anew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridmart.operators.upsert import upsert
from gridmart.plans import hours
from gridmart.plans.hours import GENERATION_HOURS, PRICE_HOURS, refresh_hours, refreshed_hours
from gridmart.plans.models import build_models
from gridmart.sources import tables
from test_models import generation, prices


@pytest.fixture
def places(spark, folder):
    table = tables.DayTable(
        spark, f"{folder}/points", tables.RAW_GENERATION, tables.GENERATION_KEY, rows_per_file=20
    )
    return table, GENERATION_HOURS.table(spark, f"{folder}/hours")


def shown(rows):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows.collect()), key=repr
    )


def full(spark, table):
    columns = refreshed_hours(GENERATION_HOURS.table(spark, "/nowhere"), GENERATION_HOURS).columns
    models = build_models(table.read(), prices(spark))
    return shown(models["int_hourly_generation"].select(columns))


def batch(spark, rng, size):
    keys = {(rng.choice("AB"), rng.choice(["B16", "B04"]), rng.randrange(5, 9), rng.randrange(96)) for _ in range(size)}
    points = [
        (f"2026-01-{day:02d}T{q // 4:02d}:{q % 4 * 15:02d}", rng.choice([None, 1.5, 2.25, 3.0, -7.1, 0.1]), zone, kind)
        for zone, kind, day, q in sorted(keys)
    ]
    rows = generation(spark, *points)
    # Some series change their name: an hour can be left without rows.
    other = F.when(F.lit(rng.random() < 0.4) & (F.col("psr_type") == "B16"), F.lit("Renamed"))
    return rows.withColumn("production_type", F.coalesce(other, F.col("production_type")))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_refreshed_hours_equal_hours_built_anew(spark, places, seed):
    table, states = places
    rng = random.Random(seed)
    for size in (300, 40, 3, 150):
        for _ in range(rng.randrange(1, 3)):
            upsert(table, batch(spark, rng, size))
        assert table.read().count() == table.read().dropDuplicates(table.key).count()
        refresh_hours(table, states, GENERATION_HOURS)
        assert states.source() == table.last()
        assert shown(refreshed_hours(states, GENERATION_HOURS)) == full(spark, table)


def test_only_changed_hours_are_read(spark, places, monkeypatch):
    table, states = places
    points = [(f"2026-01-05T{h:02d}:{m}", float(h), "A", "B16") for h in range(20) for m in ("00", "15")]
    upsert(table, generation(spark, *points, ("2026-01-06T10:00", 1.0, "A", "B16")))
    refresh_hours(table, states, GENERATION_HOURS)
    seen, built = [], hours.hour_states

    def counted(rows, *args):
        seen.append(rows.count())
        return built(rows, *args)

    monkeypatch.setattr(hours, "hour_states", counted)
    other_day = {r.file for r in states.files([dt.date(2026, 1, 6)]).collect()}
    # Hour 3 gets a new greatest value in place of a lesser one; hour 7 loses its extremes.
    upsert(table, generation(spark, ("2026-01-05T03:00", 9.0, "A", "B16"), ("2026-01-05T07:30", 5.0, "A", "B16")))
    refresh_hours(table, states, GENERATION_HOURS)
    assert seen == [0] or seen == [2]
    upsert(table, generation(spark, ("2026-01-05T07:30", 6.0, "A", "B16")))
    refresh_hours(table, states, GENERATION_HOURS)
    assert seen[-1] == 3
    assert {r.file for r in states.files([dt.date(2026, 1, 6)]).collect()} == other_day
    assert shown(refreshed_hours(states, GENERATION_HOURS)) == full(spark, table)


def test_nothing_new_makes_no_commit_and_lost_files_a_build(spark, places):
    table, states = places
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16")))
    refresh_hours(table, states, GENERATION_HOURS)
    before = states.last()
    refresh_hours(table, states, GENERATION_HOURS)
    assert states.last() == before
    upsert(table, generation(spark, ("2026-01-05T10:00", 2.0, "A", "B16")))
    table.vacuum(age=dt.timedelta(0))
    refresh_hours(table, states, GENERATION_HOURS)
    assert shown(refreshed_hours(states, GENERATION_HOURS)) == full(spark, table)


def test_price_hours(spark, folder):
    table = tables.price_table(spark, f"{folder}/prices")
    states = PRICE_HOURS.table(spark, f"{folder}/hours")
    refresh_hours(table, states, PRICE_HOURS)
    assert states.last() is None
    for price in (5.0, 4.0, 8.0):
        upsert(table, prices(spark, ("2026-01-05T10:00", price, "A"), (f"2026-01-05T1{int(price) % 3}:15", 6.0, "A")))
        refresh_hours(table, states, PRICE_HOURS)
    found = refreshed_hours(states, PRICE_HOURS)
    anew = build_models(generation(spark), table.read())["int_hourly_prices"]
    assert shown(found) == shown(anew.select(found.columns))


def test_changes_between_commits(spark, places):
    table, _ = places
    upsert(table, generation(spark, *[(f"2026-01-05T{h:02d}:00", float(h), "A", "B16") for h in range(23)]))
    since = table.last()
    upsert(table, generation(spark, ("2026-01-05T04:00", 40.0, "A", "B16"), ("2026-01-05T05:00", 5.0, "A", "B16")))
    upsert(table, generation(spark, ("2026-01-05T04:00", 41.0, "A", "B16"), ("2026-01-06T05:00", 5.0, "A", "B16")))
    rows = table.changes(since, table.last()).collect()
    assert sorted((r.delivery_start_utc.day, r.generation_mw, r.sign) for r in rows) == [
        (5, 4.0, -1), (5, 41.0, 1), (6, 5.0, 1)]
    assert table.changes(since, since).collect() == []
