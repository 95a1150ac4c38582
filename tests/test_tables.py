import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gridmart.operators.keys import latest_rows
from gridmart.operators.upsert import BatchRefused, upsert
from gridmart.sources import exports, tables
from test_models import generation, prices


def values(table):
    return {
        (r.psr_type, r.delivery_start_utc.day, r.delivery_start_utc.hour): r.generation_mw
        for r in table.read().collect()
    }


@pytest.fixture
def table(spark, folder):
    return tables.generation_table(spark, f"{folder}/generation")


def test_create_if_absent(spark, table):
    table.create_if_absent()
    assert table.read().count() == 0
    assert dict(table.read().dtypes)["delivery_start_local"] == "timestamp_ntz"
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16")))
    table.create_if_absent()
    assert table.read().count() == 1


def test_update_insert_keep(spark, table):
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16"),
                             ("2026-01-05T11:00", 2.0, "A", "B16"), ("2026-01-06T10:00", 3.0, "A", "B16")))
    upsert(table, generation(spark, ("2026-01-05T10:00", 9.0, "A", "B16"), ("2026-01-05T10:00", 8.0, "A", "B04")))
    assert values(table) == {("B16", 5, 10): 9.0, ("B16", 5, 11): 2.0, ("B16", 6, 10): 3.0, ("B04", 5, 10): 8.0}


def test_same_batch_twice(spark, table):
    batch = generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16"))
    upsert(table, batch)
    upsert(table, batch)
    assert table.read().count() == 1


def test_last_batch_wins_whatever_its_revision(spark, folder):
    table = tables.price_table(spark, f"{folder}/prices")
    for revision, price in ((2, 10.0), (1, 20.0)):
        batch = prices(spark, ("2026-01-05T10:00", price, "A"))
        upsert(table, batch.withColumn("revision_number", F.lit(revision)))
    assert [(r.revision_number, r.price_eur_mwh) for r in table.read().collect()] == [(1, 20.0)]


def test_other_days_are_not_rewritten(spark, table):
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16"), ("2026-01-06T10:00", 2.0, "A", "B16")))
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{table.path}/*/*=2026-01-06/*.parquet")}
    before = files()
    upsert(table, generation(spark, ("2026-01-05T10:00", 5.0, "A", "B16")))
    assert before and files() == before


@pytest.mark.parametrize("points", [
    [("2026-01-05T10:00", 1.0, "A", "B16"), ("2026-01-05T10:00", 2.0, "A", "B16")],
    [("2026-01-05T10:00", 1.0, None, "B16")],
])
def test_refused_batches(spark, table, points):
    with pytest.raises(BatchRefused):
        upsert(table, generation(spark, *points))
    assert table.read().count() == 0


def test_only_wanted_days_are_listed(spark, table):
    upsert(table, generation(spark, *[(f"2026-01-{d:02d}T10:00", float(d), "A", "B16") for d in range(1, 21)]))
    some = table.read_days([dt.date(2026, 1, d) for d in (2, 5, 7)] + [dt.date(2030, 1, 1)])
    assert sorted(r.generation_mw for r in some.collect()) == [2.0, 5.0, 7.0]
    assert "InMemoryFileIndex(3 paths)" in some._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert table.read_days([dt.date(2030, 1, 1)]).count() == 0


def live(table):
    """Live files by day, and the least and greatest instant of each."""
    return {
        (r.delivery_date_local.day, r.file): (r.low.delivery_start_utc, r.high.delivery_start_utc)
        for r in table.files().collect()
    }


def quarters(spark, day, first, last, value):
    return generation(spark, *[
        (f"2026-01-{day:02d}T{q // 4:02d}:{q % 4 * 15:02d}", value, "A", "B16") for q in range(first, last)
    ])


@pytest.mark.parametrize("step", ["_write", "_rename"])
def test_readers_never_see_half_a_write(spark, table, monkeypatch, step):
    """A run that dies before its commit leaves the old days; the next one is not disturbed."""
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16"), ("2026-01-06T11:00", 2.0, "A", "B16")))
    before = values(table)
    batch = generation(spark, ("2026-01-05T10:00", 9.0, "A", "B16"), ("2026-01-06T11:00", 8.0, "A", "B16"))

    def cut(*args):
        if step == "_write":
            original(*args)
        assert values(table) == before
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        owner = tables.DayTable if step == "_write" else tables
        original = getattr(owner, step)
        patch.setattr(owner, step, cut)
        with pytest.raises(KeyboardInterrupt):
            upsert(table, batch)
    assert values(table) == before
    upsert(table, batch)
    assert values(table) == {("B16", 5, 10): 9.0, ("B16", 6, 11): 8.0}
    assert os.listdir(f"{table.path}_staging") == []


def test_a_reader_keeps_the_rows_it_began_with(spark, table):
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16")))
    began = table.read()
    upsert(table, generation(spark, ("2026-01-05T10:00", 2.0, "A", "B16")))
    assert [r.generation_mw for r in began.collect()] == [1.0]
    assert [r.generation_mw for r in table.read().collect()] == [2.0]


def test_the_later_of_two_writers_starts_over(spark, table, monkeypatch):
    upsert(table, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16")))
    original, other = tables.DayTable._write, []

    def overtaken(self, rows):
        if not other:
            other.append(1)
            upsert(table, generation(spark, ("2026-01-05T11:00", 2.0, "A", "B16")))
        return original(self, rows)

    monkeypatch.setattr(tables.DayTable, "_write", overtaken)
    upsert(table, generation(spark, ("2026-01-05T10:00", 9.0, "A", "B16"), ("2026-01-05T12:00", 3.0, "A", "B16")))
    assert values(table) == {("B16", 5, 10): 9.0, ("B16", 5, 11): 2.0, ("B16", 5, 12): 3.0}
    assert not [name for name in os.listdir(f"{table.path}_commits") if name.startswith("writing")]


def test_a_commit_number_is_taken_once(spark, folder):
    for name in ("a", "b", "log/7"):
        os.makedirs(f"{folder}/{name}")
    assert not tables._rename(spark, f"{folder}/a", f"{folder}/log/7") or os.listdir(f"{folder}/log") == ["7"]
    open(f"{folder}/log/7/x", "w").close()
    assert not tables._rename(spark, f"{folder}/b", f"{folder}/log/7")
    assert tables._rename(spark, f"{folder}/b", f"{folder}/log/8")


def test_only_files_with_the_keys_of_a_batch_are_rewritten(spark, folder):
    table = tables.DayTable(spark, f"{folder}/t", tables.RAW_GENERATION, tables.GENERATION_KEY, rows_per_file=16)
    for day in (5, 6):
        upsert(table, quarters(spark, day, 0, 88, 1.0))
    before = live(table)
    upsert(table, generation(spark, ("2026-01-05T10:00", 9.0, "A", "B16"), ("2026-01-05T10:07", 8.0, "A", "B16")))
    after = live(table)
    gone = set(before) - set(after)
    (lost,) = gone
    assert lost[0] == 5 and before[lost][0] <= dt.datetime(2026, 1, 5, 10) <= before[lost][1]
    assert all(after[name] == before[name] for name in before if name not in gone)
    assert len([name for name in before if name[0] == 5]) >= 5
    rows = values(table)
    assert rows["B16", 5, 10] in (1.0, 8.0, 9.0) and table.read().count() == 2 * 88 + 1
    changed = table.read().filter("generation_mw > 1").collect()
    assert sorted(r.generation_mw for r in changed) == [8.0, 9.0]

    # Rows beyond all ranges need no old file.
    kept = set(after)
    upsert(table, quarters(spark, 5, 88, 92, 2.0))
    assert kept < set(live(table)) and table.read().count() == 2 * 88 + 5


def test_many_commits_and_vacuum(spark, table):
    for n in range(24):
        upsert(table, generation(spark, (f"2026-01-{5 + n % 3:02d}T10:00", float(n), "A", "B16")))
    want = {("B16", 5, 10): 21.0, ("B16", 6, 10): 22.0, ("B16", 7, 10): 23.0}
    assert values(table) == want
    assert [n for n, path in sorted(table.commits().items()) if path.endswith("whole")] == [0, 10, 20]
    assert table.vacuum() == 0
    assert table.vacuum(age=dt.timedelta(0)) == 24 - 3
    assert values(table) == want and min(table.commits()) == 20
    assert len(glob.glob(f"{table.path}/**/*.parquet", recursive=True)) == 3
    upsert(table, generation(spark, ("2026-01-05T10:00", 0.0, "A", "B16")))
    assert values(table) == {**want, ("B16", 5, 10): 0.0}


def test_latest_rows(spark):
    frame = spark.createDataFrame(
        [("a", 1, "x", 10.0), ("a", 2, "x", 20.0), ("a", 2, "y", None), ("b", 1, "x", 1.0)],
        "k string, at int, path string, v double",
    )
    got = {r.k: (r.path, r.v) for r in latest_rows(frame, ["k"], ["at", "path"]).collect()}
    assert got == {"a": ("y", None), "b": ("x", 1.0)}


def test_csv(spark, folder):
    rows = prices(spark, ("2026-01-05T10:15", -1.5, "A"), ("2026-01-05T10:00", 2.0, "A"),
                  ("2026-07-05T10:00", 3.0, "A"), ("2026-10-25T00:30", 4.0, "A"),
                  ("2026-10-25T01:30", 5.0, "A"), ("2026-10-26T10:00:00.250001", 6.0, "A"))
    exports.write_price_csv(rows, folder)
    (summer,) = glob.glob(f"{folder}/delivery_date=2026-07-05/*.csv")
    assert open(summer).read().splitlines() == [
        "delivery_start_utc,price_eur_mwh,bidding_zone,currency,unit,resolution,revision_number,"
        "published_at_utc,delivery_start_local,delivery_date_local",
        "2026-07-05 10:00:00+00:00,3.0,A,EUR,MWH,PT15M,1,,2026-07-05 12:00:00+02:00,2026-07-05",
    ]
    (winter,) = glob.glob(f"{folder}/delivery_date=2026-01-05/*.csv")
    assert [line[11:16] for line in open(winter).read().splitlines()[1:]] == ["10:00", "10:15"]
    (autumn,) = glob.glob(f"{folder}/delivery_date=2026-10-25/*.csv")
    locals_ = [line.split(",")[8] for line in open(autumn).read().splitlines()[1:]]
    assert locals_ == ["2026-10-25 02:30:00+02:00", "2026-10-25 02:30:00+01:00"]
    back = exports.read_price_csv(spark, folder)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_dates_are_plain_days(spark, table):
    upsert(table, generation(spark, ("2026-01-05T23:30", 1.0, "A", "B16")))
    assert table.read().first().delivery_date_local == dt.date(2026, 1, 6)
