import datetime as dt
import os
import random

import pyarrow as pa
import pytest

from gridmart.plans import ingest
from gridmart.plans.ingest import GENERATION, PRICES, DocumentsRejected
from gridmart.sources import documents, tables
from gridmart.streaming.incremental import ingest_stream
from samples import generation_document, point, price_document

DAY = "2026-09-20"


def land(root, day, name, text, at=None):
    folder = f"{root}/delivery_date={day}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.xml"
    with open(path, "w") as file:
        file.write(text)
    if at:
        os.utime(path, (at, at))


def day_document(values, **options):
    return generation_document([point(p, v) for p, v in values], **options)


def run(spark, root, path, feed=GENERATION, **options):
    return ingest.ingest(documents.read_documents(spark, root), path, feed, **options)


def stored(spark, path):
    return sorted(r.generation_mw for r in tables.generation_table(spark, path).read().collect())


@pytest.fixture
def places(folder):
    return f"{folder}/archive", f"{folder}/table"


def test_points_outside_the_day_stay_out(spark, places):
    root, path = places
    land(root, DAY, "a", day_document([(0, 1), (1, 2), (96, 3), (97, 4)]))
    run(spark, root, path)
    assert stored(spark, path) == [2.0, 3.0]


def test_later_fetch_wins(spark, places):
    root, path = places
    land(root, DAY, "b", day_document([(1, 1), (2, 2)]), at=1_700_000_000)
    land(root, DAY, "a", day_document([(2, 20), (3, 30)]), at=1_700_000_100)
    run(spark, root, path)
    assert stored(spark, path) == [1.0, 20.0, 30.0]


def test_backfill_equals_runs_day_by_day(spark, places, folder):
    root, path = places
    starts = {"2026-10-24": "2026-10-23T22:00Z", "2026-10-25": "2026-10-24T22:00Z", "2026-10-26": "2026-10-25T23:00Z"}
    for day, start in starts.items():
        land(root, day, "a", day_document([(p, p) for p in range(1, 101)], start=start))
    run(spark, root, path)
    once = tables.generation_table(spark, path).read()
    assert once.count() == 96 + 100 + 96
    for day in starts:
        date = dt.date.fromisoformat(day)
        docs = documents.read_documents(spark, root, date, date)
        ingest.ingest(docs, f"{folder}/daily", GENERATION)
    daily = tables.generation_table(spark, f"{folder}/daily").read()
    assert once.exceptAll(daily).isEmpty() and daily.exceptAll(once).isEmpty()


BAD = {
    "several resolutions": None,
    "no points": day_document([(1, "")]),
    "no points in the day": day_document([(97, 1)]),
    "malformed": day_document([(1, 1)])[:-5],
    "null values": day_document([(1, "nan")]),
    "duplicate keys": day_document([(1, 1), (1, 2)]),
    "unreadable text": day_document([(1, "x"), (2, 1)]),
}
BAD["several resolutions"] = day_document([(1, 1)]).replace(
    "</TimeSeries>",
    "<Period><timeInterval><start>2026-09-20T10:00Z</start></timeInterval>"
    "<resolution>PT60M</resolution><Point><position>1</position><quantity>1</quantity></Point>"
    "</Period></TimeSeries>",
)


@pytest.mark.parametrize("error", sorted(BAD))
def test_failing_documents(spark, places, error):
    root, path = places
    land(root, DAY, "bad", BAD[error])
    land(root, "2026-09-21", "good", day_document([(97, 5)]))
    with pytest.raises(Exception):
        run(spark, root, path)
    assert stored(spark, path) == []
    verdicts = run(spark, root, path, strict=False).collect()
    assert {str(r.delivery_date): r.error for r in verdicts} == {DAY: error, "2026-09-21": None}
    assert stored(spark, path) == [5.0]


@pytest.mark.parametrize("options", [{"resolution": "P1D"}, {"start": "soon"}])
def test_unreadable_periods(spark, places, options):
    root, path = places
    land(root, DAY, "bad", day_document([(1, 1)], **options))
    land(f"{root}_prices", DAY, "bad", price_document([(1, 1)], **options))
    for archive, feed in ((root, GENERATION), (f"{root}_prices", PRICES)):
        with pytest.raises(Exception):
            run(spark, archive, f"{path}_{feed.name}", feed)
        verdicts = run(spark, archive, f"{path}_{feed.name}", feed, strict=False)
        assert [r.error for r in verdicts.collect()] == ["unreadable text"]


def test_malformed_document(spark, places):
    root, path = places
    land(root, DAY, "bad", "<Doc><TimeSeries>")
    with pytest.raises(Exception, match="(?i)malformed"):
        run(spark, root, path)
    assert [r.error for r in run(spark, root, path, strict=False).collect()] == ["malformed"]


def test_counts_before_and_after_the_day_filter(spark, places):
    root, path = places
    land(root, DAY, "a", day_document([(0, 1), (1, 2), (96, 3), (97, 4)]))
    land(root, DAY, "empty", " ")
    land(root, "2026-09-21", "b", day_document([(1, 2)]))
    verdicts = run(spark, root, path, strict=False).collect()
    assert {
        r.path.rsplit("/", 1)[1]: (r.malformed, r.parsed_rows, r.rows, r.error) for r in verdicts
    } == {
        "a.xml": (0, 4, 2, None),
        "empty.xml": (1, 0, 0, "malformed"),
        "b.xml": (0, 1, 0, "no points in the day"),
    }
    os.remove(f"{root}/delivery_date={DAY}/empty.xml")
    with pytest.raises(DocumentsRejected):
        run(spark, root, path)


def test_strict_names_the_verdicts(spark, places):
    root, path = places
    land(root, DAY, "bad", BAD["duplicate keys"])
    with pytest.raises(DocumentsRejected, match="verdicts"):
        run(spark, root, path)


def test_prices(spark, places):
    root, path = places
    land(root, DAY, "a", price_document([(1, "-5"), (2, "6")], revision="2"))
    run(spark, root, path, PRICES)
    rows = tables.price_table(spark, path).read().collect()
    assert sorted((r.price_eur_mwh, r.revision_number) for r in rows) == [(-5.0, 2), (6.0, 2)]
    land(root, "2026-09-21", "b", price_document([(1, "1")], start="2026-09-20T22:00Z", zone=""))
    land(root, "2026-09-21", "c", price_document([(1, "1"), (1, "1")], start="2026-09-20T22:00Z"))
    verdicts = run(spark, root, path, PRICES, strict=False).collect()
    assert sorted(str(r.error) for r in verdicts) == ["None", "None", "duplicate keys"]


def test_stream_takes_up_what_lands(spark, places, folder):
    root, path = places
    checkpoint = f"{folder}/checkpoint"

    def load():
        ingest_stream(spark, root, path, GENERATION, checkpoint=checkpoint).awaitTermination()

    land(root, DAY, "first", day_document([(1, 1), (2, 2)]))
    load()
    assert stored(spark, path) == [1.0, 2.0]
    land(root, DAY, "second", day_document([(2, 20)]))
    land(root, "2026-09-21", "bad", "<Doc>")
    load()
    assert stored(spark, path) == [1.0, 20.0]
    load()
    assert stored(spark, path) == [1.0, 20.0]
    errors = spark.read.parquet(f"{path}_verdicts").filter("error IS NOT NULL").collect()
    assert [str(r.delivery_date) for r in errors] == ["2026-09-21"]


def test_landing_makes_new_names(spark, places):
    root, _ = places
    docs = spark.createDataFrame(
        [("<a/>", dt.date(2026, 9, 20)), ("<b/>", dt.date(2026, 9, 20))],
        "document string, delivery_date date",
    )
    documents.land_documents(docs, root)
    documents.land_documents(docs, root)
    back = documents.read_documents(spark, root).collect()
    assert sorted(r.document.strip() for r in back) == ["<a/>", "<a/>", "<b/>", "<b/>"]
    assert len({r.path for r in back}) == 4


def test_daily_run(spark, folder):
    from gridmart.plans.pipeline import run_day, run_days

    archive, root = f"{folder}/archive", f"{folder}/root"
    starts = {DAY: "2026-09-19T22:00Z", "2026-09-21": "2026-09-20T22:00Z"}
    for day, start in starts.items():
        values = [(p, p) for p in range(1, 97)]
        land(f"{archive}/generation", day, "a", day_document(values, start=start))
        land(f"{archive}/prices", day, "a", price_document(values, start=start))
    for day in starts:
        result = run_day(spark, archive, root, day)
    assert result.models["hourly_energy_analysis"].count() == 48
    assert {r.rule for r in result.rules.filter("failing_rows > 0").collect()} == set()
    assert sorted(os.listdir(f"{root}/csv"))[-1] == "delivery_date=2026-09-21"

    both = run_days(spark, archive, f"{folder}/other", dt.date(2026, 9, 20), dt.date(2026, 9, 21))
    one, two = (r.models["hourly_energy_analysis"] for r in (result, both))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_daily_run_stops_at_a_failing_rule(spark, folder):
    from gridmart.plans.pipeline import run_day
    from gridmart.plans.quality import ChecksFailed

    archive, root = f"{folder}/archive", f"{folder}/root"
    five_minutes = [(p, p) for p in range(1, 13)]
    land(f"{archive}/generation", DAY, "a", day_document(five_minutes, resolution="PT5M"))
    land(f"{archive}/prices", DAY, "a", price_document([(1, 1)]))
    with pytest.raises(ChecksFailed, match="interval_count.int_hourly_generation"):
        run_day(spark, archive, root, DAY)


ODD_DOCUMENTS = {
    "minutes": lambda: day_document([(1, 1)], resolution="PT99999999999M"),
    "hours": lambda: day_document([(1, 1)], resolution="PT999999999999999999H"),
    "digits": lambda: day_document([(1, 1)], resolution="PT99999999999999999999M"),
    "zero": lambda: day_document([(1, 1)], resolution="PT0M"),
    "low": lambda: day_document([(-2147483648, 1)]),
    "high": lambda: day_document([(2147483647, 1)], resolution="PT240H"),
}


def test_odd_documents_are_left_out_and_good_ones_load(spark, places):
    root, path = places
    land(root, DAY, "good", day_document([(1, 7)], resolution="PT" + "0" * 20 + "15M"))
    for name, text in ODD_DOCUMENTS.items():
        land(root, DAY, name, text())
    verdicts = run(spark, root, path, strict=False).collect()
    errors = {r.path.rsplit("/", 1)[1][:-4]: r.error for r in verdicts}
    assert errors == {"good": None, **dict.fromkeys(ODD_DOCUMENTS, "unreadable text")}
    assert stored(spark, path) == [7.0]


def test_stream_loads_files_of_any_age(spark, places):
    root, path = places
    now = 1_700_000_000
    land(root, DAY, "new", day_document([(1, 1)]), at=now)
    ingest_stream(spark, root, path, GENERATION).awaitTermination()
    land(root, DAY, "old", day_document([(2, 2)]), at=now - 30 * 86400)
    ingest_stream(spark, root, path, GENERATION).awaitTermination()
    assert stored(spark, path) == [1.0, 2.0]


def offsets(checkpoint):
    """The sources' offsets of the last batch, as text."""
    last = max(os.listdir(f"{checkpoint}/offsets"), key=lambda name: int(name) if name.isdigit() else -1)
    with open(f"{checkpoint}/offsets/{last}") as file:
        return file.read().splitlines()[-1]


def test_stream_state_does_not_grow_with_files(spark, places, folder):
    root, path = places
    sizes = []
    for start in (0, 40):
        for n in range(start, start + 40):
            land(root, DAY, f"f{n}", day_document([(n % 4 + 1, n)]), at=1_700_000_000 + n)
        ingest_stream(spark, root, path, GENERATION, checkpoint=f"{folder}/check").awaitTermination()
        sizes.append(len(offsets(f"{folder}/check")))
    assert sizes[0] == sizes[1] and stored(spark, path) == [76.0, 77.0, 78.0, 79.0]


def test_stream_lists_changed_days_only(spark, places):
    from gridmart.sources.landed import LandedReader

    root, _ = places
    for day in ("2026-09-20", "2026-09-21", "2026-09-22"):
        land(root, day, "a", "<a/>")
    reader = LandedReader(root)
    start = reader.latestOffset()
    assert sorted(start) == ["2026-09-20", "2026-09-21", "2026-09-22"]
    land(root, "2026-09-21", "b", "<b/>", at=1_000_000_000)
    land(root, "2026-09-23", "c", "<c/>")
    (task,) = reader.partitions(start, reader.latestOffset())
    assert [(day, path.rsplit("/", 1)[1]) for day, path, _ in task.value] == [
        ("2026-09-21", "a.xml"), ("2026-09-21", "b.xml"), ("2026-09-23", "c.xml")]
    assert reader.partitions(start, start) == []
    (batch,) = reader.read(task)
    assert batch.column("document").to_pylist() == ["<a/>", "<b/>", "<c/>"]
    read = documents.read_documents(spark, root).select("path", "landed_at")
    seen = spark.createDataFrame(pa.Table.from_batches([batch])).select("path", "landed_at")
    assert set(map(tuple, seen.collect())) <= set(map(tuple, read.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_reordered_and_replayed_fetches_end_as_one_run(spark, places, folder, seed):
    """Fetches with given landing times that come in any order, some of them twice."""
    root, path = places
    rng = random.Random(seed)
    days = [DAY, "2026-09-21"]
    starts = {DAY: "2026-09-19T22:00Z", "2026-09-21": "2026-09-20T22:00Z"}
    fetches = [(rng.choice(days), n, rng.sample(range(1, 9), 4)) for n in range(12)]
    rng.shuffle(fetches)
    for start in range(0, 12, 4):
        for day, n, positions in fetches[start : start + 4] + fetches[:1]:
            text = day_document([(p, 100 * n + p) for p in positions], start=starts[day])
            land(root, day, f"f{n}", text, at=1_700_000_000 + n)
        ingest_stream(spark, root, path, GENERATION).awaitTermination()
    run(spark, root, f"{folder}/once")
    assert stored(spark, path) == stored(spark, f"{folder}/once")


def test_stream_of_an_empty_archive(spark, places):
    root, path = places
    os.makedirs(root)
    ingest_stream(spark, root, path, GENERATION).awaitTermination()
    land(root, DAY, "a", day_document([(1, 1)]))
    ingest_stream(spark, root, path, GENERATION).awaitTermination()
    assert stored(spark, path) == [1.0]
