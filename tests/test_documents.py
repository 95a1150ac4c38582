import pytest
from pyspark.sql import functions as F

from gridmart.operators.flatten import generation_points, price_points
from samples import (
    docs_frame,
    document,
    generation_document,
    generation_series,
    period,
    point,
    price_document,
    price_series,
    utc,
)


def rows(frame, *columns):
    instants = {"delivery_start_utc", "published_at_utc"}
    picked = [
        F.col(c).cast("timestamp_ntz").alias(c) if c in instants else F.col(c) for c in columns
    ]
    return sorted(tuple(row) for row in frame.select(*picked).collect())


def generation(spark, *texts):
    return generation_points(docs_frame(spark, *texts))


def fails(frame, fragment):
    with pytest.raises(Exception, match=fragment):
        frame.collect()


@pytest.mark.parametrize(
    "namespace, prefix", [(' xmlns="urn:a"', ""), ("", ""), (' xmlns:x="urn:a"', "x:")]
)
def test_namespaces(spark, namespace, prefix):
    text = generation_document([point(1, 5), point(2, 6)])
    body = text.replace(' xmlns="urn:a:b:1"', "")
    if prefix:
        body = body.replace("</", "\0").replace("<", "<x:").replace("\0", "</x:")
        body = body.replace("<x:?xml", "<?xml").replace("<x:Doc", f"<x:Doc{namespace}")
    else:
        body = body.replace("<Doc", f"<Doc{namespace}")
    got = rows(generation(spark, body), "delivery_start_utc", "generation_mw", "bidding_zone")
    assert got == [
        (utc("2026-09-19T22:00"), 5.0, "Z"),
        (utc("2026-09-19T22:15"), 6.0, "Z"),
    ]


def test_columns_of_a_point(spark):
    frame = generation(spark, generation_document([point(1, "12.5")], code="B04"))
    assert frame.columns == [
        "delivery_start_utc",
        "generation_mw",
        "bidding_zone",
        "psr_type",
        "production_type",
        "unit",
        "resolution",
    ]
    assert rows(frame, "psr_type", "production_type", "unit", "resolution") == [
        ("B04", "Fossil Gas", "MAW", "PT15M")
    ]


@pytest.mark.parametrize("zone", [None, ""])
def test_consumption_series_are_dropped(spark, zone):
    kept = generation_series([period([point(1, 5)])])
    dropped = generation_series([period([point(1, 7)])], zone=zone)
    assert rows(generation(spark, document(kept, dropped)), "generation_mw") == [(5.0,)]


@pytest.mark.parametrize("missing", [{"start": None}, {"start": ""}, {"resolution": None}, {"resolution": ""}])
def test_incomplete_periods_are_dropped(spark, missing):
    series = generation_series([period([point(1, 5)]), period([point(1, 7)], **missing)])
    assert rows(generation(spark, document(series)), "generation_mw") == [(5.0,)]


def test_incomplete_points_are_dropped(spark):
    points = [point(1, 5), point(None, 6), point(3, None), point("", 7), point(5, "")]
    assert rows(generation(spark, generation_document(points)), "generation_mw") == [(5.0,)]


def test_no_fill_of_missing_positions(spark):
    frame = generation(spark, generation_document([point(p, p) for p in (1, 3, 4)]))
    starts = [row[0].minute for row in rows(frame, "delivery_start_utc")]
    assert starts == [0, 30, 45]


def test_childless_elements_give_no_rows(spark):
    empty = document(generation_series([]), generation_series([period([])]))
    assert generation(spark, empty, document()).count() == 0


@pytest.mark.parametrize("text, minutes", [("PT15M", 15), ("PT30M", 30), ("PT60M", 60), ("PT1H", 60)])
def test_resolutions(spark, text, minutes):
    frame = generation(spark, generation_document([point(2, 1)], resolution=text))
    (start,) = rows(frame, "delivery_start_utc")[0]
    assert (start - utc("2026-09-19T22:00")).total_seconds() == 60 * minutes


@pytest.mark.parametrize("text", ["P1D", "PT1S", "pt15m", "PT15M ", "PT15M\n", "PTM"])
def test_bad_resolution_raises(spark, text):
    fails(generation(spark, generation_document([point(1, 1)], resolution=text)), "unsupported")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-09-19T22:00Z", "2026-09-19T22:00"),
        ("2026-09-19T22:00:30Z", "2026-09-19T22:00:30"),
        ("2026-09-19T22:00:00.250Z", "2026-09-19T22:00:00.250"),
        ("2026-09-19T22:00+02:00", "2026-09-19T20:00"),
        ("2026-09-19T22:00", "2026-09-19T22:00"),
    ],
)
def test_instants(spark, text, expected):
    frame = generation(spark, generation_document([point(1, 1)], start=text))
    assert rows(frame, "delivery_start_utc") == [(utc(expected),)]


@pytest.mark.parametrize("field, text", [
    ("position", "x"), ("position", "1.0"), ("quantity", "12d"), ("quantity", "0x1p3"),
    ("quantity", "   "), ("quantity", "1_"),
])
def test_bad_numbers_raise(spark, field, text):
    values = {"position": 1, "quantity": 1, field: text}
    frame = generation(spark, generation_document([point(values["position"], values["quantity"])]))
    fails(frame, "not a valid")


@pytest.mark.parametrize(
    "text, number",
    [("-3.5", -3.5), (" 12 ", 12.0), ("1e3", 1000.0), ("+.5", 0.5), ("1_000", 1000.0), ("7.", 7.0),
     ("nan", None), ("inf", float("inf"))],
)
def test_numbers(spark, text, number):
    frame = generation(spark, generation_document([point(" 1 ", text)]))
    assert [row[0] for row in frame.select("generation_mw").collect()] == [number]


def test_unmapped_and_missing_codes(spark):
    frame = generation(
        spark,
        generation_document([point(1, 1)], code="B99"),
        generation_document([point(1, 1)], code=None),
        generation_document([point(1, 1)], code=" B16 "),
    )
    got = {tuple(r) for r in frame.select("psr_type", "production_type").collect()}
    assert got == {("B99", "Unknown"), (None, "Unknown"), (" B16 ", "Unknown")}


@pytest.mark.parametrize("text", ["<Doc><TimeSeries>", "", "hello", "<Doc><a></b></Doc>"])
def test_malformed_documents_raise(spark, text):
    fails(generation(spark, text), "(?i)malformed")


def test_price_points(spark):
    frame = price_points(docs_frame(spark, price_document([(1, "-12.5"), (3, "80")], revision="4")))
    assert rows(frame, "delivery_start_utc", "price_eur_mwh", "bidding_zone", "currency", "unit",
                "resolution", "revision_number", "published_at_utc") == [
        (utc(f"2026-09-19T{t}"), p, "Z", "EUR", "MWH", "PT15M", 4, utc("2026-09-19T11:00"))
        for t, p in (("22:00", -12.5), ("22:30", 80.0))
    ]


@pytest.mark.parametrize("revision, created", [(None, None), ("", "")])
def test_price_metadata_may_be_missing(spark, revision, created):
    frame = price_points(docs_frame(spark, price_document([(1, 1)], revision, created)))
    assert [tuple(r) for r in frame.select("revision_number", "published_at_utc").collect()] == [
        (None, None)
    ]


def test_price_series_without_zone_are_kept(spark):
    text = document(price_series([period([point(1, 2, "price.amount")])]).replace("<in_Domain.mRID>Z</in_Domain.mRID>", ""))
    assert rows(price_points(docs_frame(spark, text)), "price_eur_mwh", "bidding_zone") == [(2.0, None)]


def test_unreadable_text_is_flagged_when_not_strict(spark):
    texts = [
        generation_document([point(1, "x"), point(2, 5)]),
        generation_document([point("y", 6)]),
        generation_document([point(1, 7)], resolution="P1D"),
        generation_document([point(1, 8)], start="soon"),
        "<Doc>",
    ]
    frame = generation_points(docs_frame(spark, *texts), strict=False)
    assert [r.generation_mw for r in frame.filter("malformed").collect()] == [None]
    got = frame.filter("NOT malformed").select("generation_mw", "unreadable").collect()
    assert {tuple(r) for r in got} == {(None, True), (5.0, False), (6.0, True), (7.0, True), (8.0, True)}
    priced = price_points(docs_frame(spark, price_document([(1, 1)], revision="x")), strict=False)
    assert [r.unreadable for r in priced.collect()] == [True]
