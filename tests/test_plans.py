"""Physical plans: what reaches the scan, and what is shuffled."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from gridmart.functions.calendar import hours_between
from gridmart.operators.upsert import upsert
from gridmart.plans.models import build_models
from gridmart.sources import documents, tables
from test_models import generation, prices


def plan(frame) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    """What the plan is when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    gen = tables.generation_table(spark, f"{root}/generation")
    price = tables.price_table(spark, f"{root}/prices")
    upsert(gen, generation(spark, ("2026-01-05T10:00", 1.0, "A", "B16"), ("2026-01-09T10:00", 1.0, "B", "B16")))
    upsert(price, prices(spark, ("2026-01-05T10:00", 1.0, "A"), ("2026-01-09T10:00", 1.0, "B")))
    return gen, price


def test_analysis_has_three_shuffles(stored, no_broadcast):
    gen, price = stored
    text = plan(build_models(gen.read(), price.read())["hourly_energy_analysis"])
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 3
    assert tree.count("SortMergeJoin") == 1


def test_zone_filter_reaches_both_scans(stored, no_broadcast):
    gen, price = stored
    models = build_models(gen.read(), price.read())
    text = plan(models["hourly_energy_analysis"].filter("bidding_zone = 'A'"))
    assert text.count("EqualTo(bidding_zone,A)") == 2


def test_scan_reads_only_needed_columns(stored):
    text = plan(build_models(stored[0].read(), stored[1].read())["int_hourly_prices"])
    (schema,) = [line for line in text.splitlines() if "ReadSchema" in line]
    assert "price_eur_mwh" in schema and "currency" not in schema and "resolution" not in schema


def test_hour_range_prunes_days_and_reaches_the_reader(stored):
    low, high = dt.datetime(2026, 1, 5, 9), dt.datetime(2026, 1, 5, 12)
    frame = hours_between(stored[0].read(), low, high)
    text = plan(frame)
    assert "GreaterThanOrEqual(delivery_start_utc" in text
    assert "PartitionFilters: [isnotnull(delivery_date_local" in text
    assert frame.count() == 1


def test_archive_days_are_pruned(spark, folder):
    docs = spark.createDataFrame(
        [("<a/>", dt.date(2026, 1, d)) for d in (1, 2, 3)], "document string, delivery_date date"
    )
    documents.land_documents(docs, folder)
    frame = documents.read_documents(spark, folder, dt.date(2026, 1, 2), dt.date(2026, 1, 2))
    assert "PartitionFilters: [isnotnull(delivery_date" in plan(frame)
    assert "delivery_date=2026-01-02]" in plan(frame) and "2026-01-01]" not in plan(frame)
    assert frame.count() == 1


def test_documents_are_parsed_once(spark):
    from gridmart.operators.flatten import generation_points

    docs = spark.createDataFrame([("<a/>", 1)], "document string, n int").repartition(1)
    tree = plan(generation_points(docs))
    assert tree.count("from_xml(") == 1


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows in one key leaves each map task as one row."""
    from gridmart.operators.keys import duplicate_keys

    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    text = plan(duplicate_keys(rows, ["k"]))
    assert "partial_count" in text
    assert duplicate_keys(rows, ["k"]).collect()[0].duplicate_count == 10_000
