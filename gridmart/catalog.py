"""The registered queries, over market data derived from the driver tables.

Every query takes (spark, folder of driver tables) and reads whole tables. Those
about writing (upserts, archive, ingest, export) do write, into a new folder under
the shared one, and return what can be read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions import calendar, values
from gridmart.operators import checks, flatten, hourly, keys, slots
from gridmart.operators.upsert import upsert
from gridmart.plans import ingest, quality
from gridmart.plans.hours import GENERATION_HOURS, refresh_hours, refreshed_hours
from gridmart.plans.models import build_models, store_hourly, stored_models
from gridmart.plans.pipeline import run_days
from gridmart.schemas import (
    DAY,
    DEFAULT_ZONE,
    GENERATION_DOCUMENT,
    GENERATION_KEY,
    PRICE_KEY,
    RENEWABLE_TYPES,
    START,
)
from gridmart.session import new_folder
from gridmart.sources import documents, exports, tables
from gridmart.sources.standin import Market
from gridmart.streaming.incremental import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6


def query(build: Callable[[Market], DataFrame]) -> Callable[[Market], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = lambda spark, folder: comparable(build(Market(spark, folder)))
    return build


def comparable(rows: DataFrame) -> DataFrame:
    """Instants as plain UTC timestamps; doubles without the digits that depend on
    the order of a sum."""
    kinds = {
        "timestamp": lambda c: c.cast("timestamp_ntz"),
        "double": lambda c: F.round(c, DIGITS),
    }
    return rows.select(
        *[kinds.get(kind, lambda c: c)(F.col(f"`{n}`")).alias(n) for n, kind in rows.dtypes]
    )


# --- models -------------------------------------------------------------------------


@query
def stg_generation(m: Market) -> DataFrame:
    return hourly.stg_generation(m.raw_generation())


@query
def stg_prices(m: Market) -> DataFrame:
    return hourly.stg_prices(m.prices())


@query
def int_hourly_generation(m: Market) -> DataFrame:
    return hourly.int_hourly_generation(m.raw_generation())


@query
def int_hourly_prices(m: Market) -> DataFrame:
    return hourly.int_hourly_prices(m.prices())


def _models(m: Market) -> dict[str, DataFrame]:
    return build_models(m.raw_generation(), m.prices())


@query
def hourly_generation_prices(m: Market) -> DataFrame:
    return _models(m)["hourly_generation_prices"]


@query
def hourly_energy_analysis(m: Market) -> DataFrame:
    return _models(m)["hourly_energy_analysis"]


@query
def hourly_energy_analysis_stored(m: Market) -> DataFrame:
    """The analysis on top of hourly tables written by day."""
    root = new_folder(m.spark, "hourly")
    store_hourly(_models(m), root)
    return stored_models(m.spark, root)["hourly_energy_analysis"]


@query
def renewable_mix(m: Market) -> DataFrame:
    return hourly.generation_mix(hourly.int_hourly_generation(m.raw_generation())).select(
        "bidding_zone",
        "hour_start_utc",
        "renewable_generation_mw",
        "fossil_generation_mw",
        "renewable_share",
    )


@query
def hours_between(m: Market) -> DataFrame:
    """Hourly prices of one week, filtered before the hours are formed."""
    week = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15)
    return hourly.int_hourly_prices(calendar.hours_between(m.prices(), *week))


@query
def hours_without_generation(m: Market) -> DataFrame:
    """Hours that have a price but no renewable generation."""
    models = _models(m)
    generation = models["int_hourly_generation"]
    renewable = generation.filter(F.col("production_type").isin(RENEWABLE_TYPES))
    return hourly.hours_without_generation(renewable, models["int_hourly_prices"])


# --- documents ----------------------------------------------------------------------


def _series(m: Market) -> DataFrame:
    docs = m.generation_documents(damaged=True)
    return flatten.explode_series(
        flatten.parse(docs, GENERATION_DOCUMENT), flatten.GENERATION_SERIES
    )


def _points(periods: DataFrame) -> DataFrame:
    return flatten.explode_points(periods, "quantity")


def _numbers(points: DataFrame) -> DataFrame:
    """Text fields in types that print alike everywhere; empty text as null."""
    filled = {
        name: F.when(values.present(F.col(name)), F.col(name))
        for name in ("bidding_zone", "psr_type", "period_start", "resolution", "value")
    }
    return points.withColumns(filled).select(
        "delivery_date",
        "bidding_zone",
        "psr_type",
        calendar.parse_instant(F.col("period_start")).alias("period_start_utc"),
        "resolution",
        values.to_int(F.col("position")).alias("position"),
        values.to_double(F.col("value")).alias("quantity"),
    )


@query
def flatten_points(m: Market) -> DataFrame:
    """Every point of damaged documents, before anything is dropped."""
    return _numbers(_points(flatten.explode_periods(_series(m))))


@query
def filter_generation_series(m: Market) -> DataFrame:
    kept = flatten.generation_series_only(_series(m))
    return kept.select("delivery_date", "bidding_zone", "psr_type", "unit")


@query
def drop_incomplete_periods(m: Market) -> DataFrame:
    return _numbers(_points(flatten.complete_periods(flatten.explode_periods(_series(m)))))


@query
def drop_incomplete_points(m: Market) -> DataFrame:
    return _numbers(flatten.complete_points(_points(flatten.explode_periods(_series(m)))))


@query
def xml_generation_points(m: Market) -> DataFrame:
    """Generation documents, parsed back into the points they were built from."""
    points = flatten.generation_points(m.generation_documents()).drop("delivery_date")
    return calendar.add_local_columns(points)


@query
def xml_damaged_generation_points(m: Market) -> DataFrame:
    """The same with all drop rules at work."""
    return flatten.generation_points(m.generation_documents(damaged=True)).drop("delivery_date")


@query
def xml_price_points(m: Market) -> DataFrame:
    points = flatten.price_points(m.price_documents()).drop("delivery_date")
    return calendar.add_local_columns(points)


@query
def price_doc_metadata(m: Market) -> DataFrame:
    """Revision and publication time on every row, null where a document has none."""
    return flatten.price_points(m.price_documents(damaged=True)).select(
        "bidding_zone", START, "revision_number", "published_at_utc"
    )


@query
def archive_partition_prune(m: Market) -> DataFrame:
    """Points per zone from the documents of eleven days; other folders stay closed."""
    root = new_folder(m.spark, "archive")
    documents.land_documents(m.generation_documents(), root)
    days = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    points = flatten.generation_points(documents.read_documents(m.spark, root, *days))
    return points.groupBy("bidding_zone", "delivery_date").agg(
        F.count(F.lit(1)).alias("points"), F.sum("generation_mw").alias("total_mw")
    )


# --- scalar work --------------------------------------------------------------------


@query
def psr_lookup(m: Market) -> DataFrame:
    """Names of the codes in use; the code of error events has none, nor have nulls."""
    code = F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("B"), F.lpad(F.col("number"), 2, "0")))
    coded = m.table("events").withColumn("number", (F.col("user_id") % 30).cast("string"))
    return coded.select(
        "event_id",
        code.alias("psr_type"),
        values.production_type(code).alias("production_type"),
    )


def _coded_times(m: Market) -> DataFrame:
    """Events with their time as document text and a resolution of varied form."""
    ts = F.col("ts").cast("timestamp")
    forms = [
        F.concat(F.lit("PT"), (F.col("user_id") % 60 + 1).cast("string"), F.lit("M")),
        F.concat(F.lit("PT"), (F.col("user_id") % 24 + 1).cast("string"), F.lit("H")),
    ]
    return m.table("events").select(
        "event_id",
        "value",
        F.when(F.col("user_id") % 2 == 0, forms[0]).otherwise(forms[1]).alias("resolution"),
        F.when(F.col("user_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'"))
        .when(F.col("user_id") % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), F.lit("+02:00")))
        .alias("text"),
        (F.col("user_id") % 100 + 1).cast("string").alias("position"),
    )


@query
def resolution_interval(m: Market) -> DataFrame:
    step = calendar.resolution_interval(F.col("resolution"))
    start = F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    return _coded_times(m).select("event_id", "resolution", (start + step).alias("first_end"))


@query
def parse_instant(m: Market) -> DataFrame:
    return _coded_times(m).select(
        "event_id", "text", calendar.parse_instant(F.col("text")).alias("instant_utc")
    )


@query
def point_timestamp(m: Market) -> DataFrame:
    instant = flatten.point_instant(
        calendar.parse_instant(F.col("text")),
        calendar.resolution_interval(F.col("resolution")),
        values.to_int(F.col("position")),
    )
    return _coded_times(m).select("event_id", instant.alias(START))


@query
def cast_strict(m: Market) -> DataFrame:
    """Numbers through text and back: plain, signed, spaced and in exponent form."""
    number = F.col("value")
    text = (
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("+"), number.cast("string")))
        .when(F.col("user_id") % 4 == 1, F.concat(F.lit(" "), number.cast("string"), F.lit(" ")))
        .when(F.col("user_id") % 4 == 2, F.concat(F.lit("-"), number.cast("string"), F.lit("e2")))
        .otherwise(F.when(F.col("user_id") % 3 == 0, "nan").otherwise(number.cast("string")))
    )
    return m.table("events").select(
        "event_id",
        values.to_double(text).alias("value"),
        values.to_int(F.concat(F.lit(" "), F.col("user_id").cast("string"))).alias("position"),
    )


# --- calendar -----------------------------------------------------------------------


@query
def local_columns(m: Market) -> DataFrame:
    """Wall clock and date of points over ten years, with all changes of the clock."""
    points = m.line_generation().select("bidding_zone", "psr_type", START)
    return calendar.add_local_columns(points)


@query
def local_day_bounds(m: Market) -> DataFrame:
    """Bounds of every local delivery day over ten years, 23 to 25 hours apart."""
    hours = F.col("day_end_utc").cast("bigint") - F.col("day_start_utc").cast("bigint")
    bounds = slots.day_bounds(m.line_generation())
    return bounds.withColumn("hours", F.floor(hours / 3600).cast("bigint"))


@query
def filter_target_day(m: Market) -> DataFrame:
    """Points delivered in documents of their UTC day that fall in that local day."""
    points = m.generation().withColumn("target", F.to_date(START))
    kept = calendar.filter_target_day(points, F.col("target"))
    return kept.select("bidding_zone", "psr_type", START, DAY)


@query
def expected_grid(m: Market) -> DataFrame:
    return slots.expected_slots(m.prices(), slots.PRICE_DIMS)


@query
def missing_price_slots(m: Market) -> DataFrame:
    return slots.missing_slots(m.prices(), slots.PRICE_DIMS)


@query
def missing_generation_slots(m: Market) -> DataFrame:
    return slots.missing_slots(m.raw_generation(), slots.GENERATION_DIMS)


@query
def completeness_report(m: Market) -> DataFrame:
    return slots.completeness(m.raw_generation(), slots.GENERATION_DIMS)


@query
def dst_completeness_report(m: Market) -> DataFrame:
    """The same over ten years, with days of 92 and 100 slots."""
    return slots.completeness(m.line_generation(), slots.GENERATION_DIMS)


@query
def price_completeness_report(m: Market) -> DataFrame:
    return slots.completeness(m.raw_prices(), slots.PRICE_DIMS)


# --- checks -------------------------------------------------------------------------


@query
def dup_generation_key(m: Market) -> DataFrame:
    return keys.duplicate_keys(m.raw_generation(), GENERATION_KEY)


@query
def dup_price_key(m: Market) -> DataFrame:
    return keys.duplicate_keys(m.raw_prices(), PRICE_KEY)


@query
def dup_hourly_generation(m: Market) -> DataFrame:
    return keys.duplicate_keys(
        _renamed_models(m)["int_hourly_generation"], hourly.GENERATION_HOUR_KEY
    )


@query
def dup_hourly_price(m: Market) -> DataFrame:
    """Hours that both the points of 15 and those of 60 minutes give a price for."""
    raw = m.raw_prices()
    feeds = [raw.filter(F.col("resolution") == text) for text in ("PT15M", "PT60M")]
    quarter, full = (hourly.int_hourly_prices(points) for points in feeds)
    return keys.duplicate_keys(quarter.unionByName(full), hourly.HOUR_KEY)


@query
def dup_hourly_join(m: Market) -> DataFrame:
    return keys.duplicate_keys(
        _renamed_models(m)["hourly_generation_prices"], hourly.GENERATION_HOUR_KEY
    )


def _renamed_models(m: Market) -> dict[str, DataFrame]:
    """Models in which points above 100 MW carry a second name for their code."""
    name = F.when(F.col("generation_mw") > 100, "Other").otherwise(F.col("production_type"))
    return build_models(m.raw_generation().withColumn("production_type", name), m.prices())


@query
def dup_excess_count(m: Market) -> DataFrame:
    tables_of = {
        "generation": keys.excess_rows(m.raw_generation(), GENERATION_KEY),
        "prices": keys.excess_rows(m.raw_prices(), PRICE_KEY),
    }
    named = [rows.withColumn("batch", F.lit(name)) for name, rows in tables_of.items()]
    return named[0].unionByName(named[1])


@query
def rule_resolution_per_type(m: Market) -> DataFrame:
    return checks.types_with_several_resolutions(m.raw_generation())


@query
def rule_single_resolution(m: Market) -> DataFrame:
    return checks.days_without_single_resolution(m.raw_prices())


@query
def rule_generation_intervals(m: Market) -> DataFrame:
    return checks.generation_interval_failures(hourly.int_hourly_generation(m.raw_generation()))


@query
def rule_price_intervals(m: Market) -> DataFrame:
    return checks.price_interval_failures(hourly.int_hourly_prices(m.raw_prices()))


@query
def rule_hours_without_price(m: Market) -> DataFrame:
    models = _models(m)
    return hourly.hours_without_price(
        models["int_hourly_generation"], models["int_hourly_prices"]
    )


@query
def rule_not_null_counts(m: Market) -> DataFrame:
    """Nulls per model column; readings below 1 MW count as not delivered."""
    known = F.when(F.col("generation_mw") >= 1, F.col("generation_mw"))
    raw = m.raw_generation().withColumn("generation_mw", known)
    return quality.not_null_counts(build_models(raw, m.prices()))


@query
def rule_summary(m: Market) -> DataFrame:
    """All rules on the repeated-key tables, so that some of them fail.

    The hourly models are stored first: more than half of the rules read them.
    """
    models, root = build_models(m.raw_generation(), m.raw_prices()), new_folder(m.spark, "hourly")
    store_hourly(models, root)
    return quality.rule_summary({**models, **stored_models(m.spark, root)})


@query
def rows_by_production_type(m: Market) -> DataFrame:
    return hourly.rows_by_production_type(m.raw_generation())


@query
def backfill_quality_by_day(m: Market) -> DataFrame:
    return quality.quality_by_day(m.raw_generation())


@query
def sorted_points(m: Market) -> DataFrame:
    return hourly.sorted_points(m.generation())


@query
def sorted_prices(m: Market) -> DataFrame:
    return hourly.sorted_points(m.prices())


@query
def first_points(m: Market) -> DataFrame:
    return hourly.first_points(m.generation())


# --- tables and jobs ----------------------------------------------------------------

_TARGET_UNTIL, _BATCH_FROM = dt.date(2024, 1, 20), dt.date(2024, 1, 15)


def _upserted(table: tables.DayTable, rows: DataFrame, measure: str) -> DataFrame:
    """A table up to one day, then a batch of changed rows from an earlier day on."""
    upsert(table, rows.filter(F.col(DAY) <= _TARGET_UNTIL))
    changed = rows.filter(F.col(DAY) >= _BATCH_FROM).withColumn(measure, F.col(measure) + 1)
    upsert(table, changed)
    return table.read()


@query
def upsert_generation(m: Market) -> DataFrame:
    table = tables.generation_table(m.spark, new_folder(m.spark, "generation"))
    return _upserted(table, m.generation(), "generation_mw")


@query
def upsert_prices(m: Market) -> DataFrame:
    table = tables.price_table(m.spark, new_folder(m.spark, "prices"))
    return _upserted(table, m.prices(), "price_eur_mwh")


@query
def hourly_generation_refreshed(m: Market) -> DataFrame:
    """Hours kept up to date over two upserts; the second changes the first half of each hour."""
    path = new_folder(m.spark, "generation")
    table = tables.generation_table(m.spark, path)
    states = GENERATION_HOURS.table(m.spark, f"{path}_hours")
    rows = m.generation()
    upsert(table, rows.filter(F.col(DAY) <= _TARGET_UNTIL))
    refresh_hours(table, states, GENERATION_HOURS)
    early = (F.col(DAY) >= _BATCH_FROM) & (F.minute(START) < 30)
    moved = F.col("generation_mw") + F.dayofmonth(DAY) - 20
    upsert(table, rows.filter(early).withColumn("generation_mw", moved))
    refresh_hours(table, states, GENERATION_HOURS)
    return refreshed_hours(states, GENERATION_HOURS)


@query
def price_csv_roundtrip(m: Market) -> DataFrame:
    root = new_folder(m.spark, "csv")
    exports.write_price_csv(m.prices(), root)
    return exports.read_price_csv(m.spark, root)


@query
def latest_points(m: Market) -> DataFrame:
    """Of all events of a zone and hour, the last one."""
    raw = m.table("events").select(
        F.concat(F.lit("Z"), (F.col("user_id") % 4).cast("string")).alias("bidding_zone"),
        F.date_trunc("hour", "ts").alias("hour_start_utc"),
        "ts",
        "event_id",
        "value",
    )
    latest = keys.latest_rows(raw, ["bidding_zone", "hour_start_utc"], ["ts", "event_id"])
    return latest.drop("ts")


@query
def ingest_generation(m: Market) -> DataFrame:
    """Documents of all days, from the archive into the raw table in one job."""
    archive, path = (new_folder(m.spark, name) for name in ("archive", "generation"))
    documents.land_documents(m.generation_documents(), archive)
    ingest.ingest(documents.read_documents(m.spark, archive), path, ingest.GENERATION)
    return tables.generation_table(m.spark, path).read()


@query
def ingest_prices(m: Market) -> DataFrame:
    """The same for prices; points outside the delivery day of their document stay out.

    A document with no point at all in its day is rejected, so this run is not strict.
    """
    archive, path = (new_folder(m.spark, name) for name in ("archive", "prices"))
    documents.land_documents(m.price_documents(), archive)
    docs = documents.read_documents(m.spark, archive)
    ingest.ingest(docs, path, ingest.PRICES, strict=False)
    return tables.price_table(m.spark, path).read()


@query
def document_status(m: Market) -> DataFrame:
    """Documents by delivery day and error: of each four days one day's are cut in half, one
    day's hold no period, one day's lie in another day."""
    day = F.dayofmonth("delivery_date") % 4
    whole = F.col("document")
    text = (
        F.when(day == 1, F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int")))
        .when(day == 2, F.regexp_replace(whole, "(?s)<Period>.*?</Period>", ""))
        .otherwise(whole)
    )
    docs = m.generation_documents().select(
        F.sha2("document", 256).alias("path"),
        F.when(day == 3, F.date_add("delivery_date", 40))
        .otherwise(F.col("delivery_date"))
        .alias("delivery_date"),
        F.lit(None).cast("timestamp").alias("landed_at"),
        text.alias("document"),
    )
    points = ingest.day_points(docs, ingest.GENERATION, strict=False)
    verdicts = ingest.document_verdicts(docs, points, ingest.GENERATION)
    return verdicts.groupBy("delivery_date", "error").agg(F.count("*").alias("documents"))


@query
def stream_ingest_generation(m: Market) -> DataFrame:
    """The documents as a stream of landed files, into the same table."""
    archive, path, checkpoint = (
        new_folder(m.spark, name) for name in ("archive", "generation", "stream")
    )
    documents.land_documents(m.generation_documents(), archive)
    ingest_stream(
        m.spark, archive, path, ingest.GENERATION, DEFAULT_ZONE, checkpoint
    ).awaitTermination()
    return tables.generation_table(m.spark, path).read()


@query
def run_all_days(m: Market) -> DataFrame:
    """The analysis that a run over all days of both archives leaves behind."""
    archive, root = (new_folder(m.spark, name) for name in ("archive", "run"))
    documents.land_documents(m.generation_documents(), f"{archive}/generation")
    documents.land_documents(m.price_documents(), f"{archive}/prices")
    both = m.generation().select(DAY).union(m.prices().select(DAY))
    days = both.agg(F.min(DAY), F.max(DAY)).first()
    result = run_days(m.spark, archive, root, *days, strict=False)
    return result.models["hourly_energy_analysis"]
