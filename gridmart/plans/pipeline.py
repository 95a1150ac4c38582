"""A whole run: both feeds, the hourly models, the checks, the CSV export."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gridmart.functions.calendar import target_day
from gridmart.plans import quality
from gridmart.plans.ingest import GENERATION, PRICES, Feed, ingest
from gridmart.plans.models import build_models, store_hourly, stored_models
from gridmart.schemas import DEFAULT_ZONE
from gridmart.session import prepare
from gridmart.sources.documents import read_documents
from gridmart.sources.exports import write_price_csv
from gridmart.sources.tables import calendar_days


@dataclass(frozen=True)
class RunResult:
    """What a run leaves behind."""

    verdicts: dict[str, DataFrame]
    models: dict[str, DataFrame]
    rules: DataFrame


def run_day(spark: SparkSession, archive: str, root: str, day: str | None = None) -> RunResult:
    """The daily run, for YYYY-MM-DD or for yesterday in the market zone."""
    prepare(spark)
    date = spark.range(1).select(target_day(day).alias("day")).first()["day"]
    return run_days(spark, archive, root, date, date)


def run_days(
    spark: SparkSession,
    archive: str,
    root: str,
    first: dt.date,
    last: dt.date,
    zone: str = DEFAULT_ZONE,
    strict: bool = True,
) -> RunResult:
    """One run for all days in [first, last], at the cost of those days only.

    Points go to ``<root>/generation`` and ``<root>/prices``, hours below
    ``<root>/hourly``, rule outcomes below ``<root>/rules``, the export below
    ``<root>/csv``. The hourly models returned cover all stored days. The rules look at
    the rows of the run: a key holds its day, so a repeated key cannot hide in another one.
    """
    prepare(spark)
    days = calendar_days(first, last)
    verdicts = {
        feed.name: _load(spark, archive, root, feed, first, last, zone, strict)
        for feed in (GENERATION, PRICES)
    }
    points = {
        feed.name: feed.table(spark, f"{root}/{feed.name}").read_days(days)
        for feed in (GENERATION, PRICES)
    }
    fresh = build_models(points["generation"], points["prices"])
    hours = f"{root}/hourly"
    store_hourly(fresh, hours, days, zone)
    rules_path = f"{root}/rules/run={first:%Y%m%d}-{last:%Y%m%d}"
    checked = {**fresh, **stored_models(spark, hours, first, last)}
    quality.rule_summary(checked, zone).write.mode("overwrite").parquet(rules_path)
    rules = spark.read.parquet(rules_path)
    if strict:
        quality.require_passed(rules)
    write_price_csv(points["prices"], f"{root}/csv")
    return RunResult(verdicts, {**fresh, **stored_models(spark, hours)}, rules)


def _load(
    spark: SparkSession,
    archive: str,
    root: str,
    feed: Feed,
    first: dt.date,
    last: dt.date,
    zone: str,
    strict: bool,
) -> DataFrame:
    docs = read_documents(spark, f"{archive}/{feed.name}", first, last)
    run = f"{first:%Y%m%d}-{last:%Y%m%d}"
    return ingest(docs, f"{root}/{feed.name}", feed, zone, strict, run)
