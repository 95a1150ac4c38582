"""Documents of any number of days into a raw table, in one job."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.calendar import add_local_columns, in_day
from gridmart.operators import checks, flatten
from gridmart.operators.keys import latest_rows
from gridmart.schemas import DEFAULT_ZONE, START
from gridmart.sources.documents import FETCH_ORDER
from gridmart.sources.tables import (
    DayTable,
    generation_table,
    price_table,
    remove_folder,
)


class DocumentsRejected(ValueError):
    """Some documents fail their checks."""


@dataclass(frozen=True)
class Feed:
    """What differs between the kinds of document.

    ``name`` is the archive folder and the table of the kind.
    """

    name: str
    table: Callable[[SparkSession, str], DayTable]
    points: Callable[[DataFrame, bool], DataFrame]
    verdicts: Callable[[DataFrame, list[str]], DataFrame]


GENERATION = Feed(
    "generation", generation_table, flatten.generation_points, checks.generation_verdicts
)
PRICES = Feed("prices", price_table, flatten.price_points, checks.price_verdicts)


# Whether a point belongs to the delivery day of its document.
IN_DAY = "in_day"


def day_points(docs: DataFrame, feed: Feed, strict: bool, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The points of each document, with ``in_day`` telling which lie in its delivery day.

    Text that cannot be read has no place in time and counts to the day.
    """
    points = feed.points(docs, strict)
    inside = F.coalesce(in_day(F.col(START), F.col("delivery_date"), zone), F.lit(False))
    if not strict:
        inside = F.col("unreadable") | (inside & ~F.col(flatten.MALFORMED))
    return add_local_columns(points.withColumn(IN_DAY, inside), zone)


def document_verdicts(docs: DataFrame, points: DataFrame, feed: Feed) -> DataFrame:
    """One row per document, also for those without points, with its error if it has one.

    ``parsed_rows`` counts the points before the day filter, ``rows`` those in the day.
    """
    malformed = F.col(flatten.MALFORMED) if flatten.MALFORMED in points.columns else F.lit(False)
    parsed = points.groupBy("path").agg(
        F.count_if(malformed).alias("malformed"), F.count_if(~malformed).alias("parsed_rows")
    )
    counts = feed.verdicts(points.filter(IN_DAY), ["path"])
    joined = (
        docs.select("path", "delivery_date", "landed_at")
        .join(parsed, "path", "left")
        .join(counts, "path", "left")
    )
    return joined.fillna(0).withColumn("error", checks.document_error())


def ingest(
    docs: DataFrame,
    path: str,
    feed: Feed,
    zone: str = DEFAULT_ZONE,
    strict: bool = True,
    run: str = "latest",
) -> DataFrame:
    """Parse, check and upsert documents; return the stored verdict of each.

    Every document is judged on its own, as if it had a run to itself. Strict, one
    failing document stops the job before anything is loaded. Otherwise it is left
    out, its verdict says why, and the others are loaded. Of several documents
    with the same key the one that landed last wins.
    """
    spark = docs.sparkSession
    table = feed.table(spark, path)
    table.create_if_absent()

    # Texts are parsed once; all that follows reads the stored points.
    points_path = f"{path}_points/{uuid.uuid4().hex}"
    staged = [points_path]
    verdict_path = f"{path}_verdicts/run={run}"
    try:
        day_points(docs, feed, strict, zone).write.parquet(points_path)
        points = spark.read.parquet(points_path)

        document_verdicts(docs, points, feed).write.mode("overwrite").parquet(verdict_path)
        verdicts = spark.read.parquet(verdict_path)
        rejected = verdicts.filter("error IS NOT NULL").select("path")
        if strict and not rejected.isEmpty():
            raise DocumentsRejected(f"see {verdict_path}")

        good = points.filter(IN_DAY).join(rejected, "path", "left_anti")
        good = good.select(*table.columns, *FETCH_ORDER)
        # A stored row is older than any document, so the newest of these replaces it.
        staging, newest = table.stage(
            latest_rows(good, table.key, FETCH_ORDER).select(*table.columns)
        )
        staged.append(staging)
        table.merge(newest)
    finally:
        for folder in staged:
            remove_folder(spark, folder)
    return verdicts
