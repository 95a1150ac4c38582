"""Data-quality checks: failing rows, and one-pass counts of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import resolution_code
from gridmart.schemas import (
    DAY,
    GENERATION_KEY,
    MAX_INTERVALS_PER_HOUR,
    MIN_INTERVALS_PER_HOUR,
    PRICE_KEY,
)

# The generation columns a batch must have in every row.
REQUIRED_GENERATION = [
    "delivery_start_utc",
    "generation_mw",
    "bidding_zone",
    "psr_type",
    "production_type",
    "unit",
    "resolution",
]


def tally(rows: DataFrame, counts: dict[str, str]) -> DataFrame:
    """One row per count, all worked out in one pass; a count over no rows is zero.

    ``counts`` holds SQL aggregates by rule name. As text they cost one call each
    to the driver's JVM, where columns built piece by piece cost a call per piece.
    """
    names = [f"c{number}" for number in range(len(counts))]
    totals = rows.selectExpr(
        *[f"CAST(COALESCE({sql}, 0) AS BIGINT) AS {n}" for n, sql in zip(names, counts.values())]
    )
    pairs = ", ".join(f"'{rule}', {name}" for rule, name in zip(counts, names))
    return totals.selectExpr(f"stack({len(names)}, {pairs}) AS (rule, failing_rows)")


def null_conditions(rows: DataFrame, columns: list[str]) -> dict[str, str]:
    """By column, the SQL condition that its value is missing; NaN counts as missing."""
    kinds = dict(rows.dtypes)
    return {
        name: f"{name} IS NULL" + (f" OR isnan({name})" if kinds[name] == "double" else "")
        for name in columns
    }


INTERVAL_COUNT_OFF = (
    f"intervals_available NOT BETWEEN {MIN_INTERVALS_PER_HOUR} AND {MAX_INTERVALS_PER_HOUR}"
)


def generation_interval_failures(hourly: DataFrame) -> DataFrame:
    return hourly.filter(INTERVAL_COUNT_OFF)


def price_interval_failures(hourly: DataFrame) -> DataFrame:
    return hourly.filter(INTERVAL_COUNT_OFF).select(
        "bidding_zone", "hour_start_utc", "intervals_available"
    )


def types_with_several_resolutions(points: DataFrame) -> DataFrame:
    """Zone, day and type with more than one resolution."""
    counted = points.groupBy("bidding_zone", DAY, "psr_type").agg(
        F.count_distinct("resolution").alias("resolutions")
    )
    return counted.filter("resolutions > 1")


def days_without_single_resolution(points: DataFrame) -> DataFrame:
    """Zone and day whose known resolutions are not exactly one."""
    counted = points.groupBy("bidding_zone", DAY).agg(
        F.count_distinct("resolution").alias("resolutions")
    )
    return counted.filter("resolutions <> 1")


def generation_verdicts(points: DataFrame, scope: list[str]) -> DataFrame:
    """Batch checks of generation for each value of ``scope``.

    ``scope`` is a document, or a zone and day. Copies of a key are counted before
    the first shuffle, so a scope that holds much of the batch is no hot spot.
    """
    inner = _distinct([*scope, *GENERATION_KEY])
    incomplete = " OR ".join(null_conditions(points, REQUIRED_GENERATION).values())
    code = resolution_code(F.col("resolution"), strict=False)
    keys = points.groupBy(*inner).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(F.expr(incomplete)).alias("nulls"),
        *_unreadable(points),
        F.min(code).alias("low"),
        F.max(code).alias("high"),
    )
    types = keys.groupBy(*_distinct([*scope, "psr_type"])).agg(
        F.sum("copies").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("unreadable").alias("unreadable"),
        F.sum(F.col("copies") - 1).alias("excess"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    return types.groupBy(*scope).agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("null_rows"),
        F.sum("unreadable").alias("unreadable_rows"),
        F.sum("excess").alias("duplicate_rows"),
        F.count_if(F.col("low") != F.col("high")).alias("mixed_resolutions"),
    )


def price_verdicts(points: DataFrame, scope: list[str]) -> DataFrame:
    """Batch checks of prices for each value of ``scope``; a null counts in key columns only."""
    inner = _distinct([*scope, *PRICE_KEY])
    no_key = F.col("bidding_zone").isNull() | F.col("delivery_start_utc").isNull()
    code = resolution_code(F.col("resolution"), strict=False)
    keys = points.groupBy(*inner).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(no_key).alias("nulls"),
        *_unreadable(points),
        F.min(code).alias("low"),
        F.max(code).alias("high"),
    )
    return keys.groupBy(*scope).agg(
        F.sum("copies").alias("rows"),
        F.sum("nulls").alias("null_rows"),
        F.sum("unreadable").alias("unreadable_rows"),
        F.sum(F.col("copies") - 1).alias("duplicate_rows"),
        F.when(F.min("low") == F.max("high"), 0).otherwise(1).cast("bigint").alias(
            "mixed_resolutions"
        ),
    )


def verdict_error() -> Column:
    """The first check that a batch of points fails, in the order a run would meet them; null if
    none."""
    return (
        F.when(F.col("unreadable_rows") > 0, "unreadable text")
        .when(F.col("rows") == 0, "no points")
        .when(F.col("null_rows") > 0, "null values")
        .when(F.col("mixed_resolutions") > 0, "several resolutions")
        .when(F.col("duplicate_rows") > 0, "duplicate keys")
    )


def document_error() -> Column:
    """The same for a document, of which the points before the day filter are known too."""
    return (
        F.when(F.col("malformed") > 0, "malformed")
        .when(F.col("unreadable_rows") > 0, "unreadable text")
        .when(F.col("parsed_rows") == 0, "no points")
        .when(F.col("rows") == 0, "no points in the day")
        .otherwise(verdict_error())
    )


def _unreadable(points: DataFrame) -> list[Column]:
    flag = F.col("unreadable") if "unreadable" in points.columns else F.lit(False)
    return [F.count_if(flag).alias("unreadable")]


def _distinct(names: list[str]) -> list[str]:
    return list(dict.fromkeys(names))
