"""Expected time slots of local days, against the slots that arrived.

``dims`` names what has a time grid of its own: the zone for prices, the zone and
type for generation. A group's step is its own resolution; a group with more than
one resolution has no grid (a check of its own reports it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import (
    code_minutes,
    code_text,
    day_end,
    day_start,
    resolution_code,
)
from gridmart.schemas import DAY, DEFAULT_ZONE, START

GENERATION_DIMS = ["bidding_zone", "psr_type"]
PRICE_DIMS = ["bidding_zone"]

_MINUTE_MICROS = 60_000_000


def day_bounds(points: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The UTC bounds of every local day that occurs."""
    return points.select(DAY).distinct().select(
        DAY,
        day_start(F.col(DAY), zone).alias("day_start_utc"),
        day_end(F.col(DAY), zone).alias("day_end_utc"),
    )


def _code_range() -> list[Column]:
    code = resolution_code(F.col("resolution"))
    return [F.min(code).alias("low"), F.max(code).alias("high")]


def _only_code() -> Column:
    """The resolution code if smallest and largest agree, else null."""
    return F.when(F.col("low") == F.col("high"), F.col("low"))


def expected_slots(points: DataFrame, dims: list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """Every slot that each group should have on each of its days.

    At most one row per minute of a day comes out of one group.
    """
    groups = points.groupBy(*dims, DAY).agg(*_code_range())
    minutes = code_minutes(_only_code()).cast("int")
    step = F.make_dt_interval(mins=minutes)
    stepped = groups.withColumn("step", step).filter("step IS NOT NULL")
    start, end = day_start(F.col(DAY), zone), day_end(F.col(DAY), zone)
    last = end - F.col("step")
    return stepped.filter(start <= last).select(
        *dims, DAY, F.explode(F.sequence(start, last, F.col("step"))).alias(START)
    )


def missing_slots(points: DataFrame, dims: list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """Expected slots that did not arrive.

    Expected and arrived slots go into one aggregate: copies of a slot collapse
    before the only shuffle, and null group values compare equal.
    """
    columns = [*dims, DAY, START]
    expected = expected_slots(points, dims, zone).withColumn("arrived", F.lit(False))
    arrived = points.select(*columns).withColumn("arrived", F.lit(True))
    seen = expected.unionByName(arrived).groupBy(*columns).agg(
        F.bool_or("arrived").alias("arrived")
    )
    return seen.filter(~F.col("arrived")).drop("arrived")


def slot_counts(points: DataFrame, dims: list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """Rows, duplicates, expected and missing slots of each group and day.

    The grid is counted, never generated: a point is on it if its distance from
    local midnight is a whole number of steps.
    """
    slots = points.groupBy(*dims, DAY, START).agg(
        F.count(F.lit(1)).alias("copies"), *_code_range()
    )
    begin, end = (F.unix_micros(edge(F.col(DAY), zone)) for edge in (day_start, day_end))
    instant = F.unix_micros(F.col(START))
    timed = slots.withColumn("step", code_minutes(F.col("low")) * _MINUTE_MICROS)
    on_grid = ((instant - begin) % F.col("step") == 0) & (instant + F.col("step") <= end)
    groups = timed.withColumn("on_grid", on_grid).groupBy(*dims, DAY).agg(
        F.sum("copies").alias("actual_rows"),
        F.sum(F.col("copies") - 1).alias("duplicate_rows"),
        F.count_if("on_grid").alias("matched"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    step = code_minutes(_only_code()) * _MINUTE_MICROS
    expected = F.floor((end - begin) / step).cast("bigint")
    return (
        groups.withColumn("resolution", code_text(_only_code()))
        .withColumn("expected_slots", expected)
        .withColumn("missing_slots", F.col("expected_slots") - F.col("matched"))
        .select(
            *dims,
            DAY,
            "resolution",
            "expected_slots",
            "actual_rows",
            "missing_slots",
            "duplicate_rows",
            (F.col("low") != F.col("high")).alias("mixed_resolutions"),
        )
    )


def completeness(points: DataFrame, dims: list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """The report of ``slot_counts``; no resolution is shown where there are several."""
    return slot_counts(points, dims, zone).drop("mixed_resolutions")
