"""Hourly models kept up to date by what changed in the points below them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import fixed_hours, local_date, utc_hour
from gridmart.schemas import DAY, DEFAULT_ZONE, HOUR_TOTAL, START
from gridmart.sources.tables import DayTable, hour_state_table, listed_days, remove_folder

HOUR = "hour_start_utc"


@dataclass(frozen=True)
class HourModel:
    """What is rolled up to hours: the columns of a series, and the measure."""

    kind: tuple[str, ...]
    measure: str

    def table(self, spark, path: str) -> DayTable:
        return hour_state_table(spark, path, list(self.kind))


GENERATION_HOURS = HourModel(("bidding_zone", "psr_type", "production_type"), "generation_mw")
PRICE_HOURS = HourModel(("bidding_zone",), "price_eur_mwh")


def _keyed(points: DataFrame, zone: str) -> DataFrame:
    hours = points.withColumn(HOUR, utc_hour(F.col(START)))
    return hours.withColumn(DAY, local_date(F.col(HOUR), zone))


def hour_states(points: DataFrame, model: HourModel, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The state of every hour: total and count of the known values, rows, extremes."""
    value = F.col(model.measure)
    return (
        _keyed(points, zone)
        .groupBy(*model.kind, HOUR, DAY)
        .agg(
            F.coalesce(F.sum(value.cast(HOUR_TOTAL)), F.lit(0)).cast(HOUR_TOTAL).alias("total"),
            F.count(value).alias("known"),
            F.count(F.lit(1)).alias("rows"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
        )
    )


def hourly_rows(states: DataFrame, model: HourModel) -> DataFrame:
    """The hourly model from its states."""
    average = F.when(F.col("known") > 0, F.col("total").cast("double") / F.col("known"))
    return states.select(
        *model.kind,
        HOUR,
        average.alias(f"average_{model.measure}"),
        F.col("low").alias(f"minimum_{model.measure}"),
        F.col("high").alias(f"maximum_{model.measure}"),
        F.col("rows").alias("intervals_available"),
    )


def _moves(changes: DataFrame, model: HourModel, zone: str) -> DataFrame:
    """What the changed rows add to each hour, and the extremes they bring and take away."""
    value, sign = F.col(model.measure), F.col("sign")
    came, left = F.when(sign > 0, value), F.when(sign < 0, value)
    return (
        _keyed(changes, zone)
        .groupBy(*model.kind, HOUR, DAY)
        .agg(
            F.coalesce(F.sum(value.cast(HOUR_TOTAL) * sign), F.lit(0)).alias("d_total"),
            F.sum(F.when(value.isNotNull(), sign).otherwise(0)).alias("d_known"),
            F.sum(sign).alias("d_rows"),
            F.min(came).alias("came_low"),
            F.max(came).alias("came_high"),
            F.min(left).alias("left_low"),
            F.max(left).alias("left_high"),
        )
    )


def _loses(left: Column, old: Column, came: Column, least: bool) -> Column:
    """Whether an extreme goes and no new value is at least as extreme."""
    gone = left <= old if least else left >= old
    made_good = came <= old if least else came >= old
    return F.coalesce(gone & ~F.coalesce(made_good, F.lit(False)), F.lit(False))


def refresh_hours(
    points: DayTable, hours: DayTable, model: HourModel, zone: str = DEFAULT_ZONE
) -> None:
    """Bring the states of ``hours`` up to the last commit of ``points``.

    Rows that changed since the commit the states were made from are added to, or taken from,
    the state of their hour. An hour that loses an extreme is worked out anew from the
    points of its day; one that is left without rows goes. Other hours are not read, and
    files of states whose range holds no changed hour stay as they are. The commit of the
    points is noted with the states in one step, so a run that is cut short or repeated
    counts no change twice. States made from files that are gone are built anew.
    """
    until, since = points.last(), hours.source()
    if until is None or until == since:
        return
    changes = None if since is None else points.changes(since, until)
    if changes is None:
        hours.create_if_absent()
        hours.replace_days(hour_states(points.read(), model, zone), until)
        return
    keys = [*model.kind, HOUR, DAY]
    folder, moves = hours.stage(_moves(changes, model, zone))
    folders = [folder]
    try:
        days = listed_days(moves)
        old = hours.read_days(days)
        joined = moves.join(old, keys, "left")
        lost = _loses(F.col("left_low"), F.col("low"), F.col("came_low"), True) | _loses(
            F.col("left_high"), F.col("high"), F.col("came_high"), False
        )
        rows = F.coalesce("rows", F.lit(0)) + F.col("d_rows")
        merged = joined.select(
            *keys,
            (F.coalesce("total", F.lit(0)) + F.col("d_total")).cast(HOUR_TOTAL).alias("total"),
            (F.coalesce("known", F.lit(0)) + F.col("d_known")).alias("known"),
            rows.alias("rows"),
            F.least("low", "came_low").alias("low"),
            F.greatest("high", "came_high").alias("high"),
            lost.alias("lost"),
        )
        folder, merged = hours.stage(merged)
        folders.append(folder)
        again = merged.filter("lost AND rows > 0").select(*keys)
        anew = _keyed(points.read_days(days), zone).join(again, keys, "left_semi")
        fresh = merged.filter("NOT lost AND rows > 0").select(*hours.columns)
        folder, fresh = hours.stage(
            fresh.unionByName(hour_states(anew, model, zone).select(*hours.columns))
        )
        folders.append(folder)
        hours.merge(fresh, merged.filter("rows <= 0").select(*keys), until)
    finally:
        for folder in folders:
            remove_folder(hours.spark, folder)


def refreshed_hours(hours: DayTable, model: HourModel) -> DataFrame:
    """The hourly model as of the last refresh."""
    return hourly_rows(hours.read(), model)
