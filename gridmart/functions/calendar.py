"""Instants, local days, resolutions and hour buckets as column expressions.

All of them assume the UTC session that ``gridmart.session.prepare`` sets.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.values import or_raise
from gridmart.schemas import DAY, DEFAULT_ZONE, START

_RESOLUTION = r"\APT([0-9]+)[MH]\z"
_INSTANT = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][XXX]"
_HOUR_MICROS = 3_600_000_000


def _amount(text: Column) -> Column:
    """The number in the text; null if there is none, or one beyond any calendar."""
    return F.nullif(F.regexp_extract(text, _RESOLUTION, 1), F.lit("")).try_cast("bigint")


def resolution_minutes(text: Column, strict: bool = True) -> Column:
    """Minutes of a ``PT<n>M`` or ``PT<n>H`` text.

    Null stays null; other text raises, or gives null if not ``strict``. So does a
    step of zero, which makes no grid, and one of more minutes than an integer holds.
    """
    unit = F.when(F.right(text, F.lit(1)) == "H", 60).otherwise(1)
    minutes = F.try_multiply(_amount(text), unit).try_cast("int")
    minutes = F.nullif(minutes.cast("bigint"), F.lit(0).cast("bigint"))
    return or_raise(minutes, text, "unsupported resolution: ") if strict else minutes


def resolution_interval(text: Column, strict: bool = True) -> Column:
    """The same as a day-time interval."""
    return F.make_dt_interval(mins=resolution_minutes(text, strict).cast("int"))


def resolution_code(text: Column, strict: bool = True) -> Column:
    """A number for the text, another one for every other text (PT60M is not PT1H).

    The smallest or largest text of a group makes Spark sort all rows; with
    numbers it keeps to hash aggregation. Amount, length and unit say it all.
    """
    hours = (F.right(text, F.lit(1)) == "H").cast("bigint")
    amount = F.try_multiply(_amount(text), F.lit(64))
    code = F.try_add(F.try_multiply(F.try_add(amount, F.length(text)), F.lit(2)), hours)
    return or_raise(code, text, "unsupported resolution: ") if strict else code


def code_minutes(code: Column) -> Column:
    """The minutes of a resolution code; null for a step of zero, which has no grid."""
    minutes = F.shiftright(code, 7) * F.when(code % 2 == 1, 60).otherwise(1)
    return F.nullif(minutes, F.lit(0).cast("bigint"))


def code_text(code: Column) -> Column:
    """The text of a resolution code."""
    digits = (F.shiftright(code, 1) % 64).cast("int") - 3
    amount = F.lpad(F.shiftright(code, 7).cast("string"), digits, F.lit("0"))
    return F.concat(F.lit("PT"), amount, F.when(code % 2 == 1, "H").otherwise("M"))


def parse_instant(text: Column, strict: bool = True) -> Column:
    """ISO instant, seconds optional, ``Z`` or an offset; no offset reads as UTC."""
    if strict:
        return F.to_timestamp(text, _INSTANT)
    return F.try_to_timestamp(text, F.lit(_INSTANT))


def utc_hour(instant: Column) -> Column:
    """Start of the UTC hour, by plain arithmetic (no calendar conversion per row)."""
    micros = F.unix_micros(instant)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(_HOUR_MICROS)))


def local_time(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Wall clock in the zone, as a timestamp without time zone."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def local_date(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def add_local_columns(points: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Add the local wall clock and the local delivery date."""
    return points.withColumns(
        {
            "delivery_start_local": local_time(F.col(START), zone),
            DAY: local_date(F.col(START), zone),
        }
    )


def day_start(day: Column, zone: str = DEFAULT_ZONE) -> Column:
    """The instant of local midnight."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def day_end(day: Column, zone: str = DEFAULT_ZONE) -> Column:
    """The instant of the next local midnight: 23, 24 or 25 hours later."""
    return day_start(F.date_add(day, 1), zone)


def target_day(text: str | None = None, zone: str = DEFAULT_ZONE) -> Column:
    """The day a run is for: the given YYYY-MM-DD, or yesterday in the zone."""
    if text is None:
        return F.date_sub(local_date(F.current_timestamp(), zone), 1)
    try:
        return F.lit(dt.datetime.strptime(text, "%Y-%m-%d").date())
    except ValueError as error:
        raise ValueError(f"{text!r} is no date of the form YYYY-MM-DD") from error


def filter_target_day(points: DataFrame, day: Column, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Keep the points inside the local day, which may be a constant or a column."""
    return points.filter(in_day(F.col(START), day, zone))


def in_day(instant: Column, day: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Whether the instant is in [local midnight, next local midnight)."""
    return (instant >= day_start(day, zone)) & (instant < day_end(day, zone))


def hours_between(
    points: DataFrame, first: dt.datetime, last: dt.datetime, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Points of the UTC hours in [first, last).

    A filter on the hour of a model is computed after the scan. This one is on
    stored columns, so it prunes day partitions and reaches the Parquet reader.
    """
    low, high = (F.lit(_as_utc(edge)) for edge in (first, last))
    return points.filter(
        (F.col(START) >= low)
        & (F.col(START) < high)
        & (F.col(DAY) >= local_date(low, zone))
        & (F.col(DAY) <= local_date(high, zone))
    )


def _as_utc(instant: dt.datetime) -> dt.datetime:
    if instant.tzinfo is None:
        return instant.replace(tzinfo=dt.timezone.utc)
    return instant


def fixed_hours(days: list[dt.date], zone: str) -> bool:
    """Whether local midnights fall on UTC hours, so that no hour spans two days."""
    midnights = (dt.datetime(d.year, d.month, d.day, tzinfo=ZoneInfo(zone)) for d in days)
    return all(m.utcoffset() % dt.timedelta(hours=1) == dt.timedelta(0) for m in midnights)
