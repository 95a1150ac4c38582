"""The six models over the two raw tables, as views or as stored hourly tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.calendar import fixed_hours, local_date
from gridmart.operators import hourly
from gridmart.schemas import DAY, DEFAULT_ZONE
from gridmart.sources.tables import (
    DayTable,
    calendar_days,
    hourly_generation_table,
    hourly_price_table,
)


def _hour_tables(spark: SparkSession, root: str) -> dict[str, DayTable]:
    """The stored hourly models by name."""
    return {
        "int_hourly_generation": hourly_generation_table(spark, f"{root}/int_hourly_generation"),
        "int_hourly_prices": hourly_price_table(spark, f"{root}/int_hourly_prices"),
    }


def build_models(raw_generation: DataFrame, raw_prices: DataFrame) -> dict[str, DataFrame]:
    """All models, each defined on the one below it; nothing runs yet."""
    stg_generation = hourly.stg_generation(raw_generation)
    stg_prices = hourly.stg_prices(raw_prices)
    return {
        "stg_generation": stg_generation,
        "stg_prices": stg_prices,
        **analysis_models(
            hourly.int_hourly_generation(stg_generation), hourly.int_hourly_prices(stg_prices)
        ),
    }


def analysis_models(generation: DataFrame, prices: DataFrame) -> dict[str, DataFrame]:
    """The hourly models and what is built on them, from hourly rows."""
    return {
        "int_hourly_generation": generation,
        "int_hourly_prices": prices,
        "hourly_generation_prices": hourly.hourly_generation_prices(generation, prices),
        "hourly_energy_analysis": hourly.hourly_energy_analysis(generation, prices),
    }


def register_views(models: dict[str, DataFrame]) -> None:
    for name, rows in models.items():
        rows.createOrReplaceTempView(name)


def store_hourly(
    models: dict[str, DataFrame],
    root: str,
    days: list[dt.date] | None = None,
    zone: str = DEFAULT_ZONE,
) -> None:
    """Write the two hourly models below ``root``, by the local day an hour starts in.

    With ``days``, only those days are replaced: pass models over raw tables
    filtered to them. That needs a zone whose midnights fall on UTC hours, or an
    hour would hold points of two days.
    """
    if days is not None and not fixed_hours(days, zone):
        raise ValueError(f"hours cross local days in {zone}: refresh all days")
    day = local_date(F.col("hour_start_utc"), zone)
    spark = models["int_hourly_prices"].sparkSession
    for name, table in _hour_tables(spark, root).items():
        table.replace_days(models[name].withColumn(DAY, day))


def stored_models(
    spark: SparkSession,
    root: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> dict[str, DataFrame]:
    """The hourly models as stored, and the analysis on top of them.

    Readers of the analysis then read hours in place of points, and with
    ``first`` and ``last`` only those of some days.
    """
    tables = []
    for table in _hour_tables(spark, root).values():
        some = first is not None and last is not None
        rows = table.read_days(calendar_days(first, last)) if some else table.read()
        tables.append(rows.drop(DAY))
    return analysis_models(*tables)
