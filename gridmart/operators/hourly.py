"""Hourly models.

Every aggregate here is algebraic, so Spark combines it before each shuffle and a
hot zone or hour costs no more than one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import utc_hour
from gridmart.schemas import (
    FOSSIL_TYPES,
    GENERATION_COLUMNS,
    GENERATION_HOUR_KEY,
    HOUR_KEY,
    HYDRO_TYPES,
    PRICE_COLUMNS,
    RENEWABLE_TYPES,
)


def stg_generation(raw: DataFrame) -> DataFrame:
    return raw.select(*GENERATION_COLUMNS)


def stg_prices(raw: DataFrame) -> DataFrame:
    return raw.select(*PRICE_COLUMNS)


def _spread(measure: str) -> list[Column]:
    """Average, minimum, maximum of the known values, and the number of rows."""
    return [
        F.avg(measure).alias(f"average_{measure}"),
        F.min(measure).alias(f"minimum_{measure}"),
        F.max(measure).alias(f"maximum_{measure}"),
        F.count(F.lit(1)).alias("intervals_available"),
    ]


def _by_hour(points: DataFrame, keys: list[str], measure: str) -> DataFrame:
    hour = utc_hour(F.col("delivery_start_utc")).alias("hour_start_utc")
    return points.groupBy(*keys, hour).agg(*_spread(measure))


def int_hourly_generation(points: DataFrame) -> DataFrame:
    return _by_hour(points, ["bidding_zone", "psr_type", "production_type"], "generation_mw")


def int_hourly_prices(points: DataFrame) -> DataFrame:
    return _by_hour(points, ["bidding_zone"], "price_eur_mwh")


def hourly_generation_prices(generation: DataFrame, prices: DataFrame) -> DataFrame:
    """Each generation hour with its price hour; hours on one side only drop out."""
    left = generation.withColumnRenamed("intervals_available", "generation_intervals_available")
    right = prices.withColumnRenamed("intervals_available", "price_intervals_available")
    return left.join(right, HOUR_KEY, "inner").select(
        *HOUR_KEY,
        "psr_type",
        "production_type",
        "average_price_eur_mwh",
        "minimum_price_eur_mwh",
        "maximum_price_eur_mwh",
        "average_generation_mw",
        "minimum_generation_mw",
        "maximum_generation_mw",
        "generation_intervals_available",
        "price_intervals_available",
    )


def generation_mix(generation: DataFrame) -> DataFrame:
    """Totals per zone and hour, over all types and over the groups of types."""
    mw = F.col("average_generation_mw")

    def total_of(types: list[str]) -> Column:
        return F.sum(F.when(F.col("production_type").isin(types), mw).otherwise(F.lit(0.0)))

    total, renewable = F.sum(mw), total_of(RENEWABLE_TYPES)
    return generation.groupBy(*HOUR_KEY).agg(
        total.alias("total_generation_mw"),
        renewable.alias("renewable_generation_mw"),
        F.try_divide(renewable, total).alias("renewable_share"),
        total_of(["Solar"]).alias("solar_mw"),
        total_of(["Wind Onshore"]).alias("wind_onshore_mw"),
        total_of(HYDRO_TYPES).alias("hydro_mw"),
        total_of(FOSSIL_TYPES).alias("fossil_generation_mw"),
        total_of(["Fossil Gas"]).alias("fossil_gas_mw"),
        F.sum("intervals_available").alias("generation_intervals_available"),
    )


def hourly_energy_analysis(generation: DataFrame, prices: DataFrame) -> DataFrame:
    """The mix of each zone and hour beside its price.

    There is one price row per zone and hour, so totalling before the join gives
    the same rows as totalling the joined table, and the join handles one row
    per hour in place of one per type.
    """
    right = prices.withColumnRenamed("intervals_available", "price_intervals_available")
    return generation_mix(generation).join(right, HOUR_KEY, "inner").select(
        "hour_start_utc",
        "bidding_zone",
        "total_generation_mw",
        "renewable_generation_mw",
        "renewable_share",
        "solar_mw",
        "wind_onshore_mw",
        "hydro_mw",
        "fossil_generation_mw",
        "fossil_gas_mw",
        "average_price_eur_mwh",
        "minimum_price_eur_mwh",
        "maximum_price_eur_mwh",
        "generation_intervals_available",
        "price_intervals_available",
    )


def hours_without_price(generation: DataFrame, prices: DataFrame) -> DataFrame:
    """Zone-hours that have generation but no price."""
    return generation.select(*HOUR_KEY).distinct().join(prices.select(*HOUR_KEY), HOUR_KEY, "left_anti")


def hours_without_generation(generation: DataFrame, prices: DataFrame) -> DataFrame:
    """Zone-hours that the joined models drop because only a price is known."""
    return hours_without_price(prices, generation)


def rows_by_production_type(points: DataFrame) -> DataFrame:
    return points.groupBy("psr_type", "production_type").agg(F.count(F.lit(1)).alias("rows"))


def sorted_points(points: DataFrame) -> DataFrame:
    """By type (where there is one) and time, nulls last; the rest breaks ties."""
    leading = [name for name in ("psr_type", "delivery_start_utc") if name in points.columns]
    rest = [name for name in points.columns if name not in leading]
    return points.orderBy(*[F.col(name).asc_nulls_last() for name in leading + rest])


def first_points(points: DataFrame, count: int = 10) -> DataFrame:
    """The head of ``sorted_points``, as a top-k plan."""
    return sorted_points(points).limit(count)
