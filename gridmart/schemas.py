"""Column schemas, keys and code lists."""

from __future__ import annotations

import re

DEFAULT_ZONE = "Europe/Rome"

DAY = "delivery_date_local"
START = "delivery_start_utc"

RAW_GENERATION = """
    delivery_start_utc timestamp, generation_mw double, bidding_zone string,
    psr_type string, production_type string, unit string, resolution string,
    delivery_start_local timestamp_ntz, delivery_date_local date
"""
GENERATION_KEY = ["bidding_zone", "psr_type", "delivery_start_utc"]

RAW_PRICES = """
    delivery_start_utc timestamp, price_eur_mwh double, bidding_zone string,
    currency string, unit string, resolution string, revision_number int,
    published_at_utc timestamp, delivery_start_local timestamp_ntz,
    delivery_date_local date
"""
PRICE_KEY = ["bidding_zone", "delivery_start_utc"]


def column_types(schema: str) -> dict[str, str]:
    """Names and types in a column list; commas in brackets are parts of a type."""
    fields = re.split(r",(?![^(]*\))", schema)
    return {name: kind.strip() for name, kind in (field.split(maxsplit=1) for field in fields)}


def column_names(schema: str) -> list[str]:
    return list(column_types(schema))


GENERATION_COLUMNS = column_names(RAW_GENERATION)
PRICE_COLUMNS = column_names(RAW_PRICES)

HOUR_KEY = ["bidding_zone", "hour_start_utc"]
GENERATION_HOUR_KEY = ["bidding_zone", "psr_type", "hour_start_utc"]

# The stored hourly models, partitioned by the local day the hour starts in.
HOURLY_GENERATION = """
    bidding_zone string, psr_type string, production_type string,
    hour_start_utc timestamp, average_generation_mw double,
    minimum_generation_mw double, maximum_generation_mw double,
    intervals_available bigint, delivery_date_local date
"""
HOURLY_PRICES = """
    bidding_zone string, hour_start_utc timestamp, average_price_eur_mwh double,
    minimum_price_eur_mwh double, maximum_price_eur_mwh double,
    intervals_available bigint, delivery_date_local date
"""

# What the points of an hour add up to. Totals are decimal, so that taking a point out again
# leaves what it was before.
HOUR_TOTAL = "decimal(30,9)"
HOUR_STATE = """
    hour_start_utc timestamp, total decimal(30,9), known bigint, rows bigint,
    low double, high double, delivery_date_local date
"""

# Every text stays a string here: what counts as missing and what must raise is
# decided after the parse. Fields not listed are skipped by the parser.
GENERATION_DOCUMENT = """
    TimeSeries array<struct<
        `inBiddingZone_Domain.mRID`: string,
        MktPSRType: struct<psrType: string>,
        `quantity_Measure_Unit.name`: string,
        Period: array<struct<
            timeInterval: struct<start: string>,
            resolution: string,
            Point: array<struct<position: string, quantity: string>>>>>>
"""
PRICE_DOCUMENT = """
    revisionNumber string,
    createdDateTime string,
    TimeSeries array<struct<
        `in_Domain.mRID`: string,
        `currency_Unit.name`: string,
        `price_Measure_Unit.name`: string,
        Period: array<struct<
            timeInterval: struct<start: string>,
            resolution: string,
            Point: array<struct<position: string, `price.amount`: string>>>>>>
"""

# The published production type codes and their names.
PRODUCTION_TYPES = {
    "B01": "Biomass",
    "B03": "Fossil Coal-derived Gas",
    "B04": "Fossil Gas",
    "B05": "Fossil Hard Coal",
    "B06": "Fossil Oil",
    "B10": "Hydro Pumped Storage",
    "B11": "Hydro Run-of-river and Poundage",
    "B12": "Hydro Water Reservoir",
    "B16": "Solar",
    "B19": "Wind Onshore",
    "B20": "Other",
    "B25": "Energy Storage",
}
UNKNOWN_TYPE = "Unknown"

# Which production types count towards each total.
RENEWABLE_TYPES = [
    "Biomass",
    "Hydro Run-of-river and Poundage",
    "Hydro Water Reservoir",
    "Solar",
    "Wind Onshore",
]
HYDRO_TYPES = ["Hydro Run-of-river and Poundage", "Hydro Water Reservoir"]
FOSSIL_TYPES = [
    "Fossil Coal-derived Gas",
    "Fossil Gas",
    "Fossil Hard Coal",
    "Fossil Oil",
]

# Points per hour that are accepted.
MIN_INTERVALS_PER_HOUR = 1
MAX_INTERVALS_PER_HOUR = 4
