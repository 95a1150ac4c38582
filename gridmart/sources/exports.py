"""CSV export of checked price days, one folder per delivery date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.schemas import DAY, PRICE_COLUMNS

# Fixed value: instants are written with their offset, as in 2026-09-20 02:00:00+02:00.
# A fraction of a second appears only where there is one.
_STAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]xxx"
_OFFSET_LENGTH = len("+02:00")
_PATH_DAY = "delivery_date"


def _offset(local: Column, utc: Column) -> Column:
    minutes = F.timestamp_diff("MINUTE", utc.cast("timestamp_ntz"), local)
    return F.format_string(
        "%s%02d:%02d",
        F.when(minutes < 0, "-").otherwise("+"),
        F.floor(F.abs(minutes) / 60).cast("int"),
        (F.abs(minutes) % 60).cast("int"),
    )


def write_price_csv(prices: DataFrame, root: str) -> None:
    """A header and the columns of the price table; rows in time order within a file."""
    utc, local = F.col("delivery_start_utc"), F.col("delivery_start_local")

    def with_offset(instant: Column, offset: Column) -> Column:
        return F.concat(instant.cast("timestamp_ntz").cast("string"), offset)

    text = {
        "delivery_start_utc": with_offset(utc, F.lit("+00:00")),
        "published_at_utc": with_offset(F.col("published_at_utc"), F.lit("+00:00")),
        "delivery_start_local": with_offset(local, _offset(local, utc)),
    }
    (
        prices.select(*PRICE_COLUMNS, F.col(DAY).alias(_PATH_DAY))
        .hint("rebalance", _PATH_DAY)
        .sortWithinPartitions(_PATH_DAY, "delivery_start_utc", "bidding_zone")
        .select(*[text.get(name, F.col(name)).alias(name) for name in PRICE_COLUMNS], _PATH_DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(_PATH_DAY)
        .csv(root)
    )


def read_price_csv(spark: SparkSession, root: str) -> DataFrame:
    """The export, back in the types of the price table."""
    schema = """
        delivery_start_utc string, price_eur_mwh double, bidding_zone string,
        currency string, unit string, resolution string, revision_number int,
        published_at_utc string, delivery_start_local string, delivery_date_local date,
        delivery_date date
    """
    rows = spark.read.schema(schema).option("header", True).csv(root)
    local = F.col("delivery_start_local")
    wall_clock = F.substring(local, F.lit(1), F.length(local) - _OFFSET_LENGTH)
    values = {
        "delivery_start_utc": F.to_timestamp("delivery_start_utc", _STAMP),
        "published_at_utc": F.to_timestamp("published_at_utc", _STAMP),
        "delivery_start_local": wall_clock.cast("timestamp_ntz"),
    }
    return rows.select(*[values.get(name, F.col(name)).alias(name) for name in PRICE_COLUMNS])
