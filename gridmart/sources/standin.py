"""Market data derived from the driver tables, which hold none of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.calendar import add_local_columns, day_start
from gridmart.functions.values import production_type
from gridmart.schemas import DAY, GENERATION_COLUMNS, PRICE_COLUMNS
from gridmart.session import prepare

EVENT_CODES = {"view": "B16", "click": "B19", "purchase": "B04", "signup": "B12"}
LINE_CODES = {"AF": "B16", "AO": "B19", "NF": "B04", "NO": "B12", "RF": "B11"}
OTHER_CODE = "B99"


def _code(text: Column, codes: dict[str, str]) -> Column:
    entries = [F.lit(item) for pair in codes.items() for item in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), text), F.lit(OTHER_CODE))


def _quarter(instant: Column) -> Column:
    seconds = F.unix_seconds(instant)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(900)))


def _zone(number: str) -> Column:
    return F.concat(F.lit("Z"), (F.col(number) % 4).cast("string"))


@dataclass(frozen=True)
class Market:
    """Views over one folder of driver tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return prepare(self.spark).read.parquet(f"{self.folder}/{name}.parquet")

    def raw_generation(self) -> DataFrame:
        """One point per event; keys repeat, and some points claim another resolution."""
        points = self.table("events").select(
            _quarter(F.col("ts").cast("timestamp")).alias("delivery_start_utc"),
            F.col("value").alias("generation_mw"),
            _zone("user_id").alias("bidding_zone"),
            _code(F.col("event_type"), EVENT_CODES).alias("psr_type"),
            F.lit("MAW").alias("unit"),
            F.when(F.col("user_id") % 50 == 0, "PT60M").otherwise("PT15M").alias("resolution"),
        )
        named = points.withColumn("production_type", production_type(F.col("psr_type")))
        return add_local_columns(named).select(*GENERATION_COLUMNS)

    def generation(self) -> DataFrame:
        """The same with unique keys: the largest value of each."""
        return _unique_generation(self.raw_generation())

    def raw_prices(self) -> DataFrame:
        """One price point per trade event; keys repeat."""
        quarter = _quarter(F.col("ts").cast("timestamp"))
        points = (
            self.table("events")
            .filter(F.col("event_type").isin("purchase", "view"))
            .select(
                quarter.alias("delivery_start_utc"),
                (F.col("value") - 50).alias("price_eur_mwh"),
                _zone("user_id").alias("bidding_zone"),
                F.when(F.col("user_id") % 50 == 0, "PT60M").otherwise("PT15M").alias("resolution"),
            )
        )
        return _dress_prices(points)

    def prices(self) -> DataFrame:
        """The same with unique keys: the smallest value of each; there are gaps."""
        return _unique_prices(self.raw_prices())

    def line_generation(self) -> DataFrame:
        """Generation points from lineitem: many small groups, for the bench."""
        slot = (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 96
        offset = F.make_dt_interval(mins=(slot * 15).cast("int"))
        points = self.table("lineitem").select(
            (F.col("l_shipdate").cast("timestamp") + offset).alias("delivery_start_utc"),
            F.col("l_extendedprice").alias("generation_mw"),
            _zone("l_suppkey").alias("bidding_zone"),
            _code(F.concat("l_returnflag", "l_linestatus"), LINE_CODES).alias("psr_type"),
            F.lit("MAW").alias("unit"),
            F.lit("PT15M").alias("resolution"),
        )
        named = points.withColumn("production_type", production_type(F.col("psr_type")))
        return add_local_columns(named).select(*GENERATION_COLUMNS)

    def line_prices(self) -> DataFrame:
        """A price for every zone and quarter hour that occurs in lineitem."""
        points = self.line_generation().select(
            "delivery_start_utc",
            (F.col("generation_mw") / 1000 - 20).alias("price_eur_mwh"),
            "bidding_zone",
            "resolution",
        )
        return _unique_prices(_dress_prices(points))

    def generation_documents(self, damaged: bool = False) -> DataFrame:
        """One document per zone and local day, built from ``generation``.

        With ``damaged``, parts are left out or left empty so that the drop rules
        have work to do.
        """
        return _generation_documents(self.generation(), damaged)

    def price_documents(self, damaged: bool = False) -> DataFrame:
        """One document per zone and UTC day, which shares one publication time."""
        return _price_documents(self.prices(), damaged)


def _unique_generation(raw: DataFrame) -> DataFrame:
    unique = raw.groupBy("bidding_zone", "psr_type", "production_type", "delivery_start_utc").agg(
        F.max("generation_mw").alias("generation_mw")
    )
    fixed = unique.withColumns({"unit": F.lit("MAW"), "resolution": F.lit("PT15M")})
    return add_local_columns(fixed).select(*GENERATION_COLUMNS)


def _dress_prices(points: DataFrame) -> DataFrame:
    day = F.date_trunc("day", F.col("delivery_start_utc"))
    dressed = points.withColumns(
        {
            "currency": F.lit("EUR"),
            "unit": F.lit("MWH"),
            "revision_number": F.lit(1),
            "published_at_utc": day - F.make_dt_interval(hours=F.lit(13)),
        }
    )
    return add_local_columns(dressed).select(*PRICE_COLUMNS)


def _unique_prices(raw: DataFrame) -> DataFrame:
    unique = raw.groupBy("bidding_zone", "delivery_start_utc").agg(
        F.min("price_eur_mwh").alias("price_eur_mwh")
    )
    return _dress_prices(unique.withColumn("resolution", F.lit("PT15M")))


def _leave_out(value: Column, when: Column) -> Column:
    return F.when(~when, value)


def _position(start: Column) -> Column:
    seconds = F.unix_seconds(F.col("delivery_start_utc")) - F.unix_seconds(start)
    return (F.floor(seconds / 900) + 1).cast("string")


def _utc_text(instant: Column, pattern: str = "yyyy-MM-dd'T'HH:mm'Z'") -> Column:
    return F.date_format(instant, pattern)


def _generation_documents(points: DataFrame, damaged: bool) -> DataFrame:
    broken = F.lit(damaged)
    start = day_start(F.col(DAY))
    quantity = F.col("generation_mw").cast("string")
    point = F.struct(
        _position(start).alias("position"),
        # a missing quantity below 3 MW, an empty one from there to 5 MW
        F.when(broken & (F.col("generation_mw") < 3), F.lit(None))
        .when(broken & (F.col("generation_mw") < 5), F.lit(""))
        .otherwise(quantity)
        .alias("quantity"),
    )
    # Keys are unique and lie on a quarter-hour grid: at most 100 points a group.
    groups = points.groupBy("bidding_zone", "psr_type", DAY).agg(F.collect_list(point).alias("Point"))
    period = F.struct(
        F.struct(_utc_text(start).alias("start")).alias("timeInterval"),
        _leave_out(F.lit("PT15M"), broken & (F.col("psr_type") == "B12")).alias("resolution"),
        F.col("Point"),
    )
    # Zone Z3: the id is empty on solar series and absent on the others.
    zone = (
        F.when(broken & (F.col("bidding_zone") == "Z3") & (F.col("psr_type") == "B16"), F.lit(""))
        .when(broken & (F.col("bidding_zone") == "Z3"), F.lit(None))
        .otherwise(F.col("bidding_zone"))
    )
    series = F.struct(
        zone.alias("inBiddingZone_Domain.mRID"),
        F.struct(F.col("psr_type").alias("psrType")).alias("MktPSRType"),
        F.lit("MAW").alias("quantity_Measure_Unit.name"),
        F.array(period).alias("Period"),
    )
    # One series per code, and the codes are a short list.
    documents = groups.groupBy("bidding_zone", DAY).agg(F.collect_list(series).alias("TimeSeries"))
    return documents.select(
        F.to_xml(F.struct("TimeSeries"), {"rowTag": "GenerationDocument"}).alias("document"),
        F.col(DAY).alias("delivery_date"),
    )


def _price_documents(points: DataFrame, damaged: bool) -> DataFrame:
    broken = F.lit(damaged)
    day = F.to_date("delivery_start_utc")
    start = F.col("delivery_date").cast("timestamp")
    point = F.struct(
        _position(start).alias("position"),
        F.col("price_eur_mwh").cast("string").alias("price.amount"),
    )
    # Keys are unique and lie on a quarter-hour grid: at most 96 points a group.
    groups = (
        points.withColumn("delivery_date", day)
        .groupBy("bidding_zone", "delivery_date", "published_at_utc", "revision_number")
        .agg(F.collect_list(point).alias("Point"))
    )
    period = F.struct(
        F.struct(_utc_text(start).alias("start")).alias("timeInterval"),
        F.lit("PT15M").alias("resolution"),
        F.col("Point"),
    )
    series = F.struct(
        F.col("bidding_zone").alias("in_Domain.mRID"),
        F.lit("EUR").alias("currency_Unit.name"),
        F.lit("MWH").alias("price_Measure_Unit.name"),
        F.array(period).alias("Period"),
    )
    created = _utc_text(F.col("published_at_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    content = F.struct(
        # no revision in zone Z1, an empty publication time in zone Z2
        _leave_out(
            F.col("revision_number").cast("string"), broken & (F.col("bidding_zone") == "Z1")
        ).alias("revisionNumber"),
        F.when(broken & (F.col("bidding_zone") == "Z2"), F.lit(""))
        .otherwise(created)
        .alias("createdDateTime"),
        F.array(series).alias("TimeSeries"),
    )
    return groups.select(
        F.to_xml(content, {"rowTag": "PriceDocument"}).alias("document"), "delivery_date"
    )
