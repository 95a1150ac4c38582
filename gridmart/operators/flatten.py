"""Documents to points: series, periods, points.

``docs`` has a string column ``document``; all its other columns (landing time,
path, delivery date) are carried along. Scalars are picked out before each
explode, so a point row never drags its whole series with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import parse_instant, resolution_interval
from gridmart.functions.values import is_number, present, production_type, to_double, to_int
from gridmart.schemas import GENERATION_DOCUMENT, PRICE_DOCUMENT

_PARSER = {
    "mode": "FAILFAST",
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
}

MALFORMED = "malformed"
_BROKEN = "_broken"

# column name -> path inside a series
GENERATION_SERIES = {
    "bidding_zone": "`inBiddingZone_Domain.mRID`",
    "psr_type": "MktPSRType.psrType",
    "unit": "`quantity_Measure_Unit.name`",
}
PRICE_SERIES = {
    "bidding_zone": "`in_Domain.mRID`",
    "currency": "`currency_Unit.name`",
    "unit": "`price_Measure_Unit.name`",
}


def parse(docs: DataFrame, schema: str, strict: bool = True) -> DataFrame:
    """Replace ``document`` by the parsed struct ``doc``.

    Malformed text raises. If not ``strict`` it sets ``malformed`` instead, and such a document
    goes on as one row of nulls, so that whoever reads its points still knows of it.
    """
    carried = [name for name in docs.columns if name != "document"]
    if strict:
        return docs.select(*carried, F.from_xml("document", schema, _PARSER).alias("doc"))
    options = {**_PARSER, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = F.from_xml("document", f"{schema}, {_BROKEN} string", options)
    malformed = F.col("document").isNull() | F.col(f"doc.{_BROKEN}").isNotNull()
    return (
        docs.select(*carried, "document", parsed.alias("doc"))
        .select(*carried, malformed.alias(MALFORMED), "doc")
        .withColumn("doc", F.when(~F.col(MALFORMED), F.col("doc")))
    )


def _each(rows: DataFrame, array: str) -> Column:
    """The elements of an array; of a malformed document, one null."""
    return (F.explode_outer if MALFORMED in rows.columns else F.explode)(array)


def _complete(rows: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet the condition, and those of malformed documents."""
    kept = condition | F.col(MALFORMED) if MALFORMED in rows.columns else condition
    return rows.filter(kept)


def explode_series(parsed: DataFrame, fields: dict[str, str], **metadata: Column) -> DataFrame:
    """One row per series, with ``fields`` from it and ``metadata`` from the document."""
    carried = [name for name in parsed.columns if name != "doc"]
    rows = parsed.select(
        *carried,
        *[value.alias(name) for name, value in metadata.items()],
        _each(parsed, "doc.TimeSeries").alias("series"),
    )
    return rows.select(
        *carried,
        *metadata,
        *[F.col(f"series.{path}").alias(name) for name, path in fields.items()],
        F.col("series.Period").alias("periods"),
    )


def generation_series_only(series: DataFrame) -> DataFrame:
    """Drop the series without an in-zone id: those are consumption."""
    return _complete(series, present(F.col("bidding_zone")))


def explode_periods(series: DataFrame) -> DataFrame:
    carried = [name for name in series.columns if name != "periods"]
    return series.select(*carried, _each(series, "periods").alias("period")).select(
        *carried,
        F.col("period.timeInterval.start").alias("period_start"),
        F.col("period.resolution").alias("resolution"),
        F.col("period.Point").alias("points"),
    )


def complete_periods(periods: DataFrame) -> DataFrame:
    """Drop the periods without a start or a resolution."""
    return _complete(periods, present(F.col("period_start")) & present(F.col("resolution")))


def explode_points(periods: DataFrame, value: str) -> DataFrame:
    carried = [name for name in periods.columns if name != "points"]
    return periods.select(*carried, _each(periods, "points").alias("point")).select(
        *carried,
        F.col("point.position").alias("position"),
        F.col(f"point.{value}").alias("value"),
    )


def complete_points(points: DataFrame) -> DataFrame:
    """Drop the points without a position or a value."""
    return _complete(points, present(F.col("position")) & present(F.col("value")))


def point_instant(start: Column, step: Column, position: Column, strict: bool = True) -> Column:
    """Positions count from 1; nothing is filled in for positions left out.

    An instant beyond the calendar raises, or is null if not ``strict``.
    """
    if strict:
        return start + step * (position - 1)
    return F.try_add(start, F.try_multiply(step, F.try_subtract(position, F.lit(1))))


def _timed_points(periods: DataFrame, value: str, strict: bool) -> DataFrame:
    """Complete points with ``delivery_start_utc`` and a numeric ``value``.

    Start and step are worked out once per period, before its points. If not
    ``strict``, text that cannot be read sets ``unreadable`` in place of raising.
    """
    timed = complete_periods(periods).withColumns(
        {
            "period_start": parse_instant(F.col("period_start"), strict),
            "step": resolution_interval(F.col("resolution"), strict),
        }
    )
    points = complete_points(explode_points(timed, value))
    instant = point_instant(
        F.col("period_start"), F.col("step"), to_int(F.col("position"), strict), strict
    )
    columns = {"delivery_start_utc": instant, "value": to_double(F.col("value"), strict)}
    if not strict:
        earlier = F.col("unreadable") if "unreadable" in points.columns else F.lit(False)
        unreadable = earlier | instant.isNull() | ~is_number(F.col("value"))
        columns["unreadable"] = ~F.col(MALFORMED) & F.coalesce(unreadable, F.lit(True))
    return points.withColumns(columns).drop("period_start", "step", "position")


def _ordered(points: DataFrame, columns: list[str]) -> DataFrame:
    carried = [name for name in points.columns if name not in columns]
    return points.select(*columns, *carried)


def generation_points(docs: DataFrame, strict: bool = True) -> DataFrame:
    """Generation documents to raw points, without the local columns."""
    parsed = parse(docs, GENERATION_DOCUMENT, strict)
    series = generation_series_only(explode_series(parsed, GENERATION_SERIES)).withColumn(
        "production_type", production_type(F.col("psr_type"))
    )
    points = _timed_points(explode_periods(series), "quantity", strict)
    return _ordered(
        points.withColumnRenamed("value", "generation_mw"),
        [
            "delivery_start_utc",
            "generation_mw",
            "bidding_zone",
            "psr_type",
            "production_type",
            "unit",
            "resolution",
        ],
    )


def price_metadata(strict: bool = True) -> dict[str, Column]:
    """Revision and publication time of a document; missing or empty gives null."""
    revision, created = (
        F.when(present(text), text)
        for text in (F.col("doc.revisionNumber"), F.col("doc.createdDateTime"))
    )
    values = {
        "revision_number": to_int(revision, strict),
        "published_at_utc": parse_instant(created, strict),
    }
    if strict:
        return values
    number, instant = values.values()
    unreadable = (revision.isNotNull() & number.isNull()) | (
        created.isNotNull() & instant.isNull()
    )
    return {**values, "unreadable": unreadable}


def price_points(docs: DataFrame, strict: bool = True) -> DataFrame:
    """Price documents to raw points, without the local columns."""
    parsed = parse(docs, PRICE_DOCUMENT, strict)
    series = explode_series(parsed, PRICE_SERIES, **price_metadata(strict))
    points = _timed_points(explode_periods(series), "`price.amount`", strict)
    return _ordered(
        points.withColumnRenamed("value", "price_eur_mwh"),
        [
            "delivery_start_utc",
            "price_eur_mwh",
            "bidding_zone",
            "currency",
            "unit",
            "resolution",
            "revision_number",
            "published_at_utc",
        ],
    )
