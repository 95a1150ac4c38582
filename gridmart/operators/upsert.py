"""Keyed upsert of a batch into a day table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.sources.tables import DayTable, remove_folder


class BatchRefused(ValueError):
    """The batch cannot be matched by key."""


def refused_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are not unique in the batch, or hold a null.

    A match on a repeated key is ambiguous, and a null key would match nothing and
    be added again by every run.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in keys])
    counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter((F.col("rows") > 1) | has_null)


def upsert(table: DayTable, batch: DataFrame) -> None:
    """Update the rows whose key is in the batch, insert the others, delete nothing.

    The day is a function of the key, so only files of the batch's days can hold its keys,
    and of these only those whose key range meets it are written anew. All columns
    outside the key are replaced on a match, so dropping the old row and adding the new
    one is the same as updating it. The last batch wins, whatever its revision.
    Repeating it is harmless; readers see all of it or nothing.
    """
    table.create_if_absent()
    folder, staged = table.stage(batch.select(*table.columns))
    try:
        if not refused_keys(staged, table.key).isEmpty():
            raise BatchRefused(f"repeated or null values of {', '.join(table.key)} in the batch")
        table.merge(staged)
    finally:
        remove_folder(table.spark, folder)
