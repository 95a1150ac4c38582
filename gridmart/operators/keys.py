"""Duplicate keys, and the latest row of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.filter("duplicate_count > 1")


def excess_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows go beyond the first of their key."""
    excess = F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0))
    return duplicate_keys(rows, keys).agg(excess.alias("duplicate_rows"))


def latest_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key.

    An aggregate, not a window: older versions are dropped before the shuffle.
    """
    payload = [name for name in rows.columns if name not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("latest")
    return rows.groupBy(*keys).agg(best).select(
        *[F.col(name) if name in keys else F.col(f"latest.{name}") for name in rows.columns]
    )


def merge_rows(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in the batch, and the whole batch."""
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
