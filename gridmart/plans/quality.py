"""The checks over models and batches, as one summary row per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators import checks
from gridmart.operators.hourly import GENERATION_HOUR_KEY, HOUR_KEY, hours_without_price
from gridmart.operators.keys import duplicate_keys
from gridmart.operators.slots import GENERATION_DIMS, PRICE_DIMS, slot_counts
from gridmart.schemas import DAY, DEFAULT_ZONE, GENERATION_KEY, PRICE_KEY

ERROR, WARN, REPORT = "error", "warn", "report"

# The columns of each model that must not be null.
NOT_NULL = {
    "stg_generation": [
        "delivery_start_utc",
        "generation_mw",
        "bidding_zone",
        "psr_type",
        "production_type",
        "delivery_date_local",
    ],
    "stg_prices": [
        "delivery_start_utc",
        "price_eur_mwh",
        "bidding_zone",
        "delivery_date_local",
    ],
    "int_hourly_generation": [
        "bidding_zone",
        "psr_type",
        "production_type",
        "hour_start_utc",
        "average_generation_mw",
        "intervals_available",
    ],
    "int_hourly_prices": [
        "bidding_zone",
        "hour_start_utc",
        "average_price_eur_mwh",
        "intervals_available",
    ],
    "hourly_generation_prices": [
        "bidding_zone",
        "hour_start_utc",
        "psr_type",
        "production_type",
        "average_price_eur_mwh",
        "average_generation_mw",
        "generation_intervals_available",
        "price_intervals_available",
    ],
}

# The key of each model.
UNIQUE = {
    "stg_generation": GENERATION_KEY,
    "stg_prices": PRICE_KEY,
    "int_hourly_generation": GENERATION_HOUR_KEY,
    "int_hourly_prices": HOUR_KEY,
    "hourly_generation_prices": GENERATION_HOUR_KEY,
}


class ChecksFailed(ValueError):
    """At least one rule of severity error has failing rows."""


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _null_tallies(rows: DataFrame, columns: list[str], prefix: str) -> dict[str, str]:
    conditions = checks.null_conditions(rows, columns)
    return {f"{prefix}{name}": f"count_if({sql})" for name, sql in conditions.items()}


_NO_ROWS = "IF(count(*) = 0, 1, 0)"


def _with_severity(counts: DataFrame, severities: dict[str, str]) -> DataFrame:
    """The counts with the severity of their rule: error, unless named here."""
    named = F.create_map(*[F.lit(text) for pair in severities.items() for text in pair])
    severity = F.coalesce(F.element_at(named, F.col("rule")), F.lit(ERROR))
    return counts.select("rule", severity.alias("severity"), "failing_rows")


# Rules that do not fail a run.
SEVERITIES = {
    "generation_hours_have_prices": WARN,
    "batch.duplicate_prices": REPORT,
    "batch.missing_generation": REPORT,
    "batch.missing_prices": REPORT,
}


def not_null_counts(models: dict[str, DataFrame]) -> DataFrame:
    """Nulls per model and column, one pass over each model."""
    return _union(
        [
            checks.tally(models[model], _null_tallies(models[model], columns, "")).select(
                F.lit(model).alias("model"),
                F.col("rule").alias("column_name"),
                F.col("failing_rows").alias("null_rows"),
            )
            for model, columns in NOT_NULL.items()
        ]
    )


def _row_rules(model: str, rows: DataFrame) -> dict[str, str]:
    """Every rule that looks at single rows of a model, or at how many there are."""
    rules = _null_tallies(rows, NOT_NULL[model], f"not_null.{model}.")
    if model in ("int_hourly_generation", "int_hourly_prices"):
        rules[f"interval_count.{model}"] = f"count_if({checks.INTERVAL_COUNT_OFF})"
    if model == "stg_generation":
        rules |= _null_tallies(rows, checks.REQUIRED_GENERATION, "batch.not_null.")
        rules["batch.generation_rows"] = _NO_ROWS
    if model == "stg_prices":
        rules["batch.price_rows"] = _NO_ROWS
    return rules


def _key_rules(model: str) -> dict[str, str]:
    """Rules over the repeated keys of a model."""
    rules = {f"unique.{model}": "count(*)"}
    excess = "sum(duplicate_count - 1)"
    if model == "stg_generation":
        rules["batch.duplicate_generation"] = excess
    if model == "stg_prices":
        rules["batch.duplicate_prices"] = excess
    return rules


# Rules over the slot counts of each zone (and type) and day.
_GENERATION_DAY_RULES = {
    "batch.one_resolution_per_type": "count_if(mixed_resolutions)",
    "batch.missing_generation": "sum(missing_slots)",
}
_PRICE_DAY_RULES = {
    "batch.one_resolution_per_day": "count_if(resolution IS NULL)",
    "batch.missing_prices": "sum(missing_slots)",
}


def rule_tallies(models: dict[str, DataFrame], zone: str = DEFAULT_ZONE) -> list[DataFrame]:
    """All rules, with those that look at the same rows in one pass."""
    generation, prices = models["stg_generation"], models["stg_prices"]
    parts = []
    for model in NOT_NULL:
        rows = models[model]
        parts.append(checks.tally(rows, _row_rules(model, rows)))
        parts.append(checks.tally(duplicate_keys(rows, UNIQUE[model]), _key_rules(model)))
    no_price = hours_without_price(models["int_hourly_generation"], models["int_hourly_prices"])
    parts.append(checks.tally(no_price, {"generation_hours_have_prices": "count(*)"}))
    generation_days = slot_counts(generation, GENERATION_DIMS, zone)
    parts.append(checks.tally(generation_days, _GENERATION_DAY_RULES))
    parts.append(checks.tally(slot_counts(prices, PRICE_DIMS, zone), _PRICE_DAY_RULES))
    return parts


def rule_summary(models: dict[str, DataFrame], zone: str = DEFAULT_ZONE) -> DataFrame:
    """One row per rule: name, severity, failing rows (zero if it passes).

    The rules named ``batch.`` are those a run applies before it loads; the other
    36 are the checks of the models.
    """
    return _with_severity(_union(rule_tallies(models, zone)), SEVERITIES)


def outcome() -> Column:
    """pass, error, warn or report, from a row of the summary."""
    return F.when(F.col("failing_rows") == 0, "pass").otherwise(F.col("severity"))


def require_passed(summary: DataFrame) -> None:
    """Raise if a rule of severity error fails; the summary has a row per rule only."""
    failed = summary.filter((F.col("severity") == ERROR) & (F.col("failing_rows") > 0))
    names = [row["rule"] for row in failed.select("rule").collect()]
    if names:
        raise ChecksFailed(", ".join(sorted(names)))


def quality_by_day(generation: DataFrame) -> DataFrame:
    """Batch checks of generation for every zone and local day of a backfill."""
    verdicts = checks.generation_verdicts(generation, ["bidding_zone", DAY])
    return verdicts.withColumn("error", checks.verdict_error()).drop("unreadable_rows")
