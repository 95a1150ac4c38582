import pytest
from pyspark.sql import functions as F

from gridmart.operators import checks
from gridmart.plans import quality
from gridmart.plans.models import build_models
from test_models import generation, prices

HOUR = "2026-01-05T10"


def summary(spark, gen, price):
    rows = quality.rule_summary(build_models(gen, price))
    return {r.rule: (r.severity, r.failing_rows) for r in rows.collect()}


@pytest.fixture(scope="module")
def clean(spark):
    gen = generation(spark, *[(f"{HOUR}:{m:02d}", 1.0, "A", "B16") for m in (0, 15, 30, 45)])
    price = prices(spark, *[(f"{HOUR}:{m:02d}", 1.0, "A") for m in (0, 15, 30, 45)])
    return gen, price


def failing(rules):
    return {name: rows for name, (_, rows) in rules.items() if rows}


def test_clean_data_passes(spark, clean):
    rules = summary(spark, *clean)
    assert len(rules) == 51
    assert failing(rules) == {"batch.missing_generation": 92, "batch.missing_prices": 92}
    assert sum(severity == "warn" for severity, _ in rules.values()) == 1
    model_rules = [name for name in rules if not name.startswith("batch.")]
    assert len(model_rules) == 36
    quality.require_passed(quality.rule_summary(build_models(*clean)))


@pytest.mark.parametrize("column", quality.NOT_NULL["stg_generation"])
def test_null_generation_column(spark, clean, column):
    gen, price = clean
    broken = gen.withColumn(column, F.when(F.minute("delivery_start_utc") != 15, F.col(column)))
    assert failing(summary(spark, broken, price))[f"not_null.stg_generation.{column}"] == 1


def test_null_models(spark, clean):
    gen, price = clean
    none = gen.withColumn("generation_mw", F.lit(None).cast("double"))
    failed = failing(summary(spark, none, price))
    assert failed["not_null.int_hourly_generation.average_generation_mw"] == 1
    assert failed["not_null.hourly_generation_prices.average_generation_mw"] == 1
    assert failed["batch.not_null.generation_mw"] == 4


def test_nan_counts_as_null(spark, clean):
    gen, price = clean
    nan = gen.withColumn("generation_mw", F.lit(float("nan")))
    assert failing(summary(spark, nan, price))["not_null.stg_generation.generation_mw"] == 4


def test_duplicates(spark, clean):
    gen, price = clean
    failed = failing(summary(spark, gen.union(gen).union(gen), price.union(price)))
    assert failed["unique.stg_generation"] == 4
    assert failed["unique.stg_prices"] == 4
    assert failed["batch.duplicate_generation"] == 8
    assert failed["batch.duplicate_prices"] == 4
    assert failed["interval_count.int_hourly_generation"] == 1
    assert failed["interval_count.int_hourly_prices"] == 1


def test_two_names_for_one_code(spark, clean):
    gen, price = clean
    renamed = gen.withColumn(
        "production_type",
        F.when(F.minute("delivery_start_utc") == 0, "Other").otherwise(F.col("production_type")),
    )
    failed = failing(summary(spark, renamed, price))
    assert failed["unique.int_hourly_generation"] == 1
    assert failed["unique.hourly_generation_prices"] == 1


def test_resolutions(spark, clean):
    gen, price = clean
    mix = F.when(F.minute("delivery_start_utc") == 0, "PT60M").otherwise("PT15M")
    failed = failing(summary(spark, gen.withColumn("resolution", mix), price.withColumn("resolution", mix)))
    assert failed["batch.one_resolution_per_type"] == 1
    assert failed["batch.one_resolution_per_day"] == 1
    none = price.withColumn("resolution", F.lit(None).cast("string"))
    assert failing(summary(spark, gen, none))["batch.one_resolution_per_day"] == 1


def test_missing_price_hour_only_warns(spark, clean):
    gen, price = clean
    more = gen.unionByName(generation(spark, ("2026-01-05T12:00", 1.0, "A", "B16")))
    rules = summary(spark, more, price)
    assert rules["generation_hours_have_prices"] == ("warn", 1)
    quality.require_passed(quality.rule_summary(build_models(more, price)))


def test_empty_batch_and_failure(spark, clean):
    gen, price = clean
    rules = quality.rule_summary(build_models(gen.limit(0), price))
    assert {r.rule: r.failing_rows for r in rules.collect()}["batch.generation_rows"] == 1
    with pytest.raises(quality.ChecksFailed, match="batch.generation_rows"):
        quality.require_passed(rules)


def test_outcomes(spark):
    frame = spark.createDataFrame([("a", "error", 0), ("b", "warn", 2)], "rule string, severity string, failing_rows int")
    assert [r.o for r in frame.select(quality.outcome().alias("o")).collect()] == ["pass", "warn"]


def test_verdicts_order(spark, clean):
    gen, _ = clean
    mixed = gen.union(gen).withColumn("generation_mw", F.lit(None).cast("double"))
    assert quality.quality_by_day(mixed).first().error == "null values"
    assert quality.quality_by_day(gen.union(gen)).first().error == "duplicate keys"
    assert quality.quality_by_day(gen).first().error is None
    assert checks.price_verdicts(clean[1], ["bidding_zone"]).first().mixed_resolutions == 0
