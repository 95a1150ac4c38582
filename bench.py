"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of driver tables, ``BENCH_CPUS`` the cores.
Reading queries go to the no-op sink, so every row and column is worked out; jobs
that write are timed as a whole. Each is timed after one unmeasured run on the
smallest tables, which takes class loading and code generation out of the figures.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame

from gridmart.catalog import QUERIES
from gridmart.operators import slots
from gridmart.plans.models import build_models
from gridmart.session import local_session
from gridmart.sources.standin import Market

REGISTERED = [
    "int_hourly_generation",
    "int_hourly_prices",
    "hourly_generation_prices",
    "hourly_energy_analysis",
    "hourly_energy_analysis_stored",
    "rule_hours_without_price",
    "rule_summary",
    "dup_generation_key",
    "missing_generation_slots",
    "completeness_report",
    "backfill_quality_by_day",
    "xml_generation_points",
    "upsert_generation",
    "ingest_generation",
]


def _line_models(market: Market) -> dict[str, DataFrame]:
    return build_models(market.line_generation(), market.line_prices())


# The same models on lineitem, where nearly every row is a group of its own.
LINE: dict[str, Callable[[Market], DataFrame]] = {
    "line_hourly_generation": lambda m: _line_models(m)["int_hourly_generation"],
    "line_energy_analysis": lambda m: _line_models(m)["hourly_energy_analysis"],
    "line_completeness": lambda m: slots.completeness(
        m.line_generation(), slots.GENERATION_DIMS
    ),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    runs: dict[str, Callable[[str], DataFrame]] = {
        name: lambda place, name=name: QUERIES[name](spark, place) for name in REGISTERED
    }
    for name, build in LINE.items():
        runs[name] = lambda place, build=build: build(Market(spark, place))

    seconds = {}
    for name, run in runs.items():
        if os.path.isdir(small):
            run(small).write.format("noop").mode("overwrite").save()
        begin = time.perf_counter()
        run(folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
