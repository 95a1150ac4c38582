"""SQL for DuckDB that gives the answer of each registered query."""

from __future__ import annotations

# Columns that must not be null, and keys, as the data model names them. They
# are written down here again, so that a rule lost from the package shows up.
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
_GEN_KEY = ["delivery_start_utc", "bidding_zone", "psr_type"]
_PRICE_KEY = ["delivery_start_utc", "bidding_zone"]
_GEN_HOUR_KEY = ["bidding_zone", "hour_start_utc", "psr_type"]
_HOUR_KEY = ["bidding_zone", "hour_start_utc"]
UNIQUE = {
    "stg_generation": _GEN_KEY,
    "stg_prices": _PRICE_KEY,
    "int_hourly_generation": _GEN_HOUR_KEY,
    "int_hourly_prices": _HOUR_KEY,
    "hourly_generation_prices": _GEN_HOUR_KEY,
}

_LOCAL = "timezone('Europe/Rome', timezone('UTC', delivery_start_utc))"
_DAY_START = "timezone('UTC', timezone('Europe/Rome', CAST({day} AS TIMESTAMP)))"
_NAMES = """CASE {code} WHEN 'B01' THEN 'Biomass' WHEN 'B03' THEN 'Fossil Coal-derived Gas'
    WHEN 'B04' THEN 'Fossil Gas' WHEN 'B05' THEN 'Fossil Hard Coal' WHEN 'B06' THEN 'Fossil Oil'
    WHEN 'B10' THEN 'Hydro Pumped Storage' WHEN 'B11' THEN 'Hydro Run-of-river and Poundage'
    WHEN 'B12' THEN 'Hydro Water Reservoir' WHEN 'B16' THEN 'Solar' WHEN 'B19' THEN 'Wind Onshore'
    WHEN 'B20' THEN 'Other' WHEN 'B25' THEN 'Energy Storage' ELSE 'Unknown' END"""


def _start(day: str) -> str:
    return _DAY_START.format(day=day)


def _names(code: str) -> str:
    return _NAMES.format(code=code)


# Each view is a CTE; a query gets those it needs, in this order.
_VIEWS = {
    "raw_gen": f"""
        SELECT delivery_start_utc, generation_mw, bidding_zone, psr_type,
               {_names("psr_type")} AS production_type, 'MAW' AS unit, resolution,
               {_LOCAL} AS delivery_start_local, CAST({_LOCAL} AS DATE) AS delivery_date_local
        FROM (SELECT time_bucket(INTERVAL '15 minutes', ts) AS delivery_start_utc,
                     value AS generation_mw, 'Z' || (user_id % 4) AS bidding_zone,
                     CASE event_type WHEN 'view' THEN 'B16' WHEN 'click' THEN 'B19'
                          WHEN 'purchase' THEN 'B04' WHEN 'signup' THEN 'B12'
                          ELSE 'B99' END AS psr_type,
                     CASE WHEN user_id % 50 = 0 THEN 'PT60M' ELSE 'PT15M' END AS resolution
              FROM events)""",
    "gen": """
        SELECT delivery_start_utc, MAX(generation_mw) AS generation_mw, bidding_zone, psr_type,
               production_type, 'MAW' AS unit, 'PT15M' AS resolution, delivery_start_local,
               delivery_date_local
        FROM raw_gen
        GROUP BY delivery_start_utc, bidding_zone, psr_type, production_type,
                 delivery_start_local, delivery_date_local""",
    "raw_price": f"""
        SELECT delivery_start_utc, price_eur_mwh, bidding_zone, 'EUR' AS currency, 'MWH' AS unit,
               resolution, 1 AS revision_number,
               date_trunc('day', delivery_start_utc) - INTERVAL '13 hours' AS published_at_utc,
               {_LOCAL} AS delivery_start_local, CAST({_LOCAL} AS DATE) AS delivery_date_local
        FROM (SELECT time_bucket(INTERVAL '15 minutes', ts) AS delivery_start_utc,
                     value - 50 AS price_eur_mwh, 'Z' || (user_id % 4) AS bidding_zone,
                     CASE WHEN user_id % 50 = 0 THEN 'PT60M' ELSE 'PT15M' END AS resolution
              FROM events WHERE event_type IN ('purchase', 'view'))""",
    "price": """
        SELECT delivery_start_utc, MIN(price_eur_mwh) AS price_eur_mwh, bidding_zone, currency,
               unit, 'PT15M' AS resolution, revision_number, published_at_utc,
               delivery_start_local, delivery_date_local
        FROM raw_price
        GROUP BY delivery_start_utc, bidding_zone, currency, unit, revision_number,
                 published_at_utc, delivery_start_local, delivery_date_local""",
    "line_gen": f"""
        SELECT *, {_LOCAL} AS delivery_start_local, CAST({_LOCAL} AS DATE) AS delivery_date_local
        FROM (SELECT l_shipdate + to_minutes(15 * ((l_partkey * 7 + l_linenumber) % 96))
                         AS delivery_start_utc,
                     'Z' || (l_suppkey % 4) AS bidding_zone,
                     CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'B16' WHEN 'AO' THEN 'B19'
                          WHEN 'NF' THEN 'B04' WHEN 'NO' THEN 'B12' WHEN 'RF' THEN 'B11'
                          ELSE 'B99' END AS psr_type,
                     'PT15M' AS resolution
              FROM lineitem)""",
}


def _hourly(points: str, keys: str, measure: str) -> str:
    return f"""
        SELECT {keys}, date_trunc('hour', delivery_start_utc) AS hour_start_utc,
               AVG({measure}) AS average_{measure}, MIN({measure}) AS minimum_{measure},
               MAX({measure}) AS maximum_{measure}, COUNT(*) AS intervals_available
        FROM {points} GROUP BY ALL"""


_GEN_KEYS = "bidding_zone, psr_type, production_type"
_JOINED = """
        SELECT g.bidding_zone, g.hour_start_utc, g.psr_type, g.production_type,
               p.average_price_eur_mwh, p.minimum_price_eur_mwh, p.maximum_price_eur_mwh,
               g.average_generation_mw, g.minimum_generation_mw, g.maximum_generation_mw,
               g.intervals_available AS generation_intervals_available,
               p.intervals_available AS price_intervals_available
        FROM gen_hours g JOIN {prices} p USING (bidding_zone, hour_start_utc)"""

_VIEWS |= {
    "two_names": """
        SELECT * REPLACE (CASE WHEN generation_mw > 100 THEN 'Other' ELSE production_type END
                          AS production_type) FROM raw_gen""",
    "gen_hours": _hourly("raw_gen", _GEN_KEYS, "generation_mw"),
    "two_name_hours": _hourly("two_names", _GEN_KEYS, "generation_mw"),
    "price_hours": _hourly("price", "bidding_zone", "price_eur_mwh"),
    "raw_price_hours": _hourly("raw_price", "bidding_zone", "price_eur_mwh"),
    "joined": _JOINED.format(prices="price_hours"),
    "raw_joined": _JOINED.format(prices="raw_price_hours"),
}


def _with(needs: str, body: str) -> str:
    """The body after the named views and the views those are built on."""
    below = {
        "gen": ["raw_gen"],
        "price": ["raw_price"],
        "gen_hours": ["raw_gen"],
        "two_names": ["raw_gen"],
        "two_name_hours": ["two_names"],
        "price_hours": ["price"],
        "raw_price_hours": ["raw_price"],
        "joined": ["gen_hours", "price_hours"],
        "raw_joined": ["gen_hours", "raw_price_hours"],
    }
    wanted, todo = set(), needs.split()
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo += below.get(name, [])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _VIEWS.items() if name in wanted)
    return f"WITH {ctes}\n{body}"


def _rounded(measures: str, *prefixes: str) -> str:
    return ", ".join(
        f"ROUND({prefix}_{measures}, 6) AS {prefix}_{measures}" for prefix in prefixes
    )


_SPREAD = ("average", "minimum", "maximum")
_GEN_SPREAD = _rounded("generation_mw", *_SPREAD)
_PRICE_SPREAD = _rounded("price_eur_mwh", *_SPREAD)

_GEN_COLUMNS = """delivery_start_utc, ROUND(generation_mw, 6) AS generation_mw, bidding_zone,
    psr_type, production_type, unit, resolution, delivery_start_local, delivery_date_local"""
_PRICE_COLUMNS = """delivery_start_utc, ROUND(price_eur_mwh, 6) AS price_eur_mwh, bidding_zone,
    currency, unit, resolution, CAST(revision_number AS INTEGER) AS revision_number,
    published_at_utc, delivery_start_local, delivery_date_local"""

_RENEWABLE = """production_type IN ('Biomass', 'Hydro Run-of-river and Poundage',
    'Hydro Water Reservoir', 'Solar', 'Wind Onshore')"""
_HYDRO = "production_type IN ('Hydro Run-of-river and Poundage', 'Hydro Water Reservoir')"
_FOSSIL = """production_type IN ('Fossil Coal-derived Gas', 'Fossil Gas', 'Fossil Hard Coal',
    'Fossil Oil')"""


def _mw(condition: str) -> str:
    return f"SUM(IF({condition}, average_generation_mw, 0))"


_SHARE = f"""ROUND(CASE WHEN SUM(average_generation_mw) = 0 THEN NULL
    ELSE {_mw(_RENEWABLE)} / SUM(average_generation_mw) END, 6) AS renewable_share"""

_ANALYSIS = f"""
    SELECT hour_start_utc, bidding_zone,
           ROUND(SUM(average_generation_mw), 6) AS total_generation_mw,
           ROUND({_mw(_RENEWABLE)}, 6) AS renewable_generation_mw, {_SHARE},
           ROUND({_mw("production_type = 'Solar'")}, 6) AS solar_mw,
           ROUND({_mw("production_type = 'Wind Onshore'")}, 6) AS wind_onshore_mw,
           ROUND({_mw(_HYDRO)}, 6) AS hydro_mw,
           ROUND({_mw(_FOSSIL)}, 6) AS fossil_generation_mw,
           ROUND({_mw("production_type = 'Fossil Gas'")}, 6) AS fossil_gas_mw,
           ROUND(MAX(average_price_eur_mwh), 6) AS average_price_eur_mwh,
           ROUND(MAX(minimum_price_eur_mwh), 6) AS minimum_price_eur_mwh,
           ROUND(MAX(maximum_price_eur_mwh), 6) AS maximum_price_eur_mwh,
           CAST(SUM(generation_intervals_available) AS BIGINT) AS generation_intervals_available,
           MAX(price_intervals_available) AS price_intervals_available
    FROM joined GROUP BY hour_start_utc, bidding_zone"""


def _without(left: str, right: str) -> str:
    return f"""
    SELECT DISTINCT l.bidding_zone, l.hour_start_utc FROM {left} l
    WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE r.bidding_zone = l.bidding_zone
                      AND r.hour_start_utc = l.hour_start_utc)"""


def _dup(rows: str, keys: list[str]) -> str:
    listed = ", ".join(keys)
    return f"SELECT {listed}, COUNT(*) AS duplicate_count FROM {rows} GROUP BY {listed} HAVING COUNT(*) > 1"


def _excess(rows: str, keys: list[str]) -> str:
    return f"SELECT CAST(COALESCE(SUM(duplicate_count - 1), 0) AS BIGINT) FROM ({_dup(rows, keys)})"


# --- documents ------------------------------------------------------------------------

_FLAT = f"""
    SELECT delivery_date_local AS delivery_date,
           CASE WHEN bidding_zone <> 'Z3' THEN bidding_zone END AS bidding_zone, psr_type,
           {_start("delivery_date_local")} AS period_start_utc,
           CASE WHEN psr_type <> 'B12' THEN 'PT15M' END AS resolution,
           CAST(date_diff('minute', {_start("delivery_date_local")}, delivery_start_utc) // 15 + 1
                AS INTEGER) AS position,
           CASE WHEN generation_mw >= 5 THEN ROUND(generation_mw, 6) END AS quantity
    FROM gen"""

# --- slots ----------------------------------------------------------------------------


def _grid(points: str, dims: str) -> str:
    """Slots that each group with a single resolution should have."""
    return f"""
    SELECT {dims}, delivery_date_local, resolution,
           unnest(range({_start("delivery_date_local")}, {_start("delivery_date_local + 1")},
                        CASE resolution WHEN 'PT15M' THEN INTERVAL '15 minutes'
                             ELSE INTERVAL '60 minutes' END)) AS delivery_start_utc
    FROM (SELECT {dims}, delivery_date_local, MIN(resolution) AS resolution FROM {points}
          GROUP BY {dims}, delivery_date_local HAVING COUNT(DISTINCT resolution) = 1)"""


def _missing(points: str, dims: str) -> str:
    columns = f"{dims}, delivery_start_utc"
    return f"""
    SELECT {dims}, delivery_date_local, delivery_start_utc FROM ({_grid(points, dims)})
    ANTI JOIN {points} USING ({columns})"""


def _completeness(points: str, dims: str) -> str:
    group = f"{dims}, delivery_date_local"
    return f"""
    SELECT {group}, resolution, expected_slots, actual_rows,
           CASE WHEN resolution IS NOT NULL THEN COALESCE(missing, 0) END AS missing_slots,
           duplicate_rows
    FROM (SELECT {group}, COUNT(*) AS actual_rows,
                 COUNT(*) - COUNT(DISTINCT delivery_start_utc) AS duplicate_rows,
                 CASE WHEN COUNT(DISTINCT resolution) = 1 THEN MIN(resolution) END AS resolution
          FROM {points} GROUP BY {group})
    LEFT JOIN (SELECT {group}, COUNT(*) AS expected_slots FROM ({_grid(points, dims)})
               GROUP BY {group}) USING ({group})
    LEFT JOIN (SELECT {group}, COUNT(*) AS missing FROM ({_missing(points, dims)})
               GROUP BY {group}) USING ({group})"""


_DIMS = "bidding_zone, psr_type"

# --- rules ----------------------------------------------------------------------------

_MODEL_VIEWS = {
    "stg_generation": "raw_gen",
    "stg_prices": "raw_price",
    "int_hourly_generation": "gen_hours",
    "int_hourly_prices": "raw_price_hours",
    "hourly_generation_prices": "raw_joined",
}


def _count_of(rule: str, severity: str, rows: str) -> str:
    return _rule(rule, severity, f"SELECT COUNT(*) FROM ({rows})")


def _rule(rule: str, severity: str, count: str) -> str:
    return f"SELECT '{rule}' AS rule, '{severity}' AS severity, ({count}) AS failing_rows"


def _summary() -> str:
    parts = []
    for model, columns in NOT_NULL.items():
        view = _MODEL_VIEWS[model]
        for column in columns:
            nulls = f"SELECT 1 FROM {view} WHERE {column} IS NULL"
            parts.append(_count_of(f"not_null.{model}.{column}", "error", nulls))
        parts.append(_count_of(f"unique.{model}", "error", _dup(view, UNIQUE[model])))
        if model.startswith("int_"):
            off = f"SELECT 1 FROM {view} WHERE intervals_available < 1 OR intervals_available > 4"
            parts.append(_count_of(f"interval_count.{model}", "error", off))
    no_price = _without("gen_hours", "raw_price_hours")
    parts.append(_count_of("generation_hours_have_prices", "warn", no_price))
    for name, view in (("generation_rows", "raw_gen"), ("price_rows", "raw_price")):
        empty = f"SELECT CAST(COUNT(*) = 0 AS BIGINT) FROM {view}"
        parts.append(_rule(f"batch.{name}", "error", empty))
    for column in NOT_NULL["stg_generation"][:-1] + ["unit", "resolution"]:
        nulls = f"SELECT 1 FROM raw_gen WHERE {column} IS NULL"
        parts.append(_count_of(f"batch.not_null.{column}", "error", nulls))
    mixed = [
        ("one_resolution_per_type", "raw_gen", f"{_DIMS}, delivery_date_local", "> 1"),
        ("one_resolution_per_day", "raw_price", "bidding_zone, delivery_date_local", "<> 1"),
    ]
    for name, view, keys, test in mixed:
        rows = f"SELECT 1 FROM {view} GROUP BY {keys} HAVING COUNT(DISTINCT resolution) {test}"
        parts.append(_count_of(f"batch.{name}", "error", rows))
    parts.append(_rule("batch.duplicate_generation", "error", _excess("raw_gen", _GEN_KEY)))
    parts.append(_rule("batch.duplicate_prices", "report", _excess("raw_price", _PRICE_KEY)))
    for name, view, dims in (
        ("missing_generation", "raw_gen", _DIMS),
        ("missing_prices", "raw_price", "bidding_zone"),
    ):
        parts.append(_count_of(f"batch.{name}", "report", _missing(view, dims)))
    return "\nUNION ALL ".join(parts)


def _null_counts() -> str:
    """Readings below 1 MW are null here; an hour made of such readings has no average."""
    delivered = """SELECT * REPLACE (CASE WHEN generation_mw >= 1 THEN generation_mw END
        AS generation_mw) FROM raw_gen"""
    views = _MODEL_VIEWS | {
        "stg_generation": "delivered",
        "stg_prices": "price",
        "int_hourly_generation": "delivered_hours",
        "int_hourly_prices": "price_hours",
        "hourly_generation_prices": "delivered_joined",
    }
    counts = "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{column}' AS column_name,"
        f" COUNT(*) FILTER ({column} IS NULL) AS null_rows FROM {views[model]}"
        for model, columns in NOT_NULL.items()
        for column in columns
    )
    joined = _JOINED.format(prices="price_hours").replace("gen_hours", "delivered_hours")
    return _with(
        "raw_gen price_hours",
        f""", delivered AS ({delivered}),
        delivered_hours AS ({_hourly("delivered", _GEN_KEYS, "generation_mw")}),
        delivered_joined AS ({joined})
        {counts}""",
    )


_QUALITY = f"""
    WITH types AS (
        SELECT bidding_zone, delivery_date_local, psr_type, COUNT(*) AS n,
               COUNT(*) - COUNT(DISTINCT delivery_start_utc) AS excess,
               CAST(COUNT(DISTINCT resolution) > 1 AS INTEGER) AS mixed
        FROM raw_gen GROUP BY ALL),
    days AS (
        SELECT bidding_zone, delivery_date_local, CAST(SUM(n) AS BIGINT) AS rows,
               CAST(0 AS BIGINT) AS null_rows, CAST(SUM(excess) AS BIGINT) AS duplicate_rows,
               CAST(SUM(mixed) AS BIGINT) AS mixed_resolutions
        FROM types GROUP BY bidding_zone, delivery_date_local)
    SELECT *, CASE WHEN mixed_resolutions > 0 THEN 'several resolutions'
                   WHEN duplicate_rows > 0 THEN 'duplicate keys' END AS error FROM days"""


def _upsert(view: str, columns: str, measure: str, keys: str) -> str:
    return _with(
        view,
        f"""SELECT {columns} FROM (
            SELECT * REPLACE ({measure} + 1 AS {measure}) FROM {view}
            WHERE delivery_date_local >= DATE '2024-01-15'
            UNION ALL
            SELECT * FROM {view} old WHERE delivery_date_local <= DATE '2024-01-20'
            AND NOT EXISTS (SELECT 1 FROM {view} new
                            WHERE new.delivery_date_local >= DATE '2024-01-15' AND {keys}))""",
    )


_RESOLUTION_MINUTES = "IF(user_id % 2 = 0, user_id % 60 + 1, 60 * (user_id % 24 + 1))"
_RESOLUTION_TEXT = (
    "IF(user_id % 2 = 0, 'PT' || (user_id % 60 + 1) || 'M', 'PT' || (user_id % 24 + 1) || 'H')"
)
_INSTANT = """CASE user_id % 3 WHEN 0 THEN date_trunc('minute', ts)
    WHEN 1 THEN date_trunc('second', ts)
    ELSE date_trunc('minute', ts) - INTERVAL '2 hours' END"""
_INSTANT_TEXT = """CASE user_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%MZ')
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M') || '+02:00' END"""
_CODE = "CASE WHEN user_id % 7 <> 0 THEN 'B' || lpad(CAST(user_id % 30 AS VARCHAR), 2, '0') END"

_ALL_GEN = _with("gen", f"SELECT {_GEN_COLUMNS} FROM gen")
_ALL_PRICES = _with("price", f"SELECT {_PRICE_COLUMNS} FROM price")

ORACLE: dict[str, str] = {
    # models
    "stg_generation": _with("raw_gen", f"SELECT {_GEN_COLUMNS} FROM raw_gen"),
    "stg_prices": _ALL_PRICES,
    "int_hourly_generation": _with(
        "gen_hours",
        f"SELECT {_GEN_KEYS}, hour_start_utc, {_GEN_SPREAD}, intervals_available FROM gen_hours",
    ),
    "int_hourly_prices": _with(
        "price_hours",
        f"SELECT bidding_zone, hour_start_utc, {_PRICE_SPREAD}, intervals_available FROM price_hours",
    ),
    "hourly_generation_prices": _with(
        "joined",
        f"""SELECT {_GEN_KEYS}, hour_start_utc, {_PRICE_SPREAD}, {_GEN_SPREAD},
            generation_intervals_available, price_intervals_available FROM joined""",
    ),
    "hourly_energy_analysis": _with("joined", _ANALYSIS),
    "hourly_energy_analysis_stored": _with("joined", _ANALYSIS),
    "renewable_mix": _with(
        "gen_hours",
        f"""SELECT bidding_zone, hour_start_utc,
            ROUND({_mw(_RENEWABLE)}, 6) AS renewable_generation_mw,
            ROUND({_mw(_FOSSIL)}, 6) AS fossil_generation_mw, {_SHARE}
            FROM gen_hours GROUP BY bidding_zone, hour_start_utc""",
    ),
    "hours_between": _with(
        "price_hours",
        f"""SELECT bidding_zone, hour_start_utc, {_PRICE_SPREAD}, intervals_available
            FROM price_hours WHERE hour_start_utc >= TIMESTAMP '2024-01-08'
            AND hour_start_utc < TIMESTAMP '2024-01-15'""",
    ),
    "hours_without_generation": _with(
        "gen_hours price_hours",
        _without("price_hours", f"(SELECT * FROM gen_hours WHERE {_RENEWABLE})"),
    ),
    # documents
    "flatten_points": _with("gen", _FLAT),
    "filter_generation_series": _with(
        "gen",
        """SELECT DISTINCT delivery_date_local AS delivery_date, bidding_zone, psr_type, unit
           FROM gen WHERE bidding_zone <> 'Z3'""",
    ),
    "drop_incomplete_periods": _with("gen", f"{_FLAT} WHERE psr_type <> 'B12'"),
    "drop_incomplete_points": _with("gen", f"{_FLAT} WHERE generation_mw >= 5"),
    "xml_generation_points": _ALL_GEN,
    "xml_damaged_generation_points": _with(
        "gen",
        """SELECT delivery_start_utc, ROUND(generation_mw, 6) AS generation_mw, bidding_zone,
           psr_type, production_type, unit, resolution FROM gen
           WHERE bidding_zone <> 'Z3' AND psr_type <> 'B12' AND generation_mw >= 5""",
    ),
    "xml_price_points": _ALL_PRICES,
    "price_doc_metadata": _with(
        "price",
        """SELECT bidding_zone, delivery_start_utc,
           CASE WHEN bidding_zone <> 'Z1' THEN CAST(revision_number AS INTEGER) END
               AS revision_number,
           CASE WHEN bidding_zone <> 'Z2' THEN published_at_utc END AS published_at_utc
           FROM price""",
    ),
    "archive_partition_prune": _with(
        "gen",
        """SELECT bidding_zone, delivery_date_local AS delivery_date, COUNT(*) AS points,
           ROUND(SUM(generation_mw), 6) AS total_mw FROM gen
           WHERE delivery_date_local BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
           GROUP BY bidding_zone, delivery_date_local""",
    ),
    # scalar work
    "psr_lookup": f"""SELECT event_id, {_CODE} AS psr_type, {_names(_CODE)} AS production_type
        FROM events""",
    "resolution_interval": f"""SELECT event_id, {_RESOLUTION_TEXT} AS resolution,
        TIMESTAMP '2024-01-01' + to_minutes({_RESOLUTION_MINUTES}) AS first_end FROM events""",
    "parse_instant": f"""SELECT event_id, {_INSTANT_TEXT} AS text, {_INSTANT} AS instant_utc
        FROM events""",
    "point_timestamp": f"""SELECT event_id,
        {_INSTANT} + to_minutes({_RESOLUTION_MINUTES} * (user_id % 100)) AS delivery_start_utc
        FROM events""",
    "cast_strict": """SELECT event_id,
        ROUND(CASE user_id % 4 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN -value * 100
              ELSE CASE WHEN user_id % 3 <> 0 THEN value END END, 6) + 0 AS value,
        CAST(user_id AS INTEGER) AS position FROM events""",
    # calendar
    "local_columns": _with(
        "line_gen",
        """SELECT bidding_zone, psr_type, delivery_start_utc, delivery_start_local,
           delivery_date_local FROM line_gen""",
    ),
    "local_day_bounds": _with(
        "line_gen",
        f"""SELECT delivery_date_local, {_start("delivery_date_local")} AS day_start_utc,
            {_start("delivery_date_local + 1")} AS day_end_utc,
            date_diff('hour', {_start("delivery_date_local")},
                      {_start("delivery_date_local + 1")}) AS hours
            FROM (SELECT DISTINCT delivery_date_local FROM line_gen)""",
    ),
    "filter_target_day": _with(
        "gen",
        """SELECT bidding_zone, psr_type, delivery_start_utc, delivery_date_local FROM gen
           WHERE delivery_date_local = CAST(delivery_start_utc AS DATE)""",
    ),
    "expected_grid": _with(
        "price",
        f"""SELECT bidding_zone, delivery_date_local, delivery_start_utc
            FROM ({_grid("price", "bidding_zone")})""",
    ),
    "missing_price_slots": _with("price", _missing("price", "bidding_zone")),
    "missing_generation_slots": _with("raw_gen", _missing("raw_gen", _DIMS)),
    "completeness_report": _with("raw_gen", _completeness("raw_gen", _DIMS)),
    "dst_completeness_report": _with("line_gen", _completeness("line_gen", _DIMS)),
    "price_completeness_report": _with("raw_price", _completeness("raw_price", "bidding_zone")),
    # checks
    "dup_generation_key": _with("raw_gen", _dup("raw_gen", _GEN_KEY)),
    "dup_price_key": _with("raw_price", _dup("raw_price", _PRICE_KEY)),
    "dup_hourly_generation": _with("two_name_hours", _dup("two_name_hours", _GEN_HOUR_KEY)),
    "dup_hourly_price": _with(
        "raw_price",
        f""", feed_hours AS ({_hourly("raw_price", "resolution, bidding_zone", "price_eur_mwh")})
        {_dup("feed_hours", _HOUR_KEY)}""",
    ),
    "dup_hourly_join": _with(
        "two_name_hours price_hours",
        _dup(
            "(SELECT * FROM two_name_hours SEMI JOIN price_hours USING (bidding_zone, hour_start_utc))",
            _GEN_HOUR_KEY,
        ),
    ),
    "dup_excess_count": _with(
        "raw_gen raw_price",
        f"""SELECT 'generation' AS batch, ({_excess("raw_gen", _GEN_KEY)}) AS duplicate_rows
            UNION ALL SELECT 'prices', ({_excess("raw_price", _PRICE_KEY)})""",
    ),
    "rule_resolution_per_type": _with(
        "raw_gen",
        """SELECT bidding_zone, delivery_date_local, psr_type,
           COUNT(DISTINCT resolution) AS resolutions FROM raw_gen GROUP BY ALL
           HAVING COUNT(DISTINCT resolution) > 1""",
    ),
    "rule_single_resolution": _with(
        "raw_price",
        """SELECT bidding_zone, delivery_date_local, COUNT(DISTINCT resolution) AS resolutions
           FROM raw_price GROUP BY ALL HAVING COUNT(DISTINCT resolution) <> 1""",
    ),
    "rule_generation_intervals": _with(
        "gen_hours",
        f"""SELECT {_GEN_KEYS}, hour_start_utc, {_GEN_SPREAD}, intervals_available
            FROM gen_hours WHERE intervals_available NOT BETWEEN 1 AND 4""",
    ),
    "rule_price_intervals": _with(
        "raw_price_hours",
        """SELECT bidding_zone, hour_start_utc, intervals_available FROM raw_price_hours
           WHERE intervals_available NOT BETWEEN 1 AND 4""",
    ),
    "rule_hours_without_price": _with(
        "gen_hours price_hours", _without("gen_hours", "price_hours")
    ),
    "rule_not_null_counts": _null_counts(),
    "rule_summary": _with("raw_joined", _summary()),
    "rows_by_production_type": _with(
        "raw_gen",
        "SELECT psr_type, production_type, COUNT(*) AS rows FROM raw_gen GROUP BY ALL",
    ),
    "backfill_quality_by_day": _with("raw_gen", f"SELECT * FROM ({_QUALITY})"),
    "sorted_points": _with(
        "gen",
        f"""SELECT {_GEN_COLUMNS} FROM gen
            ORDER BY psr_type, delivery_start_utc, gen.generation_mw, bidding_zone""",
    ),
    "sorted_prices": _with(
        "price",
        f"""SELECT {_PRICE_COLUMNS} FROM price
            ORDER BY delivery_start_utc, price.price_eur_mwh, bidding_zone""",
    ),
    "first_points": _with(
        "gen",
        f"""SELECT {_GEN_COLUMNS} FROM gen
            ORDER BY psr_type, delivery_start_utc, gen.generation_mw, bidding_zone LIMIT 10""",
    ),
    # tables and jobs
    "upsert_generation": _upsert(
        "gen",
        _GEN_COLUMNS,
        "generation_mw",
        "new.bidding_zone = old.bidding_zone AND new.psr_type = old.psr_type"
        " AND new.delivery_start_utc = old.delivery_start_utc",
    ),
    "upsert_prices": _upsert(
        "price",
        _PRICE_COLUMNS,
        "price_eur_mwh",
        "new.bidding_zone = old.bidding_zone"
        " AND new.delivery_start_utc = old.delivery_start_utc",
    ),
    "price_csv_roundtrip": _ALL_PRICES,
    "latest_points": """
        SELECT 'Z' || (user_id % 4) AS bidding_zone, date_trunc('hour', ts) AS hour_start_utc,
               event_id, ROUND(value, 6) AS value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id % 4, date_trunc('hour', ts)
                                   ORDER BY ts DESC, event_id DESC) = 1""",
    "hourly_generation_refreshed": _with(
        "gen",
        f""", merged AS (
            SELECT * REPLACE (generation_mw + day(delivery_date_local) - 20 AS generation_mw)
            FROM gen
            WHERE delivery_date_local >= DATE '2024-01-15' AND minute(delivery_start_utc) < 30
            UNION ALL
            SELECT * FROM gen WHERE delivery_date_local <= DATE '2024-01-20'
            AND NOT (delivery_date_local >= DATE '2024-01-15' AND minute(delivery_start_utc) < 30)),
        hours AS ({_hourly("merged", _GEN_KEYS, "generation_mw")})
        SELECT {_GEN_KEYS}, hour_start_utc, {_GEN_SPREAD}, intervals_available FROM hours""",
    ),
    "ingest_generation": _ALL_GEN,
    "ingest_prices": _with(
        "price",
        f"""SELECT {_PRICE_COLUMNS} FROM price
            WHERE delivery_date_local = CAST(delivery_start_utc AS DATE)""",
    ),
    "document_status": _with(
        "gen",
        """SELECT CAST(day + CASE WHEN day(day) % 4 = 3 THEN 40 ELSE 0 END AS DATE) AS delivery_date,
            CASE day(day) % 4 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no points'
                 WHEN 3 THEN 'no points in the day' END AS error,
            COUNT(*) AS documents
        FROM (SELECT DISTINCT bidding_zone, delivery_date_local AS day FROM gen) GROUP BY ALL""",
    ),
    "stream_ingest_generation": _ALL_GEN,
    "run_all_days": _with(
        "gen price",
        f""", kept AS (SELECT * FROM price
            WHERE delivery_date_local = CAST(delivery_start_utc AS DATE)),
        gen_hours AS ({_hourly("gen", _GEN_KEYS, "generation_mw")}),
        kept_hours AS ({_hourly("kept", "bidding_zone", "price_eur_mwh")}),
        joined AS ({_JOINED.format(prices="kept_hours")})
        {_ANALYSIS}""",
    ),
}
