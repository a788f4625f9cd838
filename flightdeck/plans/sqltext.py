"""ANSI SQL text of the flight binding and shared expressions, for the DuckDB
oracle that checks each catalogue query (the engine itself never builds SQL
strings; these only describe the expected results)."""

from __future__ import annotations

CANCELLED = "(l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber <= 2)"
DIVERTED = "(l.l_returnflag = 'A' AND l.l_linestatus = 'F' AND l.l_linenumber = 3)"


def hhmm_sql(x: str) -> str:
    """SQL twin of functions.hhmm_to_time over any expression ``x``."""
    v = f"TRY_CAST(TRUNC(TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)) AS BIGINT)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN {v} IS NULL THEN 'INVALID' "
            f"WHEN {v} = 2400 THEN '00:00' "
            f"WHEN {v} < 0 OR FLOOR({v} / 100) > 23 OR ({v} % 100) > 59 THEN 'INVALID' "
            f"ELSE printf('%02d:%02d', CAST(FLOOR({v} / 100) AS BIGINT), CAST({v} % 100 AS BIGINT)) END)")


FLIGHTS_CTE = f"""
fl0 AS (
  SELECT CAST(l.l_shipdate AS DATE) AS fl_date,
         l.l_suppkey AS op_carrier_airline_id,
         s.s_name AS op_unique_carrier,
         l.l_partkey AS op_carrier_fl_num,
         s.s_nationkey AS origin_airport_id,
         c.c_nationkey AS dest_airport_id,
         CASE WHEN l.l_orderkey % 1440 = 0 THEN CAST(2400 AS BIGINT)
              ELSE CAST(FLOOR((l.l_orderkey % 1440) / 60) AS BIGINT) * 100 + l.l_orderkey % 60 END
           AS crs_dep_hhmm,
         {CANCELLED} AS is_cancelled,
         {DIVERTED} AS is_diverted,
         CASE WHEN {CANCELLED} THEN NULL ELSE CAST(l.l_partkey % 60 AS INTEGER) - 15 END AS dep_delay,
         CASE WHEN {CANCELLED} OR {DIVERTED} THEN NULL
              ELSE CAST(FLOOR(l.l_quantity) AS INTEGER) - 25 END AS arr_delay,
         l.l_orderkey AS order_key,
         l.l_linenumber AS line_number
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
),
fl AS MATERIALIZED (
  SELECT fl_date, op_carrier_airline_id, op_unique_carrier, op_carrier_fl_num,
         origin_airport_id, dest_airport_id, crs_dep_hhmm,
         {hhmm_sql('crs_dep_hhmm')} AS crs_dep_time,
         is_cancelled, is_diverted, dep_delay, arr_delay,
         dep_delay >= 15 AS dep_del15, arr_delay >= 15 AS arr_del15,
         order_key, line_number
  FROM fl0
),
ap AS (
  SELECT n.n_nationkey AS airport_id, n.n_name AS airport_code, n.n_name AS city_name,
         r.r_name AS state_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def with_flights(body: str, *ctes: str) -> str:
    """``WITH fl0, fl, ap[, ctes...] <body>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {FLIGHTS_CTE}{extra}\n{body}"


def rate(num: str, den: str = "COUNT(*)") -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF({den}, 0)"


ON_TIME = ("NOT COALESCE(arr_del15, FALSE) AND NOT COALESCE(is_cancelled, FALSE) "
           "AND NOT COALESCE(is_diverted, FALSE)")

# Aggregate SQL of the additive parts (names equal operators.measures parts).
PARTS = {
    "total_flights": "COUNT(*)",
    "on_time_flights": f"COUNT(*) FILTER (WHERE {ON_TIME})",
    "cancelled_flights": "COUNT(*) FILTER (WHERE COALESCE(is_cancelled, FALSE))",
    "diverted_flights": "COUNT(*) FILTER (WHERE COALESCE(is_diverted, FALSE))",
    "dep_delayed15_flights": "COUNT(*) FILTER (WHERE COALESCE(dep_del15, FALSE))",
    "arr_delayed15_flights": "COUNT(*) FILTER (WHERE COALESCE(arr_del15, FALSE))",
    "dep_delay_sum": "CAST(SUM(dep_delay) AS BIGINT)",
    "dep_delay_n": "COUNT(dep_delay)",
    "arr_delay_sum": "CAST(SUM(arr_delay) AS BIGINT)",
    "arr_delay_n": "COUNT(arr_delay)",
}

# Measures over part columns (unrounded).
MEASURES = {
    "total_flights": "total_flights",
    "on_time_flights": "on_time_flights",
    "cancelled_flights": "cancelled_flights",
    "diverted_flights": "diverted_flights",
    "dep_delayed15_flights": "dep_delayed15_flights",
    "arr_delayed15_flights": "arr_delayed15_flights",
    "on_time_rate": rate("on_time_flights", "total_flights"),
    "cancellation_rate": rate("cancelled_flights", "total_flights"),
    "diversion_rate": rate("diverted_flights", "total_flights"),
    "dep_delay_rate": rate("dep_delayed15_flights", "total_flights"),
    "arr_delay_rate": rate("arr_delayed15_flights", "total_flights"),
    "avg_dep_delay": rate("dep_delay_sum", "dep_delay_n"),
    "avg_arr_delay": rate("arr_delay_sum", "arr_delay_n"),
}

DOUBLE_MEASURES = {"on_time_rate", "cancellation_rate", "diversion_rate", "dep_delay_rate",
                   "arr_delay_rate", "avg_dep_delay", "avg_arr_delay"}


def parts_select(names: list[str] | None = None) -> str:
    names = names or list(PARTS)
    return ", ".join(f"{PARTS[n]} AS {n}" for n in names)


def measures_select(measures: list[str], rounded: bool = True) -> str:
    out = []
    for m in measures:
        e = MEASURES[m]
        if rounded and m in DOUBLE_MEASURES:
            e = f"ROUND({e}, 6)"
        out.append(f"{e} AS {m}")
    return ", ".join(out)


def _hhmm_text_sql(m: str) -> str:
    return (f"(CASE WHEN ({m}) = 0 THEN '2400' ELSE "
            f"CAST(CAST(FLOOR(({m}) / 60) AS BIGINT) * 100 + ({m}) % 60 AS VARCHAR) END)")


def _block_sql(m: str) -> str:
    h = f"lpad(CAST(CAST(FLOOR(({m}) / 60) AS BIGINT) AS VARCHAR), 2, '0')"
    return f"({h} || '00-' || {h} || '59')"


def _raw_cte() -> str:
    canc = CANCELLED
    div = DIVERTED
    gone = f"({canc} OR {div})"
    dep_min = "(l.l_orderkey % 1440)"
    dep_delay = f"(CASE WHEN NOT {canc} THEN CAST(l.l_partkey % 60 AS INTEGER) - 15 END)"
    arr_delay = f"(CASE WHEN NOT {gone} THEN CAST(FLOOR(l.l_quantity) AS INTEGER) - 25 END)"
    crs_elapsed = "CAST(l.l_partkey % 240 + 90 AS INTEGER)"
    taxi_out = f"(CASE WHEN NOT {canc} THEN l.l_linenumber * 3 + 5 END)"
    taxi_in = f"(CASE WHEN NOT {gone} THEN l.l_linenumber + 4 END)"
    arr_min = f"(({dep_min} + {crs_elapsed}) % 1440)"
    act = f"(CASE WHEN NOT {gone} THEN {crs_elapsed} + {arr_delay} - {dep_delay} END)"
    dist = "(l.l_partkey % 2400 + 100)"
    late = f"COALESCE({arr_delay} >= 15, FALSE)"
    d = "CAST(l.l_shipdate AS DATE)"

    def t(x):
        return f"CAST({x} AS VARCHAR)"

    def nz(flag, v):
        return f"CASE WHEN {flag} THEN {v} END"

    def code(side):
        return f"(upper(substr({side}reg.r_name, 1, 1)) || lpad(CAST({side}nat.n_nationkey AS VARCHAR), 2, '0'))"

    cols = [
        t(f"year({d})"), t(f"quarter({d})"), t(f"month({d})"), t(f"day({d})"), t(f"isodow({d})"),
        f"strftime({d}, '%-m/%-d/%Y') || ' 12:00:00 AM'",
        "s.s_name", t("l.l_suppkey"), "s.s_name",
        f"CASE WHEN l.l_orderkey % 97 = 0 THEN 'NA' WHEN NOT {canc} THEN 'N' || {t('l.l_partkey % 1000')} END",
        t("l.l_partkey"),
        t("s.s_nationkey"), t("s.s_nationkey * 100000 + s.s_suppkey % 100000"),
        t("s.s_nationkey + 30000"), code("o"), "onat.n_name || ', ' || oreg.r_name",
        "upper(substr(oreg.r_name, 1, 2))", "oreg.r_name", t("s.s_nationkey + 100"),
        t("c.c_nationkey"), t("c.c_nationkey * 100000 + c.c_custkey % 100000"),
        t("c.c_nationkey + 30000"), code("d"), "dnat.n_name || ', ' || dreg.r_name",
        "upper(substr(dreg.r_name, 1, 2))", "dreg.r_name", t("c.c_nationkey + 100"),
        _hhmm_text_sql(dep_min),
        nz(f"NOT {canc}", _hhmm_text_sql(f"({dep_min} + {dep_delay} + 1440) % 1440") + " || '.0'"),
        nz(f"NOT {canc}", t(dep_delay) + " || '.0'"),
        nz(f"NOT {canc}", t(f"greatest({dep_delay}, 0)") + " || '.0'"),
        nz(f"NOT {canc}", t(f"CAST({dep_delay} >= 15 AS INTEGER)") + " || '.0'"),
        _block_sql(dep_min),
        nz(f"NOT {canc}", t(taxi_out) + " || '.0'"),
        nz(f"NOT {canc}", _hhmm_text_sql(f"({dep_min} + {dep_delay} + {taxi_out} + 1440) % 1440") + " || '.0'"),
        nz(f"NOT {gone}", _hhmm_text_sql(f"({arr_min} + {arr_delay} - {taxi_in} + 2880) % 1440") + " || '.0'"),
        nz(f"NOT {gone}", t(taxi_in) + " || '.0'"),
        _hhmm_text_sql(arr_min),
        nz(f"NOT {gone}", _hhmm_text_sql(f"({arr_min} + {arr_delay} + 1440) % 1440") + " || '.0'"),
        nz(f"NOT {gone}", t(arr_delay) + " || '.0'"),
        nz(f"NOT {gone}", t(f"greatest({arr_delay}, 0)") + " || '.0'"),
        nz(f"NOT {gone}", t(f"CAST({arr_delay} >= 15 AS INTEGER)") + " || '.0'"),
        _block_sql(arr_min),
        f"CASE WHEN {canc} THEN '1' ELSE '0' END",
        nz(canc, "CASE WHEN l.l_linenumber = 1 THEN 'A' ELSE 'B' END"),
        f"CASE WHEN {div} THEN '1' ELSE '0' END",
        t(crs_elapsed),
        nz(f"NOT {gone}", t(act) + " || '.0'"),
        nz(f"NOT {gone}", t(f"{act} - {taxi_out} - {taxi_in}") + " || '.0'"),
        t(dist),
        nz(late, t(f"{arr_delay} - 15") + " || '.0'"),
        nz(late, "'0.0'"), nz(late, "'15.0'"), nz(late, "'0.0'"), nz(late, "'0.0'"),
        f"CASE WHEN {div} THEN '1' ELSE '0' END",
        nz(div, "'1'"),
        nz(div, t(f"{crs_elapsed} + 30") + " || '.0'"),
        nz(div, t("l.l_partkey % 60 + 30") + " || '.0'"),
        nz(div, t(f"{dist} + 50") + " || '.0'"),
        nz(div, code("d")),
        nz(div, t("c.c_nationkey") + " || '.0'"),
    ]
    from flightdeck.schemas import STAGING_NAMES
    assert len(cols) == len(STAGING_NAMES), len(cols)
    sel = ",\n    ".join(f"CAST({c} AS VARCHAR) AS {n}" for c, n in zip(cols, STAGING_NAMES))
    return f"""raw AS MATERIALIZED (
  SELECT
    {sel}
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation onat ON onat.n_nationkey = s.s_nationkey
  JOIN region oreg ON oreg.r_regionkey = onat.n_regionkey
  JOIN nation dnat ON dnat.n_nationkey = c.c_nationkey
  JOIN region dreg ON dreg.r_regionkey = dnat.n_regionkey
)"""


RAW_CTE = _raw_cte()


MISSING_TOKENS_SQL = None  # filled below


def _tokens_sql() -> str:
    from flightdeck.schemas import PANDAS_MISSING_TOKENS
    return ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_MISSING_TOKENS)


MISSING_TOKENS_SQL = _tokens_sql()


def nullif_sql(x: str) -> str:
    return f"(CASE WHEN {x} IN ({MISSING_TOKENS_SQL}) THEN NULL ELSE {x} END)"


def strict_int_sql(x: str, to_type: str) -> str:
    d = f"TRY_CAST({x} AS DOUBLE)"
    return f"(CASE WHEN {d} = FLOOR({d}) THEN TRY_CAST({d} AS {to_type}) END)"


def parse_date_sql(x: str) -> str:
    return f"CAST(try_strptime({x}, '%m/%d/%Y %I:%M:%S %p') AS DATE)"


def convert_sql(col, x: str) -> str:
    if col.kind == "clock":
        return hhmm_sql(x)
    if col.kind == "date":
        return parse_date_sql(x)
    if col.kind == "int":
        if col.sql_type == "BIT":
            return f"CAST({strict_int_sql(x, 'INTEGER')} AS BOOLEAN)"
        t = "SMALLINT" if col.sql_type in ("SMALLINT", "TINYINT") else "INTEGER"
        return strict_int_sql(x, t)
    return x


def _stg_cte() -> str:
    from flightdeck.schemas import STAGING_COLUMNS
    sel = ",\n    ".join(f"{convert_sql(c, nullif_sql(c.name))} AS {c.name}" for c in STAGING_COLUMNS)
    return f"stg AS MATERIALIZED (\n  SELECT\n    {sel}\n  FROM raw\n)"


STG_CTE = _stg_cte()


def with_staging(body: str, *ctes: str) -> str:
    """``WITH raw, stg[, ctes...] <body>`` (the raw binding and its cleaning)."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {RAW_CTE},\n{STG_CTE}{extra}\n{body}"


# ---------------------------------------------------------------------------
# Warehouse CTEs over ``stg`` (dimensions and fact), used by J / D / K oracles.
# ---------------------------------------------------------------------------

def dim_date_cte(name: str = "dd", where: str = "") -> str:
    return f"""{name}_spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date
  FROM (SELECT MIN(FL_DATE) AS lo, MAX(FL_DATE) AS hi FROM stg {where}) b WHERE lo IS NOT NULL
),
{name} AS (
  SELECT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS DateKey, Date,
         CAST(year(Date) AS SMALLINT) AS Year, CAST(quarter(Date) AS SMALLINT) AS Quarter,
         'Q' || CAST(quarter(Date) AS VARCHAR) AS QuarterName, CAST(month(Date) AS SMALLINT) AS Month,
         strftime(Date, '%B') AS MonthName, CAST(year(Date) * 100 + month(Date) AS INTEGER) AS YearMonth,
         CAST(day(Date) AS SMALLINT) AS DayOfMonth, CAST(isodow(Date) AS SMALLINT) AS DayOfWeek,
         strftime(Date, '%A') AS DayName, isodow(Date) IN (6, 7) AS IsWeekend
  FROM {name}_spine
)"""


def airline_current_cte(name: str = "ac", where: str = "") -> str:
    cond = "OP_CARRIER_AIRLINE_ID IS NOT NULL AND OP_UNIQUE_CARRIER IS NOT NULL AND OP_CARRIER IS NOT NULL"
    if where:
        cond += f" AND ({where})"
    return f"""{name} AS (
  SELECT DOTAirlineID, UniqueCarrierCode, CarrierCode FROM (
    SELECT OP_CARRIER_AIRLINE_ID AS DOTAirlineID, OP_UNIQUE_CARRIER AS UniqueCarrierCode,
           OP_CARRIER AS CarrierCode,
           ROW_NUMBER() OVER (PARTITION BY OP_CARRIER_AIRLINE_ID
                              ORDER BY OP_UNIQUE_CARRIER, OP_CARRIER) AS rn
    FROM stg WHERE {cond}) x WHERE rn = 1
)"""


def dim_airline_cte(name: str = "da", current: str = "ac") -> str:
    return f"""{name} AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY DOTAirlineID) AS INTEGER) AS AirlineKey,
         DOTAirlineID, UniqueCarrierCode, CarrierCode FROM {current}
)"""


AIRPORT_UNION_SQL = """SELECT ORIGIN_AIRPORT_ID AS AirportID, ORIGIN_AIRPORT_SEQ_ID AS AirportSeqID,
         ORIGIN AS AirportCode, ORIGIN_CITY_NAME AS CityName, ORIGIN_CITY_MARKET_ID AS CityMarketID,
         ORIGIN_STATE_ABR AS StateCode, ORIGIN_STATE_NM AS StateName, ORIGIN_WAC AS WorldAreaCode
  FROM stg {where}
  UNION ALL
  SELECT DEST_AIRPORT_ID, DEST_AIRPORT_SEQ_ID, DEST, DEST_CITY_NAME, DEST_CITY_MARKET_ID,
         DEST_STATE_ABR, DEST_STATE_NM, DEST_WAC
  FROM stg {where}"""


def airport_current_cte(name: str = "apc", where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return f"""{name}_u AS (
  {AIRPORT_UNION_SQL.format(where=w)}
),
{name} AS (
  SELECT AirportID, AirportSeqID, AirportCode, CityName, CityMarketID, StateCode, StateName,
         WorldAreaCode FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY AirportID
        ORDER BY AirportSeqID DESC NULLS LAST, AirportCode NULLS FIRST, CityName NULLS FIRST,
                 CityMarketID NULLS FIRST, StateCode NULLS FIRST, StateName NULLS FIRST,
                 WorldAreaCode NULLS FIRST) AS rn
    FROM {name}_u
    WHERE AirportID IS NOT NULL AND AirportCode IS NOT NULL AND CityName IS NOT NULL
      AND StateCode IS NOT NULL AND StateName IS NOT NULL) x WHERE rn = 1
)"""


def dim_airport_cte(name: str = "dap", current: str = "apc") -> str:
    return f"""{name} AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY AirportID) AS INTEGER) AS AirportKey, AirportID,
         AirportSeqID, AirportCode, CityName, CityMarketID, StateCode, StateName, WorldAreaCode
  FROM {current}
)"""


def _fact_body_select() -> str:
    from flightdeck.schemas import fact_projection_spec
    types = {"int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}
    cols = [f"CAST(s.{src} AS {types[t]}) AS {dst}" for src, dst, t in fact_projection_spec()]
    return ", ".join(cols)


def fact_ctes(how: str = "JOIN") -> str:
    """``fb`` (keys + projection) and ``fact`` (with FlightKey) over stg, dd, da, dap."""
    from flightdeck.schemas import FACT_GRAIN, FACT_KEYS, fact_projection_spec
    body_cols = list(FACT_KEYS) + [dst for _, dst, _ in fact_projection_spec()]
    order = list(FACT_GRAIN) + [c for c in body_cols if c not in FACT_GRAIN]
    order_sql = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"""fb AS (
  SELECT dd.DateKey, da.AirlineKey, o.AirportKey AS OriginAirportKey,
         d.AirportKey AS DestinationAirportKey, {_fact_body_select()}
  FROM stg s
  {how} dd ON dd.Date = s.FL_DATE
  {how} da ON da.DOTAirlineID = s.OP_CARRIER_AIRLINE_ID
  {how} dap o ON o.AirportID = s.ORIGIN_AIRPORT_ID
  {how} dap d ON d.AirportID = s.DEST_AIRPORT_ID
),
fact AS (
  SELECT ROW_NUMBER() OVER (ORDER BY {order_sql}) AS FlightKey, * FROM fb
)"""


def warehouse_ctes() -> tuple[str, ...]:
    return (dim_date_cte(), airline_current_cte(), dim_airline_cte(), airport_current_cte(),
            dim_airport_cte(), fact_ctes())
