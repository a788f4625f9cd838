"""Schemas, column roles and the staging -> fact column map.

Everything in this module is declarative: the engine derives Spark
``StructType`` objects, conversion lists and constraint checks from the one
column table below instead of repeating column names in every operator.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class StagingColumn(NamedTuple):
    name: str          # column name in the monthly file and staging table
    kind: str          # int | clock | date | text  (conversion rule)
    sql_type: str      # declared warehouse type (drives range / length checks)
    nullable: bool     # declared nullability
    fact_name: str | None  # column name in the flight fact, None when not carried


# ---------------------------------------------------------------------------
# The 62 staging columns in file order, their conversion rule,
# declared type, nullability and fact column (None = kept only in staging or
# resolved to a dimension key).  These must equal the monthly file layout.
# ---------------------------------------------------------------------------
STAGING_COLUMNS: tuple[StagingColumn, ...] = (
    StagingColumn("YEAR", "int", "SMALLINT", False, None),
    StagingColumn("QUARTER", "int", "TINYINT", False, None),
    StagingColumn("MONTH", "int", "TINYINT", False, None),
    StagingColumn("DAY_OF_MONTH", "int", "TINYINT", False, None),
    StagingColumn("DAY_OF_WEEK", "int", "TINYINT", False, None),
    StagingColumn("FL_DATE", "date", "DATE", False, None),
    StagingColumn("OP_UNIQUE_CARRIER", "text", "VARCHAR(10)", False, None),
    StagingColumn("OP_CARRIER_AIRLINE_ID", "int", "INT", False, None),
    StagingColumn("OP_CARRIER", "text", "VARCHAR(10)", False, None),
    StagingColumn("TAIL_NUM", "text", "VARCHAR(10)", True, "TailNumber"),
    StagingColumn("OP_CARRIER_FL_NUM", "int", "INT", False, "FlightNumber"),
    StagingColumn("ORIGIN_AIRPORT_ID", "int", "INT", False, None),
    StagingColumn("ORIGIN_AIRPORT_SEQ_ID", "int", "INT", False, None),
    StagingColumn("ORIGIN_CITY_MARKET_ID", "int", "INT", False, None),
    StagingColumn("ORIGIN", "text", "VARCHAR(3)", False, None),
    StagingColumn("ORIGIN_CITY_NAME", "text", "VARCHAR(50)", False, None),
    StagingColumn("ORIGIN_STATE_ABR", "text", "VARCHAR(2)", False, None),
    StagingColumn("ORIGIN_STATE_NM", "text", "VARCHAR(50)", False, None),
    StagingColumn("ORIGIN_WAC", "int", "SMALLINT", False, None),
    StagingColumn("DEST_AIRPORT_ID", "int", "INT", False, None),
    StagingColumn("DEST_AIRPORT_SEQ_ID", "int", "INT", False, None),
    StagingColumn("DEST_CITY_MARKET_ID", "int", "INT", False, None),
    StagingColumn("DEST", "text", "VARCHAR(3)", False, None),
    StagingColumn("DEST_CITY_NAME", "text", "VARCHAR(50)", False, None),
    StagingColumn("DEST_STATE_ABR", "text", "VARCHAR(2)", False, None),
    StagingColumn("DEST_STATE_NM", "text", "VARCHAR(50)", False, None),
    StagingColumn("DEST_WAC", "int", "SMALLINT", False, None),
    StagingColumn("CRS_DEP_TIME", "clock", "TIME(0)", False, "ScheduledDepTime"),
    StagingColumn("DEP_TIME", "clock", "TIME(0)", True, "ActualDepTime"),
    StagingColumn("DEP_DELAY", "int", "SMALLINT", True, "DepDelayMinutes"),
    StagingColumn("DEP_DELAY_NEW", "int", "SMALLINT", True, "DepDelayNonNegative"),
    StagingColumn("DEP_DEL15", "int", "TINYINT", True, "IsDepDelayed15"),
    StagingColumn("DEP_TIME_BLK", "text", "VARCHAR(9)", False, "ScheduledDepTimeBlock"),
    StagingColumn("TAXI_OUT", "int", "SMALLINT", True, "TaxiOutMinutes"),
    StagingColumn("WHEELS_OFF", "clock", "TIME(0)", True, "WheelsOffTime"),
    StagingColumn("WHEELS_ON", "clock", "TIME(0)", True, "WheelsOnTime"),
    StagingColumn("TAXI_IN", "int", "SMALLINT", True, "TaxiInMinutes"),
    StagingColumn("CRS_ARR_TIME", "clock", "TIME(0)", False, "ScheduledArrTime"),
    StagingColumn("ARR_TIME", "clock", "TIME(0)", True, "ActualArrTime"),
    StagingColumn("ARR_DELAY", "int", "SMALLINT", True, "ArrDelayMinutes"),
    StagingColumn("ARR_DELAY_NEW", "int", "SMALLINT", True, "ArrDelayNonNegative"),
    StagingColumn("ARR_DEL15", "int", "TINYINT", True, "IsArrDelayed15"),
    StagingColumn("ARR_TIME_BLK", "text", "VARCHAR(9)", False, "ScheduledArrTimeBlock"),
    StagingColumn("CANCELLED", "int", "BIT", False, "IsCancelled"),
    StagingColumn("CANCELLATION_CODE", "text", "VARCHAR(1)", True, "CancellationCode"),
    StagingColumn("DIVERTED", "int", "BIT", False, "IsDiverted"),
    StagingColumn("CRS_ELAPSED_TIME", "int", "SMALLINT", True, "ScheduledElapsedMinutes"),
    StagingColumn("ACTUAL_ELAPSED_TIME", "int", "SMALLINT", True, "ActualElapsedMinutes"),
    StagingColumn("AIR_TIME", "int", "SMALLINT", True, "AirTimeMinutes"),
    StagingColumn("DISTANCE", "int", "SMALLINT", False, "DistanceMiles"),
    StagingColumn("CARRIER_DELAY", "int", "SMALLINT", True, "CarrierDelayMinutes"),
    StagingColumn("WEATHER_DELAY", "int", "SMALLINT", True, "WeatherDelayMinutes"),
    StagingColumn("NAS_DELAY", "int", "SMALLINT", True, "NasDelayMinutes"),
    StagingColumn("SECURITY_DELAY", "int", "SMALLINT", True, "SecurityDelayMinutes"),
    StagingColumn("LATE_AIRCRAFT_DELAY", "int", "SMALLINT", True, "LateAircraftDelayMinutes"),
    StagingColumn("DIV_AIRPORT_LANDINGS", "int", "TINYINT", True, "DivertedAirportLandings"),
    StagingColumn("DIV_REACHED_DEST", "int", "TINYINT", True, "DivertedReachedDestination"),
    StagingColumn("DIV_ACTUAL_ELAPSED_TIME", "int", "SMALLINT", True, "DivertedElapsedMinutes"),
    StagingColumn("DIV_ARR_DELAY", "int", "SMALLINT", True, "DivertedArrDelayMinutes"),
    StagingColumn("DIV_DISTANCE", "int", "SMALLINT", True, "DivertedDistanceMiles"),
    StagingColumn("DIV1_AIRPORT", "text", "VARCHAR(3)", True, "DivertedAirportCode1"),
    StagingColumn("DIV1_AIRPORT_ID", "int", "INT", True, "DivertedAirportID1"),
)

# The raw date text format of FL_DATE in the monthly files.
RAW_DATE_FORMAT = "M/d/yyyy h:mm:ss a"
# Text the pandas reader treats as missing by default.
PANDAS_MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Fixed value: the marker an impossible clock value converts to.
INVALID_CLOCK = "INVALID"

STAGING_NAMES = tuple(c.name for c in STAGING_COLUMNS)
CLOCK_COLUMNS = tuple(c.name for c in STAGING_COLUMNS if c.kind == "clock")
INTEGER_COLUMNS = tuple(c.name for c in STAGING_COLUMNS if c.kind == "int")
TEXT_COLUMNS = tuple(c.name for c in STAGING_COLUMNS if c.kind == "text")
DATE_COLUMN = "FL_DATE"

# Business grain of one flight (date, airline, flight number, origin,
# destination, scheduled departure).
STAGING_GRAIN = ("FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM",
                 "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME")
FACT_GRAIN = ("DateKey", "AirlineKey", "FlightNumber", "OriginAirportKey",
              "DestinationAirportKey", "ScheduledDepTime")
FACT_REQUIRED = ("DateKey", "AirlineKey", "OriginAirportKey", "DestinationAirportKey",
                 "FlightNumber", "ScheduledDepTime", "ScheduledArrTime",
                 "ScheduledDepTimeBlock", "ScheduledArrTimeBlock", "IsCancelled",
                 "IsDiverted", "DistanceMiles")


def _spark_type(col: StagingColumn) -> T.DataType:
    if col.kind == "date":
        return T.DateType()
    if col.kind in ("clock", "text"):
        return T.StringType()
    if col.sql_type == "BIT":
        return T.BooleanType()
    if col.sql_type in ("SMALLINT", "TINYINT"):
        return T.ShortType()
    return T.IntegerType()


def raw_schema() -> T.StructType:
    """All-text schema of a raw monthly file: nothing is inferred."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in STAGING_NAMES])


def staging_schema() -> T.StructType:
    """Typed schema of the processed files / staging table."""
    return T.StructType([T.StructField(c.name, _spark_type(c), c.nullable)
                         for c in STAGING_COLUMNS])


def staging_read_schema() -> T.StructType:
    """Schema for reading processed CSV: BIT columns arrive as 0/1 integers."""
    fields = []
    for c in STAGING_COLUMNS:
        t = _spark_type(c)
        fields.append(T.StructField(c.name, T.ShortType() if isinstance(t, T.BooleanType) else t, True))
    return T.StructType(fields)


def text_schema() -> T.StructType:
    """All-text twin of the staging schema (debug loads, exact representation)."""
    return raw_schema()


def varchar_length(sql_type: str) -> int | None:
    if sql_type.startswith("VARCHAR("):
        return int(sql_type[len("VARCHAR("):-1])
    return None


# Value range of the small integer warehouse types.
INTEGER_RANGES = {"TINYINT": (0, 255), "SMALLINT": (-32768, 32767),
                  "INT": (-2147483648, 2147483647)}

# Dimension schemas (columns in declared order).
DIM_DATE_COLUMNS = ("DateKey", "Date", "Year", "Quarter", "QuarterName", "Month",
                    "MonthName", "YearMonth", "DayOfMonth", "DayOfWeek", "DayName",
                    "IsWeekend")
DIM_AIRLINE_COLUMNS = ("AirlineKey", "DOTAirlineID", "UniqueCarrierCode", "CarrierCode")
DIM_AIRPORT_COLUMNS = ("AirportKey", "AirportID", "AirportSeqID", "AirportCode", "CityName",
                       "CityMarketID", "StateCode", "StateName", "WorldAreaCode")


def fact_columns() -> list[tuple[str, str]]:
    """(staging column, fact column) pairs carried 1:1 into the fact."""
    return [(c.name, c.fact_name) for c in STAGING_COLUMNS if c.fact_name]


def fact_type(col: StagingColumn) -> T.DataType:
    """Fact column type: 0/1 flag columns become booleans."""
    if col.sql_type == "BIT" or col.fact_name in ("IsDepDelayed15", "IsArrDelayed15",
                                                  "DivertedReachedDestination"):
        return T.BooleanType()
    return _spark_type(col)


# Fact column order of the warehouse table (keys first).
FACT_ORDER = ("FlightKey", "DateKey", "AirlineKey", "OriginAirportKey", "DestinationAirportKey",
              "FlightNumber", "TailNumber", "ScheduledDepTime", "ScheduledArrTime",
              "ScheduledDepTimeBlock", "ScheduledArrTimeBlock", "CancellationCode", "IsCancelled",
              "IsDiverted", "IsDepDelayed15", "IsArrDelayed15", "ActualDepTime", "ActualArrTime",
              "WheelsOffTime", "WheelsOnTime", "DepDelayMinutes", "DepDelayNonNegative",
              "ArrDelayMinutes", "ArrDelayNonNegative", "TaxiOutMinutes", "TaxiInMinutes",
              "ScheduledElapsedMinutes", "ActualElapsedMinutes", "AirTimeMinutes", "DistanceMiles",
              "CarrierDelayMinutes", "WeatherDelayMinutes", "NasDelayMinutes",
              "SecurityDelayMinutes", "LateAircraftDelayMinutes", "DivertedAirportLandings",
              "DivertedReachedDestination", "DivertedElapsedMinutes", "DivertedArrDelayMinutes",
              "DivertedDistanceMiles", "DivertedAirportID1", "DivertedAirportCode1")
FACT_KEYS = ("DateKey", "AirlineKey", "OriginAirportKey", "DestinationAirportKey")


def fact_projection_spec() -> list[tuple[str, str, str]]:
    """(staging column, fact column, Spark type) for the 37 carried columns, in
    fact order."""
    by_fact = {c.fact_name: c for c in STAGING_COLUMNS if c.fact_name}
    out = []
    for name in FACT_ORDER:
        if name in by_fact:
            c = by_fact[name]
            out.append((c.name, name, fact_type(c).simpleString()))
    return out
