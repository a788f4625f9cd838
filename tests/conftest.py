from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("flightdeck-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only when the session names none
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flightdeck-test-"))
    yield spark


# --------------------------------------------------------------------------
# A raw monthly row builder: 62 text fields of one valid flight, overridable.
# --------------------------------------------------------------------------
DEFAULT_RAW = {
    "YEAR": "2025", "QUARTER": "1", "MONTH": "1", "DAY_OF_MONTH": "1", "DAY_OF_WEEK": "3",
    "FL_DATE": "1/1/2025 12:00:00 AM", "OP_UNIQUE_CARRIER": "DL", "OP_CARRIER_AIRLINE_ID": "19790",
    "OP_CARRIER": "DL", "TAIL_NUM": "N123DL", "OP_CARRIER_FL_NUM": "100",
    "ORIGIN_AIRPORT_ID": "10397", "ORIGIN_AIRPORT_SEQ_ID": "1039707", "ORIGIN_CITY_MARKET_ID": "30397",
    "ORIGIN": "ATL", "ORIGIN_CITY_NAME": "Atlanta, GA", "ORIGIN_STATE_ABR": "GA",
    "ORIGIN_STATE_NM": "Georgia", "ORIGIN_WAC": "34",
    "DEST_AIRPORT_ID": "12892", "DEST_AIRPORT_SEQ_ID": "1289208", "DEST_CITY_MARKET_ID": "32575",
    "DEST": "LAX", "DEST_CITY_NAME": "Los Angeles, CA", "DEST_STATE_ABR": "CA",
    "DEST_STATE_NM": "California", "DEST_WAC": "91",
    "CRS_DEP_TIME": "530", "DEP_TIME": "535.0", "DEP_DELAY": "5.0", "DEP_DELAY_NEW": "5.0",
    "DEP_DEL15": "0.0", "DEP_TIME_BLK": "0001-0559", "TAXI_OUT": "12.0", "WHEELS_OFF": "547.0",
    "WHEELS_ON": "740.0", "TAXI_IN": "6.0", "CRS_ARR_TIME": "750", "ARR_TIME": "746.0",
    "ARR_DELAY": "-4.0", "ARR_DELAY_NEW": "0.0", "ARR_DEL15": "0.0", "ARR_TIME_BLK": "0700-0759",
    "CANCELLED": "0.0", "CANCELLATION_CODE": None, "DIVERTED": "0.0", "CRS_ELAPSED_TIME": "320.0",
    "ACTUAL_ELAPSED_TIME": "311.0", "AIR_TIME": "293.0", "DISTANCE": "1946.0",
    "CARRIER_DELAY": None, "WEATHER_DELAY": None, "NAS_DELAY": None, "SECURITY_DELAY": None,
    "LATE_AIRCRAFT_DELAY": None, "DIV_AIRPORT_LANDINGS": "0", "DIV_REACHED_DEST": None,
    "DIV_ACTUAL_ELAPSED_TIME": None, "DIV_ARR_DELAY": None, "DIV_DISTANCE": None,
    "DIV1_AIRPORT": None, "DIV1_AIRPORT_ID": None,
}


def raw_row(**over):
    from flightdeck.schemas import STAGING_NAMES
    row = dict(DEFAULT_RAW)
    row.update(over)
    return tuple(row[n] for n in STAGING_NAMES)


def month_rows(year=2025, months=range(1, 13), per_month=2, **over):
    """Valid rows, ``per_month`` flights on the 1st of each month."""
    import datetime
    rows = []
    for m in months:
        d = datetime.date(year, m, 1)
        for k in range(per_month):
            rows.append(raw_row(YEAR=str(year), MONTH=str(m), QUARTER=str((m - 1) // 3 + 1),
                                DAY_OF_MONTH="1", DAY_OF_WEEK=str(d.isoweekday()),
                                FL_DATE=f"{m}/1/{year} 12:00:00 AM",
                                OP_CARRIER_FL_NUM=str(100 + k), **over))
    return rows


@pytest.fixture
def raw_df(spark):
    from flightdeck.schemas import raw_schema

    def make(rows):
        return spark.createDataFrame(rows, raw_schema())
    return make
