"""Catalogue: calendar, dimensions, dedup / latest version, surrogate keys and
upserts (C2, C3, F1-F3, J1-J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightdeck.operators import dims as D
from flightdeck.plans.pipeline import binding_staging
from flightdeck.plans.registry import query
from flightdeck.plans.sqltext import (
    AIRPORT_UNION_SQL, airline_current_cte, airport_current_cte, dim_airline_cte,
    dim_airport_cte, dim_date_cte, with_staging,
)
from flightdeck.schemas import DIM_AIRLINE_COLUMNS, DIM_AIRPORT_COLUMNS, DIM_DATE_COLUMNS
from flightdeck.sources.testdata import table

# The previous load of the calendar: the first half of the data's years.
PREVIOUS_LOAD_BEFORE = "1998-07-01"
_PREV_SQL = f"FL_DATE < DATE '{PREVIOUS_LOAD_BEFORE}'"


def _prev(staging):
    return staging.filter(F.col("FL_DATE") < F.to_date(F.lit(PREVIOUS_LOAD_BEFORE)))


# The previous load of the other dimensions knew every second business key, and
# every third of those under an older code, so a merge inserts, updates and keeps.
OLD_CODE = "old"


def _known_before(current, key, code):
    """Half of the business keys, some with a code that has changed since."""
    return (current.filter(F.col(key) % 2 == 0)
            .withColumn(code, F.when(F.col(key) % 3 == 0, F.lit(OLD_CODE)).otherwise(F.col(code))))


def _known_before_cte(name, current, columns, key, code):
    cols = ", ".join(f"CASE WHEN {key} % 3 = 0 THEN '{OLD_CODE}' ELSE {code} END AS {code}" if c == code else c
                     for c in columns)
    return f"{name} AS (SELECT {cols} FROM {current} WHERE {key} % 2 = 0)"


@query("date_spine", with_staging("SELECT Date FROM dd_spine", dim_date_cte()))
def q_date_spine(spark, sf):
    return D.date_spine(binding_staging(spark, sf))


@query("dim_date", with_staging("SELECT * FROM dd", dim_date_cte()))
def q_dim_date(spark, sf):
    return D.dim_date(D.date_spine(binding_staging(spark, sf)))


@query("airline_dedup", """
SELECT p_brand, p_type, p_name FROM (
  SELECT p_brand, p_type, p_name,
         ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_type, p_name) AS rn
  FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL AND p_name IS NOT NULL) x
WHERE rn = 1""")
def q_airline_dedup(spark, sf):
    part = table(spark, sf, "part").dropna(subset=["p_brand", "p_type", "p_name"])
    return D.first_per_key(part, ["p_brand"], [F.col("p_type"), F.col("p_name")],
                           ["p_type", "p_name"])


@query("airport_union", with_staging(AIRPORT_UNION_SQL.format(where="")))
def q_airport_union(spark, sf):
    return D.airport_union(binding_staging(spark, sf))


@query("dim_required_filter", with_staging(f"""
SELECT DISTINCT * FROM ({AIRPORT_UNION_SQL.format(where="")}) u
WHERE AirportID IS NOT NULL AND AirportCode IS NOT NULL AND CityName IS NOT NULL
  AND StateCode IS NOT NULL AND StateName IS NOT NULL"""))
def q_dim_required_filter(spark, sf):
    return (D.airport_union(binding_staging(spark, sf))
            .dropna(subset=list(D.AIRPORT_REQUIRED)).distinct())


@query("airport_latest", with_staging("SELECT * FROM apc", airport_current_cte()))
def q_airport_latest(spark, sf):
    return D.airport_current(binding_staging(spark, sf))


@query("surrogate_keys", with_staging(
    "SELECT AirlineKey, DOTAirlineID FROM da", airline_current_cte(), dim_airline_cte()))
def q_surrogate_keys(spark, sf):
    return D.dim_airline(binding_staging(spark, sf)).select("AirlineKey", "DOTAirlineID")


@query("dim_airline", with_staging("SELECT * FROM da", airline_current_cte(), dim_airline_cte()))
def q_dim_airline(spark, sf):
    return D.dim_airline(binding_staging(spark, sf))


@query("dim_airport", with_staging("SELECT * FROM dap", airport_current_cte(), dim_airport_cte()))
def q_dim_airport(spark, sf):
    return D.dim_airport(binding_staging(spark, sf))


# --- J3-J5: upserts against the dimensions of the previous load ---------------
def _merge_sql(target: str, source: str, keys: list[str], attrs: list[str], key_col: str | None,
               update: str | None) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    matched = f"t.{keys[0]} IS NOT NULL AND s.{keys[0]} IS NOT NULL"
    upd = f" AND ({update})" if update else ""
    action = (f"CASE WHEN {matched}{upd} THEN 'update' WHEN t.{keys[0]} IS NOT NULL THEN 'keep' "
              f"ELSE 'insert' END")
    key_sel = f"t.{key_col} AS _tk, " if key_col else ""
    cols = ", ".join(f"COALESCE(t.{k}, s.{k}) AS {k}" for k in keys)
    att = ", ".join(f"t.{a} AS _t_{a}, s.{a} AS _s_{a}" for a in attrs)
    m = f"SELECT {key_sel}{cols}, {att}, {action} AS _action FROM {target} t FULL OUTER JOIN {source} s ON {on}"
    out_attrs = ", ".join(f"CASE WHEN _action = 'keep' THEN _t_{a} ELSE _s_{a} END AS {a}" for a in attrs)
    if key_col:
        order = ", ".join(keys)
        key_expr = (f"CAST(CASE WHEN _action = 'insert' THEN (SELECT COALESCE(MAX({key_col}), 0) FROM {target}) "
                    f"+ ROW_NUMBER() OVER (PARTITION BY _action = 'insert' ORDER BY {order}) "
                    f"ELSE _tk END AS INTEGER) AS {key_col}, ")
    else:
        key_expr = ""
    return f"SELECT {key_expr}{', '.join(keys)}, {out_attrs}, _action FROM ({m}) m"


_DATE_ATTRS = [c for c in DIM_DATE_COLUMNS if c != "DateKey"]


@query("merge_dim_date", with_staging(
    _merge_sql("pd", "dd", ["DateKey"], _DATE_ATTRS, None, None),
    dim_date_cte(), dim_date_cte("pd", f"WHERE {_PREV_SQL}")))
def q_merge_dim_date(spark, sf):
    stg = binding_staging(spark, sf)
    target = D.dim_date(D.date_spine(_prev(stg)))
    source = D.dim_date(D.date_spine(stg))
    return D.upsert(target, source, ["DateKey"], _DATE_ATTRS)


_AIRLINE_ATTRS = ["UniqueCarrierCode", "CarrierCode"]


@query("merge_dim_airline", with_staging(
    _merge_sql("pda", "ac", ["DOTAirlineID"], _AIRLINE_ATTRS, "AirlineKey",
               " OR ".join(f"t.{a} IS DISTINCT FROM s.{a}" for a in _AIRLINE_ATTRS)),
    airline_current_cte(), _known_before_cte("pac", "ac", ["DOTAirlineID", *_AIRLINE_ATTRS], "DOTAirlineID", "CarrierCode"),
    dim_airline_cte("pda", "pac")))
def q_merge_dim_airline(spark, sf):
    stg = binding_staging(spark, sf)
    source = D.airline_current(stg)
    target = D.initial_keys(_known_before(source, "DOTAirlineID", "CarrierCode"), ["DOTAirlineID"], "AirlineKey")
    return D.upsert(target, source, ["DOTAirlineID"], _AIRLINE_ATTRS, "AirlineKey",
                    update_when=D.attrs_changed(_AIRLINE_ATTRS))


_AIRPORT_ATTRS = [c for c in DIM_AIRPORT_COLUMNS if c not in ("AirportKey", "AirportID")]


@query("merge_dim_airport", with_staging(
    _merge_sql("pdap", "apc", ["AirportID"], _AIRPORT_ATTRS, "AirportKey", None),
    airport_current_cte(), _known_before_cte("papc", "apc", ["AirportID", *_AIRPORT_ATTRS], "AirportID", "AirportCode"),
    dim_airport_cte("pdap", "papc")))
def q_merge_dim_airport(spark, sf):
    stg = binding_staging(spark, sf)
    source = D.airport_current(stg)
    target = D.initial_keys(_known_before(source, "AirportID", "AirportCode"), ["AirportID"], "AirportKey")
    return D.upsert(target, source, ["AirportID"], _AIRPORT_ATTRS, "AirportKey")


assert DIM_AIRLINE_COLUMNS[0] == "AirlineKey"
