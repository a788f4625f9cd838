"""Catalogue: KPI measures (L) and report visuals (M, C9, F4-F6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightdeck.operators import report as R
from flightdeck.plans.registry import query, round6
from flightdeck.plans.sqltext import (
    MEASURES, PARTS, measures_select, parts_select, with_flights,
)
from flightdeck.plans.pipeline import binding_star
from flightdeck.sources.testdata import airports

# Parameters of the registered visuals.
SLICER_CONTEXT = R.FilterContext(months=(6, 7), origin_states=("AMERICA", "EUROPE"),
                                 dest_states=("ASIA", "AMERICA"))
PRIOR_ON_TIME_RATE = 0.75
ROUTE_MIN_FLIGHTS = 50


def _fa(spark, sf):
    return binding_star(spark, sf), airports(spark, sf)


def _card_sql(measures, where=""):
    return with_flights(
        f"SELECT {measures_select(measures)} FROM (SELECT {parts_select()} FROM fl {where}) p")


# --- L1-L13: one KPI each -------------------------------------------------
KPI_QUERIES = {
    "kpi_total_flights": "total_flights",
    "kpi_on_time_flights": "on_time_flights",
    "kpi_on_time_rate": "on_time_rate",
    "kpi_cancelled": "cancelled_flights",
    "kpi_cancellation_rate": "cancellation_rate",
    "kpi_diverted": "diverted_flights",
    "kpi_diversion_rate": "diversion_rate",
    "kpi_dep_delayed15": "dep_delayed15_flights",
    "kpi_arr_delayed15": "arr_delayed15_flights",
    "kpi_dep_delay_rate": "dep_delay_rate",
    "kpi_arr_delay_rate": "arr_delay_rate",
    "kpi_avg_dep_delay": "avg_dep_delay",
    "kpi_avg_arr_delay": "avg_arr_delay",
}


def _kpi_builder(measure):
    def build(spark, sf):
        f, a = _fa(spark, sf)
        return round6(R.cards(f, a, R.NO_FILTER, [measure]))
    return build


for _name, _measure in KPI_QUERIES.items():
    query(_name, _card_sql([_measure]))(_kpi_builder(_measure))


@query("kpi_vs_benchmark", with_flights(f"""
SELECT ROUND(on_time_rate, 6) AS on_time_rate, CAST({PRIOR_ON_TIME_RATE} AS DOUBLE) AS prior_rate,
       ROUND((on_time_rate - {PRIOR_ON_TIME_RATE}) * 100, 6) AS delta_pp,
       CASE WHEN on_time_rate - {PRIOR_ON_TIME_RATE} > 0 THEN 'UP'
            WHEN on_time_rate - {PRIOR_ON_TIME_RATE} < 0 THEN 'DOWN'
            WHEN on_time_rate - {PRIOR_ON_TIME_RATE} = 0 THEN 'FLAT' END AS trend
FROM (SELECT {MEASURES['on_time_rate']} AS on_time_rate
      FROM (SELECT {parts_select(['on_time_flights', 'total_flights'])} FROM fl) p) q"""))
def kpi_vs_benchmark(spark, sf):
    f, a = _fa(spark, sf)
    cur = R.cards(f, a, R.NO_FILTER, ["on_time_rate"])
    return round6(R.benchmark_delta(cur, R.NO_FILTER, PRIOR_ON_TIME_RATE))


_CTX_WHERE = """
WHERE month(fl_date) IN (6, 7)
  AND origin_airport_id IN (SELECT airport_id FROM ap WHERE state_name IN ('AMERICA', 'EUROPE'))
  AND dest_airport_id IN (SELECT airport_id FROM ap WHERE state_name IN ('ASIA', 'AMERICA'))"""


@query("benchmark_trend", with_flights(f"""
SELECT context, ROUND(on_time_rate, 6) AS on_time_rate,
       CASE WHEN filtered THEN NULL ELSE ROUND((on_time_rate - {PRIOR_ON_TIME_RATE}) * 100, 6) END
         AS delta_pp,
       CASE WHEN filtered THEN NULL
            WHEN on_time_rate - {PRIOR_ON_TIME_RATE} > 0 THEN 'UP'
            WHEN on_time_rate - {PRIOR_ON_TIME_RATE} < 0 THEN 'DOWN'
            WHEN on_time_rate - {PRIOR_ON_TIME_RATE} = 0 THEN 'FLAT' END AS trend
FROM (
  SELECT 'all' AS context, FALSE AS filtered, {MEASURES['on_time_rate']} AS on_time_rate
  FROM (SELECT {parts_select(['on_time_flights', 'total_flights'])} FROM fl) p
  UNION ALL
  SELECT 'sliced' AS context, TRUE AS filtered, {MEASURES['on_time_rate']} AS on_time_rate
  FROM (SELECT {parts_select(['on_time_flights', 'total_flights'])} FROM fl {_CTX_WHERE}) p
) q"""))
def benchmark_trend(spark, sf):
    f, a = _fa(spark, sf)
    out = None
    for label, ctx in (("all", R.NO_FILTER), ("sliced", SLICER_CONTEXT)):
        cur = R.cards(f, a, ctx, ["on_time_rate"])
        one = R.benchmark_delta(cur, ctx, PRIOR_ON_TIME_RATE).select(
            F.lit(label).alias("context"), "on_time_rate", "delta_pp", "trend")
        out = one if out is None else out.unionByName(one)
    return round6(out)


# --- M0 / C9: cards -------------------------------------------------------
@query("overview_cards", _card_sql(R.OVERVIEW_MEASURES))
def overview_cards(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.cards(f, a, R.NO_FILTER, R.OVERVIEW_MEASURES))


@query("operations_cards", _card_sql(R.OPERATIONS_MEASURES))
def operations_cards(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.cards(f, a, R.NO_FILTER, R.OPERATIONS_MEASURES))


@query("slicer_filtered_kpis", _card_sql(R.OVERVIEW_MEASURES, _CTX_WHERE))
def slicer_filtered_kpis(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.cards(f, a, SLICER_CONTEXT, R.OVERVIEW_MEASURES))


# --- monthly visuals (M1, M12) ---------------------------------------------
def _monthly_sql(measures):
    return with_flights(f"""
SELECT year_month, strftime(make_date(CAST(year_month / 100 AS INTEGER), CAST(year_month % 100 AS INTEGER), 1), '%B') AS month_name,
       {measures_select(measures)}
FROM (SELECT CAST(year(fl_date) * 100 + month(fl_date) AS INTEGER) AS year_month, {parts_select()}
      FROM fl GROUP BY 1) p""")


MONTHLY = {
    "monthly_on_time": ["total_flights", "on_time_flights", "on_time_rate"],
    "monthly_diversion": ["diverted_flights", "diversion_rate"],
    "monthly_cancellation": ["cancelled_flights", "cancellation_rate"],
    "monthly_delay_trend": ["arr_delay_rate", "dep_delay_rate"],
}


def _monthly_builder(measures):
    def build(spark, sf):
        f, a = _fa(spark, sf)
        return round6(R.monthly(f, a, R.NO_FILTER, measures))
    return build


for _name, _ms in MONTHLY.items():
    query(_name, _monthly_sql(_ms))(_monthly_builder(_ms))


# --- airline visuals (M2, M4, M5, M13, M15) ---------------------------------
def _airline_sql(measures, outer="*", tail=""):
    return with_flights(f"""
SELECT {outer} FROM (
  SELECT airline, {measures_select(measures, rounded=False)}
  FROM (SELECT op_unique_carrier AS airline, {parts_select()} FROM fl GROUP BY 1) p
) q {tail}""")


def _rounded_outer(cols, doubles):
    return ", ".join(f"ROUND({c}, 6) AS {c}" if c in doubles else c for c in cols)


AIRLINE = {
    "airline_on_time": ["total_flights", "on_time_rate"],
    "airline_avg_arr_delay": ["avg_arr_delay"],
    "airline_scatter": ["on_time_rate", "cancellation_rate", "total_flights"],
    "airline_diverted": ["diverted_flights"],
}
_DBL = {"on_time_rate", "cancellation_rate", "avg_arr_delay", "diversion_rate",
        "dep_delay_rate", "arr_delay_rate", "avg_dep_delay", "volume_share",
        "max_on_time_rate", "min_on_time_rate"}


def _airline_builder(measures):
    def build(spark, sf):
        f, a = _fa(spark, sf)
        return round6(R.by_airline(f, a, R.NO_FILTER, measures))
    return build


for _name, _ms in AIRLINE.items():
    query(_name, _airline_sql(_ms, _rounded_outer(["airline", *_ms], _DBL)))(_airline_builder(_ms))


def _highlight_sql(m, hi_best=True):
    hi, lo = ("'BEST'", "'WORST'") if hi_best else ("'WORST'", "'BEST'")
    return (f"CASE WHEN {m} = MAX({m}) OVER () THEN {hi} "
            f"WHEN {m} = MIN({m}) OVER () THEN {lo} END AS {m}_highlight")


_HL = (f"{_highlight_sql('on_time_rate', True)}, {_highlight_sql('cancellation_rate', False)}, "
       f"{_highlight_sql('avg_arr_delay', False)}")
_MATRIX_COLS = ["airline", "total_flights", "on_time_rate", "cancellation_rate", "avg_arr_delay"]


def _with_highlights(df):
    for m in ("on_time_rate", "cancellation_rate", "avg_arr_delay"):
        df = R.highlight(df, m)
    return df


@query("airline_matrix", _airline_sql(R.MATRIX_MEASURES, f"""
{_rounded_outer(_MATRIX_COLS, _DBL)}, on_time_rate_highlight, cancellation_rate_highlight,
avg_arr_delay_highlight FROM (SELECT *, {_HL}""", ") h"))
def airline_matrix(spark, sf):
    f, a = _fa(spark, sf)
    return round6(_with_highlights(R.by_airline(f, a, R.NO_FILTER, R.MATRIX_MEASURES)))


@query("highlight_extremes", _airline_sql(R.MATRIX_MEASURES, f"""
{_rounded_outer(_MATRIX_COLS, _DBL)}, on_time_rate_highlight, cancellation_rate_highlight,
avg_arr_delay_highlight FROM (SELECT *, {_HL}""", """) h
WHERE on_time_rate_highlight IS NOT NULL OR cancellation_rate_highlight IS NOT NULL
   OR avg_arr_delay_highlight IS NOT NULL"""))
def highlight_extremes(spark, sf):
    """Only the rows that carry a best/worst flag in the airline matrix."""
    f, a = _fa(spark, sf)
    df = _with_highlights(R.by_airline(f, a, R.NO_FILTER, R.MATRIX_MEASURES))
    return round6(df.filter(F.col("on_time_rate_highlight").isNotNull()
                            | F.col("cancellation_rate_highlight").isNotNull()
                            | F.col("avg_arr_delay_highlight").isNotNull()))


@query("volume_share", _airline_sql(["total_flights"], """
airline, total_flights, ROUND(CAST(total_flights AS DOUBLE) / MAX(total_flights) OVER (), 6)
  AS volume_share"""))
def volume_share(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.share_of_max(R.by_airline(f, a, R.NO_FILTER, ["total_flights"])))


@query("kpi_extremes", _airline_sql(["on_time_rate"], """
airline, ROUND(on_time_rate, 6) AS on_time_rate,
ROUND(MAX(on_time_rate) OVER (), 6) AS max_on_time_rate,
ROUND(MIN(on_time_rate) OVER (), 6) AS min_on_time_rate"""))
def kpi_extremes(spark, sf):
    f, a = _fa(spark, sf)
    df = R.by_airline(f, a, R.NO_FILTER, ["on_time_rate"])
    return round6(df.select("airline", "on_time_rate",
                            R.extreme(df, "on_time_rate", F.max).alias("max_on_time_rate"),
                            R.extreme(df, "on_time_rate", F.min).alias("min_on_time_rate")))


# --- origin airport visuals (M3, M7, M11) -----------------------------------
_ORIGIN_BASE = f"""
om AS (
  SELECT origin_code,
         {measures_select(['total_flights', 'on_time_rate', 'cancellation_rate', 'avg_arr_delay'], rounded=False)}
  FROM (SELECT ap.airport_code AS origin_code, {parts_select()}
        FROM fl LEFT JOIN ap ON ap.airport_id = fl.origin_airport_id GROUP BY 1) p
)"""


@query("top10_origin_volume", with_flights("""
SELECT origin_code, total_flights FROM om ORDER BY total_flights DESC, origin_code LIMIT 10""",
                                          _ORIGIN_BASE))
def top10_origin_volume(spark, sf):
    f, a = _fa(spark, sf)
    df = R.by_origin(f, a, R.NO_FILTER, ["total_flights"])
    return R.top_n(df, 10, [F.desc("total_flights"), F.asc("origin_code")])


@query("top10_origin_delay", with_flights("""
SELECT origin_code, ROUND(avg_arr_delay, 6) AS avg_arr_delay, total_flights FROM om
ORDER BY avg_arr_delay DESC NULLS LAST, total_flights DESC, origin_code LIMIT 10""", _ORIGIN_BASE))
def top10_origin_delay(spark, sf):
    f, a = _fa(spark, sf)
    df = R.by_origin(f, a, R.NO_FILTER, ["avg_arr_delay", "total_flights"])
    return round6(R.top_n(df, 10, [F.desc_nulls_last("avg_arr_delay"), F.desc("total_flights"),
                                   F.asc("origin_code")]))


_ORIGIN_MATRIX = ["origin_code", "total_flights", "on_time_rate", "cancellation_rate",
                  "avg_arr_delay"]


@query("top25_origin_matrix", with_flights(f"""
SELECT {_rounded_outer(_ORIGIN_MATRIX, _DBL)}, on_time_rate_highlight,
       cancellation_rate_highlight, avg_arr_delay_highlight
FROM (SELECT *, {_HL}
      FROM (SELECT * FROM om ORDER BY total_flights DESC, origin_code LIMIT 25) t) h""",
                                           _ORIGIN_BASE))
def top25_origin_matrix(spark, sf):
    f, a = _fa(spark, sf)
    df = R.by_origin(f, a, R.NO_FILTER, R.MATRIX_MEASURES)
    top = R.top_n(df, 25, [F.desc("total_flights"), F.asc("origin_code")])
    return round6(_with_highlights(top))


# --- routes (M8-M10, F5, F6) ----------------------------------------------
_ROUTE_BASE = f"""
rt AS (
  SELECT o.airport_code || ' → ' || d.airport_code AS route, o.airport_code AS origin_code,
         d.airport_code AS dest_code, {parts_select()}
  FROM fl LEFT JOIN ap o ON o.airport_id = fl.origin_airport_id
          LEFT JOIN ap d ON d.airport_id = fl.dest_airport_id
  GROUP BY 1, 2, 3
),
rm AS (
  SELECT route, origin_code, dest_code,
         {measures_select(['total_flights', 'on_time_rate', 'cancellation_rate', 'avg_arr_delay'], rounded=False)}
  FROM rt
)"""


@query("route_kpis", with_flights("""
SELECT route, origin_code, dest_code, total_flights, ROUND(on_time_rate, 6) AS on_time_rate,
       ROUND(cancellation_rate, 6) AS cancellation_rate, ROUND(avg_arr_delay, 6) AS avg_arr_delay
FROM rm""", _ROUTE_BASE))
def route_kpis(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.by_route(f, a, R.NO_FILTER, ["total_flights", "on_time_rate",
                                                 "cancellation_rate", "avg_arr_delay"]))


@query("busiest_routes_otr", with_flights("""
SELECT route, origin_code, dest_code, total_flights, ROUND(on_time_rate, 6) AS on_time_rate
FROM (SELECT * FROM rm ORDER BY total_flights DESC, route LIMIT 10) t""", _ROUTE_BASE))
def busiest_routes_otr(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.busiest_routes(f, a, R.NO_FILTER, 10))


@query("route_otr_min_volume", with_flights(f"""
SELECT route, origin_code, dest_code, total_flights, ROUND(on_time_rate, 6) AS on_time_rate,
       CAST(RANK() OVER (ORDER BY on_time_rate DESC) AS INTEGER) AS otr_rank
FROM rm WHERE total_flights >= {ROUTE_MIN_FLIGHTS}""", _ROUTE_BASE))
def route_otr_min_volume(spark, sf):
    f, a = _fa(spark, sf)
    return round6(R.routes_min_volume(f, a, R.NO_FILTER, ROUTE_MIN_FLIGHTS))


@query("topn_with_ties", with_flights("""
SELECT route, total_flights, ROUND(on_time_rate, 6) AS on_time_rate, rank
FROM (SELECT route, total_flights, on_time_rate,
             CAST(RANK() OVER (ORDER BY on_time_rate DESC) AS INTEGER) AS rank FROM rm) t
WHERE rank <= 10""", _ROUTE_BASE))
def topn_with_ties(spark, sf):
    f, a = _fa(spark, sf)
    routes = R.by_route(f, a, R.NO_FILTER, ["total_flights", "on_time_rate"])
    return round6(R.top_n_with_ties(routes, 10, [F.desc("on_time_rate")]).select(
        "route", "total_flights", "on_time_rate", "rank"))


@query("topn_exact", with_flights("""
SELECT route, total_flights, ROUND(on_time_rate, 6) AS on_time_rate
FROM rm ORDER BY on_time_rate DESC, total_flights DESC, route LIMIT 10""", _ROUTE_BASE))
def topn_exact(spark, sf):
    f, a = _fa(spark, sf)
    routes = R.by_route(f, a, R.NO_FILTER, ["total_flights", "on_time_rate"])
    return round6(R.top_n(routes, 10, [F.desc("on_time_rate"), F.desc("total_flights"),
                                       F.asc("route")]).select("route", "total_flights",
                                                               "on_time_rate"))
