"""flightdeck: a Spark-native engine for flight on-time reliability analytics.

The package turns monthly on-time flight files into a typed staging table, a
star schema (date, airline and role-playing airport dimensions plus a
flight-level fact), runs fail-fast data-quality gates, and answers report
questions (KPI cards, monthly trends, airline / airport / route rankings with
top-N and best/worst highlighting) as DataFrame operators.

Layout
------
functions/   pure ``Column -> Column`` expressions (clock, dates, integers, rates)
sources/     readers: raw / processed / text CSV scans, lookups, file manifest,
             and the binding of the driver's test tables to the flight model
sinks/       writers: partitioned monthly export, snapshot, atomic publish
operators/   DataFrame operators: cleaning, dimensions, upsert, fact build,
             quality gates, measures, report visuals, profiling
plans/       end-to-end pipeline and the named query catalogue
streaming/   incremental month refresh over a file stream
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
