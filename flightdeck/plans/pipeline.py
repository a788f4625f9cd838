"""End-to-end pipeline: raw files -> gates -> staging -> dimensions -> fact -> publish.

:func:`run_pipeline` loads a folder of monthly files and enforces every gate on the
way; the ``binding_*`` functions give the catalogue's queries their tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightdeck.operators import clean as CL
from flightdeck.operators import dims as D
from flightdeck.operators import fact as FT
from flightdeck.operators import gates as G
from flightdeck.operators import quality as Q
from flightdeck.operators.cube import LAYOUT, Star, flight_cube
from flightdeck.sinks.files import publish, read_published
from flightdeck.sinks.tables import namespaces, read_table, stored, stored_at, write_table
from flightdeck.sources.files import file_manifest, file_report, read_raw
from flightdeck.sources.testdata import raw_flights


@dataclass
class Warehouse:
    staging: DataFrame
    dates: DataFrame
    airlines: DataFrame
    airports: DataFrame

    @property
    def fact(self) -> DataFrame:
        return FT.fact_flights(self.staging, self.dates, self.airlines, self.airports)


def staging_from_raw(raw: DataFrame) -> DataFrame:
    return CL.clean(raw)


def build_warehouse(staging: DataFrame) -> Warehouse:
    """Dimensions derived from the staging rows (first load: keys 1..n)."""
    return Warehouse(staging=staging, dates=D.dim_date(D.date_spine(staging)),
                     airlines=D.dim_airline(staging), airports=D.dim_airport(staging))


def binding_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging rows of the test-table binding: a view, so that a query renders
    and converts the columns it reads and 62 columns are neither dealt nor written."""
    return staging_from_raw(raw_flights(spark, sf_dir))


def binding_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Staging plus the three dimensions, each stored once per session."""
    stg = binding_staging(spark, sf_dir)
    return Warehouse(
        staging=stg,
        dates=stored(spark, f"dim_date:{sf_dir}", lambda: D.dim_date(D.date_spine(stg)), "dim_date"),
        airlines=stored(spark, f"dim_airline:{sf_dir}", lambda: D.dim_airline(stg), "dim_airline"),
        airports=stored(spark, f"dim_airport:{sf_dir}", lambda: D.dim_airport(stg), "dim_airport"))


#: path of the stored calendar -> the fact built on it
_FACTS: dict[str, DataFrame] = {}


def binding_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight fact of the binding: a view over staging and the stored dimensions.

    The numbering's counts are taken once per session; a query that does not read
    ``FlightKey`` neither deals nor sorts the rows by it.
    """
    wh = binding_warehouse(spark, sf_dir)
    built_on = stored_at(spark, f"dim_date:{sf_dir}")
    if built_on not in _FACTS:
        _FACTS[built_on] = wh.fact
    return _FACTS[built_on]


def binding_star(spark: SparkSession, sf_dir: str) -> Star:
    """The report's cube over the binding's fact, stored by month, and its dimensions."""
    wh = binding_warehouse(spark, sf_dir)
    cube = stored(spark, f"cube:{sf_dir}", lambda: flight_cube(binding_fact(spark, sf_dir)), "cube", LAYOUT)
    return Star(cube, wh.dates, wh.airlines, wh.airports)


@dataclass(frozen=True)
class LoadConfig:
    """A load: where the raw monthly files are, the period they must cover, where
    the warehouse is kept, and the name of this run."""
    raw_dir: str
    period: Q.Period
    warehouse_dir: str
    run_id: str


@dataclass
class Load:
    warehouse: Warehouse
    fact: DataFrame
    #: every gate's rows, in the order they were enforced
    checks: DataFrame


def run_pipeline(spark: SparkSession, cfg: LoadConfig) -> Load:
    """Load one period; the first gate that fails raises and publishes nothing.

    Every table is written under a folder of this run, so a failed run leaves the
    published version as it was.  Staging is stored by (YEAR, MONTH).
    """
    where = {n: f"{p}/{cfg.run_id}" for n, p in namespaces(spark, cfg.warehouse_dir).items()}
    passed: list[DataFrame] = []

    def gate(checks: DataFrame) -> None:
        # a few rows each, kept so that the report does not run the gate again
        path = f"{cfg.warehouse_dir}/gates/{cfg.run_id}/{len(passed):02d}"
        checks.write.parquet(path)
        passed.append(spark.read.schema(checks.schema).parquet(path))
        Q.enforce(passed[-1])

    def kept(df: DataFrame, space: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{where[space]}/{name}"
        write_table(df, path, by)
        return read_table(spark, path, df.schema)

    # raw files: the expected months, whole files with the expected header (K1, K7)
    gate(Q.manifest_checks(file_manifest(spark, cfg.raw_dir, cfg.period.first_year, cfg.period.last_year)))
    files = kept(file_report(spark, cfg.raw_dir), "staging", "files")
    gate(G.file_gates(files))
    raw = read_raw(spark, cfg.raw_dir)
    staged_rows, fact_rows = Observation("staged"), Observation("loaded")
    with_source = kept(CL.clean(raw).observe(staged_rows, F.count(F.lit(1)).alias("rows")),
                       "staging", "flights", ("YEAR", "MONTH"))
    staging = with_source.drop("source_file")
    # every line of every file is a row (K7), conversion and coverage
    gate(G.file_rows(files, with_source.groupBy(F.col("source_file").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))))
    gate(CL.conversion_checks(CL.conversion_report(raw, staging)))
    Q.require_date_type(staging)
    month_checks, staging_months = G.staging_gates(staging, cfg.period)
    gate(month_checks)
    built = build_warehouse(staging)
    wh = Warehouse(staging=staging, dates=kept(built.dates, "dim", "date"),
                   airlines=kept(built.airlines, "dim", "airline"), airports=kept(built.airports, "dim", "airport"))
    # dimensions and lookups
    gate(Q.union_checks(Q.lookups(FT.missing_lookups(staging, wh.dates, wh.airlines, wh.airports)),
                        Q.calendar(wh.dates, cfg.period), Q.dim_unique(wh.airlines, wh.airports)))

    def load_gates(fact: DataFrame) -> None:
        # what the writes counted, before anything is read (K13); then the written fact,
        # once for all its gates (K13, K18-K21) and once dealt by the grain
        gate(G.observed_rows(spark, staged_rows.get["rows"], fact_rows.get["rows"]))
        gate(Q.grain_unique(fact))
        gate(G.fact_gates(fact, wh.dates, wh.airlines, wh.airports, staging_months, cfg.period))

    root = f"{cfg.warehouse_dir}/published"
    publish(wh.fact.observe(fact_rows, F.count(F.lit(1)).alias("rows")), root, cfg.run_id, gate=load_gates)
    return Load(wh, read_published(spark, root), Q.union_checks(*passed))
