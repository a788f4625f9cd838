"""The report's cube: additive parts at (date, airline, origin, destination).

Aggregated once from the fact, stored by (Year, Month), and added up again by every
visual.  Slicers are filters on the dimensions.  A month slicer restricts ``dim_date``,
which is joined on the layout columns too, so Spark prunes the cube's partitions at run
time with the months that remain (dynamic partition pruning); airline and state
slicers restrict their dimensions, whose keys reach the cube through the broadcast
join, or through a Bloom filter where a dimension is too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightdeck.operators import measures as M
from flightdeck.schemas import FACT_KEYS

#: Columns the stored cube is laid out by.
LAYOUT = ("Year", "Month")


def flight_cube(fact: DataFrame) -> DataFrame:
    """The additive parts of every measure at the fact's four keys, with their month."""
    exprs = M.parts(M.FACT_COLS)
    cells = fact.groupBy(*FACT_KEYS).agg(*[e.alias(p) for p, e in exprs.items()])
    return cells.select("*", F.floor(F.col("DateKey") / 10000).cast("short").alias("Year"),
                        (F.floor(F.col("DateKey") / 100) % 100).cast("short").alias("Month"))


@dataclass(frozen=True)
class Star:
    """The cube and its dimensions, as the report reads them."""
    cube: DataFrame
    dates: DataFrame
    airlines: DataFrame
    airports: DataFrame

    def flights(self, roles: Iterable[str]) -> DataFrame:
        """Cube rows with the business columns of the dimensions in ``roles``.

        date: fl_date; airline: op_unique_carrier; origin and dest: the airports' ids.
        A dimension that no slicer and no grouping asks for is not joined: every key
        has its row there (gate 50036).
        """
        out = self.cube
        if "date" in roles:
            # at most 366 rows a year
            days = F.broadcast(self.dates.select("DateKey", *LAYOUT, F.col("Date").alias("fl_date")))
            out = out.join(days, ["DateKey", *LAYOUT])
        if "airline" in roles:
            out = out.join(self.airlines.select("AirlineKey", F.col("UniqueCarrierCode").alias("op_unique_carrier")),
                           "AirlineKey")
        for role, key, name in (("origin", "OriginAirportKey", "origin_airport_id"),
                                ("dest", "DestinationAirportKey", "dest_airport_id")):
            if role in roles:
                out = out.join(self.airports.select(F.col("AirportKey").alias(key), F.col("AirportID").alias(name)), key)
        return out
