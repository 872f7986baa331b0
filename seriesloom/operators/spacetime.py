"""Effects of time and place on one value per (year, station)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.ordered import place_rows
from seriesloom.operators.profile import min_max_scaled
from seriesloom.staging import bucketed_tables, stage

MARKER_RADIUS = 1200  # fixed value
CHUNK = 1024
HELD_YEARS = 1_000_000
HELD_STATIONS = 500_000


def station_markers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per station: number of rows, mean value, its position between the extremes, and a marker radius."""
    stations = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
    stations = min_max_scaled(stage(stations, "stations"), "mean_value", "colour")
    return stations.withColumn("radius", F.floor(MARKER_RADIUS * F.sqrt(F.col("n").cast("double"))).cast("int"))


def missing_fraction(cells: DataFrame, of: str, over: str, value: str = "v") -> DataFrame:
    """For every ``of`` the share of the known ``over`` without a value.

    Counts the pairs that are there; the grid of all pairs is never built.
    """
    known = cells.select(over).distinct().agg(F.count(F.lit(1))).scalar()
    pairs = cells.select(of, over, value).groupBy(of, over).agg(F.count(value).alias("n"))
    there = pairs.groupBy(of).agg(F.sum((F.col("n") > 0).cast("long")).alias("there"))
    return there.select(of, (1 - F.col("there") / known).alias("missing"))


def rms_effects(cells: DataFrame, year: str = "year", station: str = "station", value: str = "v") -> DataFrame:
    """Root mean square before and after removing the mean of each year or of each station."""
    known = cells.where(F.col(value).isNotNull()).select(year, station, F.col(value).cast("double").alias("v"))
    total = known.agg(F.sqrt(F.avg(F.col("v") * F.col("v")))).scalar()

    def without(key: str):
        groups = known.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.var_pop("v").alias("var"))
        return groups.agg(F.sqrt(F.sum(F.col("n") * F.col("var")) / F.sum("n")).alias("rms")).scalar()

    one = cells.sparkSession.range(1).select(
        total.alias("total"), without(year).alias("minus_year"), without(station).alias("minus_station")
    )
    return one.select(
        "*",
        (F.col("total") - F.col("minus_year")).alias("year_reduction"),
        (F.col("total") - F.col("minus_station")).alias("station_reduction"),
    )


class TwoWayCentering:
    """Alternating removal of year means and station means.

    The cells are laid out once: one row per station and chunk of at most ``chunk`` cells, an array of (number of the year, value), in
    buckets of station and chunk.  They are never exchanged afterwards.  What changes are the accumulated
    effects.  Those of the stations are sent to the buckets of the cells, one row per chunk, or to all tasks if they are
    ``held_stations`` at most; those of at most ``held`` years are one array that every task gets, more are joined.
    A half-step is one partial aggregation of the values with both effects subtracted, and its
    centred variances give the error as well.  A station with many chunks spreads over many buckets.
    Cells without a value, a year or a station take no part; repeated cells count each.
    """

    def __init__(self, cells: DataFrame, year: str = "year", station: str = "station", value: str = "v", chunk: int = CHUNK, held: int = HELD_YEARS, held_stations: int = HELD_STATIONS):
        known = cells.where(F.col(value).isNotNull() & F.col(year).isNotNull() & F.col(station).isNotNull())
        self.known = known.select(F.col(year).alias("year"), F.col(station).alias("station"), F.col(value).cast("double").alias("v"))
        self.chunk, self.held, self.held_stations = chunk, held, held_stations
        self.spark = cells.sparkSession
        self.effects: dict[str, DataFrame] = {}
        self.errors: list[DataFrame] = []

    def _lay_out(self, lay_out) -> None:
        known = stage(self.known, "cells")
        years = stage(known.select("year").distinct(), "distinct-years")
        self.few_years = years.count() <= self.held
        numbered = years.withColumn("before", F.row_number().over(Window.orderBy("year")) - 1) if self.few_years else place_rows(years, ["year"])
        self.years = numbered.select("year", F.col("before").cast("int").alias("at"))
        copy = F.row_number().over(Window.partitionBy("station", "year").orderBy("v"))  # 1 unless cells are repeated
        numbered = known.withColumn("copy", copy).join(self.years, "year")
        chunk = F.struct(F.floor(F.col("at") / self.chunk).cast("int").alias("years"), "copy")
        placed = numbered.select("station", F.xxhash64(chunk).alias("chunk"), F.struct("at", "v").alias("cell"))
        placed = placed.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "station", "chunk")
        packed = placed.groupBy("station", "chunk").agg(F.collect_list("cell").alias("cells"))
        self.cells = lay_out(packed, ["station", "chunk"], "cells")

    def _remaining(self) -> DataFrame:
        """station, at, v without both effects, and the effects: of_station, of_year."""
        rows = self.cells.withColumn("of_station", F.lit(0.0))
        if "station" in self.effects:
            of_station = self.effects["station"].select("station", F.col("effect").alias("of_station"))
            if self.few_stations:
                rows = self.cells.join(F.broadcast(of_station), "station")
            else:
                rows = self.cells.join(self.cells.select("station", "chunk").join(of_station, "station"), ["station", "chunk"])
        cells = rows.select("station", "of_station", F.explode("cells").alias("cell")).select("station", "of_station", "cell.at", "cell.v")
        if "year" not in self.effects:
            cells = cells.withColumn("of_year", F.lit(0.0))
        elif self.few_years:
            in_order = F.array_sort(F.collect_list(F.struct("at", "effect")))
            by_number = self.effects["year"].agg(F.transform(in_order, lambda e: e["effect"]).alias("effects")).scalar()
            cells = cells.withColumn("of_year", F.get(by_number, F.col("at")))
        else:
            cells = cells.join(self.effects["year"].select("at", F.col("effect").alias("of_year")), "at")
        return cells.withColumn("v", F.col("v") - F.col("of_station") - F.col("of_year"))

    def _moments(self, side: str) -> DataFrame:
        """Per year or station the mean and variance of what remains, and the effect with that mean."""
        key, own = ("at", "of_year") if side == "year" else ("station", "of_station")
        groups = self._remaining().groupBy(key).agg(
            F.count(F.lit(1)).alias("n"), F.avg("v").alias("delta"), F.var_pop("v").alias("var"), F.max(own).alias("before")
        )
        return groups.select(key, "n", "var", "delta", (F.col("before") + F.col("delta")).alias("effect"))

    def _half_step(self, number: int, side: str) -> None:
        groups = stage(self._moments(side), f"{side}-effects")
        if not self.errors:  # nothing was removed yet
            whole = F.col("var") + F.col("delta") * F.col("delta")
            start = groups.agg(F.sqrt(F.sum(F.col("n") * whole) / F.sum("n")).alias("rms"))
            self.errors.append(start.select(F.lit(-1).alias("round"), F.lit("start").alias("step"), "rms"))
        if side == "station" and side not in self.effects:
            self.few_stations = groups.count() <= self.held_stations
        self.effects[side] = groups
        error = groups.agg(F.sqrt(F.sum(F.col("n") * F.col("var")) / F.sum("n")).alias("rms"))
        self.errors.append(error.select(F.lit(number).alias("round"), F.lit(side).alias("step"), "rms"))

    def run(self, rounds: int = 5) -> TwoWayCentering:
        self.effects, self.errors = {}, []
        with bucketed_tables(self.spark) as lay_out:
            self._lay_out(lay_out)
            for number in range(rounds):
                self._half_step(number, "year")
                self._half_step(number, "station")
        return self

    def trace(self) -> DataFrame:
        """Root mean square after every half-step: ``round, step, rms``."""
        result = self.errors[0]
        for error in self.errors[1:]:
            result = result.unionByName(error)
        return result

    def year_effect(self) -> DataFrame:
        """Sum of the year means over all rounds, and those of the last round."""
        return self.years.join(self.effects["year"], "at").select("year", "effect", F.col("delta").alias("last"))
