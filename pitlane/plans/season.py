"""Season consolidation over all processed races."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.operators.shaping import grand_prix_events, union_by_name
from pitlane.sources.writers import write_season


def consolidate(parts: list[DataFrame], path: str) -> DataFrame:
    """Union processed tables by name, write them and return what is stored.

    `Year` and `Race` stay, and `Track` repeats the race for the models.
    """
    season = union_by_name(*parts).withColumn("Track", F.col("Race"))
    write_season(season, path)
    return season.sparkSession.read.parquet(path)


def season_summary(season: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Races, rows and race names per season; with `expected` also the missing races.

    Rows are counted per race first, so the list has one entry per event.
    """
    races = season.groupBy("Year", "Race").agg(F.count(F.lit(1)).alias("rows"))
    if expected is not None:
        races = expected.select("Year", "Race").join(races, ["Year", "Race"], "full")
    known = F.col("rows").isNotNull()

    def names(test):
        return F.array_join(F.array_sort(F.collect_list(F.when(test, F.col("Race")))), ", ")

    return races.groupBy("Year").agg(
        F.count("rows").alias("races"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        names(known).alias("processed"),
        names(~known).alias("missing"),
    )


def event_status(schedule: DataFrame, landed: DataFrame, pattern: str = "Grand Prix") -> DataFrame:
    """The schedule's grand prix events with what is stored of each: laps, drivers, last lap.

    `Next` marks the first event of its season, by date and round, of which nothing is stored.
    Events without a name are left out, those without a date are never next; stored races
    outside the schedule add nothing.
    """
    stored = landed.groupBy("Year", F.col("Race").alias("EventName")).agg(
        F.count(F.lit(1)).alias("Laps"),
        F.count_distinct("Driver").alias("Drivers"),
        F.max("LapNumber").alias("LastLap"),
    )
    events = grand_prix_events(schedule, "EventName").join(stored, ["Year", "EventName"], "left")
    missing = F.col("Laps").isNull()
    place = F.struct("EventDate", "RoundNumber", "EventName")
    # A season has tens of events, so its first missing one is a small aggregate.
    first = events.where(missing & F.col("EventDate").isNotNull()).groupBy("Year").agg(F.min(place).alias("_next"))
    return events.join(first, "Year", "left").select(
        "Year", "RoundNumber", "EventName", "EventDate",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("Laps", "Drivers", "LastLap")],
        F.coalesce(missing & (place == F.col("_next")), F.lit(False)).alias("Next"),
    )
