"""Lap-level operators: fuel model, fastest laps, stints, teams, finishing order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.constants import (
    DRIVER_KEY,
    EVENT_ALIASES,
    FUEL_END,
    FUEL_PENALTY_S,
    FUEL_START,
    LAP_KEY,
    TRACKS,
)
from pitlane.functions.durations import round_to_millis
from pitlane.functions.scalars import row_mean
from pitlane.operators.quantiles import percentiles
from pitlane.operators.series import Series, checked_broadcast
from pitlane.settings import materialize


def _lookup(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A fixed lookup table of a few rows, as a literal in the plan."""
    values = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}D" for v in row) + ")"
        for row in rows
    )
    return df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


# -- dimensions ------------------------------------------------------------


def with_track(laps: DataFrame) -> DataFrame:
    """Add lap and race length; a race missing from the track table is an error."""
    tracks = _lookup(laps, TRACKS, ["Race", "LapLength_km", "RaceLength_km"])
    joined = laps.join(F.broadcast(tracks), "Race", "left")
    missing = F.raise_error(F.concat(F.lit("unknown race: "), F.coalesce("Race", F.lit("NULL"))))
    return joined.withColumns(
        {
            c: F.when(F.col(c).isNull(), missing.cast("double")).otherwise(F.col(c))
            for c in ("LapLength_km", "RaceLength_km")
        }
    )


def with_provider_name(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the provider's name of an event: its alias, or the name itself."""
    aliases = _lookup(df, list(EVENT_ALIASES.items()), [column, "_alias"])
    joined = df.join(F.broadcast(aliases), column, "left")
    return joined.withColumn(name, F.coalesce("_alias", column)).drop("_alias")


# -- fuel ------------------------------------------------------------------


def fuel_per_lap(
    race_km: Column, lap_km: Column, start: float = FUEL_START, end: float = FUEL_END
) -> Column:
    """Fuel used per lap when the load goes from `start` to `end` over the race's whole laps."""
    laps = F.try_divide(race_km, lap_km).cast("int")
    return F.try_divide(F.lit(start - end), laps.cast("double"))


def start_fuel(lap: Column, per_lap: Column, start: float = FUEL_START) -> Column:
    """Fuel at the start of a lap, never below 0."""
    left = F.lit(start) - (lap - 1) * per_lap
    return F.when(lap == 1, F.lit(start)).otherwise(F.greatest(F.lit(0.0), left))


def average_fuel(lap: Column, per_lap: Column, start: float = FUEL_START) -> Column:
    """Mean of this and the previous lap's start fuel; the full load on lap 1."""
    pair = (start_fuel(lap, per_lap, start) + start_fuel(lap - 1, per_lap, start)) / 2
    return F.when(lap == 1, F.lit(start)).otherwise(pair)


def corrected_lap_time(
    seconds: Column,
    lap: Column,
    fuel: Column,
    per_lap: Column,
    start: float = FUEL_START,
    penalty: float = FUEL_PENALTY_S,
) -> Column:
    """Lap time without the cost of the fuel on board, in seconds.

    The previous lap's load is the current one plus one lap of fuel; the
    correction is cut to nanoseconds and the result to microseconds.
    """
    before = F.when(lap == 2, F.lit(start)).otherwise(fuel + per_lap)
    mean = F.when(lap == 1, F.lit(start)).otherwise((fuel + before) / 2)
    nanos = F.round(seconds * 1e9).cast("long") - (penalty * mean * 1e9).cast("long")
    return F.floor(nanos / F.lit(1000)) / F.lit(1e6)


def with_fuel(laps: DataFrame, start: float = FUEL_START) -> DataFrame:
    """Add `FuelPerLap`, `StartFuel` and `FCL`."""
    lap = F.col("LapNumber")
    known = with_track(laps).withColumn(
        "FuelPerLap", fuel_per_lap(F.col("RaceLength_km"), F.col("LapLength_km"), start)
    )
    filled = known.withColumn("StartFuel", start_fuel(lap, F.col("FuelPerLap"), start))
    return filled.withColumn(
        "FCL",
        corrected_lap_time(
            F.col("LapTime_s"), lap, F.col("StartFuel"), F.col("FuelPerLap"), start
        ),
    ).drop("LapLength_km", "RaceLength_km")


def average_fuel_by_join(laps: DataFrame, keys: list[str] = DRIVER_KEY) -> DataFrame:
    """Add `AvgFuel` from this lap's and the previous lap's row of the same driver.

    Without a row for the previous lap the average is NULL.
    """
    previous = laps.select(
        *keys,
        (F.col("LapNumber") + 1).cast(laps.schema["LapNumber"].dataType).alias("LapNumber"),
        F.col("StartFuel").alias("_before"),
    )
    return _with_average(laps.join(previous, [*keys, "LapNumber"], "left"))


def average_fuel_by_lag(laps: DataFrame, keys: list[str] = DRIVER_KEY) -> DataFrame:
    """Like `average_fuel_by_join`, reading the previous row instead of joining."""
    s = Series(laps, keys, ["LapNumber"], reach=1)
    dense = s.lag("LapNumber") == F.col("LapNumber") - 1
    s.with_columns({"_before": F.when(dense, s.lag("StartFuel"))})
    return _with_average(s.rows())


def _with_average(laps: DataFrame) -> DataFrame:
    mean = (F.col("StartFuel") + F.col("_before")) / 2
    first = F.col("LapNumber") == 1
    return laps.withColumn("AvgFuel", F.when(first, FUEL_START).otherwise(mean)).drop("_before")


def corrected_to_millis(laps: DataFrame, penalty: float = FUEL_PENALTY_S) -> DataFrame:
    """Add `FCL` from `AvgFuel`, rounded to milliseconds."""
    nanos = (penalty * F.col("AvgFuel") * 1e9).cast("long")
    seconds = F.col("LapTime_s") - nanos / F.lit(1e9)
    return laps.withColumn("FCL", round_to_millis(seconds))


# -- fastest and quick laps ------------------------------------------------


def fastest_lap(laps: DataFrame, keys: list[str], personal_best_only: bool = True) -> DataFrame:
    """The fastest timed lap of each group; ties go to the earlier lap.

    Spark limits the candidates to one per group and task before the shuffle.
    """
    timed = laps.where(F.col("LapTime_s").isNotNull())
    if personal_best_only:
        timed = timed.where("IsPersonalBest")
    fastest = Window.partitionBy(*keys).orderBy("LapTime_s", "LapNumber")
    ranked = timed.withColumn("_rank", F.row_number().over(fastest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def fastest_lap_time(laps: DataFrame, keys: list[str]) -> DataFrame:
    """Best lap time per group, fastest first."""
    known = laps.dropna(subset=keys)
    best = known.groupBy(*keys).agg(F.min("LapTime_s").alias("LapTime_s"))
    return best.orderBy(F.col("LapTime_s").asc_nulls_last(), *keys)


def quick_laps(
    laps: DataFrame, threshold: float = 1.07, scope: list[str] | None = None
) -> DataFrame:
    """Laps faster than `threshold` times the best lap of their scope (default: the race)."""
    keys = scope or ["Year", "Race"]
    best = laps.groupBy(*keys).agg(F.min("LapTime_s").alias("_best"))
    # Few scopes with many laps each must not gather in few tasks.
    joined = laps.join(checked_broadcast(materialize(best)), keys)
    return joined.where(F.col("LapTime_s") < threshold * F.col("_best")).drop("_best")


def top_finisher_laps(laps: DataFrame, places: int = 5) -> DataFrame:
    """All laps of the drivers in the first places on their race's final lap."""
    final = laps.groupBy("Year", "Race").agg(F.max("LapNumber").alias("LapNumber"))
    finishers = (
        laps.where(F.col("Position") <= places)
        .join(final, ["Year", "Race", "LapNumber"], "left_semi")
        .select(*DRIVER_KEY)
    )
    return laps.join(finishers, DRIVER_KEY, "left_semi")


def finishing_order(laps: DataFrame, keys: list[str]) -> DataFrame:
    """Last known position of each driver, best first."""
    known = laps.where(F.col("Position").isNotNull())
    last = known.groupBy(*keys).agg(F.max_by("Position", "LapNumber").alias("Position"))
    return last.orderBy("Position", *keys)


def max_lap(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max("LapNumber").alias("MaxLap"))


# -- teams and stints ------------------------------------------------------


def team_stats(laps: DataFrame) -> DataFrame:
    """Mean, median and best lap time per team, by mean."""
    known = laps.where(F.col("Team").isNotNull())
    simple = known.groupBy("Team").agg(
        F.avg("LapTime_s").alias("mean"), F.min("LapTime_s").alias("min")
    )
    middle = percentiles(known, ["Team"], {"LapTime_s": {"median": 0.5}})
    return simple.join(middle, "Team", "left").orderBy(F.col("mean").asc_nulls_last(), "Team")


STINT = ["Year", "Race", "Driver", "Stint", "Compound"]


def stint_length(laps: DataFrame) -> DataFrame:
    """Number of laps per stint."""
    known = laps.dropna(subset=["Driver", "Stint", "Compound"])
    return known.groupBy(*STINT).agg(F.count("LapNumber").alias("StintLength"))


def stint_offsets(stints: DataFrame) -> DataFrame:
    """Add `StintStart`: laps driven before the stint."""
    s = Series(stints, ["Year", "Race", "Driver"], ["Stint", "Compound"])
    s.running({"_upto": ("sum", F.col("StintLength"))})
    return s.rows().withColumn("StintStart", F.col("_upto") - F.col("StintLength")).drop("_upto")


SPEEDS = ["SpeedI1", "SpeedI2", "SpeedFL"]


def fill_forward(df: DataFrame, columns: list[str], keys: list[str], order: list[str]) -> DataFrame:
    """Replace missing values by the last known one before them in the group."""
    s = Series(df, keys, order)
    s.running({f"_f_{c}": ("last", F.col(c)) for c in columns})
    return s.rows().withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(
        *[f"_f_{c}" for c in columns]
    )


def with_average_speed(
    laps: DataFrame, keys: list[str] = DRIVER_KEY, order: list[str] | None = None
) -> DataFrame:
    """Add `SpeedAvg`: mean of the three speed traps after filling gaps forward."""
    filled = fill_forward(laps, SPEEDS, keys, order or ["LapNumber"])
    return filled.withColumn("SpeedAvg", row_mean(SPEEDS))


def stint_speed(laps: DataFrame) -> DataFrame:
    """Mean of `SpeedAvg` and number of known values per stint."""
    known = laps.dropna(subset=["Driver", "Stint", "Compound"])
    return known.groupBy(*STINT).agg(
        F.avg("SpeedAvg").alias("mean"), F.count("SpeedAvg").alias("count")
    )


def stint_summary(speeds: DataFrame) -> DataFrame:
    """Unweighted mean of stint means and total count per driver and compound."""
    return (
        speeds.groupBy("Year", "Race", "Driver", "Compound")
        .agg(F.avg("mean").alias("mean"), F.sum("count").alias("count"))
        .orderBy(F.col("mean").desc_nulls_last(), "Driver", "Compound")
    )


def renumber_laps(laps: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Replace `LapNumber` by a gapless count from 1 in the given order."""
    placed = Series(laps, keys, order).position("_at").rows()
    return placed.withColumn("LapNumber", F.col("_at").cast(T.IntegerType())).drop("_at")


# -- joins with features ---------------------------------------------------


def join_features(laps: DataFrame, features: DataFrame, keys: list[str] = LAP_KEY) -> DataFrame:
    """All laps with their features; laps without telemetry keep NULLs.

    Both sides' lap numbers are compared as integers whatever their stored type.
    """
    types = {f.name: f.dataType for f in laps.schema if f.name in keys}
    cast = features.withColumns({k: F.col(k).cast(t) for k, t in types.items()})
    return laps.join(cast, keys, "left")
