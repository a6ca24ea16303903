"""Driving style: how far each race lap is from the driver's best lap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.constants import DRIVER_KEY, LAP_KEY, SAMPLE_ORDER, SESSION_COLUMNS
from pitlane.functions.durations import seconds_to_interval
from pitlane.operators.laps import join_features, with_fuel
from pitlane.operators.motion import accelerations
from pitlane.operators.series import hand_down, hot_groups, measured, most_rows
from pitlane.operators.similarity import (
    STYLE,
    distances_to_best,
    ordered_arrays,
    reference_signal,
    style_distances,
)
from pitlane.operators.telemetry import is_regular, lap_features, lap_sums
from pitlane.settings import WARP_BLOCK, WARP_BLOCK_DEFAULT, setting


def landed(laps: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Laps whose telemetry arrived."""
    return hand_down(laps.join(telemetry.select(*LAP_KEY), LAP_KEY, "left_semi"), laps)


def style(
    race_laps: DataFrame, race_tel: DataFrame, quali_laps: DataFrame, quali_tel: DataFrame
) -> DataFrame:
    for samples in (race_tel, quali_tel):
        measured(samples, LAP_KEY)
    references = reference_signal(
        landed(quali_laps, quali_tel), quali_tel, landed(race_laps, race_tel), race_tel
    )
    return style_distances(accelerations(race_tel), references)


def with_style(laps: DataFrame, distances: DataFrame) -> DataFrame:
    """All laps with their distances; laps without one keep NULL."""
    return hand_down(laps.join(distances, LAP_KEY, "left"), laps)


def styled_features(laps: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Features of the laps whose telemetry arrived, with distances to the driver's best of them.

    These are the rows of `race_features` and of `style` of the race against itself.  Laps and
    samples are gone over once; only drivers with a lap too long for one array go through `style`.
    """
    size = setting(laps.sparkSession, WARP_BLOCK, WARP_BLOCK_DEFAULT)
    long = hot_groups(measured(telemetry, LAP_KEY), LAP_KEY, size)
    if long is None:
        made = _at_once(laps, telemetry, size)
    else:
        drivers = long.select(*DRIVER_KEY).distinct()

        def of(how: str) -> list[DataFrame]:
            return [hand_down(df.join(drivers, DRIVER_KEY, how), df) for df in (laps, telemetry)]

        made = _at_once(*of("left_anti"), size).unionByName(_apart(*of("left_semi")), allowMissingColumns=True)
    timed = made.withColumn("LapTime", seconds_to_interval(F.col("LapTime_s")))
    # One row for each lap, and a driver is in one part only.
    return hand_down(timed.select(*DRIVER_KEY, *SESSION_COLUMNS, *STYLE.values()), laps)


def _at_once(laps: DataFrame, telemetry: DataFrame, size: int) -> DataFrame:
    """Features, arrays and distances from one pass; no lap has more than `size` samples."""
    longest, rows = min(size, most_rows(telemetry, LAP_KEY)), most_rows(telemetry, [])
    rows = telemetry.count() if rows is None else rows
    # Samples without a whole key belong to no lap, however many they are.
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in LAP_KEY])
    acc = accelerations(hand_down(telemetry.where(keyed), telemetry))
    sums = [F.when(is_regular(), c).alias(n) for n, c in lap_sums().items()]
    driven = ordered_arrays(acc, LAP_KEY, SAMPLE_ORDER, list(STYLE), sums)
    # Laps of drivers without telemetry go first, so that only the others move to their samples.
    numbers = telemetry.select("DriverNumber").distinct()
    own = laps.join(numbers, "DriverNumber", "left_semi")
    joined = join_features(with_fuel(own), driven).where(" AND ".join(f"{c} IS NOT NULL" for c in STYLE))
    return distances_to_best(hand_down(joined, laps), rows * longest)


def _apart(laps: DataFrame, telemetry: DataFrame) -> DataFrame:
    """The same from `style`, for laps of any length."""
    own = landed(laps, telemetry)
    joined = hand_down(join_features(with_fuel(own), lap_features(telemetry)), own)
    return with_style(joined, style(own, telemetry, own, telemetry))
