"""Race transform: laps and telemetry of all races to one feature row per lap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.constants import SESSION_COLUMNS
from pitlane.functions.durations import seconds_to_interval
from pitlane.operators.laps import join_features, with_fuel
from pitlane.operators.series import hand_down
from pitlane.operators.telemetry import lap_features


def race_features(laps: DataFrame, telemetry: DataFrame) -> DataFrame:
    """The processed lap table: fuel-corrected times joined with telemetry sums.

    Covers every race at once; `Year` and `Race` lead so that the result can be
    written partitioned by them.  `LapTime_s` repeats `LapTime` in seconds.
    """
    joined = join_features(with_fuel(laps), lap_features(telemetry))
    timed = joined.withColumn("LapTime", seconds_to_interval(F.col("LapTime_s")))
    # One row for each lap, as features are one row for each lap too.
    return hand_down(timed.select("Year", "Race", *SESSION_COLUMNS, "LapTime_s"), laps)
