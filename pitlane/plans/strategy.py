"""Race-strategy report: pace, finishing place, stints and speeds of each driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.operators import laps as lap_ops

ENTRY = ["Year", "Race", "Driver"]


def strategy_report(laps: DataFrame) -> DataFrame:
    """One row per stint with its place in the race and the driver's pace and position."""
    pace = laps.groupBy(*ENTRY).agg(
        F.min("LapTime_s").alias("FastestLap"),
        F.max_by("Position", F.when(F.col("Position").isNotNull(), F.col("LapNumber"))).alias(
            "Finish"
        ),
    )
    stints = lap_ops.stint_offsets(lap_ops.stint_length(laps))
    speeds = lap_ops.stint_speed(lap_ops.with_average_speed(laps))
    speeds = speeds.select(*lap_ops.STINT, F.col("mean").alias("StintSpeed"))
    return stints.join(speeds, lap_ops.STINT, "left").join(pace, ENTRY, "left")
