"""Explicit schemas of the stored tables and clean-up at the door."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions.durations import nanos_to_seconds
from pitlane.functions.scalars import clean_inf

# The provider's columns and the served table. Durations arrive as nanosecond counts.
LAPS = """
    Time BIGINT, Driver STRING, DriverNumber STRING, LapTime BIGINT, LapNumber SMALLINT,
    Stint TINYINT, PitOutTime BIGINT, PitInTime BIGINT, Sector1Time BIGINT, Sector2Time BIGINT,
    Sector3Time BIGINT, Sector1SessionTime BIGINT, Sector2SessionTime BIGINT,
    Sector3SessionTime BIGINT, SpeedI1 DOUBLE, SpeedI2 DOUBLE, SpeedFL DOUBLE, SpeedST DOUBLE,
    IsPersonalBest BOOLEAN, Compound STRING, TyreLife TINYINT, FreshTyre BOOLEAN, Team STRING,
    LapStartTime BIGINT, LapStartDate TIMESTAMP_NTZ, TrackStatus STRING, Position TINYINT,
    Deleted BOOLEAN, DeletedReason STRING, FastF1Generated BOOLEAN, IsAccurate BOOLEAN
"""

TELEMETRY = """
    Time BIGINT, Speed DOUBLE, Distance DOUBLE, X DOUBLE, Y DOUBLE, DRS INT, DriverNumber STRING,
    LapNumber SMALLINT, SampleId BIGINT
"""

PARTITIONS = "Year INT, Race STRING, Session STRING"

# Types the lap columns are narrowed to on arrival.
LAP_TYPES = {
    "LapNumber": "smallint", "Stint": "tinyint", "TyreLife": "tinyint", "Position": "tinyint",
    "IsPersonalBest": "boolean", "Deleted": "boolean", "Driver": "string",
    "DriverNumber": "string", "Compound": "string", "Team": "string", "TrackStatus": "string",
    "DeletedReason": "string",
}

SCHEDULE = "Year INT, RoundNumber INT, EventName STRING, EventDate DATE"

SERVING = [
    ("year", "SMALLINT"), ("race", "STRING"), ("lapnumber", "SMALLINT"), ("driver", "STRING"),
    ("compound", "STRING"), ("tyrelife", "SMALLINT"), ("startfuel", "DOUBLE"), ("fcl", "DOUBLE"),
    ("laptime", "STRING"), ("speedi1", "DOUBLE"), ("speedi2", "DOUBLE"), ("speedfl", "DOUBLE"),
    ("sumlonacc", "DOUBLE"), ("sumlatacc", "DOUBLE"), ("meanlapspeed", "DOUBLE"),
]


def with_seconds(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add seconds for nanosecond columns, {column: name of the seconds}; clean non-finite values."""
    made = {name: nanos_to_seconds(F.col(c)) for c, name in columns.items()}
    return clean_inf(df.withColumns(made))
