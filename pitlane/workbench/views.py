"""Racing tables derived from the generic test tables, in Spark and as SQL text.

`laps` comes from orders and customer, `tel` (telemetry samples) from events.
A driver is a customer or user; year and race follow from its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.constants import TRACKS
from pitlane.operators.series import Series, hand_down

RACES = [name for name, _, _ in TRACKS]


# Columns of the test tables that laps and samples are made of; reading them needs no look into a file.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _season(number: str) -> list:
    """`Year` and `Race` of a driver number."""
    names = ", ".join(f"'{r}'" for r in RACES)
    return [
        F.expr(f"cast(2022 + {number} % 3 AS int)").alias("Year"),
        F.expr(f"element_at(array({names}), cast({number} % {len(RACES)} + 1 AS int))").alias("Race"),
    ]


def tel(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry samples; a lap is six days of one user's events."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    time = F.timestamp_diff("MICROSECOND", start, F.col("ts")) / F.lit(4e10)
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    user, event = F.col("user_id"), F.col("event_id")
    return table(spark, folder, "events").select(
        *_season("user_id"),
        user.cast("string").alias("DriverNumber"),
        (F.floor(day / F.lit(6)) + 1).cast("int").alias("LapNumber"),
        event.alias("SampleId"),
        time.alias("Time_s"),
        F.col("value").alias("Speed"),
        (event % 16).cast("int").alias("DRS"),
        ((event * 37) % 101).cast("double").alias("X"),
        ((event * 53) % 97).cast("double").alias("Y"),
        (time * F.lit(8.0)).alias("Distance"),
    )


def laps(spark: SparkSession, folder: str) -> DataFrame:
    """Laps; a driver's orders numbered in key order."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    driver = orders.withColumn("DriverNumber", F.col("o_custkey").cast("string"))
    numbered = Series(driver, ["DriverNumber"], ["o_orderkey"]).position("LapNumber").rows()
    # Each order has one customer, and a driver one number and one name.
    joined = numbered.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    key, lap = F.col("o_orderkey"), F.col("LapNumber").cast("int")
    made = joined.select(
        *_season("o_custkey"),
        "DriverNumber",
        F.concat(F.lit("C"), "DriverNumber").alias("Driver"),
        F.col("c_mktsegment").alias("Team"),
        F.col("o_orderpriority").alias("Compound"),
        lap.alias("LapNumber"),
        (1 + F.floor((lap - 1) / F.lit(5))).cast("int").alias("Stint"),
        (1 + (lap - 1) % 5).cast("int").alias("TyreLife"),
        F.when(key % 11 != 0, F.col("o_totalprice") / F.lit(5e3)).alias("LapTime_s"),
        (1 + key % 20).cast("int").alias("Position"),
        (F.col("o_orderstatus") == "O").alias("IsPersonalBest"),
        F.when(key % 7 != 0, (250 + key % 60).cast("double")).alias("SpeedI1"),
        (240 + key % 71).cast("double").alias("SpeedI2"),
        (260 + key % 53).cast("double").alias("SpeedFL"),
    )
    return hand_down(hand_down(made, numbered), numbered, names={"DriverNumber": "Driver"})


_RACE_LIST = "[" + ", ".join(f"'{r}'" for r in RACES) + "]"

TEL_SQL = f"""
tel AS (
  SELECT cast(2022 + user_id % 3 AS int) AS Year,
         {_RACE_LIST}[cast(user_id % {len(RACES)} + 1 AS int)] AS Race,
         cast(user_id AS varchar) AS DriverNumber,
         cast(date_diff('day', date '2024-01-01', cast(ts AS date)) // 6 + 1 AS int) AS LapNumber,
         event_id AS SampleId,
         date_diff('microsecond', timestamp '2024-01-01 00:00:00', ts) / 4e10 AS Time_s,
         value AS Speed,
         cast(event_id % 16 AS int) AS DRS,
         cast((event_id * 37) % 101 AS double) AS X,
         cast((event_id * 53) % 97 AS double) AS Y,
         (date_diff('microsecond', timestamp '2024-01-01 00:00:00', ts) / 4e10) * 8e0 AS Distance
  FROM events)"""

LAPS_SQL = f"""
laps AS (
  SELECT cast(2022 + o_custkey % 3 AS int) AS Year,
         {_RACE_LIST}[cast(o_custkey % {len(RACES)} + 1 AS int)] AS Race,
         cast(o_custkey AS varchar) AS DriverNumber,
         concat('C', cast(o_custkey AS varchar)) AS Driver,
         c_mktsegment AS Team, o_orderpriority AS Compound, LapNumber,
         cast(1 + floor((LapNumber - 1) / 5e0) AS int) AS Stint,
         cast(1 + (LapNumber - 1) % 5 AS int) AS TyreLife,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice / 5e3 END AS LapTime_s,
         cast(1 + o_orderkey % 20 AS int) AS Position,
         o_orderstatus = 'O' AS IsPersonalBest,
         CASE WHEN o_orderkey % 7 <> 0 THEN cast(250 + o_orderkey % 60 AS double) END AS SpeedI1,
         cast(240 + o_orderkey % 71 AS double) AS SpeedI2,
         cast(260 + o_orderkey % 53 AS double) AS SpeedFL
  FROM (SELECT *, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS int)
               AS LapNumber FROM orders) o
  JOIN customer ON c_custkey = o_custkey)"""

TRACKS_SQL = (
    "tracks(Race, LapLength_km, RaceLength_km) AS (VALUES "
    + ", ".join(f"('{r}', {a}::DOUBLE, {b}::DOUBLE)" for r, a, b in TRACKS)
    + ")"
)
