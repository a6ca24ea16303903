"""Queries that write to a fresh folder and read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane import schemas
from pitlane.constants import LAP_KEY
from pitlane.functions import durations
from pitlane.operators import shaping
from pitlane.plans import race, season
from pitlane.settings import scratch_path
from pitlane.sources import readers, writers
from pitlane.workbench.book import query, sql
from pitlane.workbench.lap_queries import LAP_DOUBLES
from pitlane.workbench.telemetry_queries import (
    KEY,
    LAP_FEATURES,
    LAP_FUEL,
    LAP_TIME_US,
    STEPS,
    lap_time_micros,
)
from pitlane.workbench.views import _RACE_LIST, RACES, _season, laps, table, tel

CHAIN = [*STEPS, LAP_FEATURES, *LAP_FUEL]
PROCESSED = (
    "processed AS (SELECT l.Year, l.Race, l.LapNumber, Driver, Compound, TyreLife, StartFuel, FCL, "
    f"{LAP_TIME_US}, LapTime_s, SpeedI1, SpeedI2, SpeedFL, SumLonAcc, SumLatAcc, MeanLapSpeed FROM fcl l "
    "LEFT JOIN features f ON l.Year = f.Year AND l.Race = f.Race AND l.DriverNumber = f.DriverNumber "
    "AND l.LapNumber = f.LapNumber)"
)
PROCESSED_DOUBLES = (
    "StartFuel FCL LapTime_s SpeedI1 SpeedI2 SpeedFL SumLonAcc SumLatAcc MeanLapSpeed"
)
ALL = "laps tel tracks"


def processed(spark, folder):
    return race.race_features(laps(spark, folder), tel(spark, folder))


def stored(spark, folder):
    """Path of a freshly written processed table."""
    path = scratch_path(spark, "processed")
    writers.write_processed(processed(spark, folder), path)
    return path


@query("write_processed")
def write_processed(spark, folder):
    """Written twice: the rerun must replace the races, not add to them."""
    path = stored(spark, folder)
    again = processed(spark, folder).where(F.col("Year") == 2023)
    writers.write_processed(again, path)
    return lap_time_micros(spark.read.parquet(path))


sql("write_processed", ALL, "SELECT * FROM processed", PROCESSED_DOUBLES, [*CHAIN, PROCESSED])


@query("bucketed_features")
def bucketed_features(spark, folder):
    """The race job over samples stored in buckets by lap."""
    table = f"samples_{uuid.uuid4().hex}"
    writers.write_bucketed(tel(spark, folder), table, scratch_path(spark, "samples"))
    return lap_time_micros(race.race_features(laps(spark, folder), spark.table(table)))


sql("bucketed_features", ALL, "SELECT * FROM processed", PROCESSED_DOUBLES, [*CHAIN, PROCESSED])


@query("scan_processed")
def scan_processed(spark, folder):
    path = stored(spark, folder)
    made = readers.read_processed(spark, path, Year=2023, Race="Monaco Grand Prix")
    return lap_time_micros(made)


sql(
    "scan_processed", ALL,
    "SELECT * FROM processed WHERE Year = 2023 AND Race = 'Monaco Grand Prix'",
    PROCESSED_DOUBLES, [*CHAIN, PROCESSED],
)


@query("race_list")
def race_list(spark, folder):
    return readers.race_list(spark, stored(spark, folder))


sql("race_list", "laps", "SELECT DISTINCT Race FROM laps")


@query("season_scan")
def season_scan(spark, folder):
    path = stored(spark, folder)
    schema = "LapNumber INT, Driver STRING, Compound STRING, LapTime_s DOUBLE, MeanLapSpeed DOUBLE"
    return readers.scan_season(spark, path, 2023, schema)


sql(
    "season_scan", ALL,
    "SELECT Year, Race, LapNumber, Driver, Compound, LapTime_s, MeanLapSpeed FROM processed "
    "WHERE Year = 2023",
    "LapTime_s MeanLapSpeed", [*CHAIN, PROCESSED],
)


@query("season_consolidate")
def season_consolidate(spark, folder):
    """Seasons stored apart, one of them without the telemetry sums, become one table."""
    made = processed(spark, folder)
    early = made.where(F.col("Year") == 2022).drop("SumLonAcc", "SumLatAcc")
    late = made.where(F.col("Year") > 2022)
    return lap_time_micros(season.consolidate([late, early], scratch_path(spark, "season")))


sql(
    "season_consolidate", ALL,
    "SELECT * REPLACE (CASE WHEN Year > 2022 THEN SumLonAcc END AS SumLonAcc, "
    "CASE WHEN Year > 2022 THEN SumLatAcc END AS SumLatAcc), Race AS Track FROM processed",
    PROCESSED_DOUBLES, [*CHAIN, PROCESSED],
)


@query("scan_season")
def scan_season(spark, folder):
    path = scratch_path(spark, "season")
    season.consolidate([processed(spark, folder)], path)
    return lap_time_micros(spark.read.parquet(path))


sql(
    "scan_season", ALL, "SELECT *, Race AS Track FROM processed", PROCESSED_DOUBLES,
    [*CHAIN, PROCESSED],
)


@query("season_summary")
def season_summary(spark, folder):
    own = laps(spark, folder)
    late = own.where((F.col("Year") > 2022) | (F.col("Race") != "Monaco Grand Prix"))
    return season.season_summary(late, own.select("Year", "Race").distinct())


sql(
    "season_summary", "laps",
    """SELECT Year, count(*) FILTER (known) AS races, cast(sum(n) FILTER (known) AS bigint) AS total_rows,
              coalesce(string_agg(Race, ', ' ORDER BY Race) FILTER (known), '') AS processed,
              coalesce(string_agg(Race, ', ' ORDER BY Race) FILTER (NOT known), '') AS missing
       FROM (SELECT Year, Race, count(*) AS n, Year > 2022 OR Race <> 'Monaco Grand Prix' AS known
             FROM laps GROUP BY Year, Race) GROUP BY Year""",
)


@query("event_schedule")
def event_schedule(spark, folder):
    """A stored schedule read for one season, next to the laps stored of its events.

    Rounds follow the first day of each race, a test before the season is round 0; laps of
    the season's later half are not there yet.
    """
    days = table(spark, folder, "orders").select(*_season("o_custkey"), F.col("o_orderdate").cast("date").alias("Day"))
    races = days.groupBy("Year", F.col("Race").alias("EventName")).agg(F.min("Day").alias("EventDate"))
    # Few events, one per race and season.
    rounds = races.select("*", F.row_number().over(Window.partitionBy("Year").orderBy("EventDate", "EventName")).alias("RoundNumber"))
    tests = races.groupBy("Year").agg((F.min("EventDate") - F.expr("INTERVAL 7 DAYS")).cast("date").alias("EventDate")).select(
        "*", F.lit("Pre-Season Testing").alias("EventName"), F.lit(0).alias("RoundNumber")
    )
    path = scratch_path(spark, "schedule")
    rounds.unionByName(tests).select("Year", "RoundNumber", "EventName", "EventDate").write.partitionBy("Year").parquet(path)
    late = rounds.where("RoundNumber % 3 = 0").select("Year", F.col("EventName").alias("Race"))
    landed = laps(spark, folder).join(late, ["Year", "Race"], "left_anti")
    made = season.event_status(readers.read_schedule(spark, path, 2023), landed)
    return made.withColumn("EventDate", F.col("EventDate").cast("string"))


sql(
    "event_schedule", "laps",
    f"""SELECT Year, RoundNumber, EventName, EventDate::VARCHAR AS EventDate, coalesce(Laps, 0) AS Laps,
              coalesce(Drivers, 0) AS Drivers, coalesce(LastLap, 0) AS LastLap,
              Laps IS NULL AND row_number() OVER (PARTITION BY Year, Laps IS NULL ORDER BY EventDate, RoundNumber) = 1 AS Next
       FROM (SELECT *, cast(row_number() OVER (PARTITION BY Year ORDER BY EventDate, EventName) AS int) AS RoundNumber
             FROM (SELECT cast(2022 + o_custkey % 3 AS int) AS Year,
                          {_RACE_LIST}[cast(o_custkey % {len(RACES)} + 1 AS int)] AS EventName,
                          min(o_orderdate)::DATE AS EventDate FROM orders GROUP BY ALL)) e
       LEFT JOIN (SELECT Year AS y, Race, count(*) AS Laps, count(DISTINCT Driver) AS Drivers, max(LapNumber) AS LastLap
                  FROM laps GROUP BY ALL) s ON y = Year AND Race = EventName AND RoundNumber % 3 <> 0
       WHERE Year = 2023 AND contains(EventName, 'Grand Prix')""",
)


@query("write_if_absent")
def write_if_absent(spark, folder):
    """The second delivery holds all seasons, but stored ones keep their first content."""
    path = scratch_path(spark, "raw")
    own = laps(spark, folder).select(*LAP_KEY, "LapTime_s").withColumn("Session", F.lit("R"))
    writers.write_if_absent(own.where(F.col("Year") == 2022).withColumn("Batch", F.lit(1)), path)
    writers.write_if_absent(own.withColumn("Batch", F.lit(2)), path)
    return spark.read.parquet(path)


sql(
    "write_if_absent", "laps",
    f"SELECT {KEY}, LapTime_s, 'R' AS Session, CASE WHEN Year = 2022 THEN 1 ELSE 2 END AS Batch FROM laps",
    "LapTime_s",
)


@query("landing_telemetry")
def landing_telemetry(spark, folder):
    """Samples delivered as JSON; those of unknown laps are skipped."""
    path = scratch_path(spark, "delivered")
    nanos = (F.col("Time_s") * 1e9).cast("long")
    tel(spark, folder).withColumn("Time", nanos).write.json(path)
    schema = f"{schemas.TELEMETRY}, Year INT, Race STRING"
    samples = readers.read_delivered(spark, path, "json", schema)
    used = readers.usable_telemetry(samples, laps(spark, folder), LAP_KEY)
    return schemas.with_seconds(used, {"Time": "Time_s"}).select(
        *[F.col(k).cast("int") if k == "LapNumber" else F.col(k) for k in LAP_KEY],
        "SampleId", "Time_s", "Speed",
    )


sql(
    "landing_telemetry", "laps tel",
    f"""SELECT {KEY}, SampleId, floor(cast(trunc(Time_s * 1e9) AS bigint) / 1000) / 1e6 AS Time_s, Speed
        FROM tel SEMI JOIN laps USING ({KEY})""",
    "Time_s Speed",
)



@query("landing_session")
def landing_session(spark, folder):
    """Laps and samples of both sessions, landed with narrow types and read back by schema.

    Laps with an even number stand for qualifying. Laps without samples are counted as skipped.
    """
    lap_path, sample_path = scratch_path(spark, "landed"), scratch_path(spark, "landed")
    own, samples = laps(spark, folder), tel(spark, folder)
    types = {c: kind for c, kind in schemas.LAP_TYPES.items() if c in own.columns}
    narrow = shaping.cast_columns(own, types).withColumn("LapTime", (F.col("LapTime_s") * 1e9).cast("long"))
    timed = shaping.cast_columns(samples, {"LapNumber": "smallint"}).withColumn(
        "Time", (F.col("Time_s") * 1e9).cast("long")
    )
    used = readers.usable_telemetry(timed, narrow, LAP_KEY)
    for session, rest in (("R", 1), ("Q", 0)):
        part = F.col("LapNumber") % 2 == rest
        writers.write_if_absent(shaping.tag(narrow.where(part).drop("LapTime_s"), Session=session), lap_path)
        writers.write_if_absent(shaping.tag(used.where(part).drop("Time_s"), Session=session), sample_path)
    raw = readers.read_session(spark, lap_path, sample_path)
    counts = []
    for kind, session in (("race", "R"), ("quali", "Q")):
        own, samples = raw[f"{kind}_laps"], raw[f"{kind}_telemetry"]
        skipped = readers.laps_without_telemetry(own, samples, LAP_KEY)
        for name, rows, value in (
            ("Laps", own, F.col("LapTime_s")), ("Samples", samples, F.col("Time_s")), ("Skipped", skipped, F.lit(0.0)),
        ):
            made = rows.groupBy("Year", "Race").agg(F.count(F.lit(1)).alias("Rows"), F.sum(value).alias("Seconds"))
            counts.append(shaping.tag(made, Session=session, Kind=name))
    return reduce(DataFrame.unionByName, counts)


sql(
    "landing_session", "laps tel",
    f"""SELECT Year, Race, CASE LapNumber % 2 WHEN 0 THEN 'Q' ELSE 'R' END AS Session, Kind,
               count(*) AS Rows, sum(s) AS Seconds
        FROM (SELECT Year, Race, LapNumber, 'Laps' AS Kind, floor(cast(trunc(LapTime_s * 1e9) AS bigint) / 1000) / 1e6 AS s
              FROM laps
              UNION ALL SELECT Year, Race, LapNumber, 'Samples', floor(cast(trunc(Time_s * 1e9) AS bigint) / 1000) / 1e6
              FROM tel SEMI JOIN laps USING ({KEY})
              UNION ALL SELECT Year, Race, LapNumber, 'Skipped', 0e0 FROM laps ANTI JOIN tel USING ({KEY}))
        GROUP BY ALL""",
    "Seconds",
)

SERVED = """SELECT cast(Year AS int) AS year, Race AS race, LapNumber AS lapnumber, Driver AS driver,
  Compound AS compound, TyreLife AS tyrelife, StartFuel AS startfuel, FCL AS fcl,
  CASE WHEN LapTime_s IS NOT NULL THEN printf('0 days 00:%02d:%02d', us // 60000000, us // 1000000 % 60)
    || CASE WHEN us % 1000000 = 0 THEN '' ELSE printf('.%06d', us % 1000000) END END AS laptime,
  SpeedI1 AS speedi1, SpeedI2 AS speedi2, SpeedFL AS speedfl, SumLonAcc AS sumlonacc,
  SumLatAcc AS sumlatacc, MeanLapSpeed AS meanlapspeed
  FROM (SELECT *, cast(round(LapTime_s * 1e6) AS bigint) AS us FROM processed)"""
SERVED_DOUBLES = "startfuel fcl speedi1 speedi2 speedfl sumlonacc sumlatacc meanlapspeed"


@query("serving_load")
def serving_load(spark, folder):
    """Appended season by season, then one season replaced by itself."""
    path = scratch_path(spark, "serving")
    rows = writers.serving_rows(processed(spark, folder))
    writers.load_serving(rows.where(F.col("year") < 2024), path)
    writers.load_serving(rows.where(F.col("year") == 2024), path)
    writers.load_serving(rows.where(F.col("year") == 2023), path, mode="replace")
    return spark.read.parquet(path)


sql("serving_load", ALL, SERVED, SERVED_DOUBLES, [*CHAIN, PROCESSED])


def served_table(spark, folder):
    table = f"session_data_{uuid.uuid4().hex}"
    writers.create_serving(spark, table, scratch_path(spark, "session_data"))
    writers.insert_serving(writers.serving_rows(processed(spark, folder)), table)
    return table


@query("serving_ddl")
def serving_ddl(spark, folder):
    rows = spark.table(served_table(spark, folder)).withColumn("year", F.col("year").cast("int"))
    return rows.groupBy("year", "race").agg(
        F.count(F.lit(1)).alias("laps"), F.count("sumlonacc").alias("with_telemetry")
    )


sql(
    "serving_ddl", ALL,
    "SELECT Year AS year, Race AS race, count(*) AS laps, count(SumLonAcc) AS with_telemetry "
    "FROM processed GROUP BY ALL",
    "", [*CHAIN, PROCESSED],
)


@query("serving_read")
def serving_read(spark, folder):
    rows = readers.read_serving(spark, served_table(spark, folder))
    rows = rows.withColumn("laptime_us", durations.text_micros(F.col("laptime")))
    return shaping.cast_columns(rows, {c: "int" for c in ("year", "lapnumber", "tyrelife")})


sql(
    "serving_read", ALL, SERVED.replace("AS laptime,", "AS laptime, us AS laptime_us,"), SERVED_DOUBLES,
    [*CHAIN, PROCESSED],
)


@query("driver_laps")
def driver_laps(spark, folder):
    return shaping.driver_view(processed(spark, folder), "C7")


VIEW = "LapNumber, Driver, Compound, TyreLife, FCL, LapTime_s, SumLonAcc, SumLatAcc"
sql(
    "driver_laps", ALL, f"SELECT {VIEW} FROM processed WHERE Driver = 'C7'",
    "FCL LapTime_s SumLonAcc SumLatAcc", [*CHAIN, PROCESSED],
)


@query("fold_acc")
def fold_acc(spark, folder):
    """The acceleration sums of all laps in long form."""
    made = processed(spark, folder)
    return shaping.melt(made, ["Driver", "LapNumber"], ["SumLatAcc", "SumLonAcc"], "Type", "Value")


sql(
    "fold_acc", ALL,
    "SELECT Driver, LapNumber, 'SumLatAcc' AS Type, SumLatAcc AS Value FROM processed "
    "UNION ALL "
    "SELECT Driver, LapNumber, 'SumLonAcc' AS Type, SumLonAcc AS Value FROM processed",
    "Value", [*CHAIN, PROCESSED],
)
