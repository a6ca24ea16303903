"""Reading and writing of stored tables."""

import re

import pytest
from pyspark.sql import functions as F

from pitlane import schemas
from pitlane.functions.durations import seconds_to_interval
from pitlane.plans import race, season
from pitlane.sources import readers, writers
from tests.data import SCHEMA, laps_of


@pytest.fixture
def processed(spark):
    rows = [
        (year, track, lap, f"D{d}", 90.0 + lap + d / 8)
        for year in (2022, 2023) for track in ("Monaco Grand Prix", "São Paulo Grand Prix")
        for lap in (1, 2, 3) for d in (1, 2)
    ]
    df = spark.createDataFrame(rows, "Year int, Race string, LapNumber int, Driver string, s double")
    return df.withColumn("LapTime", seconds_to_interval(F.col("s"))).drop("s")


def test_rerun_replaces_only_its_races(spark, processed, tmp_path):
    path = str(tmp_path / "p")
    writers.write_processed(processed, path)
    again = processed.where("Year = 2023 AND LapNumber = 1")
    writers.write_processed(again, path)
    counts = {r.Year: r["count"] for r in spark.read.parquet(path).groupBy("Year").count().collect()}
    assert counts == {2022: 12, 2023: 4}
    one = readers.read_processed(spark, path, Year=2022, Race="São Paulo Grand Prix")
    assert one.count() == 6 and one.agg(F.min("LapTime_s")).first()[0] == pytest.approx(91.125)
    assert {r.Race for r in readers.race_list(spark, path).collect()} == {
        "Monaco Grand Prix", "São Paulo Grand Prix"
    }


def test_season_scan_of_both_layouts(spark, processed, tmp_path):
    schema = "LapNumber INT, Driver STRING"
    parted = str(tmp_path / "parted")
    writers.write_processed(processed, parted)
    plain = tmp_path / "plain"
    for name in ("Monaco Grand Prix", "São Paulo Grand Prix"):
        own = processed.where((F.col("Race") == name) & (F.col("Year") == 2023))
        own.drop("Year", "Race").write.parquet(str(plain / "2023" / name))
    (plain / "2023" / "Empty Grand Prix").mkdir()
    for path in (parted, str(plain)):
        made = readers.scan_season(spark, path, 2023, schema)
        counts = {r.Race: r["count"] for r in made.groupBy("Race").count().collect()}
        assert counts == {"Monaco Grand Prix": 6, "São Paulo Grand Prix": 6}
    missing = readers.scan_season(spark, parted, 1999, schema)
    assert missing.count() == 0 and missing.columns == ["LapNumber", "Driver", "Year", "Race"]


def test_write_if_absent_never_overwrites(spark, processed, tmp_path):
    path = str(tmp_path / "raw")
    parts = ["Year", "Race"]
    first = processed.where("Year = 2022").withColumn("Batch", F.lit(1))
    writers.write_if_absent(first, path, parts)
    writers.write_if_absent(processed.withColumn("Batch", F.lit(2)), path, parts)
    writers.write_if_absent(processed.withColumn("Batch", F.lit(3)), path, parts)
    got = {(r.Year, r.Batch): r["count"] for r in spark.read.parquet(path).groupBy("Year", "Batch").count().collect()}
    assert got == {(2022, 1): 12, (2023, 2): 12}


def test_serving_load_appends_or_replaces(spark, processed, tmp_path):
    rows = writers.serving_rows(processed)
    assert rows.columns == ["driver", "lapnumber", "laptime", "race", "year"]
    path = str(tmp_path / "served")
    writers.load_serving(rows, path)
    writers.load_serving(rows, path)
    assert spark.read.parquet(path).count() == 48
    writers.load_serving(rows.where("year = 2023"), path, mode="replace")
    counts = {r.year: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}
    assert counts == {2022: 24, 2023: 12}
    assert rows.where("driver = 'D1' AND lapnumber = 1").first().laptime == "0 days 00:01:31.125000"


def test_serving_table(spark, tmp_path):
    own = spark.createDataFrame(
        [(2023, "Monaco Grand Prix", "1", "D1", "T", "SOFT", 1, 1, 1, 80.0, 1, True, 1.0, 2.0, 3.0)],
        "Year int, Race string, DriverNumber string, Driver string, Team string, Compound string, "
        "LapNumber int, Stint int, TyreLife int, LapTime_s double, Position int, "
        "IsPersonalBest boolean, SpeedI1 double, SpeedI2 double, SpeedFL double",
    )
    samples = spark.createDataFrame(laps_of([12]), SCHEMA)
    made = race.race_features(own, samples)
    writers.create_serving(spark, "served_once", str(tmp_path / "t"))
    writers.insert_serving(writers.serving_rows(made), "served_once")
    row = readers.read_serving(spark, "served_once").first()
    assert [f.name for f in spark.table("served_once").schema] == [n for n, _ in schemas.SERVING]
    assert (row.year, row.driver, row.startfuel, row.fcl) == (2023, "D1", 100.0, pytest.approx(77.0))
    assert row.sumlonacc > 0 and row.laptime == "0 days 00:01:20"


def test_season_consolidation(spark, processed, tmp_path):
    early = processed.where("Year = 2022").drop("Driver")
    late = processed.where("Year = 2023")
    made = season.consolidate([late, early], str(tmp_path / "s"))
    assert made.count() == 24 and made.where("Driver IS NULL").count() == 12
    assert made.where("Track = Race").count() == 24
    with pytest.raises(ValueError):
        writers.write_season(processed.limit(0), str(tmp_path / "none"))
    expected = processed.select("Year", "Race").distinct()
    rows = season.season_summary(late, expected).orderBy("Year").collect()
    assert [(r.Year, r.races, r.total_rows) for r in rows] == [(2022, 0, 0), (2023, 2, 12)]
    assert rows[0].missing == "Monaco Grand Prix, São Paulo Grand Prix" == rows[1].processed


def test_raw_session_tables(spark, tmp_path):
    laps = spark.createDataFrame(
        [(91_344_000_999, "1", 1, 2023, "R", "R"), (None, "1", 2, 2023, "R", "Q")],
        "LapTime long, DriverNumber string, LapNumber short, Year int, Race string, Session string",
    )
    samples = spark.createDataFrame(
        [(1_500_000_000, 200.0, "1", 1, 0, 2023, "R", "R"), (None, 1.0, "1", 1, 1, 2023, "R", "R"),
         (10**9, float("nan"), "1", 9, 2, 2023, "R", "R")],
        "Time long, Speed double, DriverNumber string, LapNumber short, SampleId long, Year int, "
        "Race string, Session string",
    )
    places = {}
    for name, df in (("laps", laps), ("tel", samples)):
        places[name] = str(tmp_path / name)
        writers.write_if_absent(df, places[name])
    got = readers.read_session(spark, places["laps"], places["tel"], Year=2023)
    assert got["race_laps"].first().LapTime_s == pytest.approx(91.344)
    assert got["quali_laps"].count() == 1 and got["quali_telemetry"].count() == 0
    tel = got["race_telemetry"]
    assert tel.where("LapNumber = 9").first().Speed is None
    keys = ["Year", "Race", "DriverNumber", "LapNumber"]
    used = readers.usable_telemetry(tel, got["race_laps"], keys)
    assert [r.Time_s for r in used.collect()] == [1.5]
    assert readers.laps_without_telemetry(got["quali_laps"], tel, keys).count() == 1
    plan = got["race_laps"]._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "(Year#" in filters and "(Session#" in filters


def test_schedule_and_records(spark, tmp_path):
    events = spark.sql(
        "SELECT * FROM VALUES (2023, 1, 'Pre-Season Testing', DATE'2023-02-23'), "
        "(2023, 2, 'Bahrain Grand Prix', DATE'2023-03-05'), (2022, 1, 'Old Grand Prix', DATE'2022-03-05') "
        "AS t(Year, RoundNumber, EventName, EventDate)"
    )
    events.write.parquet(str(tmp_path / "e"))
    assert readers.read_schedule(spark, str(tmp_path / "e"), 2023).count() == 2
    (tmp_path / "r.json").write_text('{"date": "2023-03-05T15:00:00", "speed": 10}\n{"speed": "x"}\n')
    rows = readers.read_records(spark, str(tmp_path / "r.json"), "date timestamp_ntz, speed int")
    assert rows.where("speed = 10").count() == 1 and rows.count() == 2
    (tmp_path / "c.csv").write_text("a,b\n1,x\n")
    got = readers.read_delivered(spark, str(tmp_path / "c.csv"), "csv", "a int, b string").first()
    assert tuple(got) == (1, "x")


def test_event_status(spark, tmp_path):
    events = spark.sql(
        "SELECT * FROM VALUES (2023, 0, 'Pre-Season Testing', DATE'2023-02-23'), (2023, 1, 'Bahrain Grand Prix', DATE'2023-03-05'), "
        "(2023, 2, 'Jeddah Grand Prix', DATE'2023-03-19'), (2023, 3, 'Melbourne Grand Prix', DATE'2023-04-02'), "
        "(2023, 4, 'Imola Grand Prix', NULL), (2023, 5, NULL, DATE'2023-05-01'), (2022, 1, 'Old Grand Prix', DATE'2022-03-05') "
        "AS t(Year, RoundNumber, EventName, EventDate)"
    )
    events.write.partitionBy("Year").parquet(str(tmp_path / "e"))
    laps = spark.sql(
        "SELECT * FROM VALUES (2023, 'Bahrain Grand Prix', 'VER', 1), (2023, 'Bahrain Grand Prix', 'VER', 2), "
        "(2023, 'Bahrain Grand Prix', 'HAM', 1), (2023, 'Street Race', 'HAM', 9), (2022, 'Jeddah Grand Prix', 'HAM', 1) "
        "AS t(Year, Race, Driver, LapNumber)"
    )
    status = season.event_status(readers.read_schedule(spark, str(tmp_path / "e"), 2023), laps)
    rows = {r.EventName: (r.RoundNumber, r.Laps, r.Drivers, r.LastLap, r.Next) for r in status.collect()}
    assert rows == {
        "Bahrain Grand Prix": (1, 3, 2, 2, False),
        "Jeddah Grand Prix": (2, 0, 0, 0, True),
        "Melbourne Grand Prix": (3, 0, 0, 0, False),
        "Imola Grand Prix": (4, 0, 0, 0, False),
    }
    assert season.event_status(events.limit(0), laps).count() == 0
    assert season.event_status(events, laps.limit(0)).where("Next").count() == 2
