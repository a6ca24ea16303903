"""Small worked examples of single operators."""

import math

import pytest
from pyspark.sql import functions as F

from pitlane.functions import durations, scalars
from pitlane.operators import laps, shaping, telemetry

KEYS = ["DriverNumber", "LapNumber"]


def ordered(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"SampleId long, {schema}")


def test_sign_split(spark):
    df = ordered(spark, [(1,), (0,), (-1,), (1,), (-1,)], "c int")
    rows = scalars.sign_split(df, "c").orderBy("SampleId").collect()
    assert [r.positive_c for r in rows] == [1, 0, 0, 1, 0]
    assert [r.negative_c for r in rows] == [0, 0, -1, 0, -1]


def test_drs(spark):
    df = ordered(spark, [(12,), (10,), (14,), (1,), (20,), (10000,), (-10000,), (None,)], "DRS int")
    rows = df.select(scalars.drs_open(F.col("DRS")).alias("d"), "SampleId").orderBy("SampleId")
    assert [r.d for r in rows.collect()] == [1, 1, 1, 0, 0, 0, 0, 0]


def test_mean_lap_speed(spark):
    rows = [(1, 1, 50), (1, 2, 50), (1, 1, 100), (1, 2, 50), (2, 1, 100), (2, 2, 150), (2, 1, 300), (2, 2, 300)]
    df = ordered(spark, rows, "DriverNumber int, LapNumber int, Speed int")
    made = telemetry.with_mean_speed(df, KEYS).orderBy("SampleId").collect()
    assert [r.MeanLapSpeed for r in made] == [75, 50, 75, 50, 200, 225, 200, 225]


def test_lap_progress(spark):
    rows = [(1, 1), (1, 2), (1, 1), (1, 2), (2, 1), (2, 2), (2, 1), (2, 2), (2, 1), (2, 2)]
    df = ordered(spark, rows, "DriverNumber int, LapNumber int")
    made = telemetry.lap_progress(df, KEYS, ["SampleId"]).orderBy("SampleId").collect()
    want = [1 / 2, 1 / 2, 1, 1, 1 / 3, 1 / 3, 2 / 3, 2 / 3, 1, 1]
    assert [r.LapProgress for r in made] == pytest.approx(want)


def test_last_sample_skips_irregular_laps(spark):
    rows = [
        (1, 1.0, 5), (1, 1.0, 654), (1, 2.0, 555), (2, 1.0, 444), (2, 2.0, 1), (2, 2.0, 999),
        (2, 0.0, 7), (2, -1.0, 7), (2, 1.5, 7), (2, None, 7),
    ]
    df = ordered(spark, rows, "DriverNumber int, LapNumber double, some_data int")
    made = telemetry.last_sample_per_lap(df, KEYS, ["SampleId"])
    got = {(r.DriverNumber, r.LapNumber, r.some_data) for r in made.collect()}
    assert got == {(1, 1, 654), (1, 2, 555), (2, 1, 444), (2, 2, 999)}


def test_fuel(spark):
    one = spark.range(1)
    per_lap = one.select(laps.fuel_per_lap(F.lit(100.0), F.lit(10.0))).first()[0]
    assert per_lap == pytest.approx(9.9)
    start = one.select(laps.start_fuel(F.lit(21), F.lit(1.0))).first()[0]
    assert start == 80
    empty = one.select(laps.start_fuel(F.lit(300), F.lit(1.0))).first()[0]
    assert empty == 0
    first = one.select(laps.average_fuel(F.lit(1), F.lit(1.0))).first()[0]
    later = one.select(laps.average_fuel(F.lit(11), F.lit(1.0))).first()[0]
    assert (first, later) == (100, 90.5)


def test_corrected_lap_time(spark):
    def corrected(seconds, lap, fuel):
        column = laps.corrected_lap_time(
            F.lit(seconds).cast("double"), F.lit(lap), F.lit(fuel).cast("double"), F.lit(2.0)
        )
        return spark.range(1).select(column).first()[0]

    assert corrected(90.0, 1, 100) == pytest.approx(87.0)
    assert corrected(90.0, 2, 98) == pytest.approx(90 - 0.03 * 99)
    assert corrected(90.0, 10, 82) == pytest.approx(90 - 0.03 * 83)
    assert corrected(None, 10, 82) is None


def test_unknown_race_is_an_error(spark):
    df = spark.createDataFrame([("Nowhere Grand Prix",)], "Race string")
    with pytest.raises(Exception, match="unknown race"):
        laps.with_track(df).collect()


def test_average_fuel_needs_the_previous_lap(spark):
    rows = [(2023, "R", "1", 1, 100.0), (2023, "R", "1", 2, 98.0), (2023, "R", "1", 4, 94.0)]
    df = spark.createDataFrame(
        rows, "Year int, Race string, DriverNumber string, LapNumber int, StartFuel double"
    )
    for way in (laps.average_fuel_by_join, laps.average_fuel_by_lag):
        made = way(df).orderBy("LapNumber").collect()
        assert [r.AvgFuel for r in made] == [100, 99, None]


def test_interval_text(spark):
    micros = [91_344_000, 60_000_000, 86_400_000_000 + 1, None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(micros)], "i int, m long")
    made = df.select("i", durations.interval_text(F.col("m")).alias("t")).orderBy("i").collect()
    assert [r.t for r in made] == [
        "0 days 00:01:31.344000", "0 days 00:01:00", "1 days 00:00:00.000001", None,
    ]


def test_intervals_there_and_back(spark):
    df = spark.createDataFrame([(91.344,), (7323.000001,), (None,)], "s double")
    made = df.withColumn("d", durations.seconds_to_interval(F.col("s")))
    back = [r.d for r in durations.durations_to_seconds(made).collect()]
    assert back[:2] == pytest.approx([91.344, 7323.000001]) and back[2] is None


def test_iso_timestamps(spark):
    df = spark.createDataFrame([("2023-03-05T15:03:42.5",), ("2023-03-05T15:03:42",), ("?",)], "t string")
    made = [r[0] for r in df.select(durations.iso_timestamp(F.col("t"))).collect()]
    assert made[0].microsecond == 500_000 and made[1].second == 42 and made[2] is None


def test_wrap_angle(spark):
    values = [0.0, math.pi, -math.pi, 3 * math.pi, math.pi - 1e-6, 7.0, -7.0]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    for r in df.select("a", scalars.wrap_angle(F.col("a")).alias("w")).collect():
        assert -math.pi <= r.w.angle < math.pi
        assert r.w.angle + 2 * math.pi * r.w.revolutions == pytest.approx(r.a, abs=1e-5)


def test_clean_inf_and_row_mean(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, inf, 3.0), (nan, -inf, None)], "a double, b double, c double")
    clean = scalars.clean_inf(df)
    assert [tuple(r) for r in clean.collect()] == [(1.0, None, 3.0), (None, None, None)]
    means = clean.select(scalars.row_mean(["a", "b", "c"])).collect()
    assert [r[0] for r in means] == [2.0, None]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, A int, c int")
    assert shaping.serving_columns(df).columns == ["a", "b", "c"]
    assert shaping.positional_columns(df, 1, -1).columns == ["A"]
    with pytest.raises(KeyError):
        shaping.drop_columns(df, ["nope"])
    assert shaping.drop_columns(df, ["c", "nope"], missing_ok=True).columns == ["b", "A"]
    other = spark.createDataFrame([(9,)], "b int")
    assert [tuple(r) for r in shaping.union_by_name(df, other).collect()] == [(1, 2, 3), (9, None, None)]


def test_quick_and_fastest_laps(spark):
    rows = [
        (2023, "R", "1", 1, 100.0, False), (2023, "R", "1", 2, 90.0, True),
        (2023, "R", "1", 3, 90.0, True), (2023, "R", "2", 1, 95.0, False),
        (2023, "R", "2", 2, None, True),
    ]
    df = spark.createDataFrame(
        rows,
        "Year int, Race string, DriverNumber string, LapNumber int, LapTime_s double, "
        "IsPersonalBest boolean",
    )
    key = ["Year", "Race", "DriverNumber"]
    best = laps.fastest_lap(df, key).collect()
    assert [(r.DriverNumber, r.LapNumber) for r in best] == [("1", 2)]
    assert laps.fastest_lap(df, key, personal_best_only=False).count() == 2
    assert laps.quick_laps(df).count() == 3
    assert laps.quick_laps(df, 1.02, key).count() == 3


def test_binned_matches_right_closed_bins(spark):
    rows = [(1, i / 10) for i in range(11)] + [(1, None)]
    df = spark.createDataFrame(rows, "LapNumber int, LapProgress double")
    made = telemetry.binned(df, "LapProgress", bins=5, how="count").orderBy("bin").collect()
    assert [r.bin for r in made] == [0, 1, 2, 3, 4]
    assert [r["count_of_LapProgress"] for r in made] == [3, 2, 2, 2, 2]
