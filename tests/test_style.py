"""Features and style distances from one pass against the two separate plans."""

import random

import pytest

from pitlane.constants import LAP_KEY, SESSION_COLUMNS
from pitlane.operators.similarity import STYLE, distances_to_best
from pitlane.plans.race import race_features
from pitlane.plans.style import landed, style, styled_features, with_style
from pitlane.settings import HOT_GROUP_ROWS, WARP_BLOCK

LAPS = (
    "Year int, Race string, DriverNumber string, LapNumber int, Driver string, Compound string, TyreLife int, "
    "LapTime_s double, IsPersonalBest boolean, SpeedI1 double, SpeedI2 double, SpeedFL double"
)
SAMPLES = (
    "Year int, Race string, DriverNumber string, LapNumber int, SampleId long, Time_s double, Speed double, "
    "X double, Y double, Distance double"
)
RACE = "Monaco Grand Prix"


@pytest.fixture
def tables(spark):
    """Driver 2 has no personal best, 3 no timed lap, 4 no telemetry; some laps are long, some of one sample."""
    draw = random.Random(7)
    laps, samples = [], []
    lengths = {"1": [4, 12, 1, 6, 0], "2": [5, 7, 3], "3": [4, 5], "4": [0, 0], "5": [6, 1, 5]}
    for driver, sizes in lengths.items():
        for lap, size in enumerate(sizes, 0 if driver == "5" else 1):
            time = None if driver == "3" or lap == 4 else 80.0 + draw.randint(0, 3)
            best = None if lap == 5 else driver != "2" and lap % 2 == 0
            laps.append((2023, RACE, driver, lap, f"C{driver}", "SOFT", lap, time, best, 250.0, 260.0, 270.0))
            for i in range(size):
                place = [draw.uniform(0, 100) for _ in range(2)]
                samples.append((2023, RACE, driver, lap, len(samples), float(i), draw.uniform(100, 180), *place, 8.0 * i))
    # Samples of no lap: without a key, and of a driver without laps.
    samples += [(2023, RACE, d, n, 1000 + i, float(i), 100.0, 1.0, 1.0, 8.0 * i) for d, n in ((None, 1), ("1", None), ("9", 1)) for i in range(11)]
    draw.shuffle(samples)
    return spark.createDataFrame(laps, LAPS), spark.createDataFrame(samples, SAMPLES)


def collected(df):
    rows = df.select("Driver", *SESSION_COLUMNS[:1], *SESSION_COLUMNS[2:], *STYLE.values()).collect()
    return {(r.Driver, r.LapNumber): list(r[2:]) for r in rows}


@pytest.mark.parametrize("limit", [10**9, 8])
def test_one_pass_equals_two(spark, tables, limit):
    laps, samples = tables
    own = landed(laps, samples)
    numbered = race_features(own, samples).join(own.select(*LAP_KEY, "Driver"), ["Year", "Race", "Driver", "LapNumber"])
    want = collected(with_style(numbered, style(laps, samples, laps, samples)))
    spark.conf.set(WARP_BLOCK, limit)
    try:
        got = collected(styled_features(laps, samples))
    finally:
        spark.conf.unset(WARP_BLOCK)
    assert got.keys() == want.keys() and len(got) == 12
    for key, row in want.items():
        assert got[key] == [v if not isinstance(v, float) else pytest.approx(v) for v in row], key
    assert got["C3", 1][-1] is None and got["C5", 0][-4] is None and got["C5", 0][-1] is not None


@pytest.mark.parametrize("limit", [10**9, 2])
def test_distances_to_best_of_a_driver_of_many_laps(spark, limit):
    rows = [(2023, RACE, "1", n, t, b, [float(n)], [0.0]) for n, t, b in ((1, 70.0, False), (2, 90.0, True), (3, 80.0, True), (4, None, True))]
    df = spark.createDataFrame(rows, "Year int, Race string, DriverNumber string, LapNumber int, LapTime_s double, IsPersonalBest boolean, LonAcc array<double>, LatAcc array<double>")
    spark.conf.set(HOT_GROUP_ROWS, limit)
    try:
        made = distances_to_best(df, 10).collect()
    finally:
        spark.conf.unset(HOT_GROUP_ROWS)
    assert {r.LapNumber: (r.LonDistanceDTW, r.LatDistanceDTW) for r in made} == {1: (2.0, 0.0), 2: (1.0, 0.0), 3: (0.0, 0.0), 4: (1.0, 0.0)}
