"""Warping kernel, arrays and the tiled form."""

import math
import random

import pytest

from pitlane.constants import LAP_KEY
from pitlane.operators import similarity
from tests.data import warping

GOLDEN = ([0, 0, 1, 2, 1, 0, 1, 0, 0], [0, 1, 2, 0, 0, 0, 0, 0, 0])


def test_golden_pair(spark):
    pair = tuple(list(map(float, x)) for x in GOLDEN)
    df = spark.createDataFrame([pair], "a array<double>, b array<double>")
    value = df.select(similarity.warp_distance("a", "b")).first()[0]
    assert value == pytest.approx(1.4142135623730951, abs=1e-12)
    assert value == pytest.approx(math.sqrt(2))


def test_kernel_on_mixed_lengths():
    draw = random.Random(1)
    first = [[draw.gauss(0, 2) for _ in range(draw.randint(1, 30))] for _ in range(80)]
    second = [[draw.gauss(0, 2) for _ in range(draw.randint(1, 30))] for _ in range(80)]
    got = similarity.warp_distances(first, second)
    assert got == pytest.approx([warping(a, b) for a, b in zip(first, second)])


def test_missing_and_empty_series(spark):
    rows = [([1.0], None), ([], [1.0]), ([1.0], [3.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = [r[0] for r in df.select(similarity.warp_distance("a", "b")).collect()]
    assert got == [None, None, 2.0]


def series_rows(lengths, seed):
    draw = random.Random(seed)
    rows = []
    for (driver, lap), n in lengths.items():
        for i in range(n):
            value = None if draw.random() < 0.1 else draw.gauss(0, 3)
            rows.append((2023, "R", driver, lap, i, float(i), value, draw.gauss(0, 1)))
    draw.shuffle(rows)
    return rows


SCHEMA = (
    "Year int, Race string, DriverNumber string, LapNumber int, SampleId long, Time_s double, "
    "LonAcc double, LatAcc double"
)


def known(rows, driver, lap, place):
    mine = sorted((r for r in rows if r[2] == driver and r[3] == lap), key=lambda r: r[5])
    return [r[place] for r in mine if r[place] is not None]


def test_long_laps_are_tiled(spark, hot):
    """Short and long laps against short and long references, at a block of 8 values."""
    rows = series_rows({("1", 1): 6, ("1", 2): 25, ("1", 3): 5, ("2", 1): 19, ("2", 2): 4, ("2", 3): 30}, 4)
    samples = spark.createDataFrame(rows, SCHEMA)
    references = samples.where("LapNumber = 1")
    want = {
        (d, lap): tuple(warping(known(rows, d, 1, p), known(rows, d, lap, p)) for p in (6, 7))
        for d in "12" for lap in (1, 2, 3)
    }
    for limit in (10**9, 8):
        with hot(limit):
            made = similarity.style_distances(samples, references).collect()
        got = {(r.DriverNumber, r.LapNumber): (r.LonDistanceDTW, r.LatDistanceDTW) for r in made}
        assert got.keys() == want.keys()
        for key in want:
            assert got[key] == pytest.approx(want[key])


def test_one_reference_for_all(spark, hot):
    rows = series_rows({("1", 1): 12, ("2", 1): 3, ("2", 2): 14}, 9)
    samples = spark.createDataFrame(rows, SCHEMA)
    reference = samples.where("DriverNumber = '1'")
    want = {
        (d, lap): warping(known(rows, "1", 1, 6), known(rows, d, lap, 6))
        for d, lap in (("1", 1), ("2", 1), ("2", 2))
    }
    for limit in (10**9, 5):
        with hot(limit):
            made = similarity.distances(samples, reference, {"LonAcc": "D"}, on=[]).collect()
        got = {(r.DriverNumber, r.LapNumber): r.D for r in made}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_reference_laps_fall_back_to_the_race(spark):
    schema = (
        "Year int, Race string, DriverNumber string, LapNumber int, LapTime_s double, "
        "IsPersonalBest boolean"
    )
    quali = [(2023, "R", "1", 1, 91.0, True), (2023, "R", "1", 2, 90.0, True), (2023, "R", "2", 1, 80.0, False)]
    race = [(2023, "R", "1", 9, 70.0, True), (2023, "R", "2", 5, 96.0, False), (2023, "R", "2", 6, 95.0, False)]
    made = similarity.reference_laps(spark.createDataFrame(quali, schema), spark.createDataFrame(race, schema))
    got = {(r.DriverNumber, r.LapNumber, r.Session) for r in made.select(*LAP_KEY, "Session").collect()}
    assert got == {("1", 2, "Q"), ("2", 6, "R")}
