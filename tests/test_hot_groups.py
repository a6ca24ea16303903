"""A lap holding most of the rows must give the same result in pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.constants import LAP_KEY
from pitlane.operators import laps, learning, matching, motion, quantiles, telemetry
from pitlane.operators.series import Series, attach_totals, hot_groups
from tests.data import SCHEMA, laps_of, near

SIZES = [160, 1, 3, 7, 50, 20]
ID = ["LapNumber", "SampleId"]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(laps_of(SIZES, missing=True), SCHEMA).repartition(3)


def same(hot, build, limit=30):
    plain = {r[:2]: r[2:] for r in map(tuple, build().collect())}
    with hot(limit):
        cut = {r[:2]: r[2:] for r in map(tuple, build().collect())}
    assert plain.keys() == cut.keys()
    for key, values in plain.items():
        assert all(
            near(a, b, 1e-9) if isinstance(a, float) else a == b for a, b in zip(values, cut[key])
        ), (key, values, cut[key])


def test_only_hot_groups_are_found(spark, samples, hot):
    assert hot_groups(samples, LAP_KEY) is None
    with hot(30):
        found = hot_groups(samples, LAP_KEY).collect()
    assert sorted((r.LapNumber, r._rows) for r in found) == [(1, 160), (5, 50)]


@pytest.mark.parametrize("limit", [2, 30, 100])
def test_accelerations(samples, hot, limit):
    same(hot, lambda: motion.accelerations(samples).select(*ID, "LonAcc", "LatAcc"), limit)


@pytest.mark.parametrize("limit", [2, 60])
def test_averages(samples, hot, limit):
    def build():
        made = telemetry.exponential_average(samples, "Speed", [5, 10])
        return telemetry.moving_average(made, "Speed", [5, 10]).select(*ID, *[
            f"last_{n}_{k}" for n in (5, 10) for k in ("SMA", "EMA")
        ])

    same(hot, build, limit)


def test_heading_and_progress(samples, hot):
    same(hot, lambda: motion.heading_unwrap(samples).select(*ID, "Heading"))
    same(hot, lambda: telemetry.lap_progress(samples).select(*ID, "LapProgress"))
    same(hot, lambda: motion.with_lap_sums(samples).select(*ID, "SumLonAcc", "SumLatAcc"))


def test_running_forms(samples, hot):
    def build(backwards):
        s = Series(samples, LAP_KEY, ["Time_s", "SampleId"])
        s.running(
            {
                "n": ("count", F.col("X")), "total": ("sum", F.col("Y")),
                "top": ("max", F.col("Speed")), "latest": ("last", F.col("X")),
            },
            backwards,
        )
        return s.rows().select(*ID, "n", "total", "top", "latest")

    same(hot, lambda: build(False))
    same(hot, lambda: build(True))


def test_neighbours_across_several_short_pieces(samples, hot):
    def build():
        s = Series(samples, LAP_KEY, ["Time_s", "SampleId"], reach=9)
        s.with_columns({"a": s.lag("SampleId", 9), "b": s.lead("SampleId", 9), "c": s.lag("SampleId")})
        return s.rows().select(*ID, "a", "b", "c")

    same(hot, build, 1)


def test_whole_table_as_one_group(samples, hot):
    def build():
        s = Series(samples, [], ["LapNumber", "SampleId"], reach=2).position("at")
        s.with_columns({"before": s.lag("SampleId", 2)})
        return s.rows().select(*ID, "at", "before")

    same(hot, build)
    same(hot, lambda: learning.kfold(samples, ID).select(*ID, "Fold"))
    same(hot, lambda: learning.train_test_split(samples, ID).select(*ID, "Part"))


def test_null_keys_form_a_group(spark, hot):
    rows = [(None if i % 2 else 1, i, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, i long, v double")

    def build():
        s = Series(df, ["k"], ["i"], reach=1).running({"total": ("sum", F.col("v"))})
        made = attach_totals(s.rows(), ["k"], {"all": F.sum("v")})
        return made.select("k", "i", "total", "all")

    same(hot, build)


def test_nearest(spark, hot):
    draw = np.random.default_rng(3)
    right = [("u" if i % 10 else "v", i, float(t)) for i, t in enumerate(draw.integers(0, 300, 250))]
    left = [("u" if i % 7 else "v", i, float(t)) for i, t in enumerate(draw.integers(0, 300, 120))]
    stamp = F.timestamp_add("SECOND", F.col("t").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    r = spark.createDataFrame(right, "by string, id long, t double").withColumn("at", stamp).drop("t")
    l = spark.createDataFrame(left, "by string, n long, t double").withColumn("when", stamp)  # noqa: E741
    want = {}
    for by, n, t in left:
        pool = [(abs(t - u), u, i) for b, i, u in right if b == by]
        want[n] = min(pool)[2]

    def build():
        return matching.nearest(l, r, ["by"], "when", "at", "id").select("n", "by", "id")

    assert {x.n: x.id for x in build().collect()} == want
    same(hot, build)


def test_percentiles(spark, hot):
    draw = np.random.default_rng(5)
    values = draw.normal(size=500).round(2)
    rows = [("a" if i < 400 else None, float(v)) for i, v in enumerate(values)] + [("c", None)] * 40
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"v": {"q1": 0.25, "q2": 0.5, "q3": 0.75}}
    for limit in (None, 30):
        with hot(limit or 10**9):
            got = {r.k: (r.q1, r.q2, r.q3) for r in quantiles.percentiles(df, ["k"], wanted).collect()}
            everything = quantiles.percentiles(df, [], wanted).first()
        assert got["a"] == pytest.approx(np.percentile(values[:400], [25, 50, 75]))
        assert got[None] == pytest.approx(np.percentile(values[400:], [25, 50, 75]))
        assert got["c"] == (None, None, None)
        assert tuple(everything) == pytest.approx(np.percentile(values, [25, 50, 75]))


def test_forward_fill_stays_inside_a_driver(spark, hot):
    rows = [(2023, "R", "d%d" % (i // 60), i % 60, float(i) if i % 4 == 2 else None) for i in range(120)]
    df = spark.createDataFrame(
        rows, "Year int, Race string, DriverNumber string, LapNumber int, SpeedI1 double"
    )

    def build():
        made = laps.fill_forward(df, ["SpeedI1"], ["Year", "Race", "DriverNumber"], ["LapNumber"])
        return made.select("DriverNumber", "LapNumber", "SpeedI1")

    first = {(r[0], r[1]): r[2] for r in build().collect()}
    assert first["d1", 0] is None and first["d1", 3] == 62.0
    same(hot, build, 20)


def test_label_codes(spark, hot):
    df = spark.createDataFrame([(i, f"v{i % 50:02d}" if i % 9 else None) for i in range(300)], "i int, c string")

    def build():
        return learning.label_encode(df, ["c"]).select("i", F.lit(0).alias("z"), "c")

    codes = {r.i: r.c for r in build().collect()}
    assert codes[1] == 1 and codes[0] is None and codes[49] == 49
    same(hot, build, 10)
