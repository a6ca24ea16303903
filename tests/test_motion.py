"""Window forms against sequential definitions on random series."""

import pytest

from pitlane.operators import motion, telemetry
from tests.data import (
    SCHEMA, both_accelerations, grouped, headings, laps_of, near, repaired, slopes, table,
)

SIZES = [1, 2, 3, 4, 5, 8, 13, 40, 90, 200]


@pytest.fixture(scope="module", params=["lattice", "smooth", "gaps"])
def rows(request):
    kind = request.param
    return laps_of(SIZES, seed=len(kind), missing=kind == "gaps", lattice=kind != "smooth")


def check(made, want):
    assert made.keys() == want.keys()
    bad = {k: (made[k], want[k]) for k in want if not near(made[k], want[k])}
    assert not bad


def expected(rows, function):
    out = {}
    for lap, some in grouped(rows).items():
        for row, value in zip(some, function(some)):
            out[lap, row[4]] = value
    return out


def test_derivative(spark, rows):
    made = motion.derivative(spark.createDataFrame(rows, SCHEMA), "Time_s", "Speed", "d")
    check(table(made, "d"), expected(rows, lambda r: slopes([x[5] for x in r], [x[6] for x in r])))


def smooth(t, v):
    n = len(t)
    out = []
    for i in range(n):
        if n == 1:
            out.append(None)
        elif i in (0, n - 1):
            lo, hi = (0, 1) if i == 0 else (n - 2, n - 1)
            out.append((v[hi] - v[lo]) / (t[hi] - t[lo] + 1e-9))
        elif i < 3 or i > n - 4:
            out.append((v[i + 1] - v[i - 1]) / (t[i + 1] - t[i - 1] + 1e-9))
        else:
            total = 0.0
            for j, c in ((1, 5), (2, 4), (3, 1)):
                if t[i + j] != t[i - j]:
                    total += 2 * j * c / 32 * (v[i + j] - v[i - j]) / (t[i + j] - t[i - j])
            out.append(total)
    return out


def test_smooth_derivative(spark):
    rows = laps_of(SIZES, lattice=False)
    made = motion.derivative(spark.createDataFrame(rows, SCHEMA), "Time_s", "Speed", "d", "smooth")
    check(table(made, "d"), expected(rows, lambda r: smooth([x[5] for x in r], [x[6] for x in r])))


def test_heading(spark, rows):
    made = table(motion.heading_unwrap(spark.createDataFrame(rows, SCHEMA)), "Heading")
    want = expected(
        rows, lambda r: headings([x[7] for x in r], [x[8] for x in r], [x[9] for x in r])
    )
    assert made.keys() == want.keys()
    # A snapped half turn may be off by the snap width, never by a turn.
    assert all(near(made[k], want[k], 1e-4) for k in want)


def test_accelerations(spark, rows):
    made = motion.accelerations(spark.createDataFrame(rows, SCHEMA))
    for column, place in (("LonAcc", 0), ("LatAcc", 1)):
        want = expected(rows, lambda r, place=place: both_accelerations(r)[place])
        got = table(made, column)
        assert got.keys() == want.keys()
        assert all(near(got[k], want[k], 2e-5) for k in want)


def test_order_of_arrival_does_not_matter(spark):
    rows = laps_of([30, 30])
    one = motion.accelerations(spark.createDataFrame(rows, SCHEMA))
    two = motion.accelerations(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3))
    assert table(one, "LatAcc") == table(two, "LatAcc")


def test_repair_keeps_missing_values(spark):
    values = [9.0, 1.0, -8.0, None, 20.0, 7.5, float(-7.6), 2.0]
    rows = [(2023, "R", "1", 1, i, float(i), v, 0.0, 0.0, 0.0, 0) for i, v in enumerate(values)]
    made = motion.outlier_repair(spark.createDataFrame(rows, SCHEMA), "Speed", "Clean")
    got = [r.Clean for r in made.orderBy("SampleId").collect()]
    assert got == repaired(values) == [0.0, 1.0, 1.0, None, None, 7.5, 7.5, 2.0]


def ema(values, span):
    r, num, den, out = 1 - 2 / (span + 1), 0.0, 0.0, []
    for v in values:
        num, den = num * r, den * r
        if v is not None:
            num, den = num + v, den + 1
        out.append(num / den if den else None)
    return out


def test_exponential_average(spark):
    rows = laps_of([1, 3, 50, 700], missing=True)
    # A gap longer than a block of weights.
    rows = [r if r[3] != 4 or not 100 <= r[4] < 500 else (*r[:6], None, *r[7:]) for r in rows]
    made = telemetry.exponential_average(spark.createDataFrame(rows, SCHEMA), "Speed", [5, 10])
    for span in (5, 10):
        want = expected(rows, lambda r, span=span: ema([x[6] for x in r], span))
        check(table(made, f"last_{span}_EMA"), want)


def test_moving_average(spark):
    rows = laps_of([3, 5, 60], missing=True)
    made = telemetry.moving_average(spark.createDataFrame(rows, SCHEMA), "Speed", [5])

    def sma(some):
        values = [x[6] for x in some]
        for i in range(len(values)):
            frame = values[max(0, i - 4) : i + 1]
            yield sum(frame) / 5 if len(frame) == 5 and None not in frame else None

    check(table(made, "last_5_SMA"), expected(rows, sma))
