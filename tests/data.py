"""Random samples with awkward shapes, and sequential definitions to check against."""

import math
import random

from pitlane.constants import LAP_KEY

SCHEMA = (
    "Year int, Race string, DriverNumber string, LapNumber int, SampleId long, Time_s double, "
    "Speed double, Distance double, X double, Y double, DRS int"
)


def laps_of(sizes, seed=7, missing=False, lattice=True):
    """Rows of one lap per size; includes repeated times, standstills and half turns."""
    draw = random.Random(seed)
    rows = []
    for lap, size in enumerate(sizes, start=1):
        t = s = 0.0
        for i in range(size):
            t += draw.choice([0.0, 0.1, 0.25, 0.5])
            s += draw.choice([0.0, 1.0, 2.0, 5.0])
            x = float(draw.randint(-2, 2)) if lattice else draw.uniform(-50, 50)
            y = float(draw.randint(-2, 2)) if lattice else draw.uniform(-50, 50)
            if missing and draw.random() < 0.03:
                x = None
            speed = None if missing and draw.random() < 0.1 else draw.uniform(60, 330)
            rows.append((2023, "Monaco Grand Prix", "1", lap, i, t, speed, s, x, y, i % 16))
    draw.shuffle(rows)
    return rows


def grouped(rows):
    """Lap number to its rows in time order."""
    laps = {}
    for row in rows:
        laps.setdefault(row[3], []).append(row)
    return {lap: sorted(some, key=lambda r: (r[5], r[4])) for lap, some in laps.items()}


def sub(a, b):
    return None if a is None or b is None else a - b


def ratio(a, b):
    return None if a is None or b is None or b == 0 else a / b


def slopes(t, v):
    """Centered derivative, value by value."""
    n = len(t)
    if n == 1:
        return [None]
    out = [ratio(sub(v[1], v[0]), t[1] - t[0] + 1e-9)]
    for i in range(1, n - 1):
        for lo, hi in ((i - 1, i + 1), (i, i + 1), (i - 1, i)):
            if abs(t[hi] - t[lo]) > 1e-9:
                out.append(ratio(sub(v[hi], v[lo]), t[hi] - t[lo]))
                break
        else:
            out.append(0.0)
    out.append(ratio(sub(v[-1], v[-2]), t[-1] - t[-2] + 1e-9))
    return out


def into_half_turns(angle):
    inside = (angle + math.pi) % (2 * math.pi) - math.pi
    return -math.pi if abs(inside - math.pi) <= 1e-8 + 1e-5 * math.pi else inside


def headings(s, x, y):
    """Direction followed step by step, adding the wrapped change each time."""
    angles = [
        None if dx is None or dy is None else math.atan2(dy, dx)
        for dx, dy in zip(slopes(s, x), slopes(s, y))
    ]
    out = []
    for angle in angles:
        if not out:
            out.append(angle)
        elif out[-1] is None or angle is None:
            out.append(None)
        else:
            out.append(out[-1] + into_half_turns(angle - out[-1]))
    return out


def repaired(values, limit=7.5):
    out = []
    for value in values:
        if value is not None and abs(value) > limit:
            value = out[-1] if out else 0.0
        out.append(value)
    return out


def both_accelerations(lap):
    t, s = [r[5] for r in lap], [r[7] for r in lap]
    v = [None if r[6] is None else r[6] / 3.6 for r in lap]
    lon = [None if a is None else a / 9.81 for a in slopes(t, v)]
    theta = headings(s, [r[8] for r in lap], [r[9] for r in lap])
    lat = [
        None if k is None or u is None else u * u * k / 9.81
        for k, u in zip(slopes(s, theta), v)
    ]
    return repaired(lon), repaired(lat)


def warping(a, b):
    """Full matrix, cell by cell."""
    inf = float("inf")
    cost = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    cost[0][0] = 0.0
    for i, x in enumerate(a, start=1):
        for j, y in enumerate(b, start=1):
            best = min(cost[i - 1][j], cost[i][j - 1], cost[i - 1][j - 1])
            cost[i][j] = (x - y) ** 2 + best
    return math.sqrt(cost[-1][-1])


def near(a, b, tolerance=1e-6):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))


def table(df, value, key=(*LAP_KEY[3:], "SampleId")):
    """{(lap, sample): value}"""
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}
