"""Dynamic time warping between laps.

Ordinary laps travel as one array each and are compared by a vectorised kernel
that handles many pairs at once.  A lap too long for one array is cut into
blocks of consecutive values; its distance matrix is then filled tile by tile,
all tiles of an anti-diagonal in parallel, passing on only tile edges.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pitlane.constants import DRIVER_KEY, LAP_KEY, SAMPLE_ORDER
from pitlane.operators.laps import fastest_lap
from pitlane.operators.motion import accelerations
from pitlane.operators.series import (
    Series,
    Sizes,
    attach_totals,
    checked_broadcast,
    hand_down,
    hot_groups_of,
    know,
    most_rows,
)
from pitlane.settings import (
    WARP_BLOCK,
    WARP_BLOCK_DEFAULT,
    materialize,
    scratch_path,
    setting,
)

# Cells of one padded kernel call.
CALL_CELLS = 2_000_000
# Cells that one task fills, a few seconds of work.
TASK_CELLS = 1_000_000_000
VALUES = T.ArrayType(T.DoubleType())

# Executors need not have this package installed to run the kernel.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# -- kernel ----------------------------------------------------------------


def warp(a, b, left, top):
    """Fill the warping matrices of a stack of pairs along their anti-diagonals.

    `a` is (pairs, n), `b` (pairs, m); `left` (pairs, n + 1) and `top`
    (pairs, m + 1) are the boundary costs with the common corner first.  Yields
    (d, costs) where costs[:, i] is the cell (i, d - i); cells outside the
    matrix are infinite.
    """
    pairs, n = a.shape
    m = b.shape[1]
    flipped = b[:, ::-1]
    older = np.full((pairs, n + 1), np.inf)
    old = older.copy()
    old[:, 0] = top[:, 0]
    yield 0, old
    for d in range(1, n + m + 1):
        new = np.full((pairs, n + 1), np.inf)
        if d <= m:
            new[:, 0] = top[:, d]
        if d <= n:
            new[:, d] = left[:, d]
        lo, hi = max(1, d - m), min(n, d - 1)
        if lo <= hi:
            gap = a[:, lo - 1 : hi] - flipped[:, m - d + lo : m - d + hi + 1]
            best = np.minimum(old[:, lo - 1 : hi], old[:, lo : hi + 1])
            np.minimum(best, older[:, lo - 1 : hi], out=best)
            new[:, lo : hi + 1] = gap * gap + best
        older, old = old, new
        yield d, new


def _open_edges(pairs: int, n: int, m: int):
    left, top = np.full((pairs, n + 1), np.inf), np.full((pairs, m + 1), np.inf)
    left[:, 0] = top[:, 0] = 0.0
    return left, top


def warp_distances(first: list, second: list) -> np.ndarray:
    """Distance of each pair: root of the cheapest path's squared differences."""
    n = np.array([len(x) for x in first])
    m = np.array([len(x) for x in second])
    out = np.full(len(n), np.nan)
    todo = np.flatnonzero((n > 0) & (m > 0))
    todo = todo[np.argsort(n[todo] + m[todo], kind="stable")]
    while len(todo):
        size = max(1, CALL_CELLS // int(n[todo].max() + m[todo].max()))
        some, todo = todo[:size], todo[size:]
        a, b = _padded(first, some, n), _padded(second, some, m)
        ends = n[some] + m[some]
        for d, costs in warp(a, b, *_open_edges(len(some), a.shape[1], b.shape[1])):
            done = np.flatnonzero(ends == d)
            out[some[done]] = np.sqrt(costs[done, n[some[done]]])
    return out


def _padded(series: list, chosen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(chosen), int(sizes[chosen].max())))
    for row, k in enumerate(chosen):
        out[row, : sizes[k]] = series[k]
    return out


@pandas_udf(T.DoubleType())
def warp_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Distance of two arrays; NULL if one of them is missing or empty."""
    first = [x if x is not None else () for x in a]
    second = [x if x is not None else () for x in b]
    values = warp_distances(first, second)
    return pd.Series(values).astype(object).where(~np.isnan(values), None)


@pandas_udf(T.StructType([T.StructField("bottom", VALUES), T.StructField("right", VALUES)]))
def warp_tile(a: pd.Series, b: pd.Series, left: pd.Series, top: pd.Series) -> pd.DataFrame:
    """Last row and last column of one tile from its values and its two open edges."""
    bottoms, rights = [], []
    for x, y, lft, tp in zip(a, b, left, top):
        n, m = len(x), len(y)
        bottom, right = np.empty(m + 1), np.empty(n + 1)
        stack = [np.asarray(v, dtype=float)[None, :] for v in (x, y, lft, tp)]
        for d, costs in warp(*stack):
            if d >= n:
                bottom[d - n] = costs[0, n]
            if d >= m:
                right[d - m] = costs[0, d - m]
        bottoms.append(bottom)
        rights.append(right)
    return pd.DataFrame({"bottom": bottoms, "right": rights})


# -- arrays of ordered values ----------------------------------------------


def _known(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.isnan(column)


def ordered_arrays(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], also: list[Column] = ()
) -> DataFrame:
    """Known values of each column in order, as one array per group, and other aggregates.

    Only for groups of bounded size; see `value_blocks` for the others.
    """
    made = []
    for c in columns:
        item = F.struct(*order, F.col(c).alias("_v"))
        items = F.array_sort(F.collect_list(F.when(_known(c), item)))
        made.append(F.transform(items, lambda x: x["_v"]).alias(c))
    return df.groupBy(*keys).agg(*made, *also)


def value_blocks(
    df: DataFrame, keys: list[str], order: list[str], column: str, size: int
) -> DataFrame:
    """Known values of a column in order, as arrays of at most `size` values.

    Adds `Block`, counted from 0, and the group's number of `Blocks`.  Any
    length of group works: no array and no task grows with it.
    """
    known = df.where(_known(column)).select(*keys, *order, F.col(column).alias("_v"))
    placed = Series(known, keys, order).position("_n").rows()
    block = F.floor((F.col("_n") - 1) / size)
    arrays = ordered_arrays(placed.withColumn("Block", block), [*keys, "Block"], order, ["_v"])
    last = placed.groupBy(*keys).agg((F.floor((F.max("_n") - 1) / size) + 1).alias("Blocks"))
    # A long group has many blocks, so they are not gathered by the group's key if that can be helped.
    few = checked_broadcast(materialize(last)) if keys else last
    return _join(arrays, few, keys).withColumnRenamed("_v", column)


# -- distances -------------------------------------------------------------


def distances(
    samples: DataFrame,
    references: DataFrame,
    columns: dict[str, str],
    keys: list[str] = LAP_KEY,
    on: list[str] = DRIVER_KEY,
    order: list[str] = SAMPLE_ORDER,
) -> DataFrame:
    """Warping distance of each group of samples to its reference series.

    `references` holds the sample rows of one series per `on` value, `columns`
    maps a signal to the name of its distance.  Groups without a reference are
    left out; a group without known values gets NULL.
    """
    size = setting(samples.sparkSession, WARP_BLOCK, WARP_BLOCK_DEFAULT)
    signals = list(columns)
    long_laps, long_refs = hot_groups_of(
        [(samples, keys), (references, on)], size
    )
    short, long = _split(samples, long_laps, keys)
    ref_short, ref_long = _split(references, long_refs, on)

    parts = []
    refs = ordered_arrays(ref_short, on, order, signals)
    refs = refs.withColumnsRenamed({c: f"_ref_{c}" for c in signals})
    arrays = ordered_arrays(short, keys, order, signals)
    made = [warp_distance(f"_ref_{c}", c).alias(name) for c, name in columns.items()]
    tasks = _tasks(short, ref_short, keys, on)
    parts.append(_join(arrays, refs, on).repartition(tasks).select(*keys, *made))
    if long is not None:
        parts.append(_tiled(long, references, columns, keys, on, order, size))
    if ref_long is not None:
        parts.append(_tiled(short, ref_long, columns, keys, on, order, size))
    return reduce(DataFrame.unionByName, parts)


def _tasks(samples: DataFrame, references: DataFrame, keys: list[str], on: list[str]) -> int:
    """Tasks for the pairs of series, by the cells of their matrices; bytes say little here.

    Known sizes bound the cells: all samples times the longest reference.
    """
    all_rows, longest = most_rows(samples, []), most_rows(references, on)
    if all_rows is not None and longest is not None:
        return max(samples.sparkSession.sparkContext.defaultParallelism, all_rows * longest // TASK_CELLS)
    ours = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    theirs = references.groupBy(*on).agg(F.count(F.lit(1)).alias("_m"))
    cells = _join(ours, theirs, on).agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0]
    return max(samples.sparkSession.sparkContext.defaultParallelism, int((cells or 0) // TASK_CELLS))


def _split(df: DataFrame, hot: DataFrame | None, keys: list[str]):
    """Short and long series; how many are long is not bounded, so Spark picks the join."""
    if hot is None:
        return df, None
    if not keys:
        return df.limit(0), df
    return df.join(hot, keys, "left_anti"), df.join(hot.drop("_rows"), keys, "left_semi")


def _join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Without key columns there is one reference series for all groups."""
    return left.join(right, on) if on else left.join(F.broadcast(right))


def _tiled(samples, references, columns, keys, on, order, size) -> DataFrame:
    """Distances of pairs with at least one long series."""
    one = samples.select(*keys).distinct()
    groups = _join(one, references.select(*on).distinct(), on) if on else one
    for column, name in columns.items():
        made = _tiled_signal(samples, references, column, name, keys, on, order, size)
        groups = groups.join(made, keys, "left")
    return groups


def _tiled_signal(samples, references, column, name, keys, on, order, size) -> DataFrame:
    spark = samples.sparkSession
    ours = value_blocks(samples, keys, order, column, size)
    ours = ours.withColumnsRenamed({"Block": "I", "Blocks": "Is", column: "a"})
    refs = value_blocks(references, on, order, column, size)
    refs = refs.withColumnsRenamed({"Block": "J", "Blocks": "Js", column: "b"})
    ours, refs = materialize(ours), materialize(refs)

    target = scratch_path(spark, "warp")
    steps = (ours.agg(F.max("Is")).first()[0] or 0) + (refs.agg(F.max("Js")).first()[0] or 0) - 1
    empty = spark.createDataFrame([], ours.select(*keys).schema)
    result = empty.withColumn(name, F.lit(0.0))
    result.write.mode("append").parquet(target)

    inf, zero = F.lit(float("inf")), F.lit(0.0)
    edges = None
    for step in range(steps):
        # The tiles of this anti-diagonal only: J = step - I is part of the join key.
        tiles = ours.join(refs.withColumn("I", F.lit(step) - F.col("J")), [*on, "I"])
        corner = F.when((F.col("I") == 0) & (F.col("J") == 0), zero).otherwise(inf)
        top = F.concat(F.array(corner), F.array_repeat(inf, F.size("b")))
        left = F.concat(F.array(corner), F.array_repeat(inf, F.size("a")))
        if edges is not None:
            above = edges.select(*keys, (F.col("I") + 1).alias("I"), F.col("bottom").alias("_top"))
            beside = edges.select(*keys, "I", F.col("right").alias("_left"))
            tiles = tiles.join(above, [*keys, "I"], "left").join(beside, [*keys, "I"], "left")
            top = F.when(F.col("I") > 0, F.col("_top")).otherwise(top)
            left = F.when(F.col("J") > 0, F.col("_left")).otherwise(left)
        done = tiles.withColumn("_t", warp_tile("a", "b", left, top))
        edges = materialize(done.select(*keys, "I", "J", "Is", "Js", "_t.*"))
        last = (F.col("I") == F.col("Is") - 1) & (F.col("J") == F.col("Js") - 1)
        ended = edges.where(last).select(
            *keys, F.sqrt(F.element_at("bottom", -1)).alias(name)
        )
        ended.write.mode("append").parquet(target)
    return spark.read.schema(result.schema).parquet(target)


# -- driving style ---------------------------------------------------------


def reference_laps(quali: DataFrame, race: DataFrame) -> DataFrame:
    """Each driver's fastest qualifying lap, or fastest race lap if there is none."""
    best = fastest_lap(quali, DRIVER_KEY).select(*LAP_KEY, F.lit("Q").alias("Session"))
    fallback = fastest_lap(race, DRIVER_KEY, personal_best_only=False)
    fallback = fallback.join(best.select(*DRIVER_KEY), DRIVER_KEY, "left_anti")
    return best.unionByName(fallback.select(*LAP_KEY, F.lit("R").alias("Session")))


def reference_signal(
    quali: DataFrame, quali_tel: DataFrame, race: DataFrame, race_tel: DataFrame
) -> DataFrame:
    """Samples of each driver's reference lap with their accelerations.

    Laps are whole groups of the acceleration windows, so the few reference laps
    are picked before anything is computed.
    """
    chosen = reference_laps(quali, race)

    def of(samples: DataFrame, session: str) -> DataFrame:
        laps = chosen.where(F.col("Session") == session)
        return hand_down(samples.join(laps, LAP_KEY, "left_semi"), samples)

    both = of(quali_tel, "Q"), of(race_tel, "R")
    made = accelerations(hand_down(both[0].unionByName(both[1]), *both))
    # A driver has one reference lap.
    longest = most_rows(made, LAP_KEY)
    return made if longest is None else know(made, Sizes(tuple(DRIVER_KEY), longest))


STYLE = {"LonAcc": "LonDistanceDTW", "LatAcc": "LatDistanceDTW"}


def distances_to_best(laps: DataFrame, cells: int) -> DataFrame:
    """Distance of every lap to its driver's reference among these laps, per direction.

    Laps hold the known values of each signal as an array, which the distances replace.  The
    reference is that of `reference_laps` with one session: the fastest personal best, or the
    fastest lap if there is none.  Laps of a driver without a timed lap get NULL.  `cells` bounds
    the cells of all matrices.
    """
    slower = F.struct(~F.coalesce("IsPersonalBest", F.lit(False)), "LapTime_s", "LapNumber")
    best = F.min_by(F.struct(*STYLE), F.when(F.col("LapTime_s").isNotNull(), slower))
    both = attach_totals(laps, DRIVER_KEY, {"_best": best})
    tasks = max(laps.sparkSession.sparkContext.defaultParallelism, cells // TASK_CELLS)
    # Spark repeats a deterministic call in filters on its result, before the laps are spread.
    once = pandas_udf(warp_distance.func, T.DoubleType()).asNondeterministic()
    made = [once(f"_best.{c}", c).alias(name) for c, name in STYLE.items()]
    return hand_down(both.repartition(tasks).select("*", *made).drop("_best", *STYLE), laps)


def style_distances(race_acc: DataFrame, references: DataFrame) -> DataFrame:
    """Distance of every race lap to its driver's reference lap, per direction."""
    return distances(race_acc, references, STYLE)
