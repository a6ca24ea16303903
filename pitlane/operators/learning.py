"""Encoding, scaling, splitting and regression of laps with Spark ML."""

from __future__ import annotations

import math
import os
import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.constants import MODEL_FEATURES
from pitlane.functions.durations import durations_to_seconds
from pitlane.functions.scalars import clean_inf
from pitlane.operators.laps import renumber_laps
from pitlane.operators.statistics import standard_scale
from pitlane.operators.series import Series, Sizes, checked_broadcast, hand_down, know
from pitlane.settings import materialize, scratch_path

VECTOR = "_features"


# -- preparation -----------------------------------------------------------


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace text columns by the rank of their value, from 0; NULL stays NULL.

    One grouping of (column, value) pairs gives the dictionaries of all columns, written once
    and counted while written; ranks come from the distinct values only, numbered over a
    range shuffle if there are too many for one task.
    """
    spark = df.sparkSession
    pairs = F.array(*[F.struct(F.lit(i).alias("_of"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(columns)])
    values = df.select(F.explode(pairs).alias("_p")).select("_p.*").where("_value IS NOT NULL").distinct()
    seen, path = Observation(), scratch_path(spark, "dictionary")
    values.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = seen.get["rows"]
    stored = know(spark.read.schema(values.schema).parquet(path), Sizes((), rows))
    ranks = Series(stored, ["_of"], ["_value"]).position("_rank").rows()
    for i, c in enumerate(columns):
        own = ranks.where(F.col("_of") == i)
        codes = own.select(F.col("_value").cast(df.schema[c].dataType).alias(c), (F.col("_rank") - 1).cast("int").alias("_code"))
        # Few values with many rows each would gather in few tasks, so their codes are broadcast.
        df = df.join(checked_broadcast(codes, rows), c, "left").drop(c).withColumnRenamed("_code", c)
    return df


# A bin of a histogram is looked into only down to so many rows.
BIN_ROWS = 5_000
DIGITS = 4


def sort_code(df: DataFrame, order: list[str]) -> Column | None:
    """Text of hexadecimal digits that sorts like the order columns; None for types without such a text."""
    parts = []
    for c in order:
        kind, value = df.schema[c].dataType, F.col(c)
        if isinstance(kind, T.StringType):
            code = F.hex(F.encode(value, "UTF-8"))
        elif isinstance(kind, T.IntegralType):
            code = F.lpad(F.hex(value.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
        else:
            return None
        # A blank sorts before every digit; missing values come first.
        parts.append(F.coalesce(F.concat(F.lit("1"), code, F.lit(" ")), F.lit("0 ")))
    return F.concat(*parts)


def rank_cuts(codes: DataFrame, ranks: Callable[[int], list[int]], skip: int = 0) -> list[str | None]:
    """The codes (column `code`) at some 1-based ranks; None beyond the last row.

    A histogram of the leading digits shows in which bins the ranks fall; only those bins are
    divided again, until few rows are left to look at.  Nothing is numbered or moved.
    """
    def histogram(width: int, rows: DataFrame) -> dict[str, int]:
        bins = rows.groupBy(F.substring("code", 1, width).alias("bin")).count()
        return {r.bin: r["count"] for r in bins.collect()}

    width = skip + DIGITS
    bins = histogram(width, codes)
    wanted = ranks(sum(bins.values()))

    def places(bins: dict[str, int], ranks_in: dict[int, int]) -> dict[int, tuple[str, int, int]]:
        """{index of the rank: (bin, rank inside it, rows of the bin)}."""
        out, order, before, at = {}, sorted(ranks_in, key=ranks_in.get), 0, 0
        for name in sorted(bins):
            while at < len(order) and ranks_in[order[at]] <= before + bins[name]:
                out[order[at]] = (name, ranks_in[order[at]] - before, bins[name])
                at += 1
            before += bins[name]
        return out

    found = places(bins, dict(enumerate(wanted)))
    done: dict[int, str] = {}
    while True:
        open_ = {i: p for i, p in found.items() if p[2] > BIN_ROWS and i not in done}
        if not open_:
            break
        inside = codes.where(F.substring("code", 1, width).isin(sorted({p[0] for p in open_.values()})))
        width += DIGITS
        deeper = histogram(width, inside)
        for i, (name, rank, _) in open_.items():
            mine = {b: n for b, n in deeper.items() if b.startswith(name)}
            found[i] = places(mine, {i: rank})[i]
            if all(len(b) < width for b in mine) or found[i][0] == name:
                done[i] = found[i][0]  # equal codes, which no longer prefix divides
    ask = {i: p for i, p in found.items() if i not in done}
    if ask:
        tests = [F.col("code").startswith(name) for name in sorted({p[0] for p in ask.values()})]
        few = sorted(r.code for r in codes.where(reduce(lambda a, b: a | b, tests)).collect())
        for i, (name, rank, _) in ask.items():
            done[i] = [c for c in few if c.startswith(name)][rank - 1]
    return [done.get(i) for i in range(len(wanted))]


def _common(codes: DataFrame) -> int:
    """How many leading digits all codes share."""
    low, high = codes.agg(F.min("code"), F.max("code")).first()
    return len(os.path.commonprefix([low or "", high or ""]))


def _parts(df: DataFrame, order: list[str], starts: Callable[[int], list[int]], code: Column | None = None) -> DataFrame:
    """Add `_part`: how many of the given parts start at or before the row.

    `starts` gives the 1-based first ranks of the parts after the first one for a number of
    rows.  The codes found at those ranks are literals in the plan of the whole table.
    """
    made = sort_code(df, order) if code is None else code
    if made is None:
        return _parts_by_position(df, order, starts)
    codes = df.select(made.alias("code"))
    cuts = rank_cuts(codes, starts, 0 if code is not None else _common(codes))
    at_or_after = [F.when(made >= F.lit(c), 1).otherwise(0) for c in cuts if c is not None]
    return df.withColumn("_part", reduce(lambda a, b: a + b, at_or_after, F.lit(0)))


def _parts_by_position(df: DataFrame, order: list[str], starts: Callable[[int], list[int]]) -> DataFrame:
    """`_parts` for order columns without a sort code: rows are numbered, only their order columns move."""
    narrow = materialize(df.select(*order))
    placed = Series(narrow, [], order).position("_at").rows()
    first = placed.where(F.col("_at").isin(starts(narrow.count())))
    bounds = first.agg(F.collect_list(F.struct(*order)).alias("_bounds"))
    wide = df.join(F.broadcast(bounds))
    row = F.struct(*order)
    part = F.size(F.filter("_bounds", lambda start: start <= row))
    return wide.withColumn("_part", part).drop("_bounds")


def train_test_split(
    df: DataFrame, keys: list[str], share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `Part`: the first ceil(share * n) rows by a seeded hash of the keys are "test".

    The hash is the MD5 of the keys and the seed joined by ``|``, so any engine can repeat it.
    Rows with equal keys are in one part.
    """
    code = F.md5(F.concat_ws("|", *keys, F.lit(seed)).cast("binary"))
    parted = _parts(df, keys, lambda n: [math.ceil(n * share) + 1], code)
    part = F.when(F.col("_part") == 0, "test").otherwise("train")
    return parted.withColumn("Part", part).drop("_part")


def kfold(df: DataFrame, order: list[str], folds: int = 5) -> DataFrame:
    """Add `Fold`, 0-based contiguous folds; the first n % k are one row longer."""

    def starts(n: int) -> list[int]:
        return [i * (n // folds) + min(i, n % folds) + 1 for i in range(1, folds)]

    return _parts(df, order, starts).withColumnRenamed("_part", "Fold")


def model_dataset(
    season: DataFrame,
    features: list[str] = MODEL_FEATURES,
    label: str = "LapTime",
    keep: list[str] | None = None,
) -> DataFrame:
    """Clean laps for the models, in the order the steps depend on each other.

    Infinite values count as missing, incomplete laps go, durations become
    seconds, and laps are renumbered per driver and track.
    """
    known = hand_down(durations_to_seconds(clean_inf(season).dropna()), season)
    numbered = renumber_laps(known, ["Driver", "Track"], ["LapNumber", "Year"])
    return numbered.select(*(keep or ["Year", "Track", "Driver", "LapNumber"]), *features, label)


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VECTOR).transform(df)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows from a scratch table: made once, read by column as often as needed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- models ----------------------------------------------------------------


@dataclass
class Fitted:
    """A trained model that scores rows and keeps their other columns."""

    model: Model
    features: list[str]

    def score(self, df: DataFrame, name: str = "Prediction") -> DataFrame:
        scored = self.model.transform(assemble(df, self.features))
        return scored.withColumnRenamed("prediction", name).drop(VECTOR)


def _fit(estimator, df: DataFrame, features: list[str], label: str) -> Fitted:
    estimator = estimator.setFeaturesCol(VECTOR).setLabelCol(label)
    known = df.select(*features, F.col(label).cast("double").alias(label)).dropna()
    return Fitted(estimator.fit(assemble(known, features)), features)


# Rows, mean label and squared error around that mean of a set of equal rows.
COUNT, MEAN, AROUND = "_rows", "_mean", "_around"


def alike(df: DataFrame, features: list[str], label: str, also: list[Column] = ()) -> DataFrame:
    """One row per distinct (features, `also`) with its number of rows, mean label and error around it.

    A squared-error model sees no more of rows with equal features than this: weighted by
    their number, their mean gives the same gains and the same estimates.  Rows with a
    missing feature or label are left out.
    """
    known = df.withColumn(label, F.col(label).cast("double")).dropna(subset=[*features, label])
    rows = F.count(F.lit(1)).cast("double")
    return known.groupBy(*features, *also).agg(
        rows.alias(COUNT), F.avg(label).alias(MEAN), (F.var_pop(label) * rows).alias(AROUND)
    )


def linear(df: DataFrame, features: list[str], label: str) -> Fitted:
    """Least squares without regularisation, by one pass of normal equations."""
    return _fit(LinearRegression(solver="normal"), df, features, label)


def tree(
    df: DataFrame, features: list[str], label: str, depth: int = 5, leaf: int = 1, seed: int = 12, bins: int = 32
) -> Fitted:
    """A regression tree; with more `bins` than a feature has values every split is tried."""
    made = DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=leaf, seed=seed, maxBins=bins)
    return _fit(made, df, features, label)


def boosted(df: DataFrame, features: list[str], label: str, seed: int = 42, **params) -> Fitted:
    """Gradient-boosted trees; parameters under their Spark names.

    Rounds run on the rows that are alike, unless rows are drawn or counted one by one.
    """
    made = GBTRegressor(seed=seed, **params)
    if made.getSubsamplingRate() < 1 or made.getMinInstancesPerNode() > 1 or made.getLossType() != "squared" or made.isDefined("weightCol"):
        return _fit(made, df, features, label)
    made = made.setFeaturesCol(VECTOR).setLabelCol(MEAN).setWeightCol(COUNT)
    return Fitted(made.fit(assemble(alike(df, features, label), features)), features)


def coefficients(fitted: Fitted) -> DataFrame:
    """One row per term with its estimate; the intercept is the term ``const``."""
    model = fitted.model
    rows = [*zip(fitted.features, map(float, model.coefficients)), ("const", float(model.intercept))]
    return model.summary.predictions.sparkSession.createDataFrame(rows, "term string, coef double")


def ols_summary(fitted: Fitted) -> DataFrame:
    """Estimate, standard error, t and p per term, with R2 and adjusted R2."""
    model, s = fitted.model, fitted.model.summary
    terms = [*fitted.features, "const"]
    estimates = [*map(float, model.coefficients), float(model.intercept)]
    rows = list(
        zip(
            terms, estimates, s.coefficientStandardErrors, s.tValues, s.pValues,
            [s.r2] * len(terms), [s.r2adj] * len(terms),
        )
    )
    schema = (
        "term string, coef double, std_err double, t double, p double, r2 double, r2_adj double"
    )
    return s.predictions.sparkSession.createDataFrame(rows, schema)


def partial_effect(
    fitted: Fitted, df: DataFrame, feature: str, square: str, points: int = 100
) -> DataFrame:
    """Predicted label over a grid of one feature from 0 to its maximum.

    `square` is the column holding the feature's square; all other features stay
    at their mean.
    """
    others = [c for c in fitted.features if c not in (feature, square)]
    stats = df.agg(F.max(feature).alias("_max"), *[F.avg(c).alias(c) for c in others])
    weight = dict(zip(fitted.features, map(float, fitted.model.coefficients)))
    fixed: Column = F.lit(float(fitted.model.intercept))
    for c in others:
        fixed = fixed + weight[c] * F.col(c)
    grid = df.sparkSession.range(points).join(F.broadcast(stats))
    x = F.col("id") * F.col("_max") / (points - 1)
    curve = grid.select(x.alias(feature), fixed.alias("_fixed"))
    effect = weight[feature] * F.col(feature) + weight[square] * F.col(feature) * F.col(feature)
    return curve.select(feature, (F.col("_fixed") + effect).alias("Prediction"))


def importances(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Importance of each feature of a tree model, largest first."""
    rows = list(zip(fitted.features, fitted.model.featureImportances.toArray().tolist()))
    made = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return made.orderBy(F.col("importance").desc(), "feature")


def mse(df: DataFrame, label: str, prediction: str = "Prediction") -> float:
    made = RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="mse")
    return made.evaluate(df)


def cross_validated_mse(
    df: DataFrame, features: list[str], label: str, order: list[str], folds: int = 5
) -> float:
    """Mean squared error of the linear model over contiguous folds.

    The rows are made once and stored, as several passes look for the cuts between folds;
    fits and errors take the rows that are alike.
    """
    columns = list(dict.fromkeys([*order, *features, label]))
    known = stored(df.dropna(subset=columns).select(*columns), "folds")
    rows = assemble(alike(kfold(known, order, folds), features, label, [F.col("Fold")]), features)
    rows = rows.select(VECTOR, "Fold", COUNT, MEAN, AROUND).persist()
    model = LinearRegression(solver="normal", featuresCol=VECTOR, labelCol=MEAN, weightCol=COUNT)

    def fold_error(i: int) -> float:
        scored = model.fit(rows.where(F.col("Fold") != i)).transform(rows.where(F.col("Fold") == i))
        error = F.col(AROUND) + F.col(COUNT) * (F.col(MEAN) - F.col("prediction")) ** 2
        value = scored.agg(F.sum(error) / F.sum(COUNT)).first()[0]
        if value is None:
            raise ValueError(f"fold {i} has no rows")
        return value

    try:
        with ThreadPool(folds) as pool:
            return sum(pool.map(fold_error, range(folds))) / folds
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class Range:
    """The values a parameter may take: numbers from low to high, whole or not, or as text."""

    low: float
    high: float
    whole: bool = False
    text: bool = False

    def __call__(self, draw: random.Random) -> float:
        return draw.randint(int(self.low), int(self.high)) if self.whole else draw.uniform(self.low, self.high)

    def bells(self, values: list[float]) -> list[tuple[float, float]]:
        """(centre, width) around each value: as wide as the larger gap beside it."""
        order = [self.low, *sorted(values), self.high]
        least = (self.high - self.low) / min(100, len(values) + 1)
        return [(v, max(v - before, after - v, least)) for before, v, after in zip(order, order[1:], order[2:])]

    def near(self, bells: list[tuple[float, float]], draw: random.Random) -> float:
        """A draw from one of the bells, or now and then from the whole range."""
        i = draw.randrange(len(bells) + 1)
        if i == len(bells):
            return self(draw)
        value = min(max(draw.gauss(*bells[i]), self.low), self.high)
        return round(value) if self.whole else value

    def density(self, value: float, bells: list[tuple[float, float]]) -> float:
        even = 1 / (self.high - self.low)
        return (sum(math.exp(-(((value - c) / w) ** 2) / 2) / (2.5066 * w) for c, w in bells) + even) / (len(bells) + 1)


# Search spaces: parameter name and its range.
TREE_SPACE = {"maxDepth": Range(2, 20, whole=True), "minInstancesPerNode": Range(1, 10, whole=True)}
BOOSTED_SPACE = {
    "maxDepth": Range(3, 10, whole=True),
    "stepSize": Range(0.01, 0.3),
    "maxIter": Range(50, 300, whole=True),
    "minInstancesPerNode": Range(1, 7, whole=True),
    "subsamplingRate": Range(0.6, 1.0),
    "featureSubsetStrategy": Range(0.6, 1.0, text=True),
    "minInfoGain": Range(0.0, 5.0),
}
WARM_UP, GOOD_SHARE, CANDIDATES = 8, 0.15, 24


def next_trial(space: dict, tried: list[tuple[dict, float]], draw: random.Random) -> dict:
    """Parameters worth trying next.

    The first trials are even draws.  Later, of every parameter some values are drawn near
    those of the best trials, and the one is taken whose density among the
    good trials is highest against its density among the others.
    """
    ranged = all(isinstance(r, Range) for r in space.values())
    if len(tried) < WARM_UP or not ranged:
        return {name: pick(draw) for name, pick in space.items()}
    order = sorted(tried, key=lambda t: t[1])
    size = max(2, math.ceil(GOOD_SHARE * len(order)))
    good, bad = order[:size], order[size:]
    made = {}
    for name, r in space.items():
        best, rest = (r.bells([t[0][name] for t in part]) for part in (good, bad))
        options = [r.near(best, draw) for _ in range(CANDIDATES)]
        made[name] = max(options, key=lambda v: r.density(v, best) / r.density(v, rest))
    return made


def adaptive_search(
    space: dict, evaluate: Callable[[list[dict]], list[float]], trials: int, batch: int = 4, seed: int = 42
) -> list[tuple[dict, float]]:
    """Parameters and scores of all trials; `batch` of them are evaluated at once, then the next are drawn."""
    draw = random.Random(seed)
    tried: list[tuple[dict, float]] = []
    while len(tried) < trials:
        some = [next_trial(space, tried, draw) for _ in range(min(batch, trials - len(tried)))]
        tried += zip(some, evaluate(some), strict=True)
    return tried


def _grown(estimator, train: DataFrame, rows: float, depth: int, leaf: int) -> DecisionTreeRegressionModel:
    """A tree on weighted rows whose leaves have at least `leaf` of the `rows` original ones."""
    made = estimator.copy().setLabelCol(MEAN).setWeightCol(COUNT).setMinInstancesPerNode(1)
    if 2 * leaf > rows:
        return made.setMaxDepth(0).fit(train)
    return made.setMaxDepth(depth).setMinWeightFractionPerNode((leaf - 0.5) / rows).fit(train)


def _errors_by_depth(model: DecisionTreeRegressionModel, test: DataFrame, depth: int) -> list[float]:
    """Squared error over the weighted rows of `test` of the tree cut at depth 0, 1, ... `depth`.

    Trees grow level by level, so a tree of less depth is the upper part of a deeper one.
    """
    spark = test.sparkSession
    path = scratch_path(spark, "tree")
    model.write().save(path)
    # The nodes of one model, which the driver has made.
    nodes = spark.read.parquet(f"{path}/data").orderBy("id").toPandas()
    feature = np.array([s["featureIndex"] for s in nodes["split"]])
    limit = np.array([s["leftCategoriesOrThreshold"][0] if s["featureIndex"] >= 0 else 0.0 for s in nodes["split"]])
    left, right, value = (nodes[c].to_numpy() for c in ("leftChild", "rightChild", "prediction"))

    def descend(parts):
        for rows in parts:
            x, at = np.array(rows["_x"].tolist()).reshape(len(rows), -1), np.zeros(len(rows), dtype=int)
            errors = []
            for _ in range(depth + 1):
                errors.append(float((rows[AROUND] + rows[COUNT] * (rows[MEAN] - value[at]) ** 2).sum()))
                low = x[np.arange(len(at)), feature[at]] <= limit[at]
                at = np.where(left[at] < 0, at, np.where(low, left[at], right[at]))
            yield pd.DataFrame({"depth": range(depth + 1), "error": errors})

    few = test.select(vector_to_array(VECTOR).alias("_x"), COUNT, MEAN, AROUND)
    sums = few.mapInPandas(descend, "depth int, error double").groupBy("depth").agg(F.sum("error").alias("error"))
    found = {r.depth: r.error for r in sums.collect()}
    return [found[d] for d in range(depth + 1)]


def _thresholds(counts: np.ndarray, values: np.ndarray, number: int, bins: int) -> np.ndarray:
    """Where Spark's trees may split a feature: between all its sorted `values`, or near even shares of `number` rows."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    stride = number / bins
    found, target, seen = [], stride, counts[0]
    for i, count in enumerate(counts[1:].tolist()):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            found.append(middle[i])
            target += stride
    return np.array(found)


def _variance(weight: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight > 0, (squares - total * total / weight) / weight, 0.0)


def _level(
    x: np.ndarray, sums: list[np.ndarray], node: np.ndarray, variance: np.ndarray | None, splits: list[int], least: float, gain: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node: the feature (-1: none) and bin of its best split, and the variance of its two children.

    `x` holds the bins of the rows, `sums` their weight, sum and sum of squares, `node` their node,
    `variance` that of the nodes (None: of the root, from its first split).  Sums, their order, gains
    and ties are Spark's: the first of equal splits wins.
    """
    n = 1 if variance is None else len(variance)
    best, at, which = np.full(n, -np.inf), np.zeros(n, np.int64), np.full(n, -1)
    below = np.zeros((n, 2))
    for f, cuts in enumerate(splits):
        if not cuts:
            continue
        for low in range(0, n, 8192):
            high = min(n, low + 8192)
            # Rows are ordered by node.
            a, b = np.searchsorted(node, (low, high))
            cell = (node[a:b] - low) * (cuts + 1) + x[a:b, f]
            upto = [np.bincount(cell, s[a:b], (high - low) * (cuts + 1)).reshape(-1, cuts + 1).cumsum(axis=1) for s in sums]
            left, whole = [u[:, :-1] for u in upto], [u[:, -1:] for u in upto]
            right = [w - u for w, u in zip(whole, left)]
            near, far = _variance(*left), _variance(*right)
            if variance is None:
                variance = _variance(*[u[:, 0] + v[:, 0] for u, v in zip(left, right)])
            gains = variance[low:high, None] - left[0] / whole[0] * near - right[0] / whole[0] * far
            gains[(left[0] < least) | (right[0] < least) | (gains < gain)] = -np.inf
            pick = gains.argmax(axis=1)
            rows = np.arange(high - low)
            better = np.flatnonzero(gains[rows, pick] > best[low:high])
            chosen = pick[better]
            best[low + better], at[low + better], which[low + better] = gains[better, chosen], chosen, f
            below[low + better] = np.stack((near[better, chosen], far[better, chosen]), axis=1)
    which[best <= 0] = -1
    return which, at, below


def _grow(x, sums, tested, errors, splits: list[int], least: float, depth: int, gain: float) -> list[float]:
    """Squared error of the tested rows at depth 0, 1, ... `depth` of the tree that the rows (x, sums) give.

    Of the tested rows `errors` has the weight, mean and squared error around the mean.
    """
    node, at = np.zeros(len(x), np.int64), np.zeros(len(tested), np.int64)
    weight, mean, around = errors
    predicted = np.full(1, sums[1].sum() / sums[0].sum())
    guess = np.full(len(tested), predicted[0])
    found, variance = [], None
    for level in range(depth + 1):
        found.append(float((around + weight * (mean - guess) ** 2).sum()))
        if level == depth:
            break
        which, bin_, below = _level(x, sums, node, variance, splits, least, gain)
        # Spark makes a leaf of what has no variance.
        split = (which >= 0) & (True if variance is None else np.abs(variance) >= 2.0**-52)
        if not split.any():
            break
        base = np.cumsum(split) * 2 - 2
        sides = []
        for rows, place in ((x, node), (tested, at)):
            inside = np.flatnonzero((place >= 0) & split[place])
            own = place[inside]
            child = base[own] + (rows[inside, which[own]] > bin_[own])
            sides.append((inside, child))
        (kept, child), (met, child_met) = sides
        n = 2 * int(split.sum())
        predicted = np.bincount(child, sums[1][kept], n) / np.bincount(child, sums[0][kept], n)
        guess[met] = predicted[child_met]
        variance = below[split].reshape(-1)
        order = np.argsort(child, kind="stable")
        x, sums, node = x[kept][order], [v[kept][order] for v in sums], child[order]
        at = np.full(len(tested), -1)
        at[met] = child_met
    return found


# Distinct values by fold and feature that the driver may see, and cells of a fold that a task may hold.
FEW_VALUES, FEW_CELLS = 500_000, 2_000_000


class Cells:
    """Rows by the bins of their features, apart for each fold that is left out.

    A tree sees no more of a feature than its bins, so a fold has at most as many cells as bins
    can be combined, however long the table is, and one task can grow a tree of it.
    """

    def __init__(self, rows: DataFrame, sizes: dict[int, float], splits: dict[int, list[np.ndarray]]):
        self.splits, self.sizes = splits, sizes
        width = len(next(iter(splits.values())))
        self.names = [f"_x{f}" for f in range(width)]
        middle = rows.agg(F.sum(F.col(COUNT) * F.col(MEAN)) / F.sum(COUNT)).first()[0]

        def binned(parts):
            for batch in parts:
                x = np.array(batch["_x"].tolist()).reshape(len(batch), width)
                w, m, around = (batch[c].to_numpy() for c in (COUNT, MEAN, AROUND))
                for fold, limits in splits.items():
                    test = batch["_fold"].to_numpy() == fold
                    bins = {f"_x{f}": np.searchsorted(limit, x[:, f]).astype(np.int32) for f, limit in enumerate(limits)}
                    # Errors are summed around the middle, where little is lost.
                    label = np.where(test, m - middle, m)
                    yield pd.DataFrame({"_out": fold, "_test": test, **bins, "_w": w, "_s": w * label, "_q": w * label * label + np.where(test, around, 0.0)})

        schema = "_out long, _test boolean, " + ", ".join(f"{x} int" for x in self.names) + ", _w double, _s double, _q double"
        few = rows.select(vector_to_array(VECTOR).alias("_x"), F.col("_fold").cast("long").alias("_fold"), COUNT, MEAN, AROUND)
        sums = [F.sum(c).alias(c) for c in ("_w", "_s", "_q")]
        self.rows = stored(few.mapInPandas(binned, schema).groupBy("_out", "_test", *self.names).agg(*sums), "cells")
        self.most = self.rows.groupBy("_out").count().agg(F.max("count")).first()[0]
        self.middle = middle

    def errors(self, jobs: list[tuple[int, int, int]], gain: float) -> dict[tuple[int, int, int], list[float]]:
        """Squared errors by depth of the trees asked for as (depth, least rows of a leaf, fold left out)."""
        spark, names, middle, sizes, splits = self.rows.sparkSession, self.names, self.middle, self.sizes, self.splits
        asked = spark.createDataFrame([(i, *job) for i, job in enumerate(jobs)], "_job int, _depth int, _leaf int, _out long")

        def grow(key, cells):
            depth, leaf, fold = (int(cells[c].iloc[0]) for c in ("_depth", "_leaf", "_out"))
            test = cells["_test"].to_numpy()
            x = cells[names].to_numpy()
            w, s, q = (cells[c].to_numpy() for c in ("_w", "_s", "_q"))
            number = sum(v for k, v in sizes.items() if k != fold)
            mean = s[test] / w[test]
            around = np.maximum(q[test] - s[test] * mean, 0.0)
            found = _grow(
                x[~test], [v[~test] for v in (w, s, q)], x[test], (w[test], mean + middle, around), [len(c) for c in splits[fold]],
                (leaf - 0.5) / number * number, depth if 2 * leaf <= number else 0, gain,
            )
            return pd.DataFrame({"_job": [key[0]], "errors": [found + found[-1:] * (depth + 1 - len(found))]})

        dealt = self.rows.join(F.broadcast(asked), "_out").repartition(len(jobs), "_job")
        made = dealt.groupBy("_job").applyInPandas(grow, "_job int, errors array<double>").collect()
        return {jobs[r["_job"]]: list(r["errors"]) for r in made}


def cells_of(estimator, rows: DataFrame, sizes: dict[int, float]) -> Cells | None:
    """The cells of `rows`, or None if there are too many distinct values or cells, or coded categories."""
    if any(f.name == VECTOR and "nominal" in f.metadata.get("ml_attr", {}).get("attrs", {}) for f in rows.schema.fields):
        return None
    each = rows.select("_fold", COUNT, F.posexplode(vector_to_array(VECTOR)).alias("_feature", "_value"))
    values = stored(each.groupBy("_feature", "_value", "_fold").agg(F.sum(COUNT).alias("rows"), F.count(F.lit(1)).alias("alike")), "values")
    if values.limit(FEW_VALUES + 1).count() > FEW_VALUES:
        return None
    seen = values.toPandas()
    splits = {}
    for fold in sizes:
        train = seen[seen["_fold"] != fold]
        if not len(train):
            raise ValueError(f"all rows are in fold {fold}")
        # As many bins as there are rows at most.
        bins = min(estimator.getMaxBins(), int(train.loc[train["_feature"] == 0, "alike"].sum()))
        splits[fold] = []
        for _, own in train.groupby("_feature"):
            counted = own.groupby("_value")["rows"].sum().sort_index()
            splits[fold].append(_thresholds(counted.to_numpy(), counted.index.to_numpy(), counted.sum(), bins))
    made = Cells(rows, sizes, splits)
    return made if made.most <= FEW_CELLS else None


class TreeTrials:
    """Cross-validated errors of regression trees by depth and least rows of a leaf.

    One tree for each fold and least number serves all depths up to its own.  Trees grow in
    tasks on the cells of a fold (`Cells`), all that are asked for in one job; where there are
    too many cells Spark fits them, on rows that are alike.
    """

    def __init__(self, estimator, rows: DataFrame):
        self.estimator, self.rows = estimator, rows
        self.sizes = {r._fold: r.rows for r in rows.groupBy("_fold").agg(F.sum(COUNT).alias("rows")).collect()}
        self.folds = sorted(self.sizes)
        self.known: dict[int, list[float]] = {}
        self.cells = cells_of(estimator, rows, self.sizes)

    def __call__(self, some: list[dict], pool: ThreadPool) -> list[float]:
        asked = [(self._of(t, "minInstancesPerNode"), self._of(t, "maxDepth")) for t in some]
        deepest: dict[int, int] = {}
        for leaf, depth in asked:
            if depth >= len(self.known.get(leaf, [])):
                deepest[leaf] = max(depth, deepest.get(leaf, 0))
        # The longest fits first.
        jobs = sorted(((depth, leaf, i) for leaf, depth in deepest.items() for i in self.folds), reverse=True)
        if self.cells and jobs:
            sums = self.cells.errors(jobs, self.estimator.getMinInfoGain())
            made = {job: [e / self.sizes[job[2]] for e in errors] for job, errors in sums.items()}
        else:
            made = dict(zip(jobs, pool.map(self._fold_errors, jobs, chunksize=1)))
        for leaf, depth in deepest.items():
            each = [made[depth, leaf, i] for i in self.folds]
            self.known[leaf] = [sum(errors) / len(each) for errors in zip(*each)]
        return [self.known[leaf][depth] for leaf, depth in asked]

    def _of(self, trial: dict, name: str) -> int:
        return trial.get(name, self.estimator.getOrDefault(name))

    def _fold_errors(self, job: tuple[int, int, int]) -> list[float]:
        depth, leaf, i = job
        others = sum(n for fold, n in self.sizes.items() if fold != i)
        model = _grown(self.estimator, self.rows.where(F.col("_fold") != i), others, depth, leaf)
        return [e / self.sizes[i] for e in _errors_by_depth(model, self.rows.where(F.col("_fold") == i), depth)]


def tune(
    estimator,
    space: dict,
    df: DataFrame,
    features: list[str],
    label: str,
    trials: int = 30,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
) -> tuple[Fitted, DataFrame]:
    """Adaptive search for the parameters with the least cross-validated MSE.

    `parallelism` trials are fitted at once.  Returns the model refitted with the best
    parameters and one row per trial.  Regression trees of which only depth and least rows
    of a leaf are searched share fits (`TreeTrials`).
    """
    estimator = estimator.setFeaturesCol(VECTOR).setLabelCol(label)

    def settings(trial: dict) -> dict:
        text = {n for n, r in space.items() if isinstance(r, Range) and r.text}
        return {estimator.getParam(n): str(v) if n in text else v for n, v in trial.items()}

    known = df.select(*features, F.col(label).cast("double").alias(label)).dropna()
    fold = (F.abs(F.xxhash64(F.lit(seed), *known.columns) % folds)).alias("_fold")
    if isinstance(estimator, DecisionTreeRegressor) and set(space) <= {"maxDepth", "minInstancesPerNode"}:
        # Least squares of a leaf need no more than the alike rows, but labels decide on the fold.
        rows = assemble(alike(known, features, label, [fold]), features).select(VECTOR, "_fold", COUNT, MEAN, AROUND).persist()
        try:
            with ThreadPool(parallelism) as pool:
                trials_of = TreeTrials(estimator, rows)
                tried = adaptive_search(space, lambda some: trials_of(some, pool), trials, parallelism, seed)
            best = min(tried, key=lambda t: t[1])[0]
            whole = sum(trials_of.sizes.values())
            leaf, depth = (trials_of._of(best, name) for name in ("minInstancesPerNode", "maxDepth"))
            model = _grown(estimator, rows, whole, depth, leaf)
        finally:
            rows.unpersist()
        return Fitted(model, features), _trials(df, tried)
    ready = assemble(known.select("*", fold), features).select(VECTOR, label, "_fold").persist()
    try:
        judge = RegressionEvaluator(labelCol=label, metricName="mse")

        def fold_error(job: tuple[dict, int]) -> float:
            trial, i = job
            model = estimator.fit(ready.where(F.col("_fold") != i), settings(trial))
            return judge.evaluate(model.transform(ready.where(F.col("_fold") == i)))

        def evaluate(some: list[dict]) -> list[float]:
            with ThreadPool(parallelism) as pool:
                errors = pool.map(fold_error, [(t, i) for t in some for i in range(folds)])
            return [sum(errors[i : i + folds]) / folds for i in range(0, len(errors), folds)]

        tried = adaptive_search(space, evaluate, trials, parallelism, seed)
        best = min(tried, key=lambda t: t[1])[0]
        model = estimator.fit(ready, settings(best))
    finally:
        ready.unpersist()
    return Fitted(model, features), _trials(df, tried)


def _trials(df: DataFrame, tried: list[tuple[dict, float]]) -> DataFrame:
    rows = [(i, ", ".join(f"{n}={v}" for n, v in params.items()), float(score)) for i, (params, score) in enumerate(tried)]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, MSE double")


# -- grouping and projection -----------------------------------------------


def scaled_vectors(df: DataFrame, features: list[str]) -> DataFrame:
    ready = assemble(df.dropna(subset=features), features)
    scaler = StandardScaler(
        inputCol=VECTOR, outputCol="_scaled", withMean=True, withStd=True
    )
    return scaler.fit(ready).transform(ready).drop(VECTOR)


def cluster(df: DataFrame, features: list[str], k: int = 3, seed: int = 42) -> DataFrame:
    """Add `Cluster` by k-means on the scaled features."""
    ready = scaled_vectors(df, features).persist()
    try:
        model = KMeans(k=k, seed=seed, featuresCol="_scaled", predictionCol="Cluster").fit(ready)
    finally:
        ready.unpersist()
    return model.transform(ready).drop("_scaled")


def lloyd(
    df: DataFrame, keys: list[str], features: list[str], k: int = 3, steps: int = 8, seed: int = 42
) -> DataFrame:
    """(keys, Cluster): k-means that any engine can repeat.

    Features are scaled by their population deviation.  The first centroid is the row with the
    least MD5 of keys and seed, each further one the row farthest from those chosen, ties to
    the lesser hash; then a fixed number of steps assigns rows to the nearest centroid (ties
    to the smaller number) and moves it to their mean.  Rows with a missing feature are left
    out; an empty cluster keeps its centroid.  The driver sees k centroids a step.
    """
    known = standard_scale(df.dropna(subset=features), features)
    mark = F.md5(F.concat_ws("|", *keys, F.lit(seed)).cast("binary")).alias("_mark")
    path = scratch_path(df.sparkSession, "points")
    known.select(*keys, mark, F.array(*[F.col(c) for c in features]).alias("_x")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)

    def apart(centre: list[float]) -> Column:
        gaps = F.transform("_x", lambda x, i: x - F.element_at(F.array(*[F.lit(float(v)) for v in centre]), i + 1))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)

    first = rows.orderBy("_mark").first()
    if first is None:
        return rows.select(*keys, F.lit(0).alias("Cluster"))
    centres = [first["_x"]]
    while len(centres) < k:
        nearest = F.array_min(F.array(*[apart(c) for c in centres]))
        centres.append(rows.orderBy(nearest.desc(), "_mark").first()["_x"])

    def own() -> Column:
        distances = F.array(*[apart(c) for c in centres])
        return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")

    for _ in range(steps):
        means = [F.avg(F.element_at("_x", i + 1)).alias(f"m{i}") for i in range(len(features))]
        for r in rows.groupBy(own().alias("Cluster")).agg(*means).collect():
            centres[r.Cluster] = list(r[1:])
    return rows.select(*keys, own().alias("Cluster"))


def project(df: DataFrame, features: list[str], k: int = 2) -> DataFrame:
    """Add `PC1`, `PC2`, ...: the leading components of the scaled features.

    A component points to where its largest loading is positive.
    """
    ready = scaled_vectors(df, features)
    model = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(ready)
    parts = vector_to_array(F.col("_pc"))
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).round(9).argmax(), i] >= 0 else -1.0 for i in range(k)]
    made = model.transform(ready).withColumns({f"PC{i + 1}": parts[i] * signs[i] for i in range(k)})
    return made.drop("_scaled", "_pc")


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, for the assembler."""
    return df.withColumns({c: F.col(c).cast(T.DoubleType()) for c in columns})
