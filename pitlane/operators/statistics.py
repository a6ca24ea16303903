"""Statistics over whole tables or groups: all scans aggregate before they shuffle."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.series import attach_totals


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def nunique(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of distinct known values.

    Values are spread by (column, value), so a column with many distinct values
    does not end up in one task.
    """
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("_v")
    ).select("_v.*")
    distinct = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy("column").agg(F.count("value").alias("distinct"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are known."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [_cell(a, a, F.lit(1.0)) for a in columns]
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`")
        cells += [_cell(a, b, value), _cell(b, a, value)]
    return one.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def _cell(a: str, b: str, value: Column) -> Column:
    return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value.alias("corr"))


def variance_inflation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factor of each feature.

    It is the diagonal of the inverse correlation matrix; only that k by k
    matrix reaches the driver.
    """
    cells = correlations(df.dropna(subset=columns), columns).collect()
    place = {c: i for i, c in enumerate(columns)}
    matrix = np.eye(len(columns))
    for cell in cells:
        matrix[place[cell.a], place[cell.b]] = cell.corr
    factors = np.diag(np.linalg.inv(matrix))
    rows = [(c, float(f)) for c, f in zip(columns, factors)]
    return df.sparkSession.createDataFrame(rows, "feature string, VIF double")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins, closed on the left, the last one on both sides."""
    known = df.where(F.col(column).isNotNull()).select(column)
    span = F.broadcast(known.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    width = (F.col("hi") - F.col("lo")) / bins
    number = F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("lo"), width)), F.lit(0))
    placed = known.join(span).select(F.least(number, F.lit(bins - 1)).cast("int").alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(span)
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def regression_metrics(
    df: DataFrame, actual: str, predictions: dict[str, str], keys: list[str] | None = None
) -> DataFrame:
    """``<name>_MSE`` and ``<name>_R2`` per group for each prediction column.

    Only rows where the actual value and all predictions are known count.  R2
    is NULL where the actual value does not vary.
    """
    known = df.dropna(subset=[actual, *predictions.values()])
    y = F.col(actual)
    made = []
    for name, column in predictions.items():
        square = F.pow(y - F.col(column), F.lit(2))
        spread = F.var_pop(y)
        r2 = F.when(spread > 0, 1 - F.try_divide(F.avg(square), spread))
        made += [F.avg(square).alias(f"{name}_MSE"), r2.alias(f"{name}_R2")]
    return known.groupBy(*(keys or [])).agg(*made)


def paired_ttest(df: DataFrame, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Paired t-test of two columns: n, df, statistic, p-value, significance."""
    d = F.col(a) - F.col(b)
    n, mean, spread = df.agg(F.count(d), F.avg(d), F.stddev_samp(d)).first()
    known = n > 1 and spread and spread > 0
    t = mean / (spread / math.sqrt(n)) if known else None
    p = two_sided_p(t, n - 1) if known else None
    row = (n, max(n - 1, 0), t, p, p < alpha if known else None)
    return df.sparkSession.createDataFrame(
        [row], "n long, df long, statistic double, pvalue double, significant boolean"
    )


def two_sided_p(t: float, freedom: int) -> float:
    """Probability of a |t| at least this large.

    Integrates Student's density over [0, |t|] after the substitution
    ``t = sqrt(df) tan(u)``, which makes the integrand a power of a cosine on a
    finite interval.
    """
    if math.isinf(t):
        return 0.0
    upper = math.atan(abs(t) / math.sqrt(freedom))
    nodes, weights = np.polynomial.legendre.leggauss(64)
    # The integrand falls off within a few 1/sqrt(df), so the tail is integrated
    # piece by piece from the given point to the right end.
    edges = upper + (math.pi / 2 - upper) * np.linspace(0.0, 1.0, 65)
    mid, half = (edges[1:] + edges[:-1]) / 2, (edges[1:] - edges[:-1]) / 2
    points = mid[:, None] + half[:, None] * nodes[None, :]
    with np.errstate(divide="ignore"):
        logs = (freedom - 1) * np.log(np.cos(points))
    scale = (
        math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2) - math.log(math.pi) / 2
    )
    tail = (half[:, None] * weights[None, :] * np.exp(logs + scale)).sum()
    return float(min(1.0, 2 * tail))


def column_means(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Means of several columns per group."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def standard_scale(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Centre each column and divide by its population deviation; constant columns become 0."""
    keys = keys or []
    stats = {}
    for c in columns:
        stats[f"_m_{c}"] = F.avg(c)
        stats[f"_s_{c}"] = F.stddev_pop(c)
    if keys:
        wide = attach_totals(df, keys, stats)
    else:
        wide = df.join(F.broadcast(df.agg(*[v.alias(k) for k, v in stats.items()])))
    scaled = {}
    for c in columns:
        centred, spread = F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")
        scaled[c] = F.when(spread > 0, F.try_divide(centred, spread)).otherwise(centred * 0.0)
    return wide.withColumns(scaled).drop(*stats)
