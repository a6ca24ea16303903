"""Exact quantiles and what is built on them: IQR masks, box-plot numbers, describe."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.series import Series, attach_small, checked_broadcast, hot_groups, mark_hot
from pitlane.settings import PERCENTILE_ROWS, PERCENTILE_ROWS_DEFAULT, materialize, setting

QUARTILES = {"q1": 0.25, "q3": 0.75}


def percentiles(
    df: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]]
) -> DataFrame:
    """Exact, linearly interpolated percentiles per group.

    `wanted` maps a column to {output name: fraction}.  One row per group of
    `df`; a single row when `keys` is empty.

    Spark's own exact percentile keeps all distinct values of a group in one
    task.  That is fine up to a limit; larger groups are ranked by a
    range-partitioned running count of their value counts.
    """
    narrow = df.select(*keys, *[c for c in wanted if c not in keys])
    hot = hot_groups(df, keys, setting(df.sparkSession, PERCENTILE_ROWS, PERCENTILE_ROWS_DEFAULT))
    exact = [
        F.percentile(F.col(c).cast("double"), F.lit(q)).alias(name)
        for c, names in wanted.items()
        for name, q in names.items()
    ]
    if hot is None:
        return narrow.groupBy(*keys).agg(*exact)
    marked = mark_hot(narrow, hot, keys)
    large = marked.where(F.col("_rows").isNotNull()).drop("_rows")
    ranked = _ranked(large, keys, wanted, hot.count())
    if not keys:
        return ranked
    cold = marked.where(F.col("_rows").isNull()).drop("_rows")
    # A hot group without any value has no rank but still gets its row.
    large_groups = attach_small(hot.select(*keys), ranked, keys, hot.count())
    return cold.groupBy(*keys).agg(*exact).unionByName(large_groups)


def _ranked(
    df: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]], groups: int
) -> DataFrame:
    """Percentiles of hot groups from ranks of distinct values."""
    long = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("value"))
                    for c in wanted
                ]
            )
        ).alias("_v"),
    ).select(*keys, "_v.of", "_v.value")
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy(*keys, "of", "value")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    totals = counts.groupBy(*keys, "of").agg(F.sum("times").alias("total"))
    s = Series(counts, [*keys, "of"], ["value"])
    placed = s.running({"upto": ("sum", F.col("times"))}).rows()
    ranked = attach_small(placed, totals, [*keys, "of"], groups * len(wanted))
    made = []
    for c, names in wanted.items():
        for name, q in names.items():
            at = F.lit(q) * (F.col("total") - 1)
            low, high = F.floor(at), F.ceil(at)
            mine = F.col("of") == c

            def holds(rank: Column, mine: Column = mine) -> Column:
                before = F.col("upto") - F.col("times")
                return mine & (before <= rank) & (rank < F.col("upto"))

            below = F.max(F.when(holds(low), F.col("value")))
            above = F.max(F.when(holds(high), F.col("value")))
            share = F.max(F.when(mine, at - low))
            made.append((below + (above - below) * share).alias(name))
    return ranked.groupBy(*keys).agg(*made)


def attach_bounds(df: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-group bounds, also of the NULL group; without keys they are one row.

    Groups may be few and large, so bounds are broadcast when their number allows it;
    otherwise there are too many groups for one of them to be all of a task's work,
    and adaptive execution splits what is skewed.
    """
    if not keys:
        return df.join(F.broadcast(bounds))
    names = {k: f"_of_{k}" for k in keys}
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()])
    other = checked_broadcast(materialize(bounds)).withColumnsRenamed(names)
    return df.join(other, match).drop(*names.values())


def iqr_filter(
    df: DataFrame,
    reference: str,
    columns: list[str] | None = None,
    keys: list[str] | None = None,
    factor: float = 1.5,
    lower: bool = True,
) -> DataFrame:
    """Rows whose columns all lie within the interquartile fence of `reference`.

    With ``lower=False`` only the upper fence applies.
    """
    keys = keys or []
    fence = percentiles(df, keys, {reference: {"_q1": 0.25, "_q3": 0.75}})
    reach = factor * (F.col("_q3") - F.col("_q1"))
    joined = attach_bounds(df, fence, keys)
    tests = []
    for c in columns or [reference]:
        tests.append(F.col(c) <= F.col("_q3") + reach)
        if lower:
            tests.append(F.col(c) >= F.col("_q1") - reach)
    return joined.where(reduce(lambda a, b: a & b, tests)).drop("_q1", "_q3")


def describe(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max of one column."""
    keys = keys or []
    simple = df.groupBy(*keys).agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    inner = percentiles(df, keys, {column: {"p25": 0.25, "p50": 0.5, "p75": 0.75}})
    joined = attach_bounds(simple, inner, keys)
    return joined.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def boxplot_stats(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Quartiles, whisker ends and outlier count per group.

    A whisker ends at the most extreme value within 1.5 interquartile ranges.
    """
    quartiles = percentiles(df, keys, {column: {"q1": 0.25, "median": 0.5, "q3": 0.75}})
    value, reach = F.col(column), 1.5 * (F.col("q3") - F.col("q1"))
    joined = attach_bounds(df.where(value.isNotNull()), quartiles, keys)
    inside = value.between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )
