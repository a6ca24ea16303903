"""Per-lap summaries of telemetry samples and sample-level smoothing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.constants import LAP_KEY, SAMPLE_ORDER
from pitlane.operators.motion import accelerations
from pitlane.operators.quantiles import percentiles
from pitlane.operators.series import Series, attach_totals, hand_down, measured


def is_regular() -> Column:
    lap = F.col("LapNumber")
    return (lap >= 1) & (lap == F.floor(lap))


def regular_laps(df: DataFrame) -> DataFrame:
    """Rows of whole lap numbers from 1 up; others never form a lap."""
    return hand_down(df.where(is_regular()), df)


def with_mean_speed(df: DataFrame, keys: list[str] = LAP_KEY) -> DataFrame:
    """Add the lap's mean speed to each of its samples."""
    return attach_totals(df, keys, {"MeanLapSpeed": F.avg("Speed")})


def lap_sums() -> dict[str, Column]:
    """The features of a lap as aggregates over its accelerations."""
    return {
        "MeanLapSpeed": F.avg("Speed"),
        "SumLonAcc": F.coalesce(F.sum(F.abs("LonAcc")), F.lit(0.0)),
        "SumLatAcc": F.coalesce(F.sum(F.abs("LatAcc")), F.lit(0.0)),
    }


def lap_features(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """One row per lap: mean speed and summed absolute accelerations.

    The windows and the aggregate share the partitioning by `keys`, so samples
    are shuffled once.
    """
    measured(df, keys)
    return accelerations(regular_laps(df), keys, order).groupBy(*keys).agg(*[c.alias(n) for n, c in lap_sums().items()])


def lap_abs_acc(df: DataFrame, keys: list[str] = LAP_KEY) -> DataFrame:
    """Longitudinal effort per lap, without the lateral chain."""
    return (
        accelerations(df, keys, lateral=False)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(F.abs("LonAcc")), F.lit(0.0)).alias("SumLonAcc"))
    )


def lap_progress(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """Add `LapProgress`: position of the sample over the lap's sample count."""
    placed = Series(df, keys, order).position("_at").rows()
    counted = attach_totals(placed, keys, {"_of": F.count(F.lit(1))})
    return counted.withColumn("LapProgress", F.col("_at") / F.col("_of")).drop("_at", "_of")


def last_sample_per_lap(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """The last sample of every regular lap.

    Spark keeps one candidate per lap and task before the shuffle, so a hot lap
    does not reach a single task whole.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = regular_laps(df).withColumn("_rank", F.row_number().over(latest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def moving_average(
    df: DataFrame,
    column: str,
    sizes: list[int],
    keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER,
) -> DataFrame:
    """Add ``last_<n>_SMA`` per size; NULL until n known values fill the frame."""
    s = Series(df, keys, order, reach=max(sizes) - 1)
    made = {}
    for size in sizes:
        frame = s.window.rowsBetween(1 - size, 0)
        full = F.count(column).over(frame) == size
        made[f"last_{size}_SMA"] = F.when(full, F.avg(column).over(frame))
    return s.with_columns(made).rows()


def exponential_average(
    df: DataFrame,
    column: str,
    spans: list[int],
    keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER,
) -> DataFrame:
    """Add ``last_<n>_EMA`` per span, weights normalised over the known values.

    With decay r the average is ``sum(r^i x) / sum(r^i)`` over the rows back to
    the group's start.  Rows are numbered in blocks long enough that r^block is
    below double precision; inside a block the sums are running sums of
    ``x r^-p`` (p = place in the block), which stay far from overflow, and only
    the block before can still contribute.  A missing value repeats the average
    before it, which is what decaying both sums does.
    """
    blocks = {span: _ema_block(span) for span in spans}
    s = Series(df, keys, order, reach=2 * max(blocks.values()))
    s.with_columns({"_row": F.row_number().over(s.window) - 1})
    for span, size in blocks.items():
        r = 1.0 - 2.0 / (span + 1)
        name = f"last_{span}_EMA"
        place = F.pmod(F.col("_row"), F.lit(size))
        scale = F.pow(F.lit(r), -place)
        s.with_columns(
            {
                "_block": F.floor(F.col("_row") / size).cast("int"),
                "_w": F.when(F.col(column).isNotNull(), scale).otherwise(0.0),
                "_x": F.coalesce(F.col(column) * scale, F.lit(0.0)),
            }
        )
        inside = (
            Window.partitionBy(*s.parts, "_block")
            .orderBy(*s.order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        before = Window.partitionBy(*s.parts).orderBy("_block").rangeBetween(-1, -1)
        s.with_columns(
            {
                "_xb": F.coalesce(F.sum("_x").over(before), F.lit(0.0)),
                "_wb": F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
                "_xi": F.sum("_x").over(inside),
                "_wi": F.sum("_w").over(inside),
            }
        )
        far = F.lit(r**size)
        mean = (F.col("_xi") + F.col("_xb") * far) / (F.col("_wi") + F.col("_wb") * far)
        s.with_columns({"_mean": F.when(F.col(column).isNotNull(), mean)})
        s.running({name: ("last", F.col("_mean"))})
        s.df = s.df.drop("_block", "_w", "_x", "_xb", "_wb", "_xi", "_wi", "_mean")
    return s.rows().drop("_row")


def _ema_block(span: int) -> int:
    """Rows after which a weight falls below double precision."""
    return math.ceil(40.0 / -math.log(1.0 - 2.0 / (span + 1)))


# Names under which an aggregate can be asked for.
AGGREGATES = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
    "std": F.stddev_samp,
}


def binned(
    df: DataFrame,
    column: str,
    bins: int = 10,
    how: str = "mean",
    by: str = "LapProgress",
    group: str = "LapNumber",
) -> DataFrame:
    """Aggregate `column` per (group, equal-width bin of `by`).

    Bins are closed on the right, the first one on both sides.
    """
    span = df.agg(F.min(by).alias("_lo"), F.max(by).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.ceil(F.try_divide(F.col(by) - F.col("_lo"), width)) - 1
    inside = F.least(F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)), F.lit(bins - 1))
    # The bounds are one row.
    placed = df.join(F.broadcast(span)).where(F.col(by).isNotNull() & F.col(group).isNotNull())
    placed = placed.withColumn("bin", inside.cast("int"))
    name = f"{how}_of_{column}"
    if how == "median":
        return percentiles(placed, [group, "bin"], {column: {name: 0.5}})
    return placed.groupBy(group, "bin").agg(AGGREGATES[how](column).alias(name))


def relative_time(df: DataFrame, keys: list[str], time: str = "Time_s") -> DataFrame:
    """Add `RelativeTime_s`: seconds since the group's first sample."""
    first = attach_totals(df, keys, {"_start": F.min(time)})
    return first.withColumn("RelativeTime_s", F.col(time) - F.col("_start")).drop("_start")


def align_series(
    left: DataFrame, right: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Both series of each key cut to the length of the shorter one.

    Rows are tagged with their `Side`; keys present on one side only vanish.
    """
    both = left.withColumn("Side", F.lit("left")).unionByName(
        right.withColumn("Side", F.lit("right"))
    )
    placed = Series(both, [*keys, "Side"], order).position("Position").rows()

    def size(side: str) -> Column:
        return F.count(F.when(F.col("Side") == side, 1))

    counted = attach_totals(placed, keys, {"_l": size("left"), "_r": size("right")})
    return counted.where(F.col("Position") <= F.least("_l", "_r")).drop("_l", "_r")
