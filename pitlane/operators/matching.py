"""Joins on time: nearest sample, samples within a lap, lap numbers from start times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.series import Series


def gap_micros(earlier: Column, later: Column) -> Column:
    """Microseconds from one timestamp to another."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def nearest(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_time: str,
    right_time: str,
    right_id: str,
    carry: list[str] | None = None,
    tolerance_us: int | None = None,
) -> DataFrame:
    """Left rows with the right row nearest in time within the same `by` group.

    Adds `right_id`, `right_time` and the `carry` columns of the right side,
    NULL if there is none (or none within the tolerance).  Of two equally near
    rows the earlier one wins; of simultaneous ones the lower id.  Right rows
    without a time are never matched, left rows without one match nothing.

    Both sides are merged into one series and each left row looks at the last
    right row before it and the first after it; no pair is ever formed.
    """
    carry = carry or []
    picked = [right_id, *carry]
    moments = right.where(F.col(right_time).isNotNull()).groupBy(*by, right_time).agg(
        F.min_by(F.struct(*[F.col(c) for c in picked]), right_id).alias("_row")
    )
    points = moments.select(
        *by,
        F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(F.col(right_time).alias("t"), F.col("_row").alias("row")).alias("_point"),
    )
    own = left.withColumn("_own", F.struct(*left.columns)).select(
        *by, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), "_own"
    )
    merged = own.unionByName(points, allowMissingColumns=True)
    tie = F.xxhash64("_own")
    s = Series(merged.withColumn("_tie", tie), by, ["_t", "_side", "_tie"])
    s.running({"_prev": ("last", F.col("_point"))})
    s.running({"_next": ("last", F.col("_point"))}, backwards=True)
    rows = s.rows().where(F.col("_side") == 1)

    back = gap_micros(F.col("_prev.t"), F.col("_t"))
    ahead = gap_micros(F.col("_t"), F.col("_next.t"))
    use_next = F.col("_prev").isNull() | (ahead < back)
    best = F.when(use_next, F.col("_next")).otherwise(F.col("_prev"))
    best = F.when(F.col("_t").isNotNull(), best)
    gap = F.when(use_next, ahead).otherwise(back)
    if tolerance_us is not None:
        best = F.when(gap <= tolerance_us, best)
    return rows.withColumn("_best", best).select(
        "_own.*",
        F.col("_best.t").alias(right_time),
        *[F.col(f"_best.row.{c}").alias(c) for c in picked],
    )


def tag_laps(
    samples: DataFrame,
    starts: DataFrame,
    by: list[str],
    time: str,
    sample_id: str,
    start_time: str,
    lap: str = "LapNumber",
) -> DataFrame:
    """Add `lap` to each sample from the start times of a driver's laps 2, 3, ... n+1.

    The nearest sample to a start time opens the next lap.  The last start time
    only closes lap n, which still includes the sample after the closing one;
    later samples get 0.  Missing start times do not count; a sample without a
    time gets NULL.
    """
    ordered = Series(starts.where(F.col(start_time).isNotNull()), by, [start_time], reach=1)
    ordered.with_columns({"_closing": ordered.is_last()})
    matched = nearest(
        ordered.rows().select(*by, start_time, "_closing"),
        samples, by, start_time, time, sample_id,
    )
    marks = (
        matched.where(F.col(sample_id).isNotNull())
        .groupBy(*by, sample_id)
        .agg(
            F.sum(F.when(F.col("_closing"), 0).otherwise(1)).alias("_opened"),
            F.max(F.col("_closing").cast("int")).alias("_closed"),
        )
    )
    marked = samples.join(marks, [*by, sample_id], "left").fillna(0, ["_opened", "_closed"])
    s = Series(marked, by, [time, sample_id], reach=1)
    s.with_columns({"_closed_before": F.coalesce(s.lag("_closed"), F.lit(0))})
    s.running({"_laps": ("sum", F.col("_opened")), "_ends": ("sum", F.col("_closed"))})
    past_end = F.col("_ends") - F.col("_closed") - F.col("_closed_before") > 0
    number = F.when(past_end, 0).otherwise(1 + F.col("_laps")).cast("int")
    number = F.when(F.col(time).isNotNull(), number)
    return s.rows().withColumn(lap, number).drop(
        "_opened", "_closed", "_closed_before", "_laps", "_ends"
    )


def lap_slice(
    samples: DataFrame,
    bounds: DataFrame,
    by: list[str],
    time: str,
    sample_id: str,
    start_time: str,
    end_time: str,
) -> DataFrame:
    """Samples from the one nearest to the start time up to, not including, the one
    nearest to the end time.  `bounds` has one row per `by` group.
    """
    tagged = bounds.select(*by, F.col(start_time).alias("_at"), F.lit("start").alias("_edge"))
    tagged = tagged.unionByName(
        bounds.select(*by, F.col(end_time).alias("_at"), F.lit("end").alias("_edge"))
    )
    edges = nearest(tagged, samples, by, "_at", time, sample_id)
    place = F.struct(F.col(time), F.col(sample_id))
    limits = edges.groupBy(*by).agg(
        F.max(F.when(F.col("_edge") == "start", place)).alias("_from"),
        F.max(F.when(F.col("_edge") == "end", place)).alias("_to"),
    )
    return samples.join(limits, by).where((place >= F.col("_from")) & (place < F.col("_to"))).drop(
        "_from", "_to"
    )
