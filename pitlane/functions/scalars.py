"""Row-level expressions on numbers and angles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.constants import DRS_OPEN

TURN = 2 * math.pi
# Angles this close to +pi count as -pi.
SNAP = 1e-8 + 1e-5 * math.pi


def sign_split(df: DataFrame, column: str) -> DataFrame:
    """Add ``positive_<column>`` and ``negative_<column>``; the other sign becomes 0."""
    value = F.col(column)
    zero = F.lit(0).cast(df.schema[column].dataType)
    return df.withColumns(
        {
            f"positive_{column}": F.when(value < 0, zero).otherwise(value),
            f"negative_{column}": F.when(value > 0, zero).otherwise(value),
        }
    )


def drs_open(code: Column) -> Column:
    """1 for an open flap, else 0 (also for NULL)."""
    return F.when(code.isin(DRS_OPEN), 1).otherwise(0)


def wrapped_angle(angle: Column) -> Column:
    """The angle moved by whole turns into [-pi, pi); values just under +pi become -pi."""
    inside = F.pmod(angle + math.pi, F.lit(TURN)) - math.pi
    return F.when(inside >= math.pi - SNAP, F.lit(-math.pi)).otherwise(inside)


def full_turns(angle: Column) -> Column:
    """How many whole turns `wrapped_angle` took away."""
    return F.rint((angle - wrapped_angle(angle)) / TURN)


def wrap_angle(angle: Column) -> Column:
    """Struct of the wrapped angle and the revolutions removed."""
    return F.struct(
        wrapped_angle(angle).alias("angle"), full_turns(angle).cast("int").alias("revolutions")
    )


def round_half_even(column: Column, digits: int) -> Column:
    """Rounding of the scaled double, halves to even."""
    scale = F.lit(float(10**digits))
    return F.rint(column * scale) / scale


def row_mean(columns: list[str]) -> Column:
    """Mean over the columns that are not NULL; NULL if all are."""
    known = reduce(Column.__add__, [F.col(c).isNotNull().cast("int") for c in columns])
    total = reduce(Column.__add__, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])
    return F.when(known > 0, total / known)


def is_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def clean_inf(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN and plus or minus infinity become NULL in every floating column."""
    bad = [float("inf"), float("-inf"), float("nan")]
    return df.withColumns(
        {
            c: F.when(~F.col(c).isin(bad), F.col(c))
            for c in (columns or numeric_columns(df))
        }
    )


def quadratic_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the square of each column as ``<column>2``."""
    return df.withColumns({f"{c}2": F.col(c) * F.col(c) for c in columns})
