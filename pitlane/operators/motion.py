"""Derivatives, headings and accelerations along a lap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.constants import ACC_LIMIT_G, EPSILON, GRAVITY, KMH_PER_MPS, LAP_KEY, SAMPLE_ORDER
from pitlane.functions.scalars import TURN, round_half_even, wrapped_angle
from pitlane.operators.series import Series, attach_totals, hand_down, measured

# Weights of the low-noise differentiator by neighbour distance.
SMOOTH_WEIGHTS = {1: 5.0 / 32.0, 2: 4.0 / 32.0, 3: 1.0 / 32.0}

def _slope(t: str, back: str, ahead: str, both: str) -> Column:
    """Difference quotient around a row, over the neighbours of `t`.

    The other arguments are SQL for the change of the ordinate from the previous
    row, to the next row and over both.  The two ends are one-sided with a small
    guard in the denominator; inside, a vanishing span falls back to the next,
    then to the previous neighbour, then to 0.
    """
    to_next, from_last, over = f"({t}_a1 - {t})", f"({t} - {t}_b1)", f"({t}_a1 - {t}_b1)"
    tiny = f"{EPSILON}D"
    return F.expr(
        f"""CASE
          WHEN _is_first AND _is_last THEN NULL
          WHEN _is_first THEN try_divide({ahead}, {to_next} + {tiny})
          WHEN _is_last THEN try_divide({back}, {from_last} + {tiny})
          WHEN abs({over}) > {tiny} THEN try_divide({both}, {over})
          WHEN abs({to_next}) > {tiny} THEN try_divide({ahead}, {to_next})
          WHEN abs({from_last}) > {tiny} THEN try_divide({back}, {from_last})
          ELSE 0D END"""
    )


def _centered(t: str, v: str) -> Column:
    """Centered derivative dv/dt from the neighbours of both columns."""
    return _slope(t, f"{v} - {v}_b1", f"{v}_a1 - {v}", f"{v}_a1 - {v}_b1")


def _smooth(t: str, v: str) -> Column:
    """Low-noise derivative over three neighbours on each side.

    Rows without three neighbours on both sides use the plain two-sided
    quotient, the two ends a one-sided one.
    """
    terms = " + ".join(
        f"""CASE WHEN {t}_a{j} - {t}_b{j} = 0 THEN 0D ELSE
            try_divide({2 * j * weight}D * ({v}_a{j} - {v}_b{j}), {t}_a{j} - {t}_b{j}) END"""
        for j, weight in SMOOTH_WEIGHTS.items()
    )
    tiny = f"{EPSILON}D"
    return F.expr(
        f"""CASE
          WHEN _is_first AND _is_last THEN NULL
          WHEN _is_first THEN try_divide({v}_a1 - {v}, {t}_a1 - {t} + {tiny})
          WHEN _is_last THEN try_divide({v} - {v}_b1, {t} - {t}_b1 + {tiny})
          WHEN _near_end THEN try_divide({v}_a1 - {v}_b1, {t}_a1 - {t}_b1 + {tiny})
          ELSE {terms} END"""
    )


def derivative(
    df: DataFrame,
    t: str,
    v: str,
    name: str,
    method: str = "centered",
    keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER,
) -> DataFrame:
    """Derivative of any channel inside each group, "centered" or "smooth"."""
    reach = {"centered": 1, "smooth": 3}[method]
    s = Series(df, keys, order, reach=reach).with_neighbours([t, v], reach)
    if method == "centered":
        s.with_columns({name: _centered(t, v)})
    else:
        one = F.lit(1)
        near_end = s.lag(one, 3).isNull() | s.lead(one, 3).isNull()
        s.with_columns({"_near_end": near_end}).with_columns({name: _smooth(t, v)})
    return s.rows().select(*df.columns, name)


# -- headings --------------------------------------------------------------

PATH = ["Distance", "X", "Y"]


def _angle() -> Column:
    """Tangent angle of the path, from the neighbours of its coordinates."""
    return F.atan2(_centered("Distance", "Y"), _centered("Distance", "X"))


def _with_turns(s: Series) -> Series:
    """Heading change since the previous sample, in whole turns and in full."""
    raw = F.col("_angle") - F.col("_angle_before")
    s.with_columns({"_angle_before": s.lag("_angle")})
    s.with_columns({"_turns": F.rint((wrapped_angle(raw) - raw) / TURN)})
    return s.with_columns({"_turn": raw + TURN * F.col("_turns")})


def path_angle(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """Add `Angle`: direction of the path at each sample, within one turn."""
    s = Series(df, keys, order, reach=1).with_neighbours(PATH)
    return s.with_columns({"Angle": _angle()}).rows().select(*df.columns, "Angle")


def heading_unwrap(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """Add `Heading`: the path angle without jumps at the half turn.

    The heading is the tangent angle plus all whole turns counted so far.  A
    missing coordinate makes it missing for the rest of the lap.
    """
    s = Series(df, keys, order, reach=2).with_neighbours(PATH)
    _with_turns(s.with_columns({"_angle": _angle()}))
    s.running(
        {
            "_turned": ("sum", F.coalesce(F.col("_turns"), F.lit(0.0))),
            "_lost": ("max", F.col("_angle").isNull().cast("int")),
        }
    )
    heading = F.when(F.col("_lost") == 0, F.col("_angle") + TURN * F.col("_turned"))
    return s.with_columns({"Heading": heading}).rows().select(*df.columns, "Heading")


def _with_curvature(s: Series) -> Series:
    """Change of heading per metre (`Curvature`) from `_angle`.

    Only differences of neighbouring headings enter, so the running heading
    itself is not needed: the change to a neighbour is the wrapped turn.
    """
    _with_turns(s)
    s.running({"_lost": ("max", F.col("_angle").isNull().cast("int"))})
    s.with_columns({"_turn": F.when(F.col("_lost") == 0, F.col("_turn"))})
    s.with_columns({"_turn_after": s.lead("_turn")})
    slope = _slope("Distance", "_turn", "_turn_after", "(_turn + _turn_after)")
    return s.with_columns({"Curvature": slope})


def curvature(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """Add `Curvature` in radians per metre."""
    s = Series(df, keys, order, reach=3).with_neighbours(PATH)
    _with_curvature(s.with_columns({"_angle": _angle()}))
    return s.rows().select(*df.columns, "Curvature")


# -- accelerations ---------------------------------------------------------


def _repair(s: Series, columns: dict[str, str], limit: float = ACC_LIMIT_G) -> Series:
    """Replace values beyond the limit by the last kept value before them, or 0.

    A missing value is kept as missing and also passed on to the outliers after
    it; NaN stands for it while the last kept value is looked up.  NaN in the
    input is a missing value too.
    """
    s.with_columns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})
    kept = {
        f"_kept_{out}": (
            "last",
            F.when(F.col(c).isNull() | (F.abs(c) <= limit), F.coalesce(F.col(c), F.lit(float("nan")))),
        )
        for c, out in columns.items()
    }
    s.running(kept)
    for out in columns.values():
        value = F.coalesce(F.col(f"_kept_{out}"), F.lit(0.0))
        s.with_columns({out: F.when(~F.isnan(value), value)})
    s.df = s.df.drop(*kept)
    return s


def outlier_repair(
    df: DataFrame,
    column: str,
    name: str,
    limit: float = ACC_LIMIT_G,
    keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER,
) -> DataFrame:
    return _repair(Series(df, keys, order), {column: name}, limit).rows()


def accelerations(
    df: DataFrame,
    keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER,
    lateral: bool = True,
) -> DataFrame:
    """Add `LonAcc` and `LatAcc` in g, repaired and rounded to 5 digits.

    Longitudinal: derivative of speed over time.  Lateral: speed squared times
    path curvature.
    """
    measured(df, keys)
    s = Series(hand_down(df.withColumn("_v", F.col("Speed") / KMH_PER_MPS), df), keys, order, reach=3)
    s.with_neighbours(["Time_s", "_v", *(PATH if lateral else [])])
    first = {"_lon": _centered("Time_s", "_v") / GRAVITY}
    made = {"_lon": "LonAcc"}
    if lateral:
        _with_curvature(s.with_columns({**first, "_angle": _angle()}))
        s.with_columns({"_lat": F.expr(f"_v * _v * Curvature / {GRAVITY}D")})
        made["_lat"] = "LatAcc"
    else:
        s.with_columns(first)
    _repair(s, made)
    rounded = [round_half_even(F.col(c), 5).alias(c) for c in made.values()]
    return hand_down(s.rows().select(*df.columns, *rounded), df)


def with_lap_sums(
    df: DataFrame, keys: list[str] = LAP_KEY, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """`accelerations` plus absolute values and their sums over the lap."""
    acc = accelerations(df, keys, order)
    acc = hand_down(acc.withColumns({"AbsLonAcc": F.abs("LonAcc"), "AbsLatAcc": F.abs("LatAcc")}), df)
    sums = {"SumLonAcc": F.sum("AbsLonAcc"), "SumLatAcc": F.sum("AbsLatAcc")}
    # A lap without any value sums to 0.
    return attach_totals(acc, keys, sums).fillna(0.0, list(sums))
