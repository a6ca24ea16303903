"""Durations and timestamps: nanosecond columns, day-time intervals, seconds, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000


def nanos_to_seconds(ns: Column) -> Column:
    """Whole microseconds of a nanosecond count, in seconds."""
    return F.floor(ns / F.lit(1000)) / F.lit(1e6)


def seconds_to_interval(seconds: Column) -> Column:
    """Seconds as a day-time interval, at microsecond precision."""
    whole = F.floor(seconds)
    micros = F.round((seconds - whole) * MICROS).cast("long")
    exact = whole.cast("decimal(18,6)") + micros.cast("decimal(18,6)") / F.lit(MICROS)
    return F.make_dt_interval(secs=exact.cast("decimal(18,6)"))


def interval_micros(interval: Column) -> Column:
    """Microseconds of a day-time interval."""
    seconds = F.extract(F.lit("SECOND"), interval)
    whole = (
        F.extract(F.lit("DAY"), interval).cast("long") * 86_400
        + F.extract(F.lit("HOUR"), interval).cast("long") * 3_600
        + F.extract(F.lit("MINUTE"), interval).cast("long") * 60
    )
    return whole * MICROS + (seconds * MICROS).cast("long")


def interval_to_seconds(interval: Column) -> Column:
    return interval_micros(interval) / F.lit(1e6)


def round_to_millis(seconds: Column) -> Column:
    """Seconds rounded to milliseconds, halves to even."""
    return F.rint(seconds * 1000.0) / F.lit(1000.0)


def interval_text(micros: Column) -> Column:
    """A duration as ``D days HH:MM:SS[.ffffff]``; NULL stays NULL."""
    day = 86_400 * MICROS
    rest = F.pmod(micros, F.lit(day))
    seconds = F.floor(rest / MICROS).cast("long")
    fraction = F.pmod(rest, F.lit(MICROS))
    text = F.format_string(
        "%d days %02d:%02d:%02d",
        F.floor(micros / day).cast("long"),
        F.floor(seconds / 3600).cast("long"),
        F.pmod(F.floor(seconds / 60).cast("long"), F.lit(60)),
        F.pmod(seconds, F.lit(60)),
    )
    shown = F.when(fraction == 0, text).otherwise(F.concat(text, F.format_string(".%06d", fraction)))
    return F.when(micros.isNotNull(), shown)


def text_micros(text: Column) -> Column:
    """Microseconds of a duration written ``[-][D day[s]] [+]HH:MM:SS[.fraction]``; other text is NULL.

    The day count alone carries a sign, as in ``-1 days +23:59:59``; a leading minus
    without days turns the whole duration.  Digits beyond microseconds are cut.
    """
    form = r"^\s*(?:(-?)(\d+) days?,? *)?([-+]?)(\d{1,4}):(\d{2}):(\d{2})(?:\.(\d+))?\s*$"

    def part(i: int) -> Column:
        return F.regexp_extract(text, form, i)

    def number(i: int) -> Column:
        return F.coalesce(part(i).try_cast("long"), F.lit(0))

    clock = (number(4) * 3600 + number(5) * 60 + number(6)) * MICROS
    clock = clock + F.rpad(F.substring(part(7), 1, 6), 6, "0").cast("long")
    days = number(2) * 86_400 * MICROS
    signed = F.when(part(1) == "-", -days).otherwise(days) + F.when(part(3) == "-", -clock).otherwise(clock)
    return F.when(text.rlike(form), signed)


def text_to_seconds(text: Column) -> Column:
    """`text_micros` in seconds."""
    return text_micros(text) / F.lit(1e6)


def text_to_interval(text: Column) -> Column:
    """A duration's text as a day-time interval."""
    return seconds_to_interval(text_to_seconds(text))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text, with or without fractional seconds, as a timestamp; bad text is NULL."""
    return text.try_cast("timestamp_ntz")


def durations_to_seconds(df: DataFrame) -> DataFrame:
    """Replace every day-time interval column by its seconds."""
    intervals = [f.name for f in df.schema if isinstance(f.dataType, T.DayTimeIntervalType)]
    return df.withColumns({name: interval_to_seconds(F.col(name)) for name in intervals})
