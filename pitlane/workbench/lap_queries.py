"""Queries over laps."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitlane import schemas
from pitlane.constants import DRIVER_KEY, LAP_KEY
from pitlane.functions import durations, scalars
from pitlane.operators import laps as lap_ops
from pitlane.operators import quantiles, shaping, statistics, telemetry
from pitlane.workbench import algebra
from pitlane.workbench.book import query, sql
from pitlane.workbench.telemetry_queries import KEY, LAP_FEATURES, LAP_FUEL, STEPS
from pitlane.workbench.views import _RACE_LIST, RACES, _season, laps, table, tel

DRIVER = "Year, Race, DriverNumber"
LAP_DOUBLES = "LapTime_s SpeedI1 SpeedI2 SpeedFL"
LAP_COLUMNS = [
    "Year", "Race", "DriverNumber", "Driver", "Team", "Compound", "LapNumber", "Stint", "TyreLife",
    "LapTime_s", "Position", "IsPersonalBest", "SpeedI1", "SpeedI2", "SpeedFL",
]


def timed(spark, folder):
    return laps(spark, folder).where(F.col("LapTime_s").isNotNull())


# -- scans and projections -------------------------------------------------


@query("scan_laps")
def scan_laps(spark, folder):
    return laps(spark, folder)


sql("scan_laps", "laps", "SELECT * FROM laps", LAP_DOUBLES)


@query("cast_laps")
def cast_laps(spark, folder):
    own = laps(spark, folder)
    types = {c: kind for c, kind in schemas.LAP_TYPES.items() if c in own.columns}
    return shaping.cast_columns(own, types).select("Year", "Race", *types)


sql(
    "cast_laps", "laps",
    "SELECT Year, Race, cast(LapNumber AS smallint) AS LapNumber, cast(Stint AS tinyint) AS Stint, "
    "cast(TyreLife AS tinyint) AS TyreLife, cast(Position AS tinyint) AS Position, IsPersonalBest, Driver, "
    "DriverNumber, Compound, Team FROM laps",
)


@query("lap_project")
def lap_project(spark, folder):
    return laps(spark, folder).select("LapNumber", "Driver", "Compound", "TyreLife", "SpeedI1")


sql(
    "lap_project", "laps", "SELECT LapNumber, Driver, Compound, TyreLife, SpeedI1 FROM laps", "SpeedI1"
)


@query("drop_columns")
def drop_columns(spark, folder):
    return shaping.drop_columns(tel(spark, folder), ["X", "Y", "Distance", "Speed"])


sql("drop_columns", "tel", "SELECT * EXCLUDE (X, Y, Distance, Speed) FROM tel", "Time_s")


@query("positional_columns")
def positional_columns(spark, folder):
    return shaping.positional_columns(tel(spark, folder), 1, -2)


sql("positional_columns", "tel", "SELECT * EXCLUDE (Year, Y, Distance) FROM tel", "Time_s Speed X")


@query("rename_columns")
def rename_columns(spark, folder):
    names = {"LapTime_s": "Actual", "FCL": "Predicted"}
    made = lap_ops.with_fuel(laps(spark, folder)).withColumnsRenamed(names)
    return made.select(*LAP_KEY, "Actual", "Predicted")


sql(
    "rename_columns", "laps tracks",
    f"SELECT {KEY}, LapTime_s AS Actual, FCL AS Predicted FROM fcl", "Actual Predicted", LAP_FUEL,
)


@query("drop_null_laps")
def drop_null_laps(spark, folder):
    return shaping.drop_missing(laps(spark, folder), ["LapTime_s", "SpeedI1"])


sql(
    "drop_null_laps", "laps",
    "SELECT * FROM laps WHERE LapTime_s IS NOT NULL AND SpeedI1 IS NOT NULL", LAP_DOUBLES,
)


@query("valid_rows")
def valid_rows(spark, folder):
    return timed(spark, folder).select(*LAP_KEY, "LapTime_s")


sql("valid_rows", "laps", f"SELECT {KEY}, LapTime_s FROM laps WHERE LapTime_s IS NOT NULL", "LapTime_s")


@query("clean_inf")
def clean_inf(spark, folder):
    """Speed ratios whose denominator may be zero."""
    ratio = F.expr("CASE WHEN TyreLife = 1 THEN double('Infinity') ELSE SpeedI2 / (TyreLife - 1) END")
    return scalars.clean_inf(laps(spark, folder).select(*LAP_KEY, ratio.alias("Ratio")))


sql(
    "clean_inf", "laps",
    f"SELECT {KEY}, CASE WHEN TyreLife > 1 THEN SpeedI2 / (TyreLife - 1) END AS Ratio FROM laps",
    "Ratio",
)


@query("two_driver_filter")
def two_driver_filter(spark, folder):
    return shaping.of_drivers(laps(spark, folder), ["C1", "C16"]).select(*LAP_COLUMNS)


sql("two_driver_filter", "laps", "SELECT * FROM laps WHERE Driver IN ('C1', 'C16')", LAP_DOUBLES)


@query("quadratic_features")
def quadratic_features(spark, folder):
    made = scalars.quadratic_features(laps(spark, folder), ["TyreLife", "SpeedI2"])
    return made.select(*LAP_KEY, "TyreLife2", "SpeedI22")


sql(
    "quadratic_features", "laps",
    f"SELECT {KEY}, TyreLife * TyreLife AS TyreLife2, SpeedI2 * SpeedI2 AS SpeedI22 FROM laps",
    "SpeedI22",
)


@query("durations_to_seconds")
def durations_to_seconds(spark, folder):
    times = laps(spark, folder).select(
        *LAP_KEY,
        durations.seconds_to_interval(F.col("LapTime_s")).alias("LapTime"),
        durations.seconds_to_interval(F.col("SpeedI2") * 700.0).alias("Time"),
    )
    return durations.durations_to_seconds(times)


sql(
    "durations_to_seconds", "laps",
    f"SELECT {KEY}, round(LapTime_s, 6) AS LapTime, SpeedI2 * 7e2 AS Time FROM laps", "LapTime Time",
)


@query("interval_text")
def interval_text(spark, folder):
    micros = F.round(F.col("LapTime_s") * 1000 * 1e6).cast("long")
    return laps(spark, folder).select(*LAP_KEY, durations.interval_text(micros).alias("Text"))


sql(
    "interval_text", "laps",
    f"""SELECT {KEY}, printf('%d days %02d:%02d:%02d', us // 86400000000, us // 3600000000 % 24,
               us // 60000000 % 60, us // 1000000 % 60)
             || CASE WHEN us % 1000000 = 0 THEN '' ELSE printf('.%06d', us % 1000000) END AS Text
        FROM (SELECT *, cast(round(LapTime_s * 1000 * 1e6) AS bigint) AS us FROM laps)""",
)


@query("scalar_duration")
def scalar_duration(spark, folder):
    seconds = F.col("LapTime_s")
    nanos = (seconds * 1e9).cast("long")
    there = durations.seconds_to_interval(seconds)
    return laps(spark, folder).select(
        *LAP_KEY,
        durations.nanos_to_seconds(nanos).alias("FromNanos"),
        durations.interval_to_seconds(there).alias("FromInterval"),
        durations.round_to_millis(seconds).alias("Millis"),
        durations.text_to_seconds(durations.interval_text(durations.interval_micros(there))).alias("FromText"),
    )


sql(
    "scalar_duration", "laps",
    f"""SELECT {KEY}, floor(cast(trunc(LapTime_s * 1e9) AS bigint) / 1000) / 1e6 AS FromNanos,
               round(LapTime_s, 6) AS FromInterval, round_even(LapTime_s * 1e3, 0) / 1e3 AS Millis,
               round(LapTime_s, 6) AS FromText
        FROM laps""",
    "FromNanos FromInterval Millis FromText",
)


@query("scalar_timestamp")
def scalar_timestamp(spark, folder):
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    text = text.otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    parsed = durations.iso_timestamp(text)
    origin = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        "event_id", F.timestamp_diff("MICROSECOND", origin, parsed).alias("micros")
    )


sql(
    "scalar_timestamp", "",
    """SELECT event_id, date_diff('microsecond', timestamp '2024-01-01 00:00:00',
              CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END) AS micros
       FROM events""",
)


@query("scalar_strings")
def scalar_strings(spark, folder):
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.replace(name, F.lit("ring"), F.lit("")).alias("Replaced"),
        F.lower("p_brand").alias("Lower"),
        F.col("p_size").cast("string").alias("SizeText"),
        name.contains("widget").alias("IsWidget"),
        scalars.is_digits(F.regexp_replace("p_brand", "Brand#", "")).alias("Digits"),
        scalars.is_digits(F.col("p_brand")).alias("AllDigits"),
    )


sql(
    "scalar_strings", "",
    """SELECT p_partkey, replace(p_name, 'ring', '') AS Replaced, lower(p_brand) AS Lower,
              cast(p_size AS varchar) AS SizeText, contains(p_name, 'widget') AS IsWidget,
              regexp_full_match(replace(p_brand, 'Brand#', ''), '[0-9]+') AS Digits,
              regexp_full_match(p_brand, '[0-9]+') AS AllDigits
       FROM part""",
)


@query("parse_json_records")
def parse_json_records(spark, folder):
    return shaping.parse_records(table(spark, folder, "events"), "props", "k int", ["event_id"])


sql(
    "parse_json_records", "",
    "SELECT event_id, cast(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS int) AS k FROM events",
)


# -- fuel ------------------------------------------------------------------


@query("track_lookup")
def track_lookup(spark, folder):
    return lap_ops.with_track(laps(spark, folder)).select(*LAP_KEY, "LapLength_km", "RaceLength_km")


sql(
    "track_lookup", "laps tracks",
    "SELECT l.Year, l.Race, DriverNumber, LapNumber, LapLength_km, RaceLength_km "
    "FROM laps l JOIN tracks t ON l.Race = t.Race",
    "LapLength_km RaceLength_km",
)


@query("race_alias")
def race_alias(spark, folder):
    """Events named after the country part of the race name."""
    country = F.regexp_replace("Race", " Grand Prix", "")
    named = laps(spark, folder).select(*LAP_KEY, country.alias("Event"))
    return lap_ops.with_provider_name(named, "Event", "ProviderName")


sql(
    "race_alias", "laps",
    f"""SELECT {KEY}, replace(Race, ' Grand Prix', '') AS Event,
               CASE replace(Race, ' Grand Prix', '') WHEN 'Saudi Arabia' THEN 'Saudi'
                    WHEN 'United States' THEN 'USA' ELSE replace(Race, ' Grand Prix', '') END AS ProviderName
        FROM laps""",
)


@query("fuel_per_lap")
def fuel_per_lap(spark, folder):
    return lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, "FuelPerLap")


sql("fuel_per_lap", "laps tracks", f"SELECT {KEY}, FuelPerLap FROM fuel", "FuelPerLap", LAP_FUEL)


@query("start_fuel")
def start_fuel(spark, folder):
    return lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, "StartFuel")


sql("start_fuel", "laps tracks", f"SELECT {KEY}, StartFuel FROM fuel", "StartFuel", LAP_FUEL)


@query("avg_fuel")
def avg_fuel(spark, folder):
    mean = lap_ops.average_fuel(F.col("LapNumber"), F.col("FuelPerLap"))
    return lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, mean.alias("AvgFuel"))


AVG_FUEL = (
    f"avgfuel AS (SELECT *, CASE WHEN LapNumber = 1 THEN 100e0 ELSE (StartFuel + lag(StartFuel) "
    f"OVER (PARTITION BY {DRIVER} ORDER BY LapNumber)) / 2 END AS AvgFuel FROM fuel)"
)
for name in ("avg_fuel", "avg_fuel_selfjoin", "avg_fuel_lag"):
    sql(name, "laps tracks", f"SELECT {KEY}, AvgFuel FROM avgfuel", "AvgFuel", [*LAP_FUEL, AVG_FUEL])


@query("avg_fuel_selfjoin")
def avg_fuel_selfjoin(spark, folder):
    fuel = lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, "StartFuel")
    return lap_ops.average_fuel_by_join(fuel).select(*LAP_KEY, "AvgFuel")


@query("avg_fuel_lag")
def avg_fuel_lag(spark, folder):
    fuel = lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, "StartFuel")
    return lap_ops.average_fuel_by_lag(fuel).select(*LAP_KEY, "AvgFuel")


@query("fcl")
def fcl(spark, folder):
    return lap_ops.with_fuel(laps(spark, folder)).select(*LAP_KEY, "FCL")


sql("fcl", "laps tracks", f"SELECT {KEY}, FCL FROM fcl", "FCL", LAP_FUEL)


@query("fcl_ms")
def fcl_ms(spark, folder):
    fuel = lap_ops.average_fuel_by_lag(lap_ops.with_fuel(laps(spark, folder)))
    return lap_ops.corrected_to_millis(fuel).select(*LAP_KEY, "FCL")


sql(
    "fcl_ms", "laps tracks",
    f"SELECT {KEY}, round_even((LapTime_s - trunc(0.03e0 * AvgFuel * 1e9) / 1e9) * 1e3, 0) / 1e3 AS FCL "
    "FROM avgfuel",
    "FCL", [*LAP_FUEL, AVG_FUEL],
)


# -- lap selection ---------------------------------------------------------


@query("fastest_lap_per_driver")
def fastest_lap_per_driver(spark, folder):
    return lap_ops.fastest_lap_time(laps(spark, folder), ["Driver"])


sql(
    "fastest_lap_per_driver", "laps",
    "SELECT Driver, min(LapTime_s) AS LapTime_s FROM laps GROUP BY Driver", "LapTime_s",
)


@query("fastest_lap")
def fastest_lap(spark, folder):
    return lap_ops.fastest_lap(laps(spark, folder), DRIVER_KEY)


FASTEST = f"""SELECT DISTINCT ON ({DRIVER}) * FROM laps WHERE LapTime_s IS NOT NULL AND IsPersonalBest
  ORDER BY {DRIVER}, LapTime_s, LapNumber"""
sql("fastest_lap", "laps", FASTEST, LAP_DOUBLES)


@query("quick_laps")
def quick_laps(spark, folder):
    return lap_ops.quick_laps(laps(spark, folder), 1.07, DRIVER_KEY).select(*LAP_COLUMNS)


sql(
    "quick_laps", "laps",
    f"SELECT * EXCLUDE (best) FROM (SELECT *, min(LapTime_s) OVER (PARTITION BY {DRIVER}) AS best "
    "FROM laps) WHERE LapTime_s < 1.07e0 * best",
    LAP_DOUBLES,
)


@query("quick_laps_race")
def quick_laps_race(spark, folder):
    return lap_ops.quick_laps(laps(spark, folder)).select(*LAP_COLUMNS)


sql(
    "quick_laps_race", "laps",
    "SELECT * EXCLUDE (best) FROM (SELECT *, min(LapTime_s) OVER (PARTITION BY Year, Race) AS best "
    "FROM laps) WHERE LapTime_s < 1.07e0 * best",
    LAP_DOUBLES,
)


@query("top_finisher_laps")
def top_finisher_laps(spark, folder):
    return lap_ops.top_finisher_laps(laps(spark, folder)).select(*LAP_COLUMNS)


sql(
    "top_finisher_laps", "laps",
    f"""SELECT * FROM laps WHERE ({DRIVER}) IN (
          SELECT ({DRIVER}) FROM laps l WHERE Position <= 5 AND LapNumber =
            (SELECT max(LapNumber) FROM laps m WHERE m.Year = l.Year AND m.Race = l.Race))""",
    LAP_DOUBLES,
)


@query("finishing_order")
def finishing_order(spark, folder):
    return lap_ops.finishing_order(laps(spark, folder), ["Year", "Race", "Driver"])


sql(
    "finishing_order", "laps",
    "SELECT Year, Race, Driver, arg_max(Position, LapNumber) AS Position FROM laps GROUP BY ALL",
)


@query("renumber_laps")
def renumber_laps(spark, folder):
    known = timed(spark, folder)
    made = lap_ops.renumber_laps(known, ["Driver", "Race"], ["LapNumber", "Year"])
    return made.select("Year", "Race", "Driver", "LapNumber", "LapTime_s")


sql(
    "renumber_laps", "laps",
    """SELECT Year, Race, Driver, cast(row_number() OVER (PARTITION BY Driver, Race
              ORDER BY LapNumber, Year) AS int) AS LapNumber, LapTime_s
       FROM laps WHERE LapTime_s IS NOT NULL""",
    "LapTime_s",
)


# -- teams, stints, speeds -------------------------------------------------


@query("team_stats")
def team_stats(spark, folder):
    return lap_ops.team_stats(laps(spark, folder))


sql(
    "team_stats", "laps",
    "SELECT Team, avg(LapTime_s) AS mean, median(LapTime_s) AS median, min(LapTime_s) AS min "
    "FROM laps GROUP BY Team",
    "mean median min",
)


@query("stint_length")
def stint_length(spark, folder):
    return lap_ops.stint_length(laps(spark, folder))


STINTS = (
    "stints AS (SELECT Year, Race, Driver, Stint, Compound, count(LapNumber) AS StintLength "
    "FROM laps GROUP BY ALL)"
)
sql("stint_length", "laps", "SELECT * FROM stints", "", [STINTS])


@query("stint_offsets")
def stint_offsets(spark, folder):
    return lap_ops.stint_offsets(lap_ops.stint_length(laps(spark, folder)))


sql(
    "stint_offsets", "laps",
    """SELECT *, cast(coalesce(sum(StintLength) OVER (PARTITION BY Year, Race, Driver
              ORDER BY Stint, Compound ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS bigint) AS StintStart FROM stints""",
    "", [STINTS],
)


@query("ffill_speed")
def ffill_speed(spark, folder):
    made = lap_ops.fill_forward(laps(spark, folder), ["SpeedI1"], DRIVER_KEY, ["LapNumber"])
    return made.select(*LAP_KEY, "SpeedI1")


FILLED = (
    f"filled AS (SELECT * REPLACE (last_value(SpeedI1 IGNORE NULLS) OVER (PARTITION BY {DRIVER} "
    "ORDER BY LapNumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS SpeedI1) FROM laps)"
)
SPEED_AVG = (
    "speeds AS (SELECT *, CASE WHEN SpeedI1 IS NULL THEN (SpeedI2 + SpeedFL) / 2 "
    "ELSE (SpeedI1 + SpeedI2 + SpeedFL) / 3 END AS SpeedAvg FROM filled)"
)
sql("ffill_speed", "laps", f"SELECT {KEY}, SpeedI1 FROM filled", "SpeedI1", [FILLED])


@query("row_mean")
def row_mean(spark, folder):
    return lap_ops.with_average_speed(laps(spark, folder)).select(*LAP_KEY, "SpeedAvg")


sql("row_mean", "laps", f"SELECT {KEY}, SpeedAvg FROM speeds", "SpeedAvg", [FILLED, SPEED_AVG])


@query("stint_speed")
def stint_speed(spark, folder):
    return lap_ops.stint_speed(lap_ops.with_average_speed(laps(spark, folder)))


STINT_SPEED = (
    "stintspeed AS (SELECT Year, Race, Driver, Stint, Compound, avg(SpeedAvg) AS mean, "
    "count(SpeedAvg) AS count FROM speeds GROUP BY ALL)"
)
SPEED_CTES = [FILLED, SPEED_AVG, STINT_SPEED]
sql("stint_speed", "laps", "SELECT * FROM stintspeed", "mean", SPEED_CTES)


@query("stint_summary")
def stint_summary(spark, folder):
    speeds = lap_ops.stint_speed(lap_ops.with_average_speed(laps(spark, folder)))
    return lap_ops.stint_summary(speeds)


sql(
    "stint_summary", "laps",
    "SELECT Year, Race, Driver, Compound, avg(mean) AS mean, cast(sum(count) AS bigint) AS count "
    "FROM stintspeed GROUP BY ALL",
    "mean", SPEED_CTES,
)


@query("median_speed")
def median_speed(spark, folder):
    speeds = lap_ops.with_average_speed(laps(spark, folder))
    return quantiles.percentiles(speeds, [], {"SpeedAvg": {"median": 0.5}})


sql("median_speed", "laps", "SELECT median(SpeedAvg) AS median FROM speeds", "median", SPEED_CTES)


# -- quantiles -------------------------------------------------------------


@query("quartiles")
def quartiles(spark, folder):
    return quantiles.percentiles(laps(spark, folder), ["Race"], {"LapTime_s": quantiles.QUARTILES})


sql(
    "quartiles", "laps",
    "SELECT Race, quantile_cont(LapTime_s, 0.25) AS q1, quantile_cont(LapTime_s, 0.75) AS q3 "
    "FROM laps GROUP BY Race",
    "q1 q3",
)


@query("describe")
def describe(spark, folder):
    return quantiles.describe(laps(spark, folder), "LapTime_s")


sql(
    "describe", "laps",
    """SELECT count(LapTime_s) AS count, avg(LapTime_s) AS mean, stddev_samp(LapTime_s) AS std,
              min(LapTime_s) AS min, quantile_cont(LapTime_s, 0.25) AS p25, median(LapTime_s) AS p50,
              quantile_cont(LapTime_s, 0.75) AS p75, max(LapTime_s) AS max FROM laps""",
    "mean std min p25 p50 p75 max",
)


@query("boxplot_stats")
def boxplot_stats(spark, folder):
    return quantiles.boxplot_stats(laps(spark, folder), "LapTime_s", ["Driver"])


sql(
    "boxplot_stats", "laps",
    """SELECT l.Driver, q1, median, q3,
              min(LapTime_s) FILTER (LapTime_s BETWEEN q1 - r AND q3 + r) AS whisker_low,
              max(LapTime_s) FILTER (LapTime_s BETWEEN q1 - r AND q3 + r) AS whisker_high,
              count(*) FILTER (NOT LapTime_s BETWEEN q1 - r AND q3 + r) AS outliers
       FROM laps l JOIN (SELECT *, 1.5e0 * (q3 - q1) AS r FROM (
              SELECT Driver, quantile_cont(LapTime_s, 0.25) AS q1, median(LapTime_s) AS median,
                     quantile_cont(LapTime_s, 0.75) AS q3 FROM laps GROUP BY Driver)) b
         ON l.Driver = b.Driver
       WHERE LapTime_s IS NOT NULL GROUP BY l.Driver, q1, median, q3""",
    "q1 median q3 whisker_low whisker_high",
)


@query("iqr_filter")
def iqr_filter(spark, folder):
    """Laps inside the fence of their cubed time, which has outliers."""
    known = lap_ops.with_fuel(laps(spark, folder)).withColumn("T", F.expr("LapTime_s * LapTime_s * LapTime_s"))
    return quantiles.iqr_filter(known, "T", ["T"]).select(*LAP_KEY, "T")


sql(
    "iqr_filter", "laps",
    f"""SELECT {KEY}, T FROM t, (SELECT quantile_cont(T, 0.25) AS q1, quantile_cont(T, 0.75) AS q3 FROM t)
        WHERE T BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)""",
    "T", ["t AS (SELECT *, LapTime_s * LapTime_s * LapTime_s AS T FROM laps)"],
)


@query("iqr_filter_upper")
def iqr_filter_upper(spark, folder):
    known = laps(spark, folder).withColumn("T", F.expr("LapTime_s * LapTime_s * LapTime_s"))
    made = quantiles.iqr_filter(known, "T", keys=["Driver"], lower=False)
    return made.select(*LAP_KEY, "T")


sql(
    "iqr_filter_upper", "laps",
    f"""SELECT {KEY}, T FROM t JOIN (SELECT Driver AS d, quantile_cont(T, 0.25) AS q1,
               quantile_cont(T, 0.75) AS q3 FROM t GROUP BY Driver) ON Driver = d
        WHERE T <= q3 + 1.5e0 * (q3 - q1)""",
    "T", ["t AS (SELECT *, LapTime_s * LapTime_s * LapTime_s AS T FROM laps)"],
)


# -- statistics ------------------------------------------------------------


@query("null_counts")
def null_counts(spark, folder):
    return statistics.null_counts(laps(spark, folder))


sql(
    "null_counts", "laps",
    'UNPIVOT (SELECT ' + ", ".join(f"count(*) - count({c}) AS {c}" for c in LAP_COLUMNS)
    + ' FROM laps) ON COLUMNS(*) INTO NAME "column" VALUE nulls',
)


@query("distinct_drivers")
def distinct_drivers(spark, folder):
    return laps(spark, folder).select("Driver").distinct()


sql("distinct_drivers", "laps", "SELECT DISTINCT Driver FROM laps")


@query("nunique_columns")
def nunique_columns(spark, folder):
    return statistics.nunique(laps(spark, folder), ["Driver", "Team", "Compound", "SpeedI1"])


sql(
    "nunique_columns", "laps",
    'UNPIVOT (SELECT count(DISTINCT Driver) AS Driver, count(DISTINCT Team) AS Team, '
    'count(DISTINCT Compound) AS Compound, count(DISTINCT SpeedI1) AS SpeedI1 FROM laps) '
    'ON COLUMNS(*) INTO NAME "column" VALUE "distinct"',
)

CORR = ["LapTime_s", "TyreLife", "SpeedI1", "SpeedI2", "SpeedFL"]


@query("corr_matrix")
def corr_matrix(spark, folder):
    return statistics.correlations(laps(spark, folder), CORR)


sql(
    "corr_matrix", "laps",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1e0" if a == b else f"corr({a}, {b})")
        + " AS corr FROM laps" + (" GROUP BY ()" if a == b else "")
        for a in CORR for b in CORR
    ),
    "corr",
)


@query("vif")
def vif(spark, folder):
    return statistics.variance_inflation(laps(spark, folder), INFLATED)


INFLATED = ["TyreLife", "SpeedI1", "SpeedI2", "SpeedFL", "Position", "LapTime_s"]
sql(
    "vif", "laps",
    f"SELECT unnest({INFLATED}) AS feature, unnest(list_transform(range(1, {len(INFLATED) + 1}), "
    f"lambda i: m[i][{len(INFLATED)} + i])) AS VIF FROM solved WHERE j = {len(INFLATED) + 1}",
    "VIF",
    [
        "complete AS (SELECT * FROM laps WHERE LapTime_s IS NOT NULL AND SpeedI1 IS NOT NULL)",
        "related AS (SELECT 0 AS g, ["
        + ", ".join("[" + ", ".join(f"corr({a}, {b})" for b in INFLATED) + "]" for a in INFLATED)
        + "] AS a FROM complete)",
        algebra.inverse("solved", "related", len(INFLATED)),
    ],
)


@query("residual_histogram")
def residual_histogram(spark, folder):
    errors = lap_ops.with_fuel(laps(spark, folder)).withColumn("e", F.col("LapTime_s") - F.col("SpeedI2") / 5)
    return statistics.histogram(errors, "e", 50)


sql(
    "residual_histogram", "laps",
    """SELECT cast(b AS int) AS bin, lo + b * ((hi - lo) / 50) AS "left", count(e) AS count
       FROM s, range(50) r(b) LEFT JOIN (SELECT e, least(floor((e - lo) / ((hi - lo) / 50)), 49) AS n
            FROM t, s WHERE e IS NOT NULL) x ON n = b GROUP BY b, lo, hi""",
    '"left"',
    [
        "t AS (SELECT LapTime_s - SpeedI2 / 5 AS e FROM laps)",
        "s AS (SELECT min(e) AS lo, max(e) AS hi FROM t)",
    ],
)


def predicted(spark, folder):
    """Laps with two stand-in predictions of the lap time."""
    return lap_ops.with_fuel(laps(spark, folder)).withColumn("Guess", F.col("SpeedI1") / 5)


PREDICTED = "predicted AS (SELECT *, SpeedI1 / 5 AS Guess FROM fcl)"
METRICS = """avg(pow(LapTime_s - FCL, 2)) AS FCL_MSE,
  1 - avg(pow(LapTime_s - FCL, 2)) / nullif(var_pop(LapTime_s), 0) AS FCL_R2,
  avg(pow(LapTime_s - Guess, 2)) AS Guess_MSE,
  1 - avg(pow(LapTime_s - Guess, 2)) / nullif(var_pop(LapTime_s), 0) AS Guess_R2
  FROM predicted WHERE LapTime_s IS NOT NULL AND Guess IS NOT NULL"""
BOTH = {"FCL": "FCL", "Guess": "Guess"}


@query("track_metrics")
def track_metrics(spark, folder):
    return statistics.regression_metrics(predicted(spark, folder), "LapTime_s", BOTH, ["Race"])


sql(
    "track_metrics", "laps tracks", f"SELECT Race, {METRICS} GROUP BY Race",
    "FCL_MSE FCL_R2 Guess_MSE Guess_R2", [*LAP_FUEL, PREDICTED],
)


@query("sorted_metrics")
def sorted_metrics(spark, folder):
    """Track metrics, worst first."""
    made = statistics.regression_metrics(predicted(spark, folder), "LapTime_s", BOTH, ["Race"])
    return shaping.ordered_null_last(made, "Guess_MSE", "Race", ascending=False)


sql(
    "sorted_metrics", "laps tracks", f"SELECT Race, {METRICS} GROUP BY Race ORDER BY Guess_MSE DESC",
    "FCL_MSE FCL_R2 Guess_MSE Guess_R2", [*LAP_FUEL, PREDICTED],
)


@query("global_metrics")
def global_metrics(spark, folder):
    return statistics.regression_metrics(predicted(spark, folder), "LapTime_s", BOTH)


sql(
    "global_metrics", "laps tracks", f"SELECT {METRICS}",
    "FCL_MSE FCL_R2 Guess_MSE Guess_R2", [*LAP_FUEL, PREDICTED],
)


@query("paired_ttest")
def paired_ttest(spark, folder):
    return statistics.paired_ttest(predicted(spark, folder), "LapTime_s", "Guess")


sql(
    "paired_ttest", "laps",
    f"""SELECT *, pvalue < 0.05e0 AS significant FROM (SELECT *, {algebra.two_sided_p("statistic", "df")} AS pvalue FROM (
          SELECT count(d) AS n, count(d) - 1 AS df, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS statistic
          FROM (SELECT LapTime_s - SpeedI1 / 5 AS d FROM laps)))""",
    "statistic pvalue",
)


@query("per_lap_means")
def per_lap_means(spark, folder):
    return statistics.column_means(predicted(spark, folder), ["LapTime_s", "FCL", "Guess"], ["LapNumber"])


sql(
    "per_lap_means", "laps tracks",
    "SELECT LapNumber, avg(LapTime_s) AS LapTime_s, avg(FCL) AS FCL, avg(Guess) AS Guess "
    "FROM predicted GROUP BY LapNumber",
    "LapTime_s FCL Guess", [*LAP_FUEL, PREDICTED],
)


@query("per_lap_driver_means")
def per_lap_driver_means(spark, folder):
    return statistics.column_means(
        predicted(spark, folder), ["LapTime_s", "FCL", "Guess"], ["LapNumber", "Driver"]
    )


sql(
    "per_lap_driver_means", "laps tracks",
    "SELECT LapNumber, Driver, avg(LapTime_s) AS LapTime_s, avg(FCL) AS FCL, avg(Guess) AS Guess "
    "FROM predicted GROUP BY LapNumber, Driver",
    "LapTime_s FCL Guess", [*LAP_FUEL, PREDICTED],
)


# -- joins and reshaping ---------------------------------------------------


@query("lap_feature_join")
def lap_feature_join(spark, folder):
    speeds = tel(spark, folder).groupBy(*LAP_KEY).agg(F.avg("Speed").alias("MeanLapSpeed"))
    made = lap_ops.join_features(laps(spark, folder), speeds)
    return made.select(*LAP_KEY, "LapTime_s", "MeanLapSpeed")


sql(
    "lap_feature_join", "laps tel",
    f"""SELECT {KEY}, LapTime_s, MeanLapSpeed FROM laps LEFT JOIN (
          SELECT {KEY}, avg(Speed) AS MeanLapSpeed FROM tel GROUP BY {KEY}) s USING ({KEY})""",
    "LapTime_s MeanLapSpeed",
)


@query("feature_block_join")
def feature_block_join(spark, folder):
    left = laps(spark, folder).select(*LAP_KEY, "SpeedI2", "TyreLife")
    right = telemetry.lap_features(tel(spark, folder))
    return shaping.join_blocks(left, right, LAP_KEY)


sql(
    "feature_block_join", "laps tel",
    f"""SELECT {KEY}, SpeedI2, TyreLife, MeanLapSpeed, SumLonAcc, SumLatAcc
        FROM laps JOIN features USING ({KEY})""",
    "SpeedI2 MeanLapSpeed SumLonAcc SumLatAcc", [*STEPS, LAP_FEATURES],
)


@query("melt_laps")
def melt_laps(spark, folder):
    made = lap_ops.with_fuel(laps(spark, folder))
    return shaping.melt(made, LAP_KEY, ["FCL", "LapTime_s"], "Type", "Seconds")


sql(
    "melt_laps", "laps tracks",
    f"SELECT {KEY}, 'FCL' AS Type, FCL AS Seconds FROM fcl UNION ALL "
    f"SELECT {KEY}, 'LapTime_s' AS Type, LapTime_s AS Seconds FROM fcl",
    "Seconds", LAP_FUEL,
)


@query("season_races")
def season_races(spark, folder):
    """The first grand prix events of a season, in date order."""
    days = table(spark, folder, "orders").select(
        *_season("o_custkey"), F.col("o_orderdate").cast("date").alias("EventDate")
    )
    events = days.where(F.col("Year") == 2023).groupBy("Year", "Race").agg(
        F.min("EventDate").alias("EventDate"), F.count(F.lit(1)).alias("Laps")
    )
    named = shaping.grand_prix_events(events, "Race")
    first = shaping.first_rows(named, ["EventDate", "Race"], 3)
    return first.withColumn("EventDate", F.col("EventDate").cast("string"))


sql(
    "season_races", "laps",
    f"""SELECT Year, Race, min(o_orderdate)::DATE::VARCHAR AS EventDate, count(*) AS Laps
        FROM (SELECT cast(2022 + o_custkey % 3 AS int) AS Year,
                     {_RACE_LIST}[cast(o_custkey % {len(RACES)} + 1 AS int)] AS Race, o_orderdate FROM orders)
        WHERE Year = 2023 AND contains(Race, 'Grand Prix') GROUP BY ALL ORDER BY EventDate, Race LIMIT 3""",
)
