"""Queries over telemetry samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitlane.functions.durations import interval_micros
from pitlane.constants import LAP_KEY
from pitlane.functions.scalars import SNAP, drs_open, sign_split, wrap_angle
from pitlane.operators import motion, telemetry
from pitlane.plans import race
from pitlane.workbench.book import query, sql
from pitlane.workbench.views import laps, tel

KEY = "Year, Race, DriverNumber, LapNumber"
ID = [*LAP_KEY, "SampleId"]
W = f"w AS (PARTITION BY {KEY} ORDER BY Time_s, SampleId)"
RUN = "(w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
# PI of both engines is the same double.
TURN = "(2e0 * pi())"


def centered_sql(t: str, v: str) -> str:
    before, after = f"lag({t}) OVER w", f"lead({t}) OVER w"
    vb, va = f"lag({v}) OVER w", f"lead({v}) OVER w"
    return f"""CASE
      WHEN lag(1) OVER w IS NULL AND lead(1) OVER w IS NULL THEN NULL
      WHEN lag(1) OVER w IS NULL THEN ({va} - {v}) / ({after} - {t} + 1e-9)
      WHEN lead(1) OVER w IS NULL THEN ({v} - {vb}) / ({t} - {before} + 1e-9)
      WHEN abs({after} - {before}) > 1e-9 THEN ({va} - {vb}) / ({after} - {before})
      WHEN abs({after} - {t}) > 1e-9 THEN ({va} - {v}) / ({after} - {t})
      WHEN abs({t} - {before}) > 1e-9 THEN ({v} - {vb}) / ({t} - {before})
      ELSE 0e0 END"""


def wrap_sql(x: str) -> str:
    """The angle wrapped into [-pi, pi) with the snap just under +pi."""
    r = f"(({x}) + pi()) % {TURN}"
    inside = f"((CASE WHEN {r} < 0 THEN ({r} + {TURN}) % {TURN} ELSE {r} END) - pi())"
    return f"(CASE WHEN {inside} >= pi() - {SNAP!r} THEN -pi() ELSE {inside} END)"


def even_sql(x: str, digits: int) -> str:
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def repair_sql(x: str) -> str:
    return (
        f"coalesce(last_value(CASE WHEN abs({x}) <= 7.5e0 THEN {x} END IGNORE NULLS) "
        f"OVER {RUN}, 0e0)"
    )


# Headings first, then their derivative: the running form of the definition.
STEPS = [
    f"p1 AS (SELECT *, Speed / 3.6e0 AS v, {centered_sql('Distance', 'X')} AS dx, "
    f"{centered_sql('Distance', 'Y')} AS dy FROM tel WINDOW {W})",
    "p2 AS (SELECT *, atan2(dy, dx) AS a FROM p1)",
    f"p3 AS (SELECT *, a - lag(a) OVER w AS d FROM p2 WINDOW {W})",
    f"p4 AS (SELECT *, coalesce(round_even(({wrap_sql('d')} - d) / {TURN}, 0), 0e0) AS k FROM p3)",
    f"p5 AS (SELECT *, a + {TURN} * sum(k) OVER {RUN} AS theta FROM p4 WINDOW {W})",
    f"p6 AS (SELECT *, {centered_sql('Distance', 'theta')} AS kappa, "
    f"{centered_sql('Time_s', 'v')} / 9.81e0 AS lon FROM p5 WINDOW {W})",
    "p7 AS (SELECT *, v * v * kappa / 9.81e0 AS lat FROM p6)",
    f"acc AS (SELECT *, {even_sql(repair_sql('lon'), 5)} AS LonAcc, "
    f"{even_sql(repair_sql('lat'), 5)} AS LatAcc FROM p7 WINDOW {W})",
]
LAP_FEATURES = (
    f"features AS (SELECT {KEY}, avg(Speed) AS MeanLapSpeed, "
    "coalesce(sum(abs(LonAcc)), 0e0) AS SumLonAcc, coalesce(sum(abs(LatAcc)), 0e0) AS SumLatAcc "
    f"FROM acc GROUP BY {KEY})"
)
ROW = f"{KEY}, SampleId"


@query("scan_telemetry")
def scan_telemetry(spark, folder):
    return tel(spark, folder)


sql("scan_telemetry", "tel", "SELECT * FROM tel", "Time_s Speed X Y Distance")


@query("mean_lap_speed")
def mean_lap_speed(spark, folder):
    return telemetry.with_mean_speed(tel(spark, folder)).select(*ID, "MeanLapSpeed")


sql(
    "mean_lap_speed", "tel",
    f"SELECT {ROW}, avg(Speed) OVER (PARTITION BY {KEY}) AS MeanLapSpeed FROM tel",
    "MeanLapSpeed",
)


@query("sign_split")
def split_by_sign(spark, folder):
    centred = tel(spark, folder).withColumn("dv", F.col("Speed") - 50.0)
    return sign_split(centred, "dv").select(*ID, "dv", "positive_dv", "negative_dv")


sql(
    "sign_split", "tel",
    f"SELECT {ROW}, Speed - 50e0 AS dv, greatest(Speed - 50e0, 0e0) AS positive_dv, "
    "least(Speed - 50e0, 0e0) AS negative_dv FROM tel",
    "dv positive_dv negative_dv",
)


@query("drs_normalize")
def drs_normalize(spark, folder):
    return tel(spark, folder).select(*ID, drs_open(F.col("DRS")).alias("DRS"))


sql(
    "drs_normalize", "tel",
    f"SELECT {ROW}, CASE DRS WHEN 10 THEN 1 WHEN 12 THEN 1 WHEN 14 THEN 1 ELSE 0 END AS DRS FROM tel",
)


@query("lap_progress")
def lap_progress(spark, folder):
    return telemetry.lap_progress(tel(spark, folder)).select(*ID, "LapProgress")


PROGRESS = (
    f"progress AS (SELECT *, row_number() OVER w / cast(count(*) OVER (PARTITION BY {KEY}) AS DOUBLE) "
    f"AS LapProgress FROM tel WINDOW {W})"
)
sql("lap_progress", "tel", f"SELECT {ROW}, LapProgress FROM progress", "LapProgress", [PROGRESS])


@query("last_sample_per_lap")
def last_sample_per_lap(spark, folder):
    return telemetry.last_sample_per_lap(tel(spark, folder))


sql(
    "last_sample_per_lap", "tel",
    f"SELECT DISTINCT ON ({KEY}) * FROM tel WHERE LapNumber >= 1 "
    f"ORDER BY {KEY}, Time_s DESC, SampleId DESC",
    "Time_s Speed X Y Distance",
)


@query("sma")
def sma(spark, folder):
    made = telemetry.moving_average(tel(spark, folder), "Speed", [5, 10])
    return made.select(*ID, "last_5_SMA", "last_10_SMA")


def sma_sql(n: int) -> str:
    frame = f"(w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(Speed) OVER {frame} = {n} THEN avg(Speed) OVER {frame} END AS last_{n}_SMA"


sql(
    "sma", "tel", f"SELECT {ROW}, {sma_sql(5)}, {sma_sql(10)} FROM tel WINDOW {W}",
    "last_5_SMA last_10_SMA",
)


@query("ema")
def ema(spark, folder):
    gaps = tel(spark, folder).withColumn("Speed", F.when(F.col("DRS") != 3, F.col("Speed")))
    made = telemetry.exponential_average(gaps, "Speed", [5, 10])
    return made.select(*ID, "last_5_EMA", "last_10_EMA")


def ema_sql(n: int) -> str:
    r = f"(1e0 - 2e0 / {n + 1})"
    return (
        f"sum(CASE WHEN b.Speed IS NOT NULL THEN b.Speed * pow({r}, a.i - b.i) END) "
        f"/ sum(CASE WHEN b.Speed IS NOT NULL THEN pow({r}, a.i - b.i) END) AS last_{n}_EMA"
    )


sql(
    "ema", "tel",
    "SELECT a.Year, a.Race, a.DriverNumber, a.LapNumber, a.SampleId, "
    f"{ema_sql(5)}, {ema_sql(10)} FROM n a JOIN n b ON a.Year = b.Year AND a.Race = b.Race "
    "AND a.DriverNumber = b.DriverNumber AND a.LapNumber = b.LapNumber AND b.i <= a.i "
    "GROUP BY ALL",
    "last_5_EMA last_10_EMA",
    [
        f"n AS (SELECT {ROW}, CASE WHEN DRS <> 3 THEN Speed END AS Speed, "
        f"row_number() OVER w AS i FROM tel WINDOW {W})"
    ],
)


@query("derivative_centered")
def derivative_centered(spark, folder):
    return motion.derivative(tel(spark, folder), "Time_s", "Speed", "dvdt").select(*ID, "dvdt")


sql(
    "derivative_centered", "tel",
    f"SELECT {ROW}, {centered_sql('Time_s', 'Speed')} AS dvdt FROM tel WINDOW {W}", "dvdt",
)


@query("derivative_smooth")
def derivative_smooth(spark, folder):
    made = motion.derivative(tel(spark, folder), "Time_s", "Speed", "dvdt", method="smooth")
    return made.select(*ID, "dvdt")


def smooth_sql() -> str:
    def term(j: int, c: str) -> str:
        span = f"(lead(Time_s, {j}) OVER w - lag(Time_s, {j}) OVER w)"
        rise = f"(lead(Speed, {j}) OVER w - lag(Speed, {j}) OVER w)"
        return f"CASE WHEN {span} = 0 THEN 0e0 ELSE 2 * {j} * {c} * {rise} / {span} END"

    def quotient(a: int, b: int) -> str:
        at = {-1: "lag({}) OVER w", 0: "{}", 1: "lead({}) OVER w"}
        t1, t0 = at[b].format("Time_s"), at[a].format("Time_s")
        v1, v0 = at[b].format("Speed"), at[a].format("Speed")
        return f"({v1} - {v0}) / ({t1} - {t0} + 1e-9)"

    return f"""CASE
      WHEN n = 1 THEN NULL
      WHEN i = 1 THEN {quotient(0, 1)}
      WHEN i = n THEN {quotient(-1, 0)}
      WHEN i <= 3 OR i > n - 3 THEN {quotient(-1, 1)}
      ELSE {term(1, '5e0/32e0')} + {term(2, '4e0/32e0')} + {term(3, '1e0/32e0')} END"""


sql(
    "derivative_smooth", "tel",
    f"SELECT {ROW}, {smooth_sql()} AS dvdt FROM n WINDOW {W}", "dvdt",
    [
        f"n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY {KEY}) AS n "
        f"FROM tel WINDOW {W})"
    ],
)


@query("channel_derivative")
def channel_derivative(spark, folder):
    """Derivative of a control channel over time since the lap's first sample."""
    timed = telemetry.relative_time(tel(spark, folder), LAP_KEY)
    channel = timed.withColumn("Throttle", F.col("DRS").cast("double"))
    made = motion.derivative(channel, "RelativeTime_s", "Throttle", "dThrottle")
    return made.select(*ID, "dThrottle")


sql(
    "channel_derivative", "tel",
    f"SELECT {ROW}, {centered_sql('rt', 'thr')} AS dThrottle FROM c WINDOW {W}", "dThrottle",
    [
        f"c AS (SELECT *, Time_s - min(Time_s) OVER (PARTITION BY {KEY}) AS rt, "
        "cast(DRS AS DOUBLE) AS thr FROM tel)"
    ],
)


@query("relative_time")
def relative_time(spark, folder):
    return telemetry.relative_time(tel(spark, folder), LAP_KEY).select(*ID, "RelativeTime_s")


sql(
    "relative_time", "tel",
    f"SELECT {ROW}, Time_s - min(Time_s) OVER (PARTITION BY {KEY}) AS RelativeTime_s FROM tel",
    "RelativeTime_s",
)


@query("heading")
def heading(spark, folder):
    return motion.path_angle(tel(spark, folder)).select(*ID, "Angle")


sql("heading", "tel", f"SELECT {ROW}, a AS Angle FROM p2", "Angle", STEPS[:2])


@query("wrap_angle")
def wrapped(spark, folder):
    angle = wrap_angle((F.col("X") - 50.0) * F.lit(0.3))
    return tel(spark, folder).select(*ID, angle.alias("_w")).select(*ID, "_w.angle", "_w.revolutions")


sql(
    "wrap_angle", "tel",
    f"SELECT {ROW}, {wrap_sql('raw')} AS angle, "
    f"cast(round_even((raw - {wrap_sql('raw')}) / {TURN}, 0) AS int) AS revolutions FROM "
    "(SELECT *, (X - 50e0) * 0.3e0 AS raw FROM tel)",
    "angle",
)


@query("heading_unwrap")
def heading_unwrap(spark, folder):
    return motion.heading_unwrap(tel(spark, folder)).select(*ID, "Heading")


sql("heading_unwrap", "tel", f"SELECT {ROW}, theta AS Heading FROM p5", "Heading", STEPS[:5])


@query("curvature")
def curvature(spark, folder):
    return motion.curvature(tel(spark, folder)).select(*ID, "Curvature")


sql("curvature", "tel", f"SELECT {ROW}, kappa AS Curvature FROM p6", "Curvature", STEPS[:6])


@query("outlier_repair")
def outlier_repair(spark, folder):
    """Some values are missing, some are NaN, which is the same."""
    number = F.col("SampleId")
    value = F.when(number % 19 == 0, float("nan")).when(number % 23 != 0, (F.col("Speed") - 50.0) / 4.0)
    raw = tel(spark, folder).withColumn("Raw", value)
    return motion.outlier_repair(raw, "Raw", "Clean").select(*ID, "Clean")


sql(
    "outlier_repair", "tel",
    f"""SELECT {ROW}, CASE WHEN NOT isnan(kept) THEN kept END AS Clean FROM (
          SELECT *, coalesce(last_value(CASE WHEN Raw IS NULL THEN 'nan'::DOUBLE
                             WHEN abs(Raw) <= 7.5e0 THEN Raw END IGNORE NULLS) OVER {RUN}, 0e0) AS kept
          FROM (SELECT *, CASE WHEN SampleId % 19 <> 0 AND SampleId % 23 <> 0 THEN (Speed - 50e0) / 4e0 END AS Raw
                FROM tel) WINDOW {W})""",
    "Clean",
)


@query("lon_acc")
def lon_acc(spark, folder):
    return motion.accelerations(tel(spark, folder), lateral=False).select(*ID, "LonAcc")


sql("lon_acc", "tel", f"SELECT {ROW}, LonAcc FROM acc", "LonAcc", STEPS)


@query("lat_acc")
def lat_acc(spark, folder):
    return motion.accelerations(tel(spark, folder)).select(*ID, "LatAcc")


sql("lat_acc", "tel", f"SELECT {ROW}, LatAcc FROM acc", "LatAcc", STEPS)


@query("accelerations")
def accelerations(spark, folder):
    return motion.with_lap_sums(tel(spark, folder)).select(
        *ID, "LonAcc", "LatAcc", "AbsLonAcc", "AbsLatAcc", "SumLonAcc", "SumLatAcc"
    )


sql(
    "accelerations", "tel",
    f"SELECT {ROW}, LonAcc, LatAcc, abs(LonAcc) AS AbsLonAcc, abs(LatAcc) AS AbsLatAcc, "
    f"sum(abs(LonAcc)) OVER (PARTITION BY {KEY}) AS SumLonAcc, "
    f"sum(abs(LatAcc)) OVER (PARTITION BY {KEY}) AS SumLatAcc FROM acc",
    "LonAcc LatAcc AbsLonAcc AbsLatAcc SumLonAcc SumLatAcc", STEPS,
)


@query("lap_abs_acc")
def lap_abs_acc(spark, folder):
    return telemetry.lap_abs_acc(tel(spark, folder))


sql("lap_abs_acc", "tel", f"SELECT {KEY}, SumLonAcc FROM features", "SumLonAcc", [*STEPS, LAP_FEATURES])


@query("max_lap")
def max_lap(spark, folder):
    from pitlane.operators.laps import max_lap as largest

    return largest(tel(spark, folder), LAP_KEY[:-1])


sql(
    "max_lap", "tel",
    "SELECT Year, Race, DriverNumber, max(LapNumber) AS MaxLap FROM tel GROUP BY ALL",
)


@query("binned_agg")
def binned_agg(spark, folder):
    placed = telemetry.lap_progress(tel(spark, folder))
    return telemetry.binned(placed, "Speed", bins=10, how="sum")


sql(
    "binned_agg", "tel",
    """SELECT LapNumber, cast(least(greatest(ceil((LapProgress - lo) / ((hi - lo) / 10)) - 1, 0), 9)
         AS int) AS bin, sum(Speed) AS sum_of_Speed
       FROM progress, (SELECT min(LapProgress) AS lo, max(LapProgress) AS hi FROM progress)
       GROUP BY ALL""",
    "sum_of_Speed", [PROGRESS],
)


@query("align_series")
def align_series(spark, folder):
    """Each driver's first and second lap cut to the same number of samples."""
    samples = tel(spark, folder)
    key = LAP_KEY[:-1]
    first = samples.where(F.col("LapNumber") == 1)
    second = samples.where(F.col("LapNumber") == 2)
    made = telemetry.align_series(first, second, key, motion.SAMPLE_ORDER)
    return made.select(*ID, "Side", "Position")


sql(
    "align_series", "tel",
    f"""SELECT {ROW}, Side, Position FROM (
          SELECT *, min(n) OVER (PARTITION BY Year, Race, DriverNumber) AS shortest,
                 count(DISTINCT Side) OVER (PARTITION BY Year, Race, DriverNumber) AS sides
          FROM (SELECT *, CASE LapNumber WHEN 1 THEN 'left' ELSE 'right' END AS Side,
                       row_number() OVER w AS Position, count(*) OVER (PARTITION BY {KEY}) AS n
                FROM tel WHERE LapNumber IN (1, 2) WINDOW {W}))
        WHERE sides = 2 AND Position <= shortest""",
)


def lap_time_micros(df):
    """Intervals have no common form in both engines, microseconds have."""
    return df.withColumn("LapTime_us", interval_micros(F.col("LapTime"))).drop("LapTime")


LAP_TIME_US = "cast(round(LapTime_s * 1e6) AS bigint) AS LapTime_us"


@query("race_features")
def race_features(spark, folder):
    return lap_time_micros(race.race_features(laps(spark, folder), tel(spark, folder)))


LAP_FUEL = [
    "fuel AS (SELECT l.*, 99e0 / floor(RaceLength_km / LapLength_km) AS FuelPerLap, "
    "CASE WHEN LapNumber = 1 THEN 100e0 ELSE greatest(0e0, 100e0 - (LapNumber - 1) * "
    "(99e0 / floor(RaceLength_km / LapLength_km))) END AS StartFuel "
    "FROM laps l JOIN tracks t ON l.Race = t.Race)",
    "fcl AS (SELECT *, floor((cast(round(LapTime_s * 1e9) AS bigint) - "
    "cast(trunc(0.03e0 * (CASE WHEN LapNumber = 1 THEN 100e0 ELSE (StartFuel + CASE WHEN LapNumber = 2 "
    "THEN 100e0 ELSE StartFuel + FuelPerLap END) / 2 END) * 1e9) AS bigint)) / 1e3) / 1e6 AS FCL "
    "FROM fuel)",
]
sql(
    "race_features", "laps tel tracks",
    f"""SELECT l.Year, l.Race, l.LapNumber, Driver, Compound, TyreLife, StartFuel, FCL,
              {LAP_TIME_US}, LapTime_s, SpeedI1, SpeedI2, SpeedFL, SumLonAcc, SumLatAcc, MeanLapSpeed
       FROM fcl l LEFT JOIN features f ON l.Year = f.Year AND l.Race = f.Race
            AND l.DriverNumber = f.DriverNumber AND l.LapNumber = f.LapNumber""",
    "StartFuel FCL LapTime_s SpeedI1 SpeedI2 SpeedFL SumLonAcc SumLatAcc MeanLapSpeed",
    [*STEPS, LAP_FEATURES, *LAP_FUEL],
)
