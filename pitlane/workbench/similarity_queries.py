"""Queries on warping distances and on nearest-time matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitlane.constants import DRIVER_KEY, LAP_KEY, SAMPLE_ORDER
from pitlane.operators import matching, similarity
from pitlane.operators.laps import fastest_lap
from pitlane.operators.motion import accelerations
from pitlane.plans import style as style_plan
from pitlane.workbench.book import query, sql
from pitlane.workbench.lap_queries import DRIVER
from pitlane.workbench.telemetry_queries import KEY, ROW, STEPS
from pitlane.workbench.views import laps, table, tel

INF = "'Infinity'::DOUBLE"


def warp_sql(name: str, pairs: str) -> str:
    """One matrix row per recursion step over pairs(id, a, b)."""
    cost = "pow(p.a[w.i + 1] - p.b[cast(e[1] AS int)], 2)"
    best = "least(acc[cast(e[1] AS int)], w.r[cast(e[1] AS int)], w.r[cast(e[1] AS int) + 1])"
    return f"""{name} AS (
      SELECT id, 0 AS i, list_prepend(0e0, list_transform(b, lambda x: {INF})) AS r FROM {pairs}
      UNION ALL SELECT w.id, w.i + 1, list_reduce(
          list_transform(range(1, len(p.b) + 1), lambda j: [cast(j AS DOUBLE)]),
          lambda acc, e: list_append(acc, {cost} + {best}), [{INF}])
      FROM {name} w JOIN {pairs} p ON w.id = p.id WHERE w.i < len(p.a))"""


def ended_sql(name: str, pairs: str) -> str:
    return (
        f"(SELECT w.id, sqrt(w.r[-1]) AS distance FROM {name} w JOIN {pairs} p ON w.id = p.id "
        "WHERE w.i = len(p.a))"
    )


@query("dtw_distance")
def dtw_distance(spark, folder):
    """Each embedding against the first one of its label."""
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("a")
    )
    first = vectors.groupBy("label").agg(F.min_by("a", "vec_id").alias("b"))
    pairs = vectors.join(first, "label")
    return pairs.select("vec_id", similarity.warp_distance("b", "a").alias("distance"))


sql(
    "dtw_distance", "",
    f"SELECT id AS vec_id, distance FROM {ended_sql('wp', 'pairs')} d", "distance",
    [
        """pairs AS (SELECT vec_id AS id, b AS a, a AS b FROM (SELECT vec_id, label,
             cast(embedding AS DOUBLE[]) AS a FROM embeddings) JOIN (SELECT label, arg_min(
             cast(embedding AS DOUBLE[]), vec_id) AS b FROM embeddings GROUP BY label) USING (label))""",
        warp_sql("wp", "pairs"),
    ],
)


def style(spark, folder):
    samples, own = tel(spark, folder), laps(spark, folder)
    return style_plan.style(own, samples, own, samples)


ARRAYS = [
    *STEPS,
    f"landed AS (SELECT * FROM laps WHERE ({KEY}) IN (SELECT ({KEY}) FROM tel))",
    f"reference AS (SELECT DISTINCT ON ({DRIVER}) {KEY} FROM landed WHERE LapTime_s IS NOT NULL "
    f"ORDER BY {DRIVER}, IsPersonalBest DESC, LapTime_s, LapNumber)",
    f"arrays AS (SELECT {KEY}, list(LonAcc ORDER BY Time_s, SampleId) FILTER (LonAcc IS NOT NULL) AS lon, "
    f"list(LatAcc ORDER BY Time_s, SampleId) FILTER (LatAcc IS NOT NULL) AS lat FROM acc GROUP BY {KEY})",
    f"refs AS (SELECT {DRIVER}, lon AS rlon, lat AS rlat FROM arrays JOIN reference USING ({KEY}))",
]


def style_sql(refs: str) -> list[str]:
    joined = f"JOIN refs USING ({DRIVER})" if refs == "refs" else f"CROSS JOIN {refs}"
    return [
        f"lonp AS MATERIALIZED (SELECT ({KEY}) AS id, rlon AS a, lon AS b FROM arrays {joined})",
        f"latp AS MATERIALIZED (SELECT ({KEY}) AS id, rlat AS a, lat AS b FROM arrays {joined})",
        warp_sql("lonw", "lonp"),
        warp_sql("latw", "latp"),
        f"style AS (SELECT a.id[1] AS Year, a.id[2] AS Race, a.id[3] AS DriverNumber, "
        "a.id[4] AS LapNumber, a.distance AS LonDistanceDTW, b.distance AS LatDistanceDTW "
        f"FROM {ended_sql('lonw', 'lonp')} a JOIN {ended_sql('latw', 'latp')} b ON a.id = b.id)",
    ]


@query("dtw_style")
def dtw_style(spark, folder):
    return style(spark, folder)


BOTH = "LonDistanceDTW LatDistanceDTW"
sql("dtw_style", "laps tel", "SELECT * FROM style", BOTH, [*ARRAYS, *style_sql("refs")])


@query("dtw_join")
def dtw_join(spark, folder):
    joined = style_plan.with_style(laps(spark, folder), style(spark, folder))
    return joined.select(*LAP_KEY, "LapTime_s", "LonDistanceDTW", "LatDistanceDTW")


sql(
    "dtw_join", "laps tel",
    f"SELECT {KEY}, LapTime_s, LonDistanceDTW, LatDistanceDTW FROM laps LEFT JOIN style USING ({KEY})",
    f"LapTime_s {BOTH}", [*ARRAYS, *style_sql("refs")],
)


@query("dtw_mean")
def dtw_mean(spark, folder):
    return style(spark, folder).groupBy("DriverNumber").agg(
        F.avg("LonDistanceDTW").alias("LonDistanceDTW"), F.avg("LatDistanceDTW").alias("LatDistanceDTW")
    )


sql(
    "dtw_mean", "laps tel",
    "SELECT DriverNumber, avg(LonDistanceDTW) AS LonDistanceDTW, avg(LatDistanceDTW) AS LatDistanceDTW "
    "FROM style GROUP BY DriverNumber",
    BOTH, [*ARRAYS, *style_sql("refs")],
)


@query("reference_signal")
def reference_signal(spark, folder):
    samples, own = tel(spark, folder), laps(spark, folder)
    there = style_plan.landed(own, samples)
    return similarity.reference_signal(there, samples, there, samples).select(
        *LAP_KEY, "SampleId", "LonAcc", "LatAcc"
    )


sql(
    "reference_signal", "laps tel",
    f"SELECT {ROW}, LonAcc, LatAcc FROM acc JOIN reference USING ({KEY})", "LonAcc LatAcc", ARRAYS,
)


@query("dtw_single_reference")
def dtw_single_reference(spark, folder):
    """Every lap against the one fastest personal best that has telemetry."""
    samples, own = tel(spark, folder), laps(spark, folder)
    best = fastest_lap(style_plan.landed(own, samples), DRIVER_KEY)
    one = best.orderBy("LapTime_s", "DriverNumber").limit(1)
    reference = accelerations(samples.join(F.broadcast(one), LAP_KEY, "left_semi"))
    return similarity.distances(accelerations(samples), reference, similarity.STYLE, on=[])


ONE = (
    "one AS (SELECT lon AS rlon, lat AS rlat FROM arrays JOIN (SELECT * FROM landed WHERE LapTime_s "
    f"IS NOT NULL AND IsPersonalBest ORDER BY LapTime_s, DriverNumber LIMIT 1) b USING ({KEY}))"
)
sql(
    "dtw_single_reference", "laps tel", "SELECT * FROM style", BOTH,
    [*ARRAYS, ONE, *style_sql("one")],
)


@query("acc_arrays")
def acc_arrays(spark, folder):
    """The blocks of ordered values, unfolded again with their places."""
    acc = accelerations(tel(spark, folder))
    blocks = similarity.value_blocks(acc, LAP_KEY, SAMPLE_ORDER, "LonAcc", 4096)
    place = (F.col("Block") * 4096 + F.col("pos") + 1).cast("long")
    unfolded = blocks.select(*LAP_KEY, "Block", F.posexplode("LonAcc").alias("pos", "LonAcc"))
    return unfolded.select(*LAP_KEY, place.alias("Place"), "LonAcc")


sql(
    "acc_arrays", "tel",
    f"SELECT {KEY}, row_number() OVER w AS Place, LonAcc FROM acc WHERE LonAcc IS NOT NULL "
    f"WINDOW w AS (PARTITION BY {KEY} ORDER BY Time_s, SampleId)",
    "LonAcc", STEPS,
)


# -- nearest in time -------------------------------------------------------

BY = ["user_id"]


def samples_and_starts(spark, folder):
    """Start times are purchases, moved by an hour; the other events are the samples.

    Some of either have no time, as in delivered data.
    """
    later = F.col("ts") + F.expr("INTERVAL '0 1:00:00' DAY TO SECOND")
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "value", "event_type")
    marks = events.where(F.col("event_type") == "purchase")
    known = F.when(F.col("event_id") % 13 != 0, later)
    starts = marks.select("user_id", F.col("event_id").alias("start_id"), known.alias("start"))
    samples = events.where(F.col("event_type") != "purchase").drop("event_type")
    return samples.withColumn("ts", F.when(F.col("event_id") % 17 != 0, F.col("ts"))), starts


NEAR = [
    "samples AS (SELECT user_id, event_id, CASE WHEN event_id % 17 <> 0 THEN ts END AS ts, value "
    "FROM events WHERE event_type <> 'purchase')",
    "starts AS (SELECT user_id, event_id AS start_id, "
    "CASE WHEN event_id % 13 <> 0 THEN ts + INTERVAL 1 HOUR END AS start FROM events "
    "WHERE event_type = 'purchase')",
    """near AS (SELECT s.user_id, s.start_id, s.start,
         CASE WHEN p.ts IS NULL OR n.ts - s.start < s.start - p.ts THEN n.event_id ELSE p.event_id END
           AS event_id,
         CASE WHEN p.ts IS NULL OR n.ts - s.start < s.start - p.ts THEN n.ts ELSE p.ts END AS ts
       FROM starts s ASOF LEFT JOIN samples p ON s.user_id = p.user_id AND s.start >= p.ts
       ASOF LEFT JOIN samples n ON s.user_id = n.user_id AND s.start < n.ts)""",
]


@query("asof_nearest")
def asof_nearest(spark, folder):
    samples, starts = samples_and_starts(spark, folder)
    return matching.nearest(starts, samples, BY, "start", "ts", "event_id").drop("start")


sql("asof_nearest", "", "SELECT user_id, start_id, event_id, ts FROM near", "", NEAR)


@query("asof_tolerance")
def asof_tolerance(spark, folder):
    samples, starts = samples_and_starts(spark, folder)
    limit = 4 * 3600 * 1_000_000
    made = matching.nearest(
        starts, samples, BY, "start", "ts", "event_id", ["value"], tolerance_us=limit
    )
    return made.where(F.col("ts").isNotNull()).drop("start")


sql(
    "asof_tolerance", "",
    """SELECT near.user_id, start_id, near.event_id, near.ts, samples.value FROM near
       JOIN samples ON near.event_id = samples.event_id
       WHERE abs(date_diff('microsecond', near.ts, start)) <= 14400000000""",
    "value", NEAR,
)


@query("lap_tagging")
def lap_tagging(spark, folder):
    samples, starts = samples_and_starts(spark, folder)
    return matching.tag_laps(samples, starts, BY, "ts", "event_id", "start").drop("value")


sql(
    "lap_tagging", "",
    """SELECT s.user_id, s.event_id, s.ts, cast(CASE WHEN closing IS NOT NULL AND s.pos > closing + 1
              THEN 0 ELSE 1 + coalesce((SELECT count(*) FROM b WHERE b.user_id = s.user_id
                AND b.pos <= s.pos AND NOT last), 0) END AS int) AS LapNumber
       FROM placed s LEFT JOIN (SELECT user_id, pos AS closing FROM b WHERE last) c
         ON s.user_id = c.user_id
       UNION ALL SELECT user_id, event_id, ts, NULL FROM samples WHERE ts IS NULL""",
    "",
    [
        *NEAR,
        "placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos "
        "FROM samples WHERE ts IS NOT NULL)",
        """b AS (SELECT near.user_id, pos, start = max(start) OVER (PARTITION BY near.user_id) AS last
             FROM near JOIN placed ON near.event_id = placed.event_id)""",
    ],
)


@query("lap_slice")
def lap_slice(spark, folder):
    """Samples between each user's first two start times."""
    samples, starts = samples_and_starts(spark, folder)
    order = Window.partitionBy("user_id").orderBy("start")
    two = starts.where(F.col("start").isNotNull()).withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2)
    bounds = two.groupBy("user_id").agg(F.min("start").alias("begin"), F.max("start").alias("end"))
    return matching.lap_slice(samples, bounds, BY, "ts", "event_id", "begin", "end").drop("value")


sql(
    "lap_slice", "",
    """SELECT s.user_id, s.event_id, s.ts FROM samples s JOIN (
         SELECT user_id, min(ts) AS a, max(ts) AS b FROM (SELECT near.*, row_number() OVER
           (PARTITION BY user_id ORDER BY start) AS n FROM near WHERE start IS NOT NULL) WHERE n <= 2 GROUP BY user_id) e
       ON s.user_id = e.user_id WHERE s.ts >= a AND s.ts < b""",
    "", NEAR,
)
