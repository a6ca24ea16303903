"""Queries that prepare data for models, train them and score laps."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from pitlane.constants import LAP_KEY, MODEL_FEATURES
from pitlane.functions.scalars import quadratic_features
from pitlane.operators import learning, statistics
from pitlane.operators.series import hand_down
from pitlane.plans import evaluation, strategy
from pitlane.plans import style as style_plan
from pitlane.workbench import algebra
from pitlane.workbench.book import query, sql
from pitlane.workbench.lap_queries import SPEED_CTES, STINTS
from pitlane.workbench.similarity_queries import ARRAYS, style_sql
from pitlane.workbench.telemetry_queries import KEY, LAP_FEATURES, LAP_FUEL
from pitlane.workbench.views import laps, tel

FEATURES = ["TyreLife", "SpeedI1", "SpeedI2", "SpeedFL"]
LABEL = "LapTime_s"


def known(spark, folder):
    """Complete laps with numeric features."""
    return learning.numeric(laps(spark, folder), FEATURES).dropna(subset=[*FEATURES, LABEL])


KNOWN = "known AS (SELECT * FROM laps WHERE LapTime_s IS NOT NULL AND SpeedI1 IS NOT NULL)"


# -- preparation -----------------------------------------------------------


@query("label_encode")
def label_encode(spark, folder):
    text = ["Compound", "Team", "Race"]
    made = learning.label_encode(laps(spark, folder), text)
    return made.select("DriverNumber", "LapNumber", *text)


sql(
    "label_encode", "laps",
    "SELECT DriverNumber, LapNumber, "
    + ", ".join(
        f"cast(dense_rank() OVER (ORDER BY encode({c})) - 1 AS int) AS {c}"
        for c in ("Compound", "Team", "Race")
    )
    + " FROM laps",
)


@query("standard_scale")
def standard_scale(spark, folder):
    made = statistics.standard_scale(known(spark, folder), FEATURES)
    return made.select(*LAP_KEY, *FEATURES)


sql(
    "standard_scale", "laps",
    f"SELECT {KEY}, "
    + ", ".join(
        f"({c} - (SELECT avg({c}) FROM known)) / (SELECT stddev_pop({c}) FROM known) AS {c}"
        for c in FEATURES
    )
    + " FROM known",
    " ".join(FEATURES), [KNOWN],
)


@query("train_test_split")
def train_test_split(spark, folder):
    """The part of every lap for two seeds."""
    own = laps(spark, folder)
    parts = [
        learning.train_test_split(own, LAP_KEY, 0.2, seed).withColumn("Seed", F.lit(seed))
        for seed in (42, 1221)
    ]
    return parts[0].unionByName(parts[1]).select(*LAP_KEY, "Seed", "Part")


sql(
    "train_test_split", "laps",
    f"""SELECT {KEY}, Seed, CASE WHEN row_number() OVER (PARTITION BY Seed ORDER BY hash, {KEY})
               <= ceil(count(*) OVER (PARTITION BY Seed) * 0.2e0) THEN 'test' ELSE 'train' END AS Part
        FROM (SELECT {KEY}, Seed, md5(concat_ws('|', {KEY}, Seed)) AS hash
              FROM laps, (VALUES (42), (1221)) s(Seed))""",
)


@query("kfold_ids")
def kfold_ids(spark, folder):
    order = ["DriverNumber", "LapNumber"]
    return learning.kfold(known(spark, folder), order).select(*order, "Fold")


sql(
    "kfold_ids", "laps",
    """SELECT DriverNumber, LapNumber, cast(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
              ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS int) AS Fold
       FROM (SELECT *, row_number() OVER (ORDER BY encode(DriverNumber), LapNumber) - 1 AS i,
                    count(*) OVER () AS n FROM known)""",
    "", [KNOWN],
)


def season(spark, folder):
    """Processed laps whose telemetry arrived, with style distances and the track name."""
    raced = style_plan.styled_features(laps(spark, folder), tel(spark, folder))
    return hand_down(raced.withColumn("Track", F.col("Race")), raced)


@query("model_dataset")
def model_dataset(spark, folder):
    return learning.model_dataset(season(spark, folder))


sql(
    "model_dataset", "laps tel tracks",
    f"""SELECT Year, Race AS Track, Driver, cast(row_number() OVER (PARTITION BY Driver, Race
               ORDER BY LapNumber, Year) AS int) AS LapNumber, {", ".join(MODEL_FEATURES)},
               round(LapTime_s, 6) AS LapTime
        FROM fcl JOIN features USING ({KEY}) JOIN style USING ({KEY})
        WHERE LapTime_s IS NOT NULL AND SpeedI1 IS NOT NULL""",
    "StartFuel SpeedI1 SpeedI2 SpeedFL SumLonAcc SumLatAcc MeanLapSpeed LonDistanceDTW "
    "LatDistanceDTW LapTime",
    [*ARRAYS, LAP_FEATURES, *LAP_FUEL, *style_sql("refs")],
)


# -- linear models ---------------------------------------------------------


@query("linreg")
def linreg(spark, folder):
    return learning.coefficients(learning.linear(known(spark, folder), FEATURES, LABEL))


FIT = algebra.regression("known", FEATURES, LABEL)
PREDICTED = algebra.predicted(FEATURES)
TERMS = f"unnest({[*FEATURES, 'const']}) AS term, unnest(list_append(b, b0)) AS coef"
sql("linreg", "laps", f"SELECT {TERMS} FROM fit", "coef", [KNOWN, *FIT])


@query("ols_summary")
def ols_summary(spark, folder):
    return learning.ols_summary(learning.linear(known(spark, folder), FEATURES, LABEL))


WIDTH = len(FEATURES)
# The variance of the constant is 1/n + m' V m, of a slope V's diagonal, over the rows' covariance.
VARIANCES = f"""list_append(list_transform(range(1, {WIDTH + 1}), lambda i: v[i][i] / n),
  1e0 / n + list_sum(list_transform(range(1, {WIDTH + 1}), lambda r: list_sum(list_transform(range(1, {WIDTH + 1}), lambda c: mx[r] * v[r][c] * mx[c])))) / n)"""
sql(
    "ols_summary", "laps",
    f"""SELECT term, coef, std_err, t, {algebra.two_sided_p("t", "f")} AS p, r2, 1 - (1 - r2) * (n - 1) / f AS r2_adj
        FROM (SELECT *, coef / std_err AS t FROM (
          SELECT {TERMS}, sqrt(s2 * unnest({VARIANCES})) AS std_err, r2, n, n - {WIDTH + 1} AS f FROM fit))""",
    "coef std_err t p r2 r2_adj", [KNOWN, *FIT],
)


def quadratic(spark, folder):
    """Finish-line speed around its middle, with its square."""
    centred = known(spark, folder).withColumn("S", (F.col("SpeedFL") - 285.0) / 20.0)
    return quadratic_features(centred, ["S"])


@query("ols_quadratic")
def ols_quadratic(spark, folder):
    fitted = learning.linear(quadratic(spark, folder), ["S", "S2"], LABEL)
    return learning.ols_summary(fitted).select("term", "coef", "r2")


QUADRATIC = [
    KNOWN,
    "xy AS (SELECT s AS x, s * s AS z, LapTime_s AS y FROM "
    "(SELECT (SpeedFL - 285e0) / 20e0 AS s, LapTime_s FROM known))",
    "m AS (SELECT avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, "
    "covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy, var_pop(y) AS yy, "
    "max(x) AS top FROM xy)",
    "q AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, "
    "(zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM m)",
    "f AS (SELECT *, my - b1 * mx - b2 * mz AS b0, (b1 * xy + b2 * zy) / yy AS r2 FROM q)",
]
sql(
    "ols_quadratic", "laps",
    "SELECT 'S' AS term, b1 AS coef, r2 FROM f UNION ALL SELECT 'S2', b2, r2 FROM f "
    "UNION ALL SELECT 'const', b0, r2 FROM f",
    "coef r2", QUADRATIC,
)


@query("partial_effect")
def partial_effect(spark, folder):
    rows = quadratic(spark, folder)
    fitted = learning.linear(rows, ["S", "S2"], LABEL)
    return learning.partial_effect(fitted, rows, "S", "S2")


sql(
    "partial_effect", "laps",
    "SELECT i * top / 99 AS S, b0 + b1 * (i * top / 99) + b2 * (i * top / 99) * (i * top / 99) "
    "AS Prediction FROM f, range(100) r(i)",
    "S Prediction", QUADRATIC,
)


@query("cv_mse")
def cv_mse(spark, folder):
    """Cross-validated error of the linear model."""
    value = learning.cross_validated_mse(known(spark, folder), FEATURES, LABEL, ["DriverNumber", "LapNumber"])
    return spark.createDataFrame([(value,)], "MSE double")


sql(
    "cv_mse", "laps",
    f"SELECT avg(e) AS MSE FROM (SELECT g, avg(pow({LABEL} - ({PREDICTED}), 2)) AS e FROM folds JOIN fit ON Fold = g GROUP BY g)",
    "MSE",
    [
        KNOWN,
        """folds AS (SELECT *, cast(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
             ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS int) AS Fold
           FROM (SELECT *, row_number() OVER (ORDER BY encode(DriverNumber), LapNumber) - 1 AS i,
                        count(*) OVER () AS n FROM known))""",
        "others AS (SELECT folds.* EXCLUDE (n, i), v.f FROM folds, (VALUES (0), (1), (2), (3), (4)) v(f) WHERE Fold <> v.f)",
        *algebra.regression("others", FEATURES, LABEL, "f"),
    ],
)


@query("score_season")
def score_season(spark, folder):
    """All laps with known features, scored by the model fitted on the complete ones."""
    fitted = learning.linear(known(spark, folder), FEATURES, LABEL)
    made = fitted.score(learning.numeric(laps(spark, folder), FEATURES).dropna(subset=FEATURES))
    return made.select(*LAP_KEY, F.round("Prediction", 4).alias("Prediction"))


sql(
    "score_season", "laps",
    f"SELECT {KEY}, round({PREDICTED}, 4) AS Prediction FROM laps, fit WHERE SpeedI1 IS NOT NULL", "Prediction", [KNOWN, *FIT],
)


@query("two_driver_compare")
def two_driver_compare(spark, folder):
    fitted = learning.linear(known(spark, folder), FEATURES, LABEL)
    return evaluation.compare_drivers(laps(spark, folder), {"Predicted_Linear": fitted}, ["C1", "C16"], FEATURES)


sql(
    "two_driver_compare", "laps",
    f"""SELECT LapNumber, Driver, Type, avg(CASE Type WHEN 'LapTime_s' THEN LapTime_s ELSE {PREDICTED} END) AS Seconds
       FROM known, fit, (VALUES ('LapTime_s'), ('Predicted_Linear')) v(Type)
       WHERE Driver IN ('C1', 'C16') GROUP BY LapNumber, Driver, Type""",
    "Seconds", [KNOWN, *FIT],
)


@query("lap_curve")
def lap_curve(spark, folder):
    fitted = learning.linear(known(spark, folder), FEATURES, LABEL)
    return evaluation.lap_curve(fitted.score(known(spark, folder)), LABEL, ["Prediction"])


sql(
    "lap_curve", "laps",
    """SELECT LapNumber, v.Type, CASE v.Type WHEN 'LapTime_s' THEN LapTime_s ELSE Prediction END AS Seconds
       FROM means, (SELECT quantile_cont(LapTime_s, 0.25) AS q1, quantile_cont(LapTime_s, 0.75) AS q3
                    FROM means), (VALUES ('LapTime_s'), ('Prediction')) v(Type)
       WHERE LapTime_s BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)
         AND Prediction BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)""",
    "Seconds",
    [
        KNOWN, *FIT,
        f"means AS (SELECT LapNumber, avg(LapTime_s) AS LapTime_s, avg({PREDICTED}) AS Prediction "
        "FROM known, fit GROUP BY LapNumber)",
    ],
)


# -- trees, search, clusters ------------------------------------------------

# More bins than a feature has values, so that every split is tried.
BINS, DEPTH = 128, 5


@query("tree_reg")
def tree_reg(spark, folder):
    rows = known(spark, folder)
    fitted = learning.tree(rows, FEATURES, LABEL, DEPTH, bins=BINS)
    return statistics.regression_metrics(fitted.score(rows), LABEL, {"Tree": "Prediction"})


def tree_sql() -> list[str]:
    """Level by level: sums of each (node, feature, value), the best cut of every node, then the next nodes."""
    names = ", ".join(FEATURES)
    made = [
        KNOWN,
        f"points AS MATERIALIZED (SELECT row_number() OVER () AS r, {LABEL} AS y, [{names}]::DOUBLE[] AS x FROM known)",
        "nodes0 AS (SELECT r, y, x, 1 AS node FROM points)",
    ]
    for level in range(DEPTH):
        made += [
            f"""sums{level} AS (SELECT node, f, x[f] AS v, count(*) AS n, sum(y) AS s
                  FROM (SELECT *, unnest(range(1, {len(FEATURES) + 1})) AS f FROM nodes{level}) GROUP BY ALL)""",
            f"""cuts{level} AS (SELECT node, f, v, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl,
                  sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
                  FROM sums{level} WINDOW upto AS (PARTITION BY node, f ORDER BY v))""",
            f"""best{level} AS MATERIALIZED (SELECT DISTINCT ON (node) node, f, v, gain FROM (
                  SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM cuts{level} WHERE nl < n)
                  WHERE gain > 1e-9 ORDER BY node, gain DESC, f, v)""",
            f"""nodes{level + 1} AS MATERIALIZED (SELECT r, y, x, CASE WHEN f IS NULL THEN c.node ELSE 2 * c.node + (x[f] > v)::INT END AS node
                  FROM nodes{level} c LEFT JOIN best{level} b ON b.node = c.node)""",
        ]
    return made


sql(
    "tree_reg", "laps",
    f"""SELECT avg(pow(y - p, 2)) AS Tree_MSE, 1 - avg(pow(y - p, 2)) / var_pop(y) AS Tree_R2
        FROM (SELECT y, avg(y) OVER (PARTITION BY node) AS p FROM nodes{DEPTH})""",
    "Tree_MSE Tree_R2", tree_sql(),
)


@query("gbt_reg")
def gbt_reg(spark, folder):
    # Stored for the fit and the scores.
    rows = learning.stored(known(spark, folder).select(*FEATURES, LABEL), "laps")
    fitted = learning.boosted(rows, FEATURES, LABEL)
    return statistics.regression_metrics(fitted.score(rows), LABEL, {"Boosted": "Prediction"})


@query("feature_importance")
def feature_importance(spark, folder):
    rows = known(spark, folder)
    return learning.importances(learning.tree(rows, FEATURES, LABEL, DEPTH, bins=BINS), rows)


SPLITS = " UNION ALL ".join(f"SELECT f, gain FROM best{level}" for level in range(DEPTH))
sql(
    "feature_importance", "laps",
    f"""SELECT feature, coalesce(gain, 0) / sum(gain) OVER () AS importance
        FROM (SELECT unnest({FEATURES}) AS feature, unnest(range(1, {len(FEATURES) + 1})) AS f)
        LEFT JOIN (SELECT f, sum(gain) AS gain FROM ({SPLITS}) GROUP BY f) USING (f)""",
    "importance", tree_sql(),
)


@query("tune_tree")
def tune_tree(spark, folder):
    _, trials = learning.tune(
        DecisionTreeRegressor(seed=12), learning.TREE_SPACE, known(spark, folder), FEATURES, LABEL, parallelism=8
    )
    return trials


@query("tune_boosted")
def tune_boosted(spark, folder):
    """The boosted space with few rounds, so that a search ends in seconds."""
    space = {**learning.BOOSTED_SPACE, "maxIter": learning.Range(2, 6, whole=True), "maxDepth": learning.Range(3, 5, whole=True)}
    _, trials = learning.tune(GBTRegressor(seed=42), space, known(spark, folder), FEATURES, LABEL, trials=10, folds=2, parallelism=8)
    return trials


@query("kmeans_laps")
def kmeans_laps(spark, folder):
    return learning.lloyd(known(spark, folder), LAP_KEY, CLUSTERED)


CLUSTERED, CLUSTERS, STEPS = [*FEATURES, LABEL], 3, 8


def kmeans_sql() -> list[str]:
    scaled = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in CLUSTERED)
    gap = f"list_sum(list_transform(range(1, {len(CLUSTERED) + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    made = [
        KNOWN,
        f"points AS MATERIALIZED (SELECT {KEY}, md5(concat_ws('|', {KEY}, 42)) AS mark, [{scaled}] AS x FROM known)",
        "start1 AS MATERIALIZED (SELECT [x] AS m FROM points ORDER BY mark LIMIT 1)",
    ]
    for i in range(1, CLUSTERS):
        made.append(
            f"start{i + 1} AS MATERIALIZED (SELECT list_append(m, x) AS m FROM points, start{i} "
            f"ORDER BY list_min(list_transform(m, lambda c: {gap})) DESC, mark LIMIT 1)"
        )
    made.append(f"centres0 AS (SELECT m FROM start{CLUSTERS})")
    for i in range(STEPS + 1):
        nearest = f"list_position(list_transform(m, lambda c: {gap}), list_min(list_transform(m, lambda c: {gap})))"
        made.append(f"own{i} AS MATERIALIZED (SELECT {KEY}, x, {nearest} AS own FROM points, centres{i})")
        means = ", ".join(f"avg(x[{j + 1}])" for j in range(len(CLUSTERED)))
        made.append(
            f"centres{i + 1} AS MATERIALIZED (SELECT list(coalesce(mean, m[k]) ORDER BY k) AS m FROM "
            f"(SELECT m, unnest(range(1, {CLUSTERS + 1})) AS k FROM centres{i}) LEFT JOIN "
            f"(SELECT own, [{means}] AS mean FROM own{i} GROUP BY own) ON own = k)"
        )
    return made[:-1]


sql("kmeans_laps", "laps", f"SELECT {KEY}, (own - 1)::INT AS Cluster FROM own{STEPS}", "", kmeans_sql())


@query("pca_laps")
def pca_laps(spark, folder):
    made = learning.project(known(spark, folder), CLUSTERED)
    return made.select(*LAP_KEY, F.round("PC1", 4).alias("PC1"), F.round("PC2", 4).alias("PC2"))


def jacobi_sql(size: int, sweeps: int = 8) -> list[str]:
    """turned(step, a, v): rotations that clear one pair after the other; v ends as the eigenvectors (columns) of a."""
    pairs = [[p, q] for p in range(1, size + 1) for q in range(p + 1, size + 1)]
    span = f"range(1, {size + 1})"
    unit = f"list_transform({span}, lambda r: list_transform({span}, lambda c: CASE WHEN r = c THEN 1e0 ELSE 0e0 END))"

    def columns(m: str) -> str:
        """m times the rotation in columns p and q."""
        return (
            f"list_transform({m}, lambda row: list_transform({span}, lambda c: CASE c WHEN p THEN cs * row[p] - sn * row[q] "
            "WHEN q THEN sn * row[p] + cs * row[q] ELSE row[c] END))"
        )

    rows = (
        f"list_transform({span}, lambda r: list_transform({span}, lambda c: CASE r WHEN p THEN cs * half[p][c] - sn * half[q][c] "
        "WHEN q THEN sn * half[p][c] + cs * half[q][c] ELSE half[r][c] END))"
    )
    return [
        f"""turned AS (
  SELECT 0 AS step, a, {unit} AS v FROM spread
  UNION ALL SELECT step + 1, {rows}, w FROM (
    SELECT step, p, q, cs, sn, {columns("a")} AS half, {columns("v")} AS w FROM (
      SELECT *, cos(angle) AS cs, sin(angle) AS sn FROM (
        SELECT *, 0.5e0 * atan2(2 * a[p][q], a[q][q] - a[p][p]) AS angle FROM (
          SELECT *, {pairs}[step % {len(pairs)} + 1][1] AS p, {pairs}[step % {len(pairs)} + 1][2] AS q
          FROM turned WHERE step < {len(pairs) * sweeps})))))""",
        f"""axes AS (SELECT list_transform({span}, lambda i: v[i][k]) AS axis, row_number() OVER (ORDER BY a[k][k] DESC) AS place
              FROM (SELECT a, v, unnest({span}) AS k FROM turned WHERE step = {len(pairs) * sweeps}))""",
        """pointed AS (SELECT place, list_transform(axis, lambda x: x * sign(axis[list_position(list_transform(axis, lambda y: round(abs(y), 9)),
              list_max(list_transform(axis, lambda y: round(abs(y), 9))))])) AS axis FROM axes)""",
    ]


def pca_sql() -> tuple[str, list[str]]:
    size = len(CLUSTERED)
    scaled = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z{i + 1}" for i, c in enumerate(CLUSTERED))
    cells = ", ".join("[" + ", ".join(f"covar_samp(z{i + 1}, z{j + 1})" for j in range(size)) + "]" for i in range(size))
    along = [" + ".join(f"z{i + 1} * p{k}.axis[{i + 1}]" for i in range(size)) for k in (1, 2)]
    text = f"SELECT {KEY}, round({along[0]}, 4) AS PC1, round({along[1]}, 4) AS PC2 FROM scaled, pointed p1, pointed p2 WHERE p1.place = 1 AND p2.place = 2"
    return text, [KNOWN, f"scaled AS MATERIALIZED (SELECT {KEY}, {scaled} FROM known)", f"spread AS (SELECT [{cells}] AS a FROM scaled)", *jacobi_sql(size)]


sql("pca_laps", "laps", pca_sql()[0], "PC1 PC2", pca_sql()[1])


@query("model_eval")
def model_eval(spark, folder):
    rows = known(spark, folder).withColumn("Track", F.col("Race"))
    return evaluation.evaluate(
        rows, ["Compound", *FEATURES], LABEL, LAP_KEY, ["Compound"]
    )


@query("strategy_report")
def strategy_report(spark, folder):
    return strategy.strategy_report(laps(spark, folder))


sql(
    "strategy_report", "laps",
    """SELECT s.*, cast(coalesce(sum(StintLength) OVER (PARTITION BY s.Year, s.Race, s.Driver
              ORDER BY s.Stint, s.Compound ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint)
              AS StintStart, v.mean AS StintSpeed, FastestLap, Finish
       FROM stints s JOIN stintspeed v ON s.Year = v.Year AND s.Race = v.Race AND s.Driver = v.Driver
            AND s.Stint = v.Stint AND s.Compound = v.Compound
       JOIN (SELECT Year, Race, Driver, min(LapTime_s) AS FastestLap, arg_max(Position, LapNumber)
             AS Finish FROM laps GROUP BY ALL) p
         ON s.Year = p.Year AND s.Race = p.Race AND s.Driver = p.Driver""",
    "StintSpeed FastestLap", [STINTS, *SPEED_CTES],
)


# -- models small enough to be written out in SQL ---------------------------

STUMP = ["TyreLife", "Position"]
# The split with the least squared error over both features, and the means of its sides.
BEST_SPLIT = [
    KNOWN,
    """sides AS (SELECT f, x, count(*) AS n, sum(y) AS s FROM (
         SELECT 'TyreLife' AS f, TyreLife AS x, LapTime_s AS y FROM known
         UNION ALL SELECT 'Position', Position, LapTime_s FROM known) GROUP BY f, x)""",
    """splits AS (SELECT f, x, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl,
         sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
         FROM sides WINDOW upto AS (PARTITION BY f ORDER BY x))""",
    """best AS (SELECT * FROM splits WHERE nl < n
         ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)""",
]
STUMP_SQL = f"""SELECT {KEY}, CASE WHEN CASE f WHEN 'TyreLife' THEN TyreLife ELSE Position END <= x
  THEN sl / nl ELSE (s - sl) / (n - nl) END AS Prediction FROM known, best"""


def stump_rows(spark, folder):
    return learning.numeric(known(spark, folder), STUMP)


@query("tree_stump")
def tree_stump(spark, folder):
    rows = stump_rows(spark, folder)
    fitted = learning.tree(rows, STUMP, LABEL, depth=1)
    return fitted.score(rows).select(*LAP_KEY, "Prediction")


sql("tree_stump", "laps", STUMP_SQL, "Prediction", BEST_SPLIT)


@query("boosted_stump")
def boosted_stump(spark, folder):
    """One boosting round is its first tree."""
    rows = stump_rows(spark, folder)
    fitted = learning.boosted(rows, STUMP, LABEL, maxIter=1, maxDepth=1)
    return fitted.score(rows).select(*LAP_KEY, "Prediction")


sql("boosted_stump", "laps", STUMP_SQL, "Prediction", BEST_SPLIT)


@query("stump_importance")
def stump_importance(spark, folder):
    rows = stump_rows(spark, folder)
    return learning.importances(learning.tree(rows, STUMP, LABEL, depth=1), rows)


sql(
    "stump_importance", "laps",
    "SELECT v.feature, CASE WHEN v.feature = f THEN 1e0 ELSE 0e0 END AS importance "
    "FROM (VALUES ('TyreLife'), ('Position')) v(feature), best",
    "importance", BEST_SPLIT,
)


@query("pca_pair")
def pca_pair(spark, folder):
    """Two scaled features have components along and across the diagonal; signs are free."""
    made = learning.project(known(spark, folder), ["SpeedI2", LABEL])
    return made.select(*LAP_KEY, F.abs("PC1").alias("PC1"), F.abs("PC2").alias("PC2"))


sql(
    "pca_pair", "laps",
    f"""SELECT {KEY}, abs(a + sign(c) * b) / sqrt(2e0) AS PC1, abs(a - sign(c) * b) / sqrt(2e0) AS PC2
        FROM (SELECT {KEY}, (SpeedI2 - avg(SpeedI2) OVER ()) / stddev_samp(SpeedI2) OVER () AS a,
                     (LapTime_s - avg(LapTime_s) OVER ()) / stddev_samp(LapTime_s) OVER () AS b
              FROM known), (SELECT corr(SpeedI2, LapTime_s) AS c FROM known)""",
    "PC1 PC2", [KNOWN],
)
