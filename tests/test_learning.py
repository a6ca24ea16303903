"""Statistics and models against direct calculation."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from pitlane.constants import MODEL_FEATURES
from pitlane.functions.durations import seconds_to_interval
from pitlane.functions.scalars import quadratic_features
from pitlane.operators import learning, statistics
from pitlane.plans import evaluation

N = 203


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(2)
    a, b = draw.normal(size=N), draw.normal(size=N)
    return a, b + 0.5 * a, 3.0 + 2.0 * a - b + draw.normal(size=N) / 4


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(i, "xyz"[i % 3], *map(float, p)) for i, p in enumerate(zip(*points))]
    return spark.createDataFrame(rows, "id long, Track string, a double, b double, y double")


def test_split_sizes_and_seed(table):
    one = learning.train_test_split(table, ["id"], 0.2, 1)
    ids = {r.id for r in one.where("Part = 'test'").collect()}
    assert len(ids) == math.ceil(0.2 * N) and one.count() == N
    same = learning.train_test_split(table.repartition(3), ["id"], 0.2, 1)
    assert ids == {r.id for r in same.where("Part = 'test'").collect()}
    other = learning.train_test_split(table, ["id"], 0.2, 2)
    assert ids != {r.id for r in other.where("Part = 'test'").collect()}


@pytest.mark.parametrize("n", [3, 10, 203])
def test_folds_are_contiguous(table, n):
    rows = learning.kfold(table.where(F.col("id") < n), ["id"], 5).orderBy("id").collect()
    sizes = [n // 5 + (i < n % 5) for i in range(5)]
    assert [r.Fold for r in rows] == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_scaling(table):
    made = statistics.standard_scale(table.withColumn("k", F.lit(4.0)), ["a", "k"])
    m, s, z = made.agg(F.avg("a"), F.stddev_pop("a"), F.max(F.abs("k"))).first()
    assert (m, s, z) == (pytest.approx(0, abs=1e-12), pytest.approx(1), 0)


def test_correlation_and_inflation(table, points):
    cells = {(r.a, r.b): r.corr for r in statistics.correlations(table, ["a", "b", "y"]).collect()}
    want = np.corrcoef(points)
    assert cells["a", "y"] == pytest.approx(want[0, 2]) and cells["b", "a"] == pytest.approx(want[0, 1])
    factors = {r.feature: r.VIF for r in statistics.variance_inflation(table, ["a", "b"]).collect()}
    assert factors["a"] == factors["b"] == pytest.approx(1 / (1 - want[0, 1] ** 2))


def test_paired_ttest(table, points):
    row = statistics.paired_ttest(table, "y", "a").first()
    d = points[2] - points[0]
    assert row.df == N - 1 and row.significant
    assert row.statistic == pytest.approx(d.mean() / (d.std(ddof=1) / math.sqrt(N)))
    # Known two-sided tail points of Student's distribution.
    for t, freedom, p in ((12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (1.96, 10**6, 0.05), (0.0, 5, 1.0)):
        assert statistics.two_sided_p(t, freedom) == pytest.approx(p, abs=2e-5)


def test_linear_model(table, points):
    a, b, y = points
    fitted = learning.linear(table, ["a", "b"], "y")
    want, *_ = np.linalg.lstsq(np.column_stack([a, b, np.ones(N)]), y, rcond=None)
    got = {r.term: r.coef for r in learning.coefficients(fitted).collect()}
    assert [got["a"], got["b"], got["const"]] == pytest.approx(list(want))
    error = y - np.column_stack([a, b, np.ones(N)]) @ want
    scored = fitted.score(table)
    assert learning.mse(scored, "y") == pytest.approx((error**2).mean())
    row = statistics.regression_metrics(scored, "y", {"L": "Prediction"}).first()
    assert row.L_R2 == pytest.approx(1 - (error**2).mean() / y.var())
    summary = {r.term: r for r in learning.ols_summary(fitted).collect()}
    assert summary["a"].p < 1e-6 and summary["a"].r2 == pytest.approx(row.L_R2)


def test_partial_effect_keeps_other_features_at_their_mean(table, points):
    rows = quadratic_features(table, ["a"])
    fitted = learning.linear(rows, ["a", "a2", "b"], "y")
    w = {r.term: r.coef for r in learning.coefficients(fitted).collect()}
    curve = learning.partial_effect(fitted, rows, "a", "a2").orderBy("a").collect()
    top = points[0].max()
    assert len(curve) == 100 and curve[0].a == 0 and curve[-1].a == pytest.approx(top)
    end = w["const"] + w["a"] * top + w["a2"] * top**2 + w["b"] * points[1].mean()
    assert curve[-1].Prediction == pytest.approx(end)


def test_trees_beat_the_mean(table, points):
    spread = points[2].var()
    tree = learning.tree(table, ["a", "b"], "y")
    boosted = learning.boosted(table, ["a", "b"], "y", maxIter=5)
    assert learning.mse(tree.score(table), "y") < spread / 2
    assert learning.mse(boosted.score(table), "y") < spread / 2
    parts = learning.importances(tree, table).collect()
    assert [r.feature for r in parts] == ["a", "b"] and sum(r.importance for r in parts) == pytest.approx(1)


def test_search(table, points):
    space = {"maxDepth": lambda r: r.randint(1, 6)}
    best, trials = learning.tune(DecisionTreeRegressor(seed=1), space, table, ["a", "b"], "y", 3, 2)
    assert trials.count() == 3
    assert learning.mse(best.score(table), "y") < points[2].var()
    assert learning.cross_validated_mse(table, ["a", "b"], "y", ["id"]) < 0.1


def test_search_of_trees_shares_fits(spark, monkeypatch):
    """The errors are those of one fit for each trial and fold, from far fewer fits on rows that are alike."""
    draw = random.Random(4)
    cells = [(float(draw.randint(0, 40)), float(draw.randint(0, 5))) for _ in range(2500)]
    rows = [(a, b, a * b + draw.gauss(0, 20)) for a, b in cells]
    table = spark.createDataFrame(rows, "a double, b double, y double")
    fits, fit = [], DecisionTreeRegressor._fit
    monkeypatch.setattr(DecisionTreeRegressor, "_fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    _, trials = learning.tune(DecisionTreeRegressor(seed=1), learning.TREE_SPACE, table, ["a", "b"], "y", 12, 3, parallelism=6)
    assert len(fits) < 12 * 3 and max(fits) <= 3 * 41 * 6
    monkeypatch.undo()

    ready = learning.assemble(table.withColumn("f", F.abs(F.xxhash64(F.lit(42), "a", "b", "y") % 3)), ["a", "b"]).persist()
    for trial in trials.limit(3).collect():
        depth, leaf = (int(part.split("=")[1]) for part in trial.params.split(", "))
        made = DecisionTreeRegressor(seed=1, maxDepth=depth, minInstancesPerNode=leaf, featuresCol="_features", labelCol="y")
        errors = [learning.mse(made.fit(ready.where(F.col("f") != i)).transform(ready.where(F.col("f") == i)), "y", "prediction") for i in range(3)]
        assert trial.MSE == pytest.approx(sum(errors) / 3, rel=1e-9)
    ready.unpersist()


def test_trees_of_the_search_grow_in_tasks(spark, monkeypatch):
    """One fit by Spark, of the best tree; the errors are those of Spark's fits, also of a constant feature and zeros."""
    draw = random.Random(8)
    cells = [(float(draw.randint(-3, 80)), round(draw.gauss(0, 1), 3), 7.0, float(draw.randint(0, 2))) for _ in range(1500)]
    rows = [(*x, x[0] * x[1] + 30 * x[3] + draw.gauss(0, 20)) for x in cells] + [(None, 1.0, 7.0, 1.0, 5.0), (*cells[0], None)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double, y double")
    space = {"maxDepth": learning.Range(2, 6, whole=True), "minInstancesPerNode": learning.Range(5, 10, whole=True)}
    fits, fit = [], DecisionTreeRegressor._fit
    monkeypatch.setattr(DecisionTreeRegressor, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    found, number = [], []
    for limit in (learning.FEW_CELLS, 0) if hasattr(learning, "FEW_CELLS") else (0, 0):
        monkeypatch.setattr(learning, "FEW_CELLS", limit, raising=False)
        fits.clear()
        _, trials = learning.tune(DecisionTreeRegressor(seed=1, minInfoGain=0.5), space, table, ["a", "b", "c", "d"], "y", 9, 3)
        found.append({r.params: r.MSE for r in trials.collect()})
        number.append(len(fits))
    assert number[0] == 1 < number[1]
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_leaves_of_the_search_count_original_rows(spark):
    """Of nine alike rows a side no leaf of ten can be made, of leaves of eight both."""
    table = spark.createDataFrame([(float(i % 2), float(i % 2) + i // 2 % 9 / 1e6) for i in range(36)], "a double, y double")
    known = learning.alike(table, ["a"], "y", [(F.monotonically_increasing_id() % 2).alias("_fold")])
    trials = learning.TreeTrials(DecisionTreeRegressor(featuresCol="_features"), learning.assemble(known, ["a"]).persist())
    assert sum(trials.sizes.values()) == 36 and trials.cells is not None
    least = min(trials.sizes.values())
    small, large = trials([{"maxDepth": 1, "minInstancesPerNode": n} for n in (1, 36)], None)
    assert least > 2 and small < 1e-6 and large > 0.1


def test_least_rows_of_a_leaf_are_original_rows(spark):
    """Five alike rows on one side count as five."""
    table = spark.createDataFrame([(0.0, 1.0)] * 5 + [(1.0, 9.0)] * 3, "a double, y double")
    rows = learning.assemble(learning.alike(table, ["a"], "y"), ["a"])
    for leaf, nodes in ((1, 3), (3, 3), (4, 1), (5, 1)):
        assert learning._grown(DecisionTreeRegressor(featuresCol="_features"), rows, 8, 4, leaf).numNodes == nodes


def counted(table, column):
    """The table and an accumulator of how often a row of it is made."""
    seen = table.sparkSession.sparkContext.accumulator(0)
    made = F.udf(lambda v: seen.add(1) or v, "double").asNondeterministic()
    return table.withColumn(column, made(column)), seen


def test_folds_make_the_rows_once(table, points):
    rows, seen = counted(table, "a")
    got = learning.cross_validated_mse(rows, ["a", "b"], "y", ["id"])
    assert seen.value == N
    x, y, errors = np.column_stack([np.ones(N), *points[:2]]), points[2], []
    for part in np.array_split(np.arange(N), 5):
        rest = np.setdiff1d(np.arange(N), part)
        weights = np.linalg.lstsq(x[rest], y[rest], rcond=None)[0]
        errors.append(((x[part] @ weights - y[part]) ** 2).mean())
    assert got == pytest.approx(np.mean(errors), rel=1e-9)


def test_boosting_fits_rows_that_are_alike(spark, monkeypatch):
    draw = random.Random(6)
    cells = [(float(draw.randint(0, 12)), float(draw.randint(0, 5))) for _ in range(1500)]
    table = spark.createDataFrame([(a, b, a * b + draw.gauss(0, 5)) for a, b in cells], "a double, b double, y double")
    fits, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    made = learning.boosted(table, ["a", "b"], "y", maxIter=4)
    assert fits == [len(set(cells))]
    monkeypatch.undo()
    plain = GBTRegressor(seed=42, maxIter=4, featuresCol="_features", labelCol="y").fit(learning.assemble(table, ["a", "b"]))
    both = plain.transform(made.score(table, "Alike").transform(lambda df: learning.assemble(df, ["a", "b"])))
    assert both.agg(F.max(F.abs(F.col("Alike") - F.col("prediction")))).first()[0] < 1e-9


def test_evaluation_makes_the_rows_once(table):
    rows, seen = counted(table, "a")
    made = evaluation.evaluate(rows, ["Track", "a", "b"], "y", ["id"], ["Track"], "Track", maxIter=2).collect()
    assert len(made) == 3 and seen.value == N


def test_clusters_and_components(table, points):
    sizes = learning.cluster(table, ["a", "b", "y"]).groupBy("Cluster").count().collect()
    assert len(sizes) == 3 and sum(r["count"] for r in sizes) == N
    row = learning.project(table, ["a", "b", "y"]).agg(
        F.avg("PC1"), F.var_samp("PC1"), F.var_samp("PC2"), F.corr("PC1", "PC2")
    ).first()
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(points)))[::-1]
    assert row[0] == pytest.approx(0, abs=1e-9) and row[3] == pytest.approx(0, abs=1e-9)
    assert list(row[1:3]) == pytest.approx(list(values[:2]))


def test_model_dataset(spark):
    numbers = [c for c in MODEL_FEATURES if c != "Compound"]
    rows = []
    for lap in range(1, 7):
        values = [float(lap)] * len(numbers)
        if lap == 2:
            values[0] = float("inf")
        rows.append((2023, "T", "D", lap, "SOFT", None if lap == 4 else 80.0 + lap, *values))
    schema = "Year int, Track string, Driver string, LapNumber int, Compound string, s double, "
    df = spark.createDataFrame(rows, schema + ", ".join(f"{c} double" for c in numbers))
    made = learning.model_dataset(df.withColumn("LapTime", seconds_to_interval(F.col("s"))).drop("s"))
    got = made.orderBy("LapNumber").select("LapNumber", "LapTime").collect()
    assert [tuple(r) for r in got] == [(1, 81.0), (2, 83.0), (3, 85.0), (4, 86.0)]


def test_evaluation(table):
    keyed = table.withColumn("Kind", F.col("Track"))
    rows = evaluation.evaluate(keyed, ["Kind", "a", "b"], "y", ["id"], ["Kind"], maxIter=3).collect()
    assert {r.Track for r in rows} == {"x", "y", "z"}
    assert all(r.Linear_R2 > 0.9 and r.Boosted_R2 > 0.5 for r in rows)


def rows_of(spark, n, seed=5):
    draw = np.random.default_rng(seed)
    names = ["", "a", "ab", "b", "é", "\U00010000", "￿", None]
    rows = [(names[draw.integers(8)], int(draw.integers(-(2**62), 2**62)) if i % 3 else int(i), i) for i in range(n)]
    return spark.createDataFrame(rows, "s string, x long, i int"), rows


@pytest.mark.parametrize("limit", [1, 7, 5000])
def test_cuts_by_histogram_are_exact(spark, monkeypatch, limit):
    monkeypatch.setattr(learning, "BIN_ROWS", limit)
    df, rows = rows_of(spark, 401)
    found = {r.i: r.Fold for r in learning.kfold(df, ["s", "x", "i"], 7).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1], r[2]))
    size = [401 // 7 + (i < 401 % 7) for i in range(7)]
    want = {r[2]: f for r, f in zip(order, [f for f, n in enumerate(size) for _ in range(n)])}
    assert found == want
    parts = learning.train_test_split(df, ["i"], 0.3, 9).where("Part = 'test'")
    assert parts.count() == math.ceil(401 * 0.3)


def test_equal_codes_and_other_types(spark, monkeypatch):
    monkeypatch.setattr(learning, "BIN_ROWS", 3)
    same = spark.createDataFrame([("k", i) for i in range(40)], "k string, i int")
    assert {r.Fold for r in learning.kfold(same, ["k"], 4).collect()} == {3}  # no cut inside equal rows
    real = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    assert [r.Fold for r in learning.kfold(real, ["x"], 5).orderBy("x").collect()] == [i // 2 for i in range(10)]
    assert learning.kfold(same.limit(0), ["k"], 4).count() == 0


def test_planning_jobs_of_preparation(spark, tmp_path):
    """A split starts three jobs, dictionaries of any number of columns two."""
    path = str(tmp_path / "t")
    spark.range(3000).selectExpr("id", *[f"cast(id % {n} AS string) AS c{n}" for n in range(2, 12)]).write.parquet(path)
    df = spark.read.parquet(path)
    jobs = spark.sparkContext.statusTracker()

    def started(make):
        before = len(jobs.getJobIdsForGroup(None))
        make()
        return len(jobs.getJobIdsForGroup(None)) - before

    assert started(lambda: learning.train_test_split(df, ["id"])) <= 3
    assert started(lambda: learning.kfold(df, ["id"])) <= 5
    text = [f"c{n}" for n in range(2, 12)]
    assert started(lambda: learning.label_encode(df, text)) <= 3
    made = learning.label_encode(df, text).agg(*[F.max(c).alias(c) for c in text]).first()
    assert list(made) == [n - 1 for n in range(2, 12)]


def surface(trial):
    """One valley, narrow in x and wide in y, with a slope that whole numbers see."""
    return (trial["x"] - 0.83) ** 2 * 40 + (trial["y"] - 3.1) ** 2 + abs(trial["n"] - 17) / 4


def test_adaptive_search_beats_even_draws():
    space = {"x": learning.Range(0, 1), "y": learning.Range(-5, 10), "n": learning.Range(1, 40, whole=True)}
    better = 0
    for seed in range(60):
        tried = learning.adaptive_search(space, lambda some: [surface(t) for t in some], 60, 4, seed)
        assert len(tried) == 60 and all(r.low <= t[name] <= r.high for t, _ in tried for name, r in space.items())
        draw = random.Random(1000 + seed)
        even = min(surface({name: pick(draw) for name, pick in space.items()}) for _ in range(60))
        better += min(score for _, score in tried) < even
    assert better >= 38  # of 60: even odds would give so many in one of forty cases
    assert all(isinstance(t["n"], int) for t, _ in tried)


def test_search_of_the_boosted_space(table, points):
    """Every parameter of the space reaches the estimator; rounds are few to keep the test short."""
    space = {**learning.BOOSTED_SPACE, "maxIter": learning.Range(2, 3, whole=True), "maxDepth": learning.Range(3, 4, whole=True)}
    best, trials = learning.tune(GBTRegressor(seed=1), space, table, ["a", "b"], "y", 3, 2)
    row = trials.orderBy("MSE").first()
    assert trials.count() == 3 and all(name in row.params for name in space)
    assert learning.mse(best.score(table), "y") < points[2].var()


def test_repeatable_clusters(spark):
    draw = np.random.default_rng(3)
    middle = [(0, 0), (6, 0), (0, 8), (9, 9)]
    rows = [(i, *(float(m + d) for m, d in zip(middle[i % 4], draw.normal(size=2)))) for i in range(200)]
    df = spark.createDataFrame([*rows, (900, None, 1.0)], "id int, a double, b double")
    found = {r.id: r.Cluster for r in learning.lloyd(df, ["id"], ["a", "b"], 4).collect()}
    assert len(found) == 200 and len({(i % 4, c) for i, c in found.items()}) == 4
    again = learning.lloyd(df.repartition(7), ["id"], ["a", "b"], 4).collect()
    assert found == {r.id: r.Cluster for r in again}
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], df.schema)
    assert {r.Cluster for r in learning.lloyd(same, ["id"], ["a", "b"], 3).collect()} == {0}
    assert learning.lloyd(same.limit(0), ["id"], ["a", "b"], 3).count() == 0


def test_components_point_to_their_largest_loading(table, points):
    values, vectors = np.linalg.eigh(np.corrcoef(points))
    z = np.array([(p - p.mean()) / p.std(ddof=1) for p in points]).T
    for i in (1, 2):
        axis = vectors[:, -i] * np.sign(vectors[np.abs(vectors[:, -i]).argmax(), -i])
        got = [r[0] for r in learning.project(table, ["a", "b", "y"]).orderBy("id").select(f"PC{i}").collect()]
        assert got == pytest.approx(list(z @ axis))
