"""Cases that earlier versions got wrong: missing times, NaN, NULL groups, long narrow tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.functions.durations import text_micros, text_to_interval
from pitlane.operators.laps import quick_laps
from pitlane.operators.learning import label_encode, train_test_split
from pitlane.operators.matching import nearest, tag_laps
from pitlane.operators.motion import outlier_repair
from pitlane.operators.quantiles import iqr_filter
from pitlane.operators.series import Series, hand_down, hot_groups, most_rows
from pitlane.operators.similarity import distances
from pitlane.settings import BROADCAST_ROWS


def at(seconds):
    return None if seconds is None else f"2024-01-01 00:{seconds // 60:02d}:{seconds % 60:02d}"


def timed(spark, rows, names):
    df = spark.createDataFrame([(*r[:-1], at(r[-1])) for r in rows], f"{names}, raw string")
    return df.withColumn("t", F.col("raw").cast("timestamp_ntz")).drop("raw")


def test_rows_without_a_time_match_nothing(spark):
    left = timed(spark, [("k", 1, 10), ("k", 2, None)], "k string, n int")
    right = timed(spark, [("k", 7, None), ("k", 8, 20)], "k string, id int").withColumnRenamed("t", "rt")
    out = {r.n: r.id for r in nearest(left, right, ["k"], "t", "rt", "id").collect()}
    assert out == {1: 8, 2: None}


def test_missing_starts_do_not_shift_laps(spark):
    samples = timed(spark, [("k", i, 10 * i) for i in range(8)] + [("k", 99, None)], "k string, id int")
    starts = timed(spark, [("k", 20), ("k", 40)], "k string").withColumnRenamed("t", "s")
    more = starts.unionByName(timed(spark, [("k", None)], "k string").withColumnRenamed("t", "s"))
    laps = [
        {r.id: r.LapNumber for r in tag_laps(samples, x, ["k"], "t", "id", "s").collect()} for x in (starts, more)
    ]
    assert laps[0] == laps[1] and laps[0][99] is None
    assert [laps[0][i] for i in range(8)] == [1, 1, 2, 2, 2, 2, 0, 0]


def test_nan_is_missing_not_an_outlier(spark):
    rows = [("k", i, v) for i, v in enumerate([1.0, float("nan"), 2.0, 99.0])]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    out = [r.o for r in outlier_repair(df, "v", "o", 5.0, ["k"], ["i"]).orderBy("i").collect()]
    assert out == [1.0, None, 2.0, 2.0]


def test_nan_leaves_a_warping_distance(spark):
    rows = [("k", i, float(v)) for i, v in enumerate([1, 2, np.nan, 3])]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    ref = spark.createDataFrame([("k", 0, 1.0), ("k", 1, 2.0), ("k", 2, 3.0)], df.schema)
    assert distances(df, ref, {"v": "d"}, ["k"], ["k"], ["i"]).first().d == 0.0


def test_fence_of_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 1.0)], "k string, v double")
    assert iqr_filter(df, "v", keys=["k"]).count() == 3


def test_long_narrow_table_is_hot(spark, hot):
    df = spark.range(20_000).withColumn("k", F.lit("one"))
    with hot(5_000):
        assert [(r.k, r["_rows"]) for r in hot_groups(df, ["k"]).collect()] == [("one", 20_000)]
        jobs = spark.sparkContext.statusTracker()
        before = len(jobs.getJobIdsForGroup(None))
        # Columns that are no keys don't make it another table.
        assert hot_groups(df.withColumn("x", F.col("id") * 2), ["k"]).count() == 1
        assert len(jobs.getJobIdsForGroup(None)) - before <= 2
    assert hot_groups(df, ["k"]) is None


@pytest.mark.parametrize("few,join", [(1000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_broadcasts_are_checked(spark, few, join):
    spark.conf.set(BROADCAST_ROWS, few)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laps = spark.createDataFrame([(2023, "r", 80.0), (2023, "r", 90.0), (2024, "r", 70.0)], "Year int, Race string, LapTime_s double")
        quick = quick_laps(laps)
        assert join in quick._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.LapTime_s for r in quick.collect()) == [70.0, 80.0]
        coded = label_encode(laps, ["Race"])
        assert join in coded._jdf.queryExecution().executedPlan().toString()
        assert {r.Race for r in coded.collect()} == {0}
    finally:
        for key in (BROADCAST_ROWS, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)


def test_one_reference_is_tiled_without_a_nested_loop(spark, hot, monkeypatch):
    from pitlane.operators import similarity

    rows = [(k, i, float((i * 7 + k) % 5)) for k in range(3) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    ref = spark.createDataFrame([(i, float(i % 4)) for i in range(15)], "i int, v double")
    plain = {r.k: r.d for r in distances(df, ref, {"v": "d"}, ["k"], [], ["i"]).collect()}
    plans = []
    keep = similarity.materialize

    def seen(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame)

    monkeypatch.setattr(similarity, "materialize", seen)
    with hot(6):
        tiled = {r.k: r.d for r in distances(df, ref, {"v": "d"}, ["k"], [], ["i"]).collect()}
    assert tiled == pytest.approx(plain)
    steps = [p for p in plans if "bottom" in p]
    assert steps and not any("NestedLoop" in p or "Cartesian" in p for p in steps)


def test_split_by_a_hash_that_any_engine_has(spark):
    import hashlib

    df = spark.range(50).withColumn("k", F.lit("é"))
    parts = {r.id: r.Part for r in train_test_split(df, ["k", "id"], 0.2, 7).collect()}
    order = sorted(range(50), key=lambda i: hashlib.md5(f"é|{i}|7".encode()).hexdigest())
    assert {i for i, p in parts.items() if p == "test"} == set(order[:10])


def test_text_to_duration(spark):
    cases = {
        "0 days 00:01:31.344000": 91_344_000, "0 days 00:01:31": 91_000_000, "1 day, 00:00:01": 86_401_000_000,
        "00:01:02.5": 62_500_000, "-1 days +23:59:59.5": -500_000, "-00:00:01": -1_000_000, "2 days 10:00:00": 208_800_000_000,
        "00:00:00.1234567": 123_456, "": None, "abc": None, "1:2:3": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.us for r in df.select("t", text_micros(F.col("t")).alias("us")).collect()} == cases
    one = df.where("t = '0 days 00:01:31.344000'").select(text_to_interval(F.col("t")).alias("i")).first().i
    assert one.total_seconds() == 91.344


def test_counts_do_not_outlive_a_rewrite(spark, hot, tmp_path):
    path = str(tmp_path / "t")
    with hot(100):
        for rows, hot_keys in ((50, None), (5000, 1), (60, None)):
            spark.range(rows).selectExpr("1 AS k", "id").write.mode("overwrite").parquet(path)
            found = hot_groups(spark.read.parquet(path), ["k"])
            assert (found and found.count()) == hot_keys


def test_known_sizes_answer_without_a_job(spark, hot):
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))

    df = spark.range(400).selectExpr("id % 4 AS a", "id % 40 AS b", "id")
    with hot(150):
        assert hot_groups(df, ["a"]) is None and most_rows(df, ["a", "b"]) == 100 and most_rows(df, []) == 400
        part = hand_down(df.where("id < 90"), df)
        before = jobs()
        # Groups by more keys and of fewer rows are no larger.
        assert hot_groups(df, ["b", "a"]) is None and hot_groups(part, ["a"]) is None
        assert Series(part, ["a"], ["id"]).position("n").rows() is not None
        assert jobs() == before
        both = hand_down(part.unionByName(part), part, part)
        assert most_rows(both, ["a"]) == 200 and hot_groups(both, ["a"]) is None  # counted: 46
        assert jobs() > before
    renamed = hand_down(df.withColumnRenamed("a", "c"), df, names={"a": "c"})
    assert most_rows(renamed, ["c"]) == 100 and most_rows(renamed, ["a"]) == 400


def test_columns_that_a_series_replaces_lose_their_sizes(spark):
    df = spark.range(100).selectExpr("id % 4 AS a", "id")
    assert hot_groups(df, ["a"]) is None
    s = Series(df, ["a"], ["id"]).with_columns({"a": F.lit(1)})
    assert most_rows(s.rows(), ["a"]) == 100  # only the bound of the whole table is left
