"""Shape of the physical plans."""

import re
from pathlib import Path

import pytest

from pitlane.constants import LAP_KEY
from pitlane.operators import laps as lap_ops
from pitlane.operators import telemetry
from pitlane.plans.race import race_features
from pitlane.sources.writers import write_bucketed
from pitlane.workbench import QUERIES
from pitlane.workbench.views import laps, tel

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lap_features_shuffle_samples_once(spark):
    text = plan(telemetry.lap_features(tel(spark, FOLDER)))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert text.count("Window [") >= 4
    assert "Python" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(telemetry.lap_abs_acc(tel(spark, FOLDER)))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "user_id", "value"}
    narrow = plan(laps(spark, FOLDER).select("DriverNumber", "LapNumber"))
    assert "o_totalprice" not in narrow


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet").where("value > 50").select("user_id")
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,50.0)]" in plan(df)


def test_first_rows_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "laps")
    laps(spark, FOLDER).write.parquet(path)
    fastest = lap_ops.fastest_lap(spark.read.parquet(path), LAP_KEY[:-1])
    for df in (telemetry.last_sample_per_lap(tel(spark, FOLDER)), fastest):
        above, below = plan(df).split("Exchange hashpartitioning")
        assert "1, Final" in above and "1, Partial" in below


def test_python_only_for_warping(spark):
    for name in ("race_features", "ema", "lap_tagging", "boxplot_stats", "strategy_report"):
        assert "Python" not in plan(QUERIES[name](spark, FOLDER)), name
    assert "ArrowEvalPython" in plan(QUERIES["dtw_distance"](spark, FOLDER))


def test_planning_counts_each_source_once(spark):
    """Sizes are handed down the chain: laps and samples are counted once each."""
    jobs = spark.sparkContext.statusTracker()
    for name in ("model_dataset", "dtw_style"):
        before = len(jobs.getJobIdsForGroup(None))
        QUERIES[name](spark, FOLDER)
        assert len(jobs.getJobIdsForGroup(None)) - before <= 5, name


def test_bucketed_samples_are_not_shuffled(spark, tmp_path):
    """Windows, sums and the join with laps read the buckets as they lie."""
    write_bucketed(tel(spark, FOLDER), "samples_in_buckets", str(tmp_path / "b"), buckets=5)
    samples = spark.table("samples_in_buckets")
    text = plan(telemetry.lap_features(samples))
    assert "Exchange" not in text and "Bucketed: true" in text
    # Of the whole job only laps and their dimensions move.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan(race_features(laps(spark, FOLDER), samples))
        plain = plan(race_features(laps(spark, FOLDER), tel(spark, FOLDER)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count("Exchange hashpartitioning") == plain.count("Exchange hashpartitioning") - 1
    moved = [line for line in joined.split("\n") if "Exchange" in line]
    assert moved and not any("SampleId" in line or "Time_s#" in line for line in moved)
    spark.sql("DROP TABLE samples_in_buckets")


def test_model_dataset_goes_over_its_tables_once(spark):
    text = plan(QUERIES["model_dataset"](spark, FOLDER))
    assert text.count("FileScan parquet [event_id") == 1
    assert text.count("FileScan parquet [o_orderkey") == 1
    assert text.count("ArrowEvalPython") == 1
