"""Landing survives broken deliveries; stored tables know their group sizes."""

import pytest
from pyspark.sql import functions as F

from pitlane.operators.series import hot_groups, most_rows
from pitlane.sources import landing, readers, writers

PARTS = ["Year", "Race"]


def delivery(spark, batch, races=("A B", "C/D", None), rows=20):
    made = [(y, r, str(i % 3), i % 4, float(i), batch) for y in (2022, 2023) for r in races for i in range(rows)]
    return spark.createDataFrame(made, "Year int, Race string, DriverNumber string, LapNumber short, v double, Batch int")


def counts(spark, path):
    return {(r.Year, r.Race, r.Batch): r["count"] for r in spark.read.parquet(path).groupBy("Year", "Race", "Batch").count().collect()}


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


@pytest.mark.parametrize("moved", [0, 1, 3, 6])
def test_broken_delivery_is_repeated_whole(spark, tmp_path, monkeypatch, moved):
    path = str(tmp_path / "t")
    writers.write_if_absent(delivery(spark, 1, ["first"]), path, PARTS)
    real, left = landing.Files.move, [moved]

    def breaking(self, source, target):
        if "_staging" in source[0] and left[0] == 0:
            raise RuntimeError("lost")
        left[0] -= "_staging" in source[0]
        real(self, source, target)
        if left[0] == 0 and moved == 6:
            raise RuntimeError("lost before the manifest")

    with monkeypatch.context() as patch:
        patch.setattr(landing.Files, "move", breaking)
        with pytest.raises(RuntimeError):
            writers.write_if_absent(delivery(spark, 2), path, PARTS)
    writers.write_if_absent(delivery(spark, 3), path, PARTS)
    want = {(y, r, 3): 20 for y in (2022, 2023) for r in ("A B", "C/D", None)} | {(y, "first", 1): 20 for y in (2022, 2023)}
    assert counts(spark, path) == want
    writers.write_if_absent(delivery(spark, 4), path, PARTS)
    assert counts(spark, path) == want


def test_half_written_partition_gives_way(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_if_absent(delivery(spark, 1, ["first"]), path, PARTS)
    half = delivery(spark, 9, ["C/D"], 3).where("Year = 2022")
    half.write.mode("append").partitionBy(*PARTS).parquet(path)  # no manifest names it
    writers.write_if_absent(delivery(spark, 2, ["C/D"]), path, PARTS)
    assert counts(spark, path) == {(y, r, b): 20 for y in (2022, 2023) for r, b in (("first", 1), ("C/D", 2))}


def test_older_tables_are_adopted(spark, tmp_path):
    path = str(tmp_path / "t")
    delivery(spark, 1).write.partitionBy(*PARTS).parquet(path)
    writers.write_if_absent(delivery(spark, 2, ["A B", "new", None]), path, PARTS)
    assert counts(spark, path) == {(y, r, 2 if r == "new" else 1): 20 for y in (2022, 2023) for r in ("A B", "C/D", None, "new")}
    writers.write_if_absent(delivery(spark, 3).limit(0), path, PARTS)
    assert spark.read.parquet(path).count() == 160


def test_sizes_are_stored_with_the_table(spark, tmp_path, hot):
    path, schema = str(tmp_path / "t"), "DriverNumber STRING, LapNumber SMALLINT, v DOUBLE, Batch INT"

    def table(**only):
        return readers.read_partitioned(spark, path, schema, "Year INT, Race STRING", **only)

    writers.write_if_absent(delivery(spark, 1, ["A"], 48), path, PARTS)
    writers.write_if_absent(delivery(spark, 2, ["A", "B"], 96), path, PARTS)
    key = ["Year", "Race", "DriverNumber", "LapNumber"]
    for df in (table(), table(Year=2023)):
        before = jobs(spark)
        assert most_rows(df, key) == 8 and most_rows(df, key[:3]) == 32 and most_rows(df, []) == 288
        assert hot_groups(df, key) is None
        assert jobs(spark) == before
    with hot(20):
        df, before = table(), jobs(spark)
        listed = hot_groups(df, key[:3], exact=False)
        assert jobs(spark) == before
        assert {(r.Year, r.Race, r["_rows"]) for r in listed.collect()} == {(y, "B", 32) for y in (2022, 2023)}
    # Rows that came by another way make the note worthless.
    delivery(spark, 3, ["A"], 30).write.mode("append").partitionBy(*PARTS).parquet(path)
    assert most_rows(table(), key) is None
    with hot(7):
        assert hot_groups(table(), key).count() == 24


def test_clean_names(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_if_absent(delivery(spark, 1, ["São Paulo 100%", "a=b"]), path, PARTS)
    assert {r.Race for r in readers.race_list(spark, path).collect()} == {"São Paulo 100%", "a=b"}
    assert spark.read.parquet(path).where(F.col("Race") == "a=b").count() == 40
