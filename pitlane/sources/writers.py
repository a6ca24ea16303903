"""Writers of raw, processed, season and serving tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitlane import schemas
from pitlane.constants import LAP_KEY, SAMPLE_ORDER
from pitlane.functions.durations import interval_micros, interval_text
from pitlane.operators.shaping import serving_columns
from pitlane.sources.landing import land

RACE = ["Year", "Race"]
SESSION = [*RACE, "Session"]
INSERT_BATCH = 5000


def balanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Bring rows of one stored partition together in files of even size.

    Adaptive execution splits a large partition over several tasks and merges
    small ones, so neither one huge nor thousands of tiny files come out.
    """
    return df.hint("rebalance", *partitions)


def write_if_absent(df: DataFrame, path: str, partitions: list[str] = SESSION) -> None:
    """Add only partitions that are not stored yet; stored ones are never touched.

    A partition is stored whole or not at all, whatever breaks on the way (`landing`).
    """
    land(df, path, partitions)


def write_processed(df: DataFrame, path: str, partitions: list[str] = RACE) -> None:
    """Write processed laps; a rerun replaces exactly the races it contains."""
    writer = balanced(df, partitions).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_bucketed(
    samples: DataFrame, table: str, path: str | None = None, keys: list[str] = LAP_KEY,
    order: list[str] = SAMPLE_ORDER, buckets: int | None = None,
) -> None:
    """Store samples as a table of buckets by the lap key, sorted by time in each.

    Windows over a lap and joins by the lap key then read a bucket per task and need no
    exchange of the samples.  One task writes a bucket's file, so choose `buckets` (default: the
    shuffle partitions of the session) for the size that the table will have.
    """
    number = buckets or int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = samples.repartition(number, *keys).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(number, *keys).sortBy(*order)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_season(df: DataFrame, path: str) -> int:
    """Write a consolidated season and return its number of rows, counted while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    balanced(counted, ["Year"]).write.mode("overwrite").partitionBy("Year").parquet(path)
    rows = seen.get["rows"]
    if not rows:
        raise ValueError("no race data to consolidate")
    return rows


def serving_rows(processed: DataFrame) -> DataFrame:
    """Processed laps as served: sorted lower-case columns, lap time as text."""
    text = interval_text(interval_micros(F.col("LapTime")))
    return serving_columns(processed.drop("LapTime_s").withColumn("LapTime", text))


def load_serving(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows to the served table, or replace the races they contain.

    Appending the same race twice stores it twice; ``mode="replace"`` does not.
    """
    rows = balanced(rows, ["year", "race"])
    if mode == "replace":
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = rows.write.mode(mode)
    writer.partitionBy("year", "race").parquet(path)


def load_serving_jdbc(
    rows: DataFrame, table: str, mode: str = "append", sessions: int = 8, **options: str
) -> None:
    """Insert rows into a database table in batches over a bounded number of connections."""
    writer = rows.write.format("jdbc").mode(mode).option("batchsize", INSERT_BATCH)
    writer.option("numPartitions", sessions).options(dbtable=table, **options).save()


def create_serving(spark: SparkSession, table: str, path: str) -> None:
    """Drop and create the served table over a folder."""
    columns = ", ".join(f"{name} {kind}" for name, kind in schemas.SERVING)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")


def insert_serving(rows: DataFrame, table: str) -> None:
    """INSERT INTO the served table by column name."""
    spark = rows.sparkSession
    view = f"new_rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    names = ", ".join(name for name, _ in schemas.SERVING)
    casts = ", ".join(f"CAST({name} AS {kind})" for name, kind in schemas.SERVING)
    try:
        spark.sql(f"INSERT INTO {table} ({names}) SELECT {casts} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
