"""Readers.  Schemas are explicit; partition filters reach the file listing."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane import schemas
from pitlane.functions.durations import interval_to_seconds
from pitlane.operators.series import hand_down
from pitlane.sources.landing import NO_VALUE, with_sizes


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_partitioned(
    spark: SparkSession, path: str, schema: str, partitions: str = schemas.PARTITIONS, **only
) -> DataFrame:
    """A Parquet table partitioned into folders, limited to the given partition values."""
    df = with_sizes(spark.read.schema(f"{schema}, {partitions}").parquet(path), path)
    tests = [F.col(name) == value for name, value in only.items()]
    return hand_down(df.where(reduce(lambda a, b: a & b, tests)), df) if tests else df


def read_laps(spark: SparkSession, path: str, **only) -> DataFrame:
    """Stored laps with `LapTime_s`; `only` may fix Year, Race, Session."""
    laps = read_partitioned(spark, path, schemas.LAPS, **only)
    return hand_down(schemas.with_seconds(laps, {"LapTime": "LapTime_s"}), laps)


def read_telemetry(spark: SparkSession, path: str, **only) -> DataFrame:
    """Stored samples with `Time_s`."""
    samples = read_partitioned(spark, path, schemas.TELEMETRY, **only)
    return hand_down(schemas.with_seconds(samples, {"Time": "Time_s"}), samples)


def read_session(spark: SparkSession, laps: str, telemetry: str, **only) -> dict[str, DataFrame]:
    """The four raw tables of the chosen races."""
    kinds = {"race": "R", "quali": "Q"}
    made = {f"{k}_laps": read_laps(spark, laps, Session=v, **only) for k, v in kinds.items()}
    for k, v in kinds.items():
        made[f"{k}_telemetry"] = read_telemetry(spark, telemetry, Session=v, **only)
    return made


def read_processed(spark: SparkSession, path: str, **only) -> DataFrame:
    """Processed laps; adds `LapTime_s` if only the interval is stored."""
    df = spark.read.parquet(path)
    for name, value in only.items():
        df = df.where(F.col(name) == value)
    if "LapTime_s" not in df.columns:
        df = df.withColumn("LapTime_s", interval_to_seconds(F.col("LapTime")))
    return df


def race_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of the stored races, from the folders alone; no file is opened."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = set()
    for depth in ("", "/*"):
        for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}{depth}/Race=*")) or []:
            if not found.getPath().getParent().getName().startswith(("_", ".")):
                names.add(unquote(found.getPath().getName().removeprefix("Race=")))
    rows = [(None if name == NO_VALUE else name,) for name in sorted(names)]
    return spark.createDataFrame(rows, "Race STRING")


def scan_season(spark: SparkSession, path: str, year: int, schema: str) -> DataFrame:
    """Every Parquet file below the season's folder, in any nesting.

    The race is the name of a file's folder, plain or as ``Race=<name>``.  Race
    folders without files add nothing, a missing season gives an empty table.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.parquet")
    for folder in (f"{path}/Year={year}", f"{path}/{year}"):
        if not exists(spark, folder):
            continue
        files = reader.parquet(folder)
        name = F.regexp_extract("_metadata.file_path", r"/(?:Race=)?([^/]+)/[^/]+$", 1)
        # File paths are percent-encoded once, and folder names of partitions once more.
        plain = F.url_decode(F.regexp_replace(name, r"\+", "%2B"))
        race = F.when(plain.contains("%"), F.url_decode(plain)).otherwise(plain)
        return files.select("*", F.lit(year).alias("Year"), race.alias("Race"))
    return spark.createDataFrame([], f"{schema}, Year INT, Race STRING")


def read_schedule(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Events of one season."""
    return spark.read.schema(schemas.SCHEDULE).parquet(path).where(F.col("Year") == year)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON records with a fixed schema."""
    return spark.read.schema(schema).json(path)


def read_delivered(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """Delivered session files: json, csv (with header) or parquet."""
    reader = spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", "true")
    return reader.format(kind).load(path)


def usable_telemetry(samples: DataFrame, laps: DataFrame, keys: list[str]) -> DataFrame:
    """Samples of known laps that carry a time; the rest cannot be used."""
    timed = samples.where(F.col("Time").isNotNull())
    return timed.join(laps.select(*keys), keys, "left_semi")


def laps_without_telemetry(laps: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """The skipped laps, for the log."""
    return laps.select(*keys).join(samples.select(*keys), keys, "left_anti")


def read_serving(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def read_serving_jdbc(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """The serving table of a database; partitioning options split the read."""
    return spark.read.format("jdbc").options(dbtable=table, **options).load()
