"""Run-time settings, read from the session, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# A group above this many rows is processed in pieces instead of in one task.
HOT_GROUP_ROWS = "spark.pitlane.hotGroupRows"
HOT_GROUP_ROWS_DEFAULT = 4_000_000
# A group above this many rows is not ranked by Spark's in-memory exact percentile.
PERCENTILE_ROWS = "spark.pitlane.percentileRows"
PERCENTILE_ROWS_DEFAULT = 500_000
# A side with more rows than this is never broadcast.
BROADCAST_ROWS = "spark.pitlane.broadcastRows"
BROADCAST_ROWS_DEFAULT = 1_000_000
# Longest series handed to a single warping kernel call.
WARP_BLOCK = "spark.pitlane.warpBlock"
WARP_BLOCK_DEFAULT = 16_384


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="pitlane-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used before; it is deleted when the application ends."""
    return f"{_scratch_home(spark, spark.sparkContext.applicationId, shared_folder(spark))}/{name}-{uuid.uuid4().hex}"


@cache
def _scratch_home(spark: SparkSession, application: str, shared: str) -> str:
    home = f"{shared}/{application}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(home)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return home


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and cut its lineage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def drop_scratch(df: DataFrame) -> None:
    """Delete a scratch table that no plan reads any more; other paths are left alone."""
    spark = df.sparkSession
    home = _scratch_home(spark, spark.sparkContext.applicationId, shared_folder(spark))
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if home.rsplit("/", 1)[-1] in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
