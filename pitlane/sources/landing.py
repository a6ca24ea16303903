"""Landing of whole partitions, and what a stored table says about its own groups.

A delivery is written to a staging folder, its partition folders are then moved into place
one by one, and at last a manifest names them.  Only the manifests say what is stored: a
partition folder that none of them names is left over from a broken delivery and gives way.

Beside the data lie the row counts of each key (`_key_rows`) and a note of the largest
groups with the version of the data, a digest of the listing of its files.  A reader whose
listing has the same version knows the group sizes without counting; with any other one it
ignores the note.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.constants import DRIVER_KEY, LAP_KEY
from pitlane.operators.series import Sizes, hot_limit, know

MANIFESTS, STAGING, KEY_ROWS, SIZES = "_landed", "_staging", "_key_rows", "_sizes.json"
# Folder name of a missing partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Keys whose groups later jobs ask for.
KEYS = [LAP_KEY, DRIVER_KEY]


class Files:
    """The few calls of a file system that landing needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.make_path = spark._jvm.org.apache.hadoop.fs.Path
        self.as_text = spark._jvm.org.apache.commons.io.IOUtils.toString
        self.system = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.make_path("/".join(parts))

    def exists(self, *parts: str) -> bool:
        return self.system.exists(self.path(*parts))

    def names(self, *parts: str, folders: bool = True) -> list[str]:
        found = self.system.listStatus(self.path(*parts)) if self.exists(*parts) else []
        return sorted(f.getPath().getName() for f in found if f.isDirectory() == folders)

    def read(self, *parts: str) -> str:
        stream = self.system.open(self.path(*parts))
        try:
            return self.as_text(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, folder: str, name: str) -> None:
        """Write aside and rename, so that nobody sees half a file."""
        aside = f".{name}-{uuid.uuid4().hex}"
        stream = self.system.create(self.path(folder, aside))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.delete(folder, name)
        self.move((folder, aside), (folder, name))

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        self.system.mkdirs(self.path(*target[:-1]))
        if not self.system.rename(self.path(*source), self.path(*target)):
            raise OSError(f"cannot move {'/'.join(source)} to {'/'.join(target)}")

    def delete(self, *parts: str) -> None:
        self.system.delete(self.path(*parts), True)

    def partitions(self, depth: int, *parts: str) -> list[tuple[str, ...]]:
        """Folders ``name=value`` of the given depth, relative."""
        if depth == 0:
            return [()]
        own = [n for n in self.names(*parts) if "=" in n and not n.startswith(("_", "."))]
        return [(n, *rest) for n in own for rest in self.partitions(depth - 1, *parts, n)]


def landed(spark: SparkSession, path: str, depth: int) -> set[tuple[str, ...]]:
    """Partition folders that a manifest names; those of a table without manifests are adopted first."""
    files = Files(spark, path)
    if not files.exists(path, MANIFESTS):
        found = files.partitions(depth, path)
        if found:
            files.write(json.dumps([list(p) for p in found]), f"{path}/{MANIFESTS}", "adopted.json")
        else:
            files.system.mkdirs(files.path(path, MANIFESTS))
        return set(found)
    names = [n for n in files.names(path, MANIFESTS, folders=False) if n.endswith(".json") and not n.startswith(".")]
    return {tuple(p) for n in names for p in json.loads(files.read(path, MANIFESTS, n))}


def not_landed(df: DataFrame, stored: set[tuple[str, ...]], partitions: list[str]) -> DataFrame:
    """Rows of partitions that are not stored; a missing value is a value like others."""
    if not stored:
        return df
    unescape = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def value(folder: str) -> str | None:
        text = unescape(folder.split("=", 1)[1])
        return None if text == NO_VALUE else text

    rows = [tuple(value(f) for f in place) for place in sorted(stored)]
    names = [f"_stored_{i}" for i in range(len(partitions))]
    known = df.sparkSession.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    known = known.select(*[F.col(n).cast(df.schema[p].dataType).alias(n) for n, p in zip(names, partitions)])
    match = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(n)) for p, n in zip(partitions, names)])
    # As many rows as there are folders.
    return df.join(F.broadcast(known), match, "left_anti")


def land(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Add the partitions of `df` that are not stored yet, all of a partition or nothing."""
    spark, depth, name = df.sparkSession, len(partitions), uuid.uuid4().hex
    stored = landed(spark, path, depth)
    staging = f"{path}/{STAGING}-{name}"
    fresh = not_landed(df, stored, partitions)
    fresh.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(staging)
    files = Files(spark, path)
    places = files.partitions(depth, staging)
    known = set(files.partitions(depth, path))
    for place in places:
        if place in known:
            files.delete(path, *place)  # left over from a broken delivery
        files.move((staging, *place), (path, *place))
    files.write(json.dumps([list(p) for p in places]), f"{path}/{MANIFESTS}", f"{name}.json")
    files.delete(staging)
    if places:
        note_sizes(spark, path, df, places)


# -- sizes of groups -------------------------------------------------------


def version(df: DataFrame) -> str | None:
    """A digest of the names, lengths and times of the files that a plain scan has listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    if leaves.size() != 1 or "HadoopFsRelation" not in leaves.apply(0).toString() and not hasattr(leaves.apply(0), "relation"):
        return None
    listing = leaves.apply(0).relation().location().allFiles().mkString("\n")
    return hashlib.sha256("\n".join(sorted(listing.split("\n"))).encode()).hexdigest()


def note_sizes(spark: SparkSession, path: str, like: DataFrame, places: list[tuple[str, ...]]) -> None:
    """Count the new partitions by key, add them to the stored counts and note the largest groups."""
    files, notes = Files(spark, path), []
    table = spark.read.schema(like.schema).parquet(path)
    fresh = spark.read.schema(like.schema).option("basePath", path).parquet(*["/".join((path, *p)) for p in places])
    for keys in KEYS:
        if not set(keys) <= set(like.columns):
            continue
        target = f"{path}/{KEY_ROWS}/{'-'.join(keys)}"
        # Partitions that were left over and replaced may have been counted: only a whole delivery is noted.
        fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).write.mode("append").parquet(target)
        summed = key_rows(spark, path, keys, like).agg(F.max("_rows").alias("most"), F.sum("_rows").alias("rows")).first()
        notes.append({"keys": keys, "most": summed.most, "rows": summed.rows})
    if notes:
        files.write(json.dumps({"version": version(table), "sizes": notes}), path, SIZES)


def key_rows(spark: SparkSession, path: str, keys: list[str], like: DataFrame) -> DataFrame:
    """(keys, _rows) of the stored table, from the counts beside it."""
    kinds = ", ".join(f"{k} {like.schema[k].dataType.simpleString()}" for k in keys)
    stored = spark.read.schema(f"{kinds}, _rows long").parquet(f"{path}/{KEY_ROWS}/{'-'.join(keys)}")
    return stored.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))


def with_sizes(df: DataFrame, path: str) -> DataFrame:
    """`df`, a plain scan of the table, with its noted group sizes if they are of these very files."""
    spark = df.sparkSession
    files = Files(spark, path)
    if not files.exists(path, SIZES):
        return df
    note = json.loads(files.read(path, SIZES))
    if note["version"] != version(df):
        return df
    limit = hot_limit(df)
    for s in note["sizes"]:
        hot = key_rows(spark, path, s["keys"], df).where(F.col("_rows") > limit) if s["most"] > limit else None
        know(df, Sizes(tuple(s["keys"]), s["most"], limit, hot), Sizes((), s["rows"]))
    return df
