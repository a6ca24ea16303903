"""Shared helpers: by-value shipping, per-process caches, bounded slices, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.settings import scratch_path

# Tasks must run where this package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that a task handles at once (one longer text is handled alone).
BLOCK_BYTES = 1_000_000
# Rows that Spark hands to Python at once while a table is stored.
BATCH_ROWS_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
# Names of per-process values that other operators drop.
LARGE = "large_"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back: lineage ends there.

    Rows with texts or sets are large, so they go to Python in small batches meanwhile.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(BATCH_ROWS_KEY)
    spark.conf.set(BATCH_ROWS_KEY, min(BATCH_ROWS, int(before) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def _home() -> dict[str, Any]:
    return sys.modules.setdefault("_pitlane_process", types.ModuleType("_pitlane_process")).__dict__


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """A value made once per Python process and kept for its later tasks."""
    home = _home()
    if name not in home:
        home[name] = make()
    return home[name]


def release(keep: str | None = None) -> None:
    """Drop large per-process values of other operators, which this process may not need again.

    Python processes outlive a job; without this each operator of a pipeline would
    leave its state to the next one.
    """
    old = [n for n in _home() if n.startswith(LARGE) and n != keep]
    for name in old:
        del _home()[name]
    if old:
        give_back()


def give_back() -> None:
    """Return freed memory to the system, as the process lives on beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Shared:
    """A value broadcast as bytes, by value: tasks can load it where this package is not installed.

    A process loads it once and keeps the last one.
    """

    def __init__(self, df: DataFrame, value: Any):
        self.bytes = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
        self.key = uuid.uuid4().hex

    @property
    def value(self) -> Any:
        held = per_process("shared", dict)
        if self.key not in held:
            held.clear()
            held[self.key] = cloudpickle.loads(self.bytes.value)
        return held[self.key]


def sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts as empty."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of `batch` with about `most` bytes of text each; every row is in one part."""
    total = np.cumsum(sizes(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def map_arrow(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    column: str = "text",
    most: int = BLOCK_BYTES,
    keep: str | None = None,
) -> DataFrame:
    """`function` over bounded slices of `df`; `keep` names the large per-process value it uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        for batch in batches:
            for part in slices(batch, column, most):
                yield function(part)
        give_back()

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the two columns, under fixed names, whatever else `df` holds."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


# A side with at most so many rows of a few numbers may be broadcast.
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows, else as it is.

    `df` should be stored, as it is counted.  The count stops at the bound.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
