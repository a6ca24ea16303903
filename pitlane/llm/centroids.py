"""Clustering around centroids, exact, with ns-bounds.

Vectors are integers, ``floor(scale * x)``; they are packed into blocks once.  A round is one
pass over the blocks with the present centroids, which are few.

Of every vector and centroid the state keeps the distance that was last computed and the
round of it.  All earlier centroids are kept, so a later round knows how far a centroid
has moved since *that* round in a straight line: the stored distance plus or minus the norm
of this total displacement bounds the present one.  (Adding up the drifts of each round
would give looser bounds.)  Where the bounds leave more than one candidate, the distances
are computed again, in whole numbers.  Bounds are floats with some slack and never decide
between near values; ties go to the smaller centroid number.

A block also reports the count and sum of each cluster; Spark adds them up and the driver
sees k x (dimension + 1) numbers a round.  State is written to the shared folder each
round and the round before last is deleted.

Defined cases: vectors of another length than `dimension`, null, or with null or non-finite
components are not kept; kept vectors with a null id are clustered but never a starting
centroid; repeated rows each count; equal hashes start in the order of their vectors; with
fewer vectors than k all are starting centroids; no vectors give no rows.  Integers of
2**27 and more in size would have distances beyond a long: they end in an error that says so.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import stored
from pitlane.settings import drop_scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors of one block; a block is one row and the unit of work.
BLOCK = 4096
LIMIT = 2**27
# Relative and absolute slack of a bound: far above the rounding of its floats.
SLACK = 1e-9
STATE = "ids binary, null_ids binary, vectors binary, owner binary, distance binary, seen binary, counts array<long>, sums array<long>, inertia array<long>, evaluated long"
RESULT = "vec_id long, cluster int, distance long"


def usable(df: DataFrame, id_col: str, vector_col: str, dimension: int, scale: int) -> DataFrame:
    """(id, vector of longs) of the rows that are kept."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(
        (F.size("vector") == dimension)
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    )
    wide = F.exists("vector", lambda x: F.abs(x * scale) >= F.lit(float(LIMIT)))
    message = f"centroids: a component times {scale} reaches 2**27, so distances may exceed a long"
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    return rows.select("id", F.when(wide, F.raise_error(F.lit(message)).cast("array<long>")).otherwise(whole).alias("vector"))


def starts(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the least hashes of salt and id."""
    hashed = rows.where("id IS NOT NULL").withColumn("hash", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256))
    return np.array([r.vector for r in hashed.orderBy("hash", "vector").limit(k).collect()], dtype=np.int64)


def pack(rows: DataFrame, dimension: int) -> DataFrame:
    """Blocks of vectors; nothing is known of their distances yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            ids, nulls, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return to_batch([(ids, nulls, vectors.reshape(-1, dimension), None, None, None)], dimension)

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                ids = part.column("id")
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                held.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), nulls, flat))
                if sum(len(h[0]) for h in held) >= BLOCK:
                    yield block()
        if held:
            yield block()

    return rows.mapInArrow(run, STATE)


def to_batch(blocks: list[tuple], dimension: int, totals: list[tuple] | None = None) -> pa.RecordBatch:
    names = [c.split()[0] for c in STATE.split(", ")]
    columns: list[list] = [[] for _ in names]
    for i, (ids, nulls, vectors, owner, distance, seen) in enumerate(blocks):
        arrays = [ids, nulls, vectors.astype(np.int32), owner, distance, seen]
        for column, a in zip(columns, arrays):
            column.append(None if a is None else np.ascontiguousarray(a).tobytes())
        for column, value in zip(columns[6:], totals[i] if totals else (None, None, None, None)):
            column.append(value)
    types = [pa.binary()] * 6 + [pa.list_(pa.int64())] * 3 + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def squares(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    apart = vectors.astype(np.int64) - centre
    return np.einsum("ij,ij->i", apart, apart)


def assign(
    vectors: np.ndarray, history: np.ndarray, owner: np.ndarray | None, distance: np.ndarray | None, seen: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(owner, exact squared distance to it, stored distances, their rounds, distances computed).

    `history` is (rounds, k, dimension); its last entry holds the present centroids.
    """
    now, k, n = len(history) - 1, history.shape[1], len(vectors)
    rows = np.arange(n)
    if owner is None:
        owner, distance, seen = np.zeros(n, np.int16), np.zeros((n, k)), np.zeros((n, k), np.int16)
        open_ = np.ones((n, k), dtype=bool)
    else:
        distance, seen = distance.copy(), seen.copy()
        moved = np.sqrt(((history - history[-1]).astype(np.float64) ** 2).sum(axis=2))  # (rounds, k)
        moved = moved[seen, np.arange(k)]
        slack = SLACK * (distance + moved) + SLACK
        low = distance - moved - slack
        high = (distance + moved + slack)[rows, owner]
        open_ = low <= high[:, None]
        open_[rows, owner] = True
        # A vector whose owner alone is open keeps it.
        open_[open_.sum(axis=1) == 1] = False
        # The others first get the exact distance to their owner, which may close some candidates.
        unsure = open_.any(axis=1)
        for j in range(k):
            own = np.flatnonzero(unsure & (owner == j))
            exact = np.sqrt(squares(vectors[own], history[-1, j]).astype(np.float64))
            open_[own] &= low[own] <= (exact * (1 + SLACK) + SLACK)[:, None]
            open_[own, j] = True
    best = np.full(n, np.iinfo(np.int64).max)
    chosen = owner.copy()
    for j in range(k):
        here = np.flatnonzero(open_[:, j])
        exact = squares(vectors[here], history[-1, j])
        distance[here, j], seen[here, j] = np.sqrt(exact.astype(np.float64)), now
        nearer = exact < best[here]
        best[here[nearer]], chosen[here[nearer]] = exact[nearer], j
    return chosen, best, distance, seen, int(open_.sum())


def step(state: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
    """One round over the blocks; in the last one every distance to the owner is exact and reported."""
    k, dimension = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, dimension)
                known = row["owner"] is not None
                before = (
                    np.frombuffer(row["owner"], np.int16),
                    np.frombuffer(row["distance"], np.float64).reshape(-1, k),
                    np.frombuffer(row["seen"], np.int16).reshape(-1, k),
                ) if known else (None, None, None)
                owner, best, distance, seen, evaluated = assign(vectors, history, *before)
                counts = np.bincount(owner, minlength=k)
                sums = np.stack([vectors[owner == j].sum(axis=0, dtype=np.int64) for j in range(k)])
                inertia = np.zeros(k, np.int64)
                if last:
                    for j in range(k):
                        own = np.flatnonzero(owner == j)
                        best[own] = squares(vectors[own], history[-1, j])
                        inertia[j] = best[own].sum()
                    distance = best  # what the result needs of it
                made = (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["null_ids"], bool), vectors, owner, distance, seen)
                yield to_batch([made], dimension, [(counts.tolist(), sums.ravel().tolist(), inertia.tolist(), evaluated)])

    return state.mapInArrow(run, STATE)


def totals(state: DataFrame, column: str) -> list[int]:
    """The column's lists added up by position."""
    each = state.select(F.posexplode(column).alias("at", "value"))
    return [r.total for r in each.groupBy("at").agg(F.sum("value").alias("total")).orderBy("at").collect()]


def moved(centres: np.ndarray, counts: list[int], sums: list[int]) -> np.ndarray:
    """The componentwise floor of the means; empty clusters stay."""
    made = centres.copy()
    for j, n in enumerate(counts):
        if n:
            made[j] = [s // n for s in sums[j * made.shape[1] : (j + 1) * made.shape[1]]]
    return made


def digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centre).encode()).hexdigest()


def cluster(
    df: DataFrame, k: int = 8, rounds: int = 10, dimension: int = 64, scale: int = 1024,
    salt: str = "3", id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, one row of sums per cluster, final centroids)."""
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, dimension, scale)
    centres = starts(rows, k, salt)
    if not len(centres):
        sums = spark.createDataFrame([], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return spark.createDataFrame([], RESULT), sums, centres
    history = centres[None]
    state = stored(pack(rows, dimension), "vectors")
    for i in range(rounds + 1):
        before, state = state, stored(step(state, history, last=i == rounds), "assigned")
        drop_scratch(before)
        if i < rounds:
            centres = moved(centres, totals(state, "counts"), totals(state, "sums"))
            history = np.concatenate([history, centres[None]])
    inertia = totals(state, "inertia")
    each = [(j, s, sum(inertia), digest(c)) for j, (s, c) in enumerate(zip(inertia, centres, strict=True))]
    sums = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["null_ids"], bool))
                owner = pa.array(np.frombuffer(row["owner"], np.int16).astype(np.int32))
                yield pa.RecordBatch.from_arrays([ids, owner, pa.array(np.frombuffer(row["distance"], np.int64))], ["vec_id", "cluster", "distance"])

    return state.select("ids", "null_ids", "owner", "distance").mapInArrow(unpack, RESULT), sums, centres


def clustered(df: DataFrame, **options) -> DataFrame:
    """`cluster` with the sums of each vector's cluster beside it; there are k of them, so they are broadcast."""
    rows, sums, _ = cluster(df, **options)
    return rows.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
