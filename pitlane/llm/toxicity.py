"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words (A-Z lower-cased), the first five
bytes of longer words, pairs of neighbouring words, and pairs with one word skipped.
They are hashed to 64 bits.  FTRL keeps a learning rate for each coordinate and an L1
term that leaves most weights at zero; only the other ones are broadcast.

Labels are read only where ``crc32(id as text) % 5 != 0``.  The fit uses a bounded,
documented sample: the `per_class` labelled rows of either label with the smallest
hash of their id; the intercept is then moved by the difference between the log odds of
the table and those of the sample, so that the size of the table does not matter.
Scoring covers every row and every word.

Defined cases: null and empty texts get the score of the intercept; a null id counts
as the text "" (held out); without labelled rows of both
kinds every score is 0; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import Shared, id_and_text, map_arrow, stored
from pitlane.llm.words import BASE, Words, grams, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Labelled rows of either label that the fit reads at most.
PER_CLASS = 2000
# Fit: rates, penalties, passes, and in how many sampled rows a feature must occur.
ALPHA, BETA, L1, L2, PASSES, LEAST_ROWS = 1.0, 1.0, 10.0, 0.01, 12, 3
STEM = 5
SLOTS = 1 << 22
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Weights:
    """Non-zero weights by feature hash, sorted, and the intercept."""

    hashes: np.ndarray
    values: np.ndarray
    bias: float
    fitted: bool = True


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, bounds by text) of each kind of feature, with repetitions."""
    one = words.hash
    kinds = [(one, words.bounds)]
    stems = words.stems(STEM)
    kinds.append((mix(stems + np.uint64(1)), words.bounds))
    kinds.append(grams(one, words.bounds, 2))
    # Skip-grams: words two apart in the same text.
    counts = np.maximum(words.counts - 2, 0)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    first = np.repeat(words.bounds[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    kinds.append((mix(one[first] * BASE + one[first + 2] + np.uint64(7)), bounds))
    return kinds


def feature_sets(column: pa.Array) -> list[np.ndarray]:
    """The distinct features of each text."""
    kinds = features(Words(column, lower=True))
    return [
        np.unique(np.concatenate([h[b[i] : b[i + 1]] for h, b in kinds])) for i in range(len(column))
    ]


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Weights:
    """FTRL-proximal over rows of distinct feature hashes, in the order given."""
    if len(set(labels.tolist())) < 2:
        return Weights(np.zeros(0, np.uint64), np.zeros(0), 0.0, False)
    names, counts = np.unique(np.concatenate(rows), return_counts=True)
    names = names[counts >= LEAST_ROWS]
    found = []
    for row in rows:
        at = np.searchsorted(names, row)
        at[at == len(names)] = 0
        found.append(at[names[at] == row] if len(names) else at[:0])
    z, n = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    bias = len(names)
    order = np.random.default_rng(0)

    def weights(at: np.ndarray) -> np.ndarray:
        w = (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0.0
        return w

    for _ in range(PASSES):
        for i in order.permutation(len(found)):
            at = np.append(found[i], bias)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[i]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(len(names) + 1))
    keep = np.flatnonzero(w[:-1])
    return Weights(names[keep], w[keep], float(w[-1]))


def score_texts(column: pa.Array, model: Weights) -> np.ndarray:
    """Scores between 0 and 1."""
    total = np.full(len(column), model.bias)
    if len(model.hashes):
        table = np.zeros(SLOTS, dtype=bool)
        table[(model.hashes & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        hits, owners = [], []
        for hashes, bounds in features(Words(column, lower=True)):
            near = np.flatnonzero(table[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)])
            at = np.searchsorted(model.hashes, hashes[near])
            at[at == len(model.hashes)] = 0
            sure = model.hashes[at] == hashes[near]
            hits.append(at[sure])
            owners.append(np.searchsorted(bounds, near[sure], "right") - 1)
        once = np.unique(np.concatenate(owners) * len(model.hashes) + np.concatenate(hits))
        np.add.at(total, once // len(model.hashes), model.values[once % len(model.hashes)])
    return 1 / (1 + np.exp(-np.clip(total, -35, 35))) if model.fitted else np.zeros(len(column))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS) -> Weights:
    """Fit on the bounded sample; `docs` has doc_id and text."""
    usable = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    usable = usable.where("label IN (0, 1)").distinct()
    totals = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    parts = [usable.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    # At most 2 * per_class rows, so the broadcast is bounded.
    chosen = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.view(np.int64) for s in feature_sets(batch.column("text"))]
        rows = [uuid.uuid4().hex for _ in sets]
        arrays = [pa.array(rows), batch.column("doc_id"), batch.column("label"), pa.array(sets, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "label", "features"])

    # Most features occur in one text only, however long it is; they are counted and left out before
    # anything goes to the driver, as the fit has no use for them.
    sampled = stored(map_arrow(chosen, extract, "row string, doc_id long, label int, features array<long>"), "sampled")
    each = sampled.select("row", F.explode("features").alias("feature"))
    common = each.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS).select("feature")
    lists = each.join(common, "feature").groupBy("row").agg(F.sort_array(F.collect_list("feature")).alias("features"))
    table = sampled.select("row", "doc_id", "label").join(lists, "row", "left").select(
        "doc_id", "label", F.coalesce("features", F.array().cast("array<long>")).alias("features")
    ).toArrow()
    rows = []
    for chunk in table.to_batches():
        sets = chunk.column("features")
        flat, bounds = np.asarray(sets.values.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64), sets.offsets.to_numpy()
        ids, marks = chunk.column("doc_id").to_pylist(), chunk.column("label").to_pylist()
        rows += [(doc, mark, flat[bounds[i] : bounds[i + 1]]) for i, (doc, mark) in enumerate(zip(ids, marks))]
    del table
    # Neither the order of partitions nor that of repeated rows may change the fit.
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    model = fit([r[2] for r in rows], np.array([r[1] for r in rows], dtype=float))
    if model.fitted:
        # The share of each label's rows that the sample has.
        taken = {k: min(n, per_class) / n for k, n in totals.items()}
        model.bias += float(np.log(taken[0] / taken[1]))
    return model


def score(df: DataFrame, model: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: held_out, score and predicted."""
    shared = Shared(df, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = score_texts(batch.column("text"), shared.value)
        arrays = [
            batch.column("doc_id"),
            pa.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0 for i in batch.column("doc_id").to_pylist()]),
            pa.array(scores, pa.float64()),
            pa.array((scores >= 0.5).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(id_and_text(df, id_col, text_col), run, SCHEMA)


def keep_clean(df: DataFrame, model: Weights, text_col: str = "text") -> DataFrame:
    """The rows of `df` that are not predicted toxic, with all their columns."""
    shared = Shared(df, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(score_texts(batch.column(text_col), shared.value) < 0.5))

    return map_arrow(df, run, df.schema, text_col)
