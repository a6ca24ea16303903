"""MinHash near-duplicates: fast similarity sketching, banding, exact verification.

A text's set holds its distinct shingles of `width` words (A-Z lower-cased); a text
with fewer words has its whole sequence as one; a text without words has an empty set.

Sketch.  Each round throws all elements of a set into bins by a new hash and a bin
keeps the least hash of the first round that reached it; after as many rounds as bins,
round t + i fills bin i.  Every bin fills, the share of equal bins estimates the
Jaccard similarity with at least the concentration of independent hashes, and a set of
n elements needs about t log(t) / n rounds.  A bin is kept as 8 bits.

Candidates.  Equal sets become one class first.  Classes with an equal band of ROWS
bins meet in a bucket.  A bucket compares each member with a centre, never all pairs;
members of other components than the centre's meet another centre in a second turn.  Pairs whose sketches agree too little for the threshold (six
standard deviations) are left out; the others are verified on the full sets.

The rest.  If a bucket then holds classes of several components, links between its
members that avoid the centre may be missing.  All classes in such buckets go through
an exact prefix join: a linked pair must share one of the (1 - t) n + 1 rarest shingles
of either side, early enough in both orders for the overlap that the threshold needs.

Defined cases: rows with a null id are returned with a null component and kept; empty
sets are linked with nothing; repeated rows are in one class, and each of them whose id
is the component's is kept; ids should be unique otherwise; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import few, id_and_text, map_arrow, stored
from pitlane.llm.components import components
from pitlane.llm.words import BASE, Words, grams, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, ROWS = 48, 6
BINS = BANDS * ROWS
# Times that the members of a bucket are compared with a centre.
TURNS = 2
SETS_SCHEMA = "doc_id long, n_shingles long, set_key binary, sketch binary"


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(column, lower=True)
    hashes, bounds = grams(words.hash, words.bounds, width)
    sets = []
    for i, n in enumerate(words.counts):
        if n >= width:
            sets.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        else:
            whole = np.full(min(n, 1), n, dtype=np.uint64)
            for h in words.hash[words.bounds[i] : words.bounds[i + 1]]:
                whole = mix(whole * BASE + h)
            sets.append(whole)
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BINS bytes for each set; rows of empty sets are zero."""
    least = np.full(len(sets) * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    for k in range(2 * BINS):
        if not len(elements):
            break
        h = mix(elements ^ mix(np.array([k + 1], dtype=np.uint64) * BASE))
        if k < BINS:
            bins = ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(h), k - BINS)
        value = (np.uint64(k) << np.uint64(48)) | (mix(h) >> np.uint64(16))
        np.minimum.at(least, owner * BINS + bins, value)
        if k < 4 or k % 4 == 0:
            open_sets = (least.reshape(-1, BINS) == np.iinfo(np.uint64).max).any(axis=1)
            stay = open_sets[owner]
            elements, owner = elements[stay], owner[stay]
    out = (mix(least) & np.uint64(255)).astype(np.uint8).reshape(-1, BINS)
    out[sizes == 0] = 0
    return out


def describe(df: DataFrame, width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), width)
        made = sketches(sets)
        arrays = [
            batch.column("doc_id"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([m.tobytes() for m in made], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set_key", "sketch"])

    return map_arrow(df, run, SETS_SCHEMA)


def band_rows(classes: DataFrame) -> DataFrame:
    """(band, rep): a band's number and bytes as one integer."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.conv(F.hex(F.substring("sketch", i * ROWS + 1, ROWS)), 16, 10).cast("long")
        + i.cast("long") * F.lit(1 << (8 * ROWS)),
    )
    return classes.select("rep", F.explode(bands).alias("band"))


def agreeing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the threshold, with their sizes."""
    t = percent / 100
    # 8-bit bins also agree by chance; six standard deviations below what the threshold gives.
    share = t + (1 - t) / 256
    least = int(BINS * (share - 6 * (share * (1 - share) / BINS) ** 0.5))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sa", "sb"))
        keep = pa.array((one == two).sum(axis=1) >= least)
        return batch.select(["a", "b", "na", "nb"]).filter(keep)

    side = {
        x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
        for x in "ab"
    }
    sized = pairs.join(side["a"], "a").join(side["b"], "b").where(
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    )
    return map_arrow(sized.select("a", "b", "na", "nb", "sa", "sb"), run, "a long, b long, na long, nb long", "sa")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rep, items) of the wanted reps: their sets as sorted 64-bit integers."""
    rows = docs.join(few(wanted), docs["doc_id"] == wanted["rep"], "left_semi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), width)
        arrays = [batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["rep", "items"])

    return map_arrow(rows, run, "rep long, items binary").dropDuplicates(["rep"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("ia").to_pylist(), batch.column("ib").to_pylist(), strict=True):
            one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(100 * shared >= percent * (len(one) + len(two) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("ia"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("ib"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ia", "ib")
    return map_arrow(both, run, "a long, b long", "ia")


def with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, rep, label): a class without links is its own component."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return named.select("band", "rep", F.coalesce("label", "rep").alias("label"))


def prefix_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share one of their rarest shingles (exact)."""
    spread = sets.join(labels.select(F.col("node").alias("rep"), "label"), "rep")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [np.frombuffer(x, np.int64) for x in batch.column("items").to_pylist()]
        sizes = [len(p) for p in parts]
        at = np.repeat(np.arange(len(parts)), sizes)
        columns = [batch.column("rep").take(pa.array(at)), batch.column("label").take(pa.array(at))]
        arrays = [*columns, pa.array(np.repeat(np.array(sizes, dtype=np.int64), sizes)), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]))]
        return pa.RecordBatch.from_arrays(arrays, ["rep", "label", "n", "h"])

    items = map_arrow(spread, run, "rep long, label long, n long, h long", "items", 400_000)
    counted = items.join(items.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "h")
    # How many rarest shingles a set must show; those that occur once can't be shared.
    order = F.array_sort(F.collect_list(F.struct("df", "h")))
    shown = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("o"))
    prefix = (
        counted.groupBy("rep", "label", "n").agg(order.alias("o")).where(shown > 0)
        .select("rep", "label", "n", F.size("o").alias("m"), F.posexplode(F.slice("o", F.lit(1), shown.cast("int"))).alias("i", "x"))
        .select("rep", "label", (F.col("n") - F.col("m") + F.col("i")).alias("at"), "n", F.col("x.h").alias("h"))
    )
    one, two = (prefix.select("h", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "label", "n", "at")]) for x in "ab")
    # The first shared shingle and all that follow it must be enough for the overlap that is needed.
    both = F.col("n_a") + F.col("n_b")
    enough = [(F.col(f"n_{x}") - F.col(f"at_{x}")) * (100 + percent) >= both * percent for x in "ab"]
    apart = (F.col("rep_a") < F.col("rep_b")) & (F.col("label_a") != F.col("label_b"))
    matched = one.join(two, "h").where(apart & enough[0] & enough[1])
    return matched.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(
    df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: n_shingles, component_id, and whether it is the one to keep.

    Two texts are linked if 100 * shared shingles >= percent * united shingles.
    """
    return judged_sets(df, width, percent, id_col, text_col).drop("set_key")


def judged_sets(
    df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`near_duplicates` with a key of each row's set, which tells rows of one id apart."""
    docs = id_and_text(df, id_col, text_col)
    rows = stored(describe(docs, width), "sets")
    real = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    keyed = real.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = stored(keyed, "classes")

    members = band_rows(classes)
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("band")
    placed = stored(members.join(shared, "band"), "buckets")
    sets = stored(full_sets(docs, stored(placed.select("rep").distinct(), "reps"), width), "full")

    links = sets.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    labels = placed.select(F.col("rep").alias("node"), F.col("rep").alias("label")).limit(0)
    for turn in range(TURNS):
        # First one order of centres for all bands, so that a family meets at few of them; later
        # another order for each band, for what is still apart.
        order = F.xxhash64("rep", F.col("band") * 0 if turn == 0 else F.col("band"), F.lit(turn))
        current = with_labels(placed, labels)
        heads = current.groupBy("band").agg(F.min(F.struct(order.alias("order"), "rep", "label")).alias("head"))
        apart = current.join(heads, "band").where(F.col("label") != F.col("head.label"))
        one, two = F.col("rep"), F.col("head.rep")
        pairs = apart.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
        found = stored(verified(agreeing(pairs, classes, percent), sets, percent), "verified")
        if found.limit(1).count():
            links = links.union(found)
            labels = components(links)

    # Buckets that still hold several components.
    current = with_labels(placed, labels)
    several = current.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    unsettled = stored(
        current.join(several, "band", "left_semi").select(F.col("rep").alias("node"), "label").distinct(), "unsettled"
    )
    more = stored(prefix_pairs(sets, unsettled, percent), "prefix")
    found = stored(verified(agreeing(more, classes, percent), sets, percent), "found")
    if found.limit(1).count():
        labels = components(links.union(found))

    named = classes.select("set_key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", F.coalesce("label", "rep").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.drop("sketch").join(named, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "set_key"
    )


def set_keys(df: DataFrame, width: int = 5, name: str = "_set_key", text_col: str = "text") -> DataFrame:
    """`df` with a column that equals the `set_key` of `judged_sets` for equal texts; null without shingles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(text_col), width)
        keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, name])

    return map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())]), text_col)
