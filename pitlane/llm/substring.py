"""Substring dedup over super-k-mers.

A window is `width` consecutive words.  Its minimiser is the least hash among its runs
of `grain` words.  Consecutive windows with one minimiser form a super-k-mer (at most
`LONGEST` windows), which travels as one packed string to the minimiser's bucket.
Sorting a bucket's windows finds each sequence's first occurrence; every later one is
marked, and the words it covers are removed.

* Only super-k-mers whose minimiser occurs more than once travel: equal windows have
  equal minimisers, so nothing can be missed.  The counts are pre-aggregated.
* Lists of minimisers and of runs belong to a row key `g`, the hash of id and text, so that
  they are as long as one text at most, however many rows have no id or repeat one.
* A bucket with many super-k-mers is salted.  Each part marks what is later inside the
  part; its first occurrences are then compared across the parts.

Order: smaller id first, then earlier start.  Defined cases: a null id is ordered as
the least 64-bit integer; rows with the same id count as one document, so repeated rows
get equal results; null and empty texts have no words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import id_and_text, map_arrow, release
from pitlane.llm.words import BASE, Words, grams, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 64
# Super-k-mers of one minimiser that one task sorts together.
BUCKET_ROWS = 1000
# Packed bytes that a task gathers before it sorts.
SORT_BYTES = 4_000_000


def sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each `width` neighbours and its leftmost place, by doubling."""
    least, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = least[: len(least) - step] <= least[step:]
        place = np.where(left, place[: len(place) - step], place[step:])
        least = np.where(left, least[: len(least) - step], least[step:])
        have += step
    return least, place


def super_kmers(words: Words, width: int, grain: int) -> tuple[np.ndarray, ...]:
    """(minimiser, text, first window, number of windows, weight) of each super-k-mer.

    The weight is 2 if the minimiser occurs more than once inside, as then windows of
    this super-k-mer may be equal to each other.
    """
    counts = np.maximum(words.counts - width + 1, 0)
    if not counts.sum():
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty, empty
    small, small_bounds = grams(words.hash, words.bounds, grain)
    least, place = sliding_least(small, width - grain + 1)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    own = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    at = own + small_bounds[:-1][text]
    value, place = least[at], place[at]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (own[1:] == 0)
    first = np.flatnonzero(new)
    since = np.arange(len(value)) - np.repeat(first, np.diff(np.append(first, len(value))))
    first = np.flatnonzero(since % LONGEST == 0)
    n = np.diff(np.append(first, len(value)))
    return value[first], text[first], own[first], n, 1 + (place[first] != place[first + n - 1])


def find(batch: pa.RecordBatch, width: int, grain: int) -> pa.RecordBatch:
    value, text, _, _, weight = super_kmers(Words(batch.column("text")), width, grain)
    arrays = [pa.array(value.view(np.int64)), batch.column("g").take(pa.array(text)), pa.array(weight, pa.int8())]
    return pa.RecordBatch.from_arrays(arrays, ["h", "g", "weight"])


def pack(batch: pa.RecordBatch, width: int, grain: int) -> pa.RecordBatch:
    """The super-k-mers of each text whose minimiser is wanted, as strings.

    Of neighbouring rows with one key (equal id and text) one is enough.
    """
    key = batch.column("g").to_numpy()
    batch = batch.filter(pa.array(np.append(True, key[1:] != key[:-1])[: len(key)]))
    words = Words(batch.column("text"))
    value, row, start, n, _ = super_kmers(words, width, grain)
    lists = batch.column("wanted")
    items = lists.flatten()
    owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    wanted = mix(items.field("h").to_numpy().view(np.uint64) + owner.astype(np.uint64) * BASE)
    order = np.argsort(wanted)
    own = mix(value + row.astype(np.uint64) * BASE)
    at = np.minimum(np.searchsorted(wanted[order], own), max(len(wanted) - 1, 0))
    hit = np.flatnonzero(wanted[order][at] == own) if len(wanted) else at[:0]
    salts = items.field("salts").to_numpy()[order][at[hit]]
    value, row, start, n = value[hit], row[hit], start[hit], n[hit]
    first = words.bounds[row] + start
    begin, end = words.start[first], words.end[first + n + width - 2]
    strings = [words.bytes[b:e].tobytes() for b, e in zip(begin, end, strict=True)]
    rows = pa.array(row)
    arrays = [
        pa.array(value.view(np.int64)), pa.array(salts, pa.int32()), batch.column("d").take(rows),
        batch.column("g").take(rows), pa.array(start, pa.int32()), pa.array(strings, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["h", "salts", "d", "g", "s", "packed"])


def later_windows(table: pa.Table, width: int) -> pa.RecordBatch:
    """Later occurrences as runs (w is null); in salted buckets the first ones too, with their hash."""
    words = Words(table.column("packed").combine_chunks())
    w, bounds = grams(words.hash, words.bounds, width)
    row = np.repeat(np.arange(table.num_rows), np.diff(bounds))
    d, g = table.column("d").to_numpy()[row], table.column("g").to_numpy()[row]
    start = table.column("s").to_numpy().astype(np.int64)[row] + np.arange(len(row)) - bounds[:-1][row]
    salted = table.column("salts").to_numpy()[row] > 1
    order = np.lexsort((start, d, w))
    new = np.ones(len(order), dtype=bool)
    new[1:] = w[order][1:] != w[order][:-1]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(order), dtype=bool)
    later[order] = (d[order] != d[head]) | (start[order] != start[head])
    # Runs of later windows; rows hold consecutive windows.
    begins = later.copy()
    begins[1:] &= ~later[:-1] | (row[1:] != row[:-1])
    ends = later.copy()
    ends[:-1] &= ~later[1:] | (row[1:] != row[:-1])
    at, to = np.flatnonzero(begins), np.flatnonzero(ends)
    single = np.flatnonzero(salted & ~later)
    pick = np.concatenate((at, single))
    runs = np.concatenate((to - at + 1, np.ones(len(single), np.int64)))
    none = np.arange(len(pick)) < len(at)
    arrays = [
        pa.array(d[pick]), pa.array(g[pick]), pa.array(start[pick], pa.int32()), pa.array(runs, pa.int32()),
        pa.array(w[pick].view(np.int64), mask=none),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["d", "g", "s", "n", "w"])


def sort_buckets(packs: DataFrame, width: int) -> DataFrame:
    """`later_windows` over whole (h, salt) groups; input partitions are sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                held.append(part)
                size += part.nbytes
                if size < SORT_BYTES:
                    continue
                table = pa.Table.from_batches(held)
                keys = np.stack([table.column(c).to_numpy() for c in ("h", "salt")])
                # The last group may go on in the next batch.
                ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
                if len(ends):
                    yield later_windows(table.slice(0, ends[-1]), width)
                    held = table.slice(ends[-1]).to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield later_windows(pa.Table.from_batches(held), width)

    return packs.mapInArrow(run, "d long, g long, s int, n int, w long")


def cut(batch: pa.RecordBatch, width: int, digest: bool) -> pa.RecordBatch:
    """Remove the covered words of each text."""
    lists, texts = batch.column("runs").to_pylist(), batch.column("text").to_pylist()
    n_words, n_removed, kept = [], [], []
    for text, runs in zip(texts, lists, strict=True):
        words = (text or "").encode().split()
        total = len(words)
        if runs:
            gone = np.zeros(total + 1, dtype=np.int64)
            for r in runs:
                gone[r["s"]] += 1
                gone[r["s"] + r["n"] + width - 1] -= 1
            stay = np.cumsum(gone[:total]) == 0
            words = [words[i] for i in np.flatnonzero(stay)]
        n_words.append(total)
        n_removed.append(total - len(words))
        left = b" ".join(words)
        kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
    arrays = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept"])


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, the id `d` that orders and the row key `g`."""
    d = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    g = F.xxhash64(d, F.coalesce("text", F.lit("")))
    return id_and_text(df, id_col, text_col).select("doc_id", "text", d.alias("d"), g.alias("g"))


def repeated_runs(base: DataFrame, width: int, grain: int) -> DataFrame:
    """(g, runs): where the later windows of each key's text start; `d` tells keys that are equal by chance apart."""
    kmers = map_arrow(base.select("g", "text"), lambda b: find(b, width, grain), "h long, g long, weight byte")
    counts = kmers.groupBy("h").agg(F.sum("weight").alias("c")).where("c > 1")
    salts = F.ceil(F.col("c") / BUCKET_ROWS).cast("int").alias("salts")
    wanted = kmers.select("h", "g").join(counts, "h").select("g", F.struct("h", salts).alias("kmer"))
    # A text's list is as long as the text at most.
    lists = wanted.groupBy("g").agg(F.collect_set("kmer").alias("wanted"))
    # Both joins with the texts keep the same columns, so that the texts are shuffled once.
    joined = base.join(lists, "g").select(*base.columns, "wanted")
    packs = map_arrow(joined, lambda b: pack(b, width, grain), "h long, salts int, d long, g long, s int, packed string")
    packs = packs.withColumn("salt", F.pmod(F.xxhash64("g", "s"), F.col("salts")).cast("int"))
    keys = ["h", "salt"]
    found = sort_buckets(packs.repartition(*keys).sortWithinPartitions(*keys), width)
    # Parts of a salted bucket: at most one row for each part has a given window.
    place = F.struct("d", "s")
    first = F.min(place).over(Window.partitionBy("part", "w"))
    parts = found.withColumn("part", F.when(F.col("w").isNull(), F.xxhash64("d", "g", "s")))
    later = parts.select("d", "g", "s", "n", "w", (place > first).alias("later")).where("w IS NULL OR later")
    return later.groupBy("g").agg(F.collect_set(F.struct("d", "s", "n")).alias("runs"))


def remove_repeats(
    df: DataFrame, width: int = 20, grain: int = 4, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """One row per input row: n_words, n_removed, and the kept words joined by one space.

    With `digest` the kept words are given as their SHA-256 (`kept_sha256`).
    """
    base = keyed(df, id_col, text_col)
    runs = repeated_runs(base, width, grain)
    last = "kept_sha256" if digest else "kept"
    mine = F.transform(F.filter("runs", lambda r: r["d"] == F.col("d")), lambda r: F.struct(r["s"].alias("s"), r["n"].alias("n")))
    joined = base.join(runs, "g", "left").select(*base.columns, mine.alias("runs"))
    return map_arrow(joined, lambda b: cut(b, width, digest), f"doc_id long, n_words long, n_removed long, {last} string")
