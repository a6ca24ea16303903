"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK embedding reads a sequence by a random walk: at each step it writes the current
character and moves on or stays, by a random bit of (step, character).  Sequences that
differ by few edits write nearly the same output, so edit distance becomes Hamming
distance.  An LSH key is a sample of the output; repeated walks raise the recall.

Windows have the item's size and begin at every word of every text.  A walk over a whole
window would meet an edit in almost every item, so a window is read by many walks, one
from each of its words; a walk from a word is the same for all windows that hold it.
How many samples make a key follows from the item's own words and length: as many as let
at least one of its walks pass untouched with the wanted chance if `edits` of its
characters were changed at random (`samples_for`).  A walk goes on only while what it
wrote so far begins some item's key, which gives the same matches as comparing whole keys.

Each candidate window, with slack to both sides, is verified.  It must hold as many of the
item's pieces of three characters, repeats counted, as `edits` leave in any case; then the
least edit distance, in characters, between the item and any part of it must be at most
`edits` times the item's length.  Both are compared with A-Z lower-cased and words joined by one space.

Items are read in blocks of at most `BLOCK_CHARS` characters (or one longer item), each
broadcast; every block meets all texts.

Defined cases: null and empty texts hold no items; items with a null id or without words
are left out; a null id of a text is carried through; repeated rows give repeated
results; other columns are ignored by `find_items` and kept by `keep_clean`.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import Shared, map_arrow
from pitlane.llm.words import BASE, Words, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WALKS = 4
# Numbers of samples a key may have; walks are checked there.
DEPTHS = (*range(1, 9), *range(10, 30, 2))
# Sampled steps among all, and the characters that a walk passes for each sample.
DENSITY, PASSED = 0.75, 0.67
# Depths at which walks are thinned out whatever the keys' lengths.
CHECKS = (8, 12)
STEPS = math.ceil(DEPTHS[-1] / DENSITY) + 1
EDITS, RECALL = 0.2, 0.9
BLOCK_CHARS = 2_000_000
SLOTS, PIECE_BITS = 1 << 20, 16
NONE = 1 << PIECE_BITS
UPPER = {i: i + 32 for i in range(65, 91)}
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def samples_for(words: int, size: int, edits: float, recall: float) -> int:
    """Samples of a key of an item with so many words and bytes.

    A walk meets if what it passes is untouched.  Walks from different words count as
    independent, the four from one word as two and a half.
    """
    best = DEPTHS[0]
    for depth in DEPTHS:
        once = (1 - edits) ** (depth * PASSED + 0.5)
        fits = depth * PASSED + 1 <= size
        if fits and (1 - once) ** (2.5 * words) <= 1 - recall:
            best = depth
    return best


def plan(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a walk: the move of each (step, byte), and whether a step is sampled."""
    rng = np.random.default_rng(1000 + number)
    moves = rng.integers(0, 2, (STEPS, 256))
    sampled = np.ones(STEPS, dtype=bool)
    sampled[1 + rng.choice(STEPS - 1, STEPS - DEPTHS[-1], replace=False)] = False
    return moves, sampled


def words_of(text: str) -> list[str]:
    """The words, A-Z lower-cased; split at ASCII white space only."""
    return [w.decode("utf-8", "surrogatepass") for w in text.translate(UPPER).encode("utf-8", "surrogatepass").split()]


class Flat:
    """Texts as bytes, A-Z lower-cased, each word followed by one space; words begin at `start`."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        sizes = words.end - words.start + 1
        ends = np.cumsum(sizes)
        self.start = ends - sizes
        source = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(self.start - words.start, sizes)
        # The place of the last word's space may lie behind the last byte.
        found = np.append(words.bytes, np.uint8(32))[source]
        found[(found >= 65) & (found <= 90)] += 32
        found[ends - 1] = 32
        self.bytes = np.concatenate((found, np.zeros(STEPS, np.uint8)))
        edges = np.concatenate(([0], ends))
        self.low, self.high = edges[words.bounds[:-1]], np.maximum(edges[words.bounds[1:]] - 1, edges[words.bounds[:-1]])
        self.words = words.counts
        self.text = words.text

    def pieces(self) -> np.ndarray:
        """The code of the three characters that begin at each byte, `NONE` inside of a character."""
        first = np.flatnonzero((self.bytes & 0xC0) != 0x80)
        code = self.bytes[first].astype(np.uint32)
        size = np.diff(first, append=len(self.bytes))
        wide = np.flatnonzero(size > 1)
        for k in range(1, 4):
            wide = wide[size[wide] > k]
            code[wide] = code[wide] * np.uint32(257) + self.bytes[first[wide] + k]
        three = (code[:-2] * np.uint32(0x85EBCA77) + code[1:-1]) * np.uint32(0xC2B2AE3D) + code[2:]
        out = np.full(len(self.bytes), NONE, np.uint32)
        out[first[:-2]] = three * np.uint32(0x9E3779B1) >> np.uint32(32 - PIECE_BITS)
        return out


def walks(flat: Flat, number: int, depths: list[int], keep: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Walk from all words at once; `keep(depth, keys)` gives the positions of those that go on.

    Yields (depth, words, keys) at each depth, before they are thinned out.  Walks end with their text.
    """
    moves, sampled = plan(number)
    word = np.arange(len(flat.start))
    at, key = flat.start.copy(), np.zeros(len(word), np.uint64)
    high = flat.high[flat.text]
    taken = 0
    for step in range(STEPS):
        if not len(at):
            return
        byte = np.take(flat.bytes, at)
        if sampled[step]:
            key = key * BASE + np.take(VALUES, byte)
            taken += 1
            if taken in depths:
                inside = np.flatnonzero(at < high)
                if len(inside) < len(at):
                    word, at, key, high, byte = word[inside], at[inside], key[inside], high[inside], byte[inside]
                mixed = mix(key)
                yield taken, word, mixed
                if taken == depths[-1]:
                    return
                go = keep(taken, mixed)
                word, at, key, high, byte = word[go], at[go], key[go], high[go], byte[go]
        at = at + np.take(moves[step], byte)


class Index:
    """Keys of a block of items."""

    def __init__(self, items: list[tuple[int, str]], edits: float, recall: float):
        self.edits = edits
        self.items = [(i, " ".join(words_of(t))) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        flat = Flat(pa.array([t.encode("utf-8", "surrogatepass").decode("utf-8", "replace") for _, t in self.items], pa.string()))
        self.sizes = flat.high - flat.low
        wanted = np.array([samples_for(w, n, edits, recall) for w, n in zip(flat.words.tolist(), self.sizes.tolist(), strict=True)], np.int64)
        self.most = np.array([math.floor(edits * len(t)) for _, t in self.items], np.int64)
        widths = [sorted((len(c.encode("utf-8", "replace")) for c in t), reverse=True) for _, t in self.items]
        # Pieces that the most edits can spoil, and bytes, widest characters first, by which they can shift the rest.
        self.spoilt = 3 * self.most
        self.slack = np.array([sum(ws[:k]) + 2 for ws, k in zip(widths, self.most.tolist(), strict=True)], np.int64)
        self.letters = [letters_of(t) for _, t in self.items]
        codes = flat.pieces()
        begun = [codes[a:b][codes[a:b] < NONE] for a, b in zip(flat.low.tolist(), flat.high.tolist(), strict=True)]
        self.codes = [c[: max(0, len(c) - 2)].astype(np.uint16) for c in begun]
        offset = flat.start - flat.low[flat.text]
        # For each walk and depth: beginnings of longer keys, and sorted keys with the item and place of each.
        self.tables: list[dict[int, tuple[np.ndarray, ...]]] = []
        self.depths: list[int] = []
        for number in range(WALKS):
            found = {d: (w, k) for d, w, k in walks(flat, number, list(DEPTHS), lambda _, k: np.arange(len(k)))}
            reach = np.zeros(len(self.items), np.int64)
            for d, (w, _) in found.items():
                np.maximum.at(reach, flat.text[w], d)
            # Items too short for their key have a shorter one.
            own = np.minimum(wanted, reach)
            self.depths = sorted({*self.depths, *own[own > 0].tolist(), *(d for d in CHECKS if d < own.max(initial=0))})
            table = {}
            for d, (w, k) in found.items():
                item = flat.text[w]
                ends, longer = own[item] == d, np.unique(k[own[item] > d])
                order = np.argsort(k[ends], kind="stable")
                table[d] = (longer, k[ends][order], item[ends][order].astype(np.int32), offset[w][ends][order].astype(np.int32))
            self.tables.append(table)
        none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
        self.tables = [{d: t.get(d, none) for d in self.depths} for t in self.tables]

    def candidates(self, flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and byte at which the item may begin, of every walk that meets a key."""
        out = []
        for number, table in enumerate(self.tables):
            ways = {d: in_set(t[0]) for d, t in table.items()}
            ends = {d: in_set(t[1]) for d, t in table.items()}
            for depth, word, key in walks(flat, number, self.depths, lambda d, k, ways=ways: ways[d](k)):
                _, known, item, offset = table[depth]
                hit = ends[depth](key)
                if not len(hit):
                    continue
                first, last = np.searchsorted(known, key[hit]), np.searchsorted(known, key[hit], "right")
                n = last - first
                which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
                word = np.repeat(word[hit], n)
                out.append((flat.text[word], item[which].astype(np.int64), flat.start[word] - offset[which]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def items_in(self, column: pa.Array) -> list[list[int]]:
        """The ids of the items in each text."""
        out: list[list[int]] = [[] for _ in range(len(column))]
        flat = Flat(column)
        if not self.items or not len(flat.start):
            return out
        text, item, place = self.candidates(flat)
        if not len(item):
            return out
        order = np.lexsort((place, text, item))
        item, text, place = item[order], text[order], place[order]
        # Places close to each other share one window.
        apart = (np.diff(item, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0) | (np.diff(place, prepend=0) > self.slack[item] // 4)
        first = np.flatnonzero(apart)
        final = np.append(first[1:], len(item)) - 1
        item, text, least, most = item[first], text[first], place[first], place[final]
        begin = np.maximum(least - self.slack[item], flat.low[text])
        end = np.minimum(most + self.sizes[item] + self.slack[item], flat.high[text])
        codes = flat.pieces()
        edges = np.flatnonzero(np.diff(item, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i = int(item[a])
            near = self.near(i, codes, begin[a:b], end[a:b])
            last = -1
            for t, x, y in zip(text[a:b][near].tolist(), begin[a:b][near].tolist(), end[a:b][near].tolist(), strict=True):
                if t == last:
                    continue
                span = flat.bytes[x:y].tobytes().decode("utf-8", "replace")
                if least_edits(self.items[i][1], span, int(self.most[i]), self.letters[i]) <= self.most[i]:
                    out[t].append(self.items[i][0])
                    last = t
        return [sorted(x) for x in out]

    def near(self, i: int, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which windows hold as many pieces of item `i`, repeats counted, as it has under the most edits."""
        least = len(self.codes[i]) - int(self.spoilt[i])
        if least <= 0:
            return np.arange(len(begin))
        own, times = np.unique(self.codes[i], return_counts=True)
        place = np.full(NONE + 1, len(own), np.int64)
        place[own] = np.arange(len(own))
        width = len(own) + 1
        good = []
        for low in range(0, len(begin), 256):
            a = begin[low : low + 256]
            n = np.maximum(end[low : low + 256] - a, 0)
            at = np.arange(n.sum()) + np.repeat(a - np.cumsum(n) + n, n)
            held = np.bincount(np.repeat(np.arange(len(a)) * width, n) + place[codes[at]], minlength=len(a) * width).reshape(len(a), width)
            good.append(low + np.flatnonzero(np.minimum(held[:, :-1], times).sum(1) >= least))
        return np.concatenate(good)


def in_set(known: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function that gives the positions of keys that are in the sorted `known`."""
    if not len(known):
        return lambda keys: np.zeros(0, np.int64)
    table = np.zeros(SLOTS, dtype=bool)
    table[(known & np.uint64(SLOTS - 1)).astype(np.int64)] = True

    def find(keys: np.ndarray) -> np.ndarray:
        near = np.flatnonzero(np.take(table, (keys & np.uint64(SLOTS - 1)).astype(np.int64)))
        some = keys[near]
        return near[known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some]

    return find


def letters_of(pattern: str) -> dict[str, int]:
    """The places of each character, as bits."""
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    return dict(where)


def least_edits(pattern: str, text: str, enough: int = -1, letters: dict[str, int] | None = None) -> int:
    """The least edit distance between `pattern` and any part of `text`.

    Bit-parallel: one column of the distance table is one pair of integers.  Stops when a
    distance of at most `enough` is found, or the rest of `text` is too short to bring one.
    """
    m = len(pattern)
    if not m:
        return 0
    where = letters or letters_of(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    # The score sinks by one with each character at most.
    left = len(text)
    for c in text:
        if score - left > enough >= 0:
            break
        left -= 1
        eq = where.get(c, 0)
        x = eq | down
        across = (((eq & up) + up) ^ up) | eq
        more = down | (full & ~(across | up))
        less = up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best = score
                if best <= enough:
                    return best
        more, less = more << 1 & full, less << 1 & full
        up = less | (full & ~(x | more))
        down = more & x
    return best


def blocks_of(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Items by blocks of bounded size, in an order that depends on the items only."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // BLOCK_CHARS)
    for part in range(parts):
        yield sorted((r.id, r.text) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect())


def find_items(
    df: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, contaminated, n_items and the sorted ids of the items it holds."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = [Shared(df, Index(block, edits, recall)) for block in blocks_of(items, item_id, item_text)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        """One block after the other, so that a process holds one index."""
        found: list[set[int]] = [set() for _ in range(batch.num_rows)]
        for block in blocks:
            for own, more in zip(found, block.value.items_in(batch.column("text")), strict=True):
                own.update(more)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([sorted(x) for x in found], pa.list_(pa.int64()))], ["doc_id", "items"])

    rows = map_arrow(rows, run, "doc_id long, items array<long>")
    n = F.size("items").cast("long")
    return rows.select("doc_id", (n > 0).alias("contaminated"), n.alias("n_items"), "items")


def keep_clean(
    df: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL,
    text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of `df` that hold no item, with all their columns."""
    blocks = [Shared(df, Index(block, edits, recall)) for block in blocks_of(items, item_id, item_text)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        for block in blocks:  # what one block finds need not be searched for the next
            batch = batch.filter(pa.array([not x for x in block.value.items_in(batch.column(text_col))], pa.bool_()))
        return batch

    return map_arrow(df, run, df.schema, text_col)
