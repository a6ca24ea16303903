"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and 0x09-0x0D.  Hashes have 64 bits:
a polynomial over random byte values, mixed afterwards.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from pitlane.llm.common import per_process

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables() -> dict[str, np.ndarray]:
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    value = mix(np.arange(1, 257, dtype=np.uint64) * BASE) | np.uint64(1)
    lower = value.copy()
    lower[65:91] = value[97:123]
    return {"space": space, "value": value, "lower": lower}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of BASE and of its inverse, at least `n` of them."""
    home = per_process("powers", dict)
    if "up" not in home or len(home["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            home[name] = np.cumprod(steps)
    return home["up"], home["down"]


class Words:
    """Words of the texts of one Arrow column, as positions in its bytes.

    `bounds` holds where each text's words begin in `start`, `end` and `hash`
    (one more entry than texts); null texts have none.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        texts = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        tables = per_process("word_tables", _tables)
        n = len(self.bytes)
        word = ~tables["space"][self.bytes]
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        before = np.zeros(n + 1, dtype=bool)
        before[1:] = word
        before &= ~cut
        after = np.zeros(n + 1, dtype=bool)
        after[:-1] = word
        after &= ~cut
        self.start = np.flatnonzero(word & ~before[:n])
        self.end = np.flatnonzero(word & ~after[1:]) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)
        self._values = tables["lower" if lower else "value"]
        self._hash: np.ndarray | None = None
        self._total: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self._hashes(self.end)
        return self._hash

    def stems(self, n: int) -> np.ndarray:
        """Hashes of each word's first `n` bytes."""
        return self._hashes(np.minimum(self.end, self.start + n))

    def _hashes(self, ends: np.ndarray) -> np.ndarray:
        n = len(self.bytes)
        up, down = _powers(n)
        if self._total is None:
            self._total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self._values[self.bytes] * up[:n], out=self._total[1:])
        return mix((self._total[ends] - self._total[self.start]) * down[self.start])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.bytes[self.start[i] : self.end[i]].tobytes()


def grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `n` consecutive words and the bounds of each text's grams.

    A text of fewer words has none.
    """
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(counts)))
    size = len(hashes) - n + 1
    total = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        total = total * BASE + hashes[i : i + size]
    inside = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(inside, bounds[:-1][counts > 0], 1)
    np.add.at(inside, (bounds[:-1] + counts)[counts > 0], -1)
    keep = np.cumsum(inside)[:size] > 0
    return mix(total[keep]), np.concatenate(([0], np.cumsum(counts)))
