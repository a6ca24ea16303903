import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from pitlane.llm import mixing
from pitlane.llm.mixing import count_words, emit, mix, targets

rng = np.random.default_rng(12)
COLUMNS = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, cut at the cap, share what is left over again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        level = (left - sum(cap * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if level * weight[s] > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in names}
        full |= above


def plain(rows):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, _, t in rows]
    total = Counter()
    for (_, s, _), n in zip(rows, sizes):
        total[s] += n
    aim, seen, out = plain_targets(total), Counter(), []
    for (i, s, t), n in zip(rows, sizes):
        marks = ["12", "n" if i is None else f"v{i}", hashlib.md5((t or "").encode()).hexdigest(), "n" if s is None else f"v{s}"]
        key = hashlib.md5("|".join(marks).encode()).hexdigest()
        seen[key] += 1
        coin = int(hashlib.md5(f"{key}|{seen[key]}".encode()).hexdigest()[:13], 16) / 2**52
        rate = aim[s] / total[s] if total[s] else 0
        out.append((i, n, total[s], round(aim[s], 6), (int(rate) + (coin < rate % 1)) * n))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def made(df):
    return order([(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mix(df).collect()])


def words(n):
    return " ".join(f"w{x}" for x in rng.integers(0, 50, n))


ROWS = [(i, f"s{rng.integers(0, 7)}", words(int(rng.integers(0, 40)))) for i in range(300)]
ROWS += [(1000 + i, "hot", words(30)) for i in range(200)] + [(2000, "tiny", "one"), (2001, "none", None), (2002, "none", " \t\x0b ")]
ROWS += [(None, None, words(5)) for _ in range(40)] + [(7, "s1", "same row twice")] * 60 + [(8, None, None), (9, "", "x"), (9, "", "y")]
ROWS += [(3000, "long", "ab\r\n" * 100_000), (3001, "\U00010000", "a b c"), (3002, "￿", "a b c")]


def test_equal_to_plain(spark):
    df = spark.createDataFrame(ROWS, COLUMNS).repartition(5)
    assert made(df) == order(plain(ROWS))
    assert made(df.repartition(2)) == made(df)


def test_hot_groups_and_many_sources(spark, hot, monkeypatch):
    monkeypatch.setattr(mixing, "few", lambda df: df)  # as if there were too many to broadcast
    monkeypatch.setattr(mixing, "SHARE", 0.1)
    with hot(9):
        assert made(spark.createDataFrame(ROWS, COLUMNS).repartition(5)) == order(plain(ROWS))


@pytest.mark.parametrize("weights, cap", [((5, 2, 1), 3), ((1,), 1), ((1, 100), 2)])
def test_targets(spark, weights, cap):
    for _ in range(4):
        sizes = {f"s{i}": int(rng.integers(0, 10 ** rng.integers(1, 6))) for i in range(rng.integers(1, 30))}
        rows = [(s, n, 1) for s, n in sizes.items()]
        found = targets(spark.createDataFrame(rows, "_mix_source string, source_size long, rows long"), weights, cap).collect()
        want = plain_targets(sizes, weights, cap)
        assert {r["_mix_source"]: r.target for r in found} == pytest.approx(want)
        assert sum(r.target for r in found) == pytest.approx(sum(sizes.values()))


def test_sources_come_near_their_targets(spark):
    rows = [(i, f"s{i % 4}", words(int(rng.integers(5, 15)))) for i in range(8000)]
    found = mix(spark.createDataFrame(rows, COLUMNS)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in found:
        assert r["sum(taken)"] == pytest.approx(r["max(target)"], rel=0.04)


def test_emitted_rows(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    mixed = mix(df)
    out = emit(mixed)
    assert out.columns == ["doc_id", "source", "text"]
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, r.source, r.text] += r.copies
    assert Counter(map(tuple, out.collect())) == +want


def test_empty_and_clashing_columns(spark):
    assert mix(spark.createDataFrame([], COLUMNS)).count() == 0
    blank = mix(spark.createDataFrame([(1, "a", None), (2, None, "")], COLUMNS)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
    odd = spark.createDataFrame([(1, "a", "x y", 5, 6, "k", 8)], COLUMNS + ", Size int, rows int, `a.b` string, taken int")
    out = mix(odd)
    assert out.columns == ["doc_id", "source", "text", "rows", "a.b", "size", "source_size", "target", "copies", "taken"]
    assert out.first().rows == 6 and out.first()["a.b"] == "k" and out.first().size == 2


def test_main_path_is_native(spark):
    plan = mix(spark.createDataFrame(ROWS[:50], COLUMNS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and count_words(spark.createDataFrame(ROWS[:5], COLUMNS)).count() == 5
