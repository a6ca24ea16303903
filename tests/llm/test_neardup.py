import re

import numpy as np
import pytest

from pitlane.llm.neardup import near_duplicates, shingle_sets, sketches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = np.random.default_rng(11)
VOCABULARY = [f"w{i}" for i in range(400)] + ["É", "Ab"]


def naive(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
        grams = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)}
        sets[i] = grams if len(words) >= width else {tuple(words)} if words else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    texts = [None, "", " \t ", "one", "ONE", "one two", "Two one"]
    template = list(rng.choice(VOCABULARY, 60))
    for _ in range(12):
        base = list(rng.choice(VOCABULARY, rng.integers(8, 120)))
        chain = list(base)
        for _ in range(6):  # a chain that drifts away from its start
            texts.append(" ".join(chain))
            for _ in range(max(1, len(chain) // 40)):
                chain[rng.integers(len(chain))] = rng.choice(VOCABULARY)
        texts += [" ".join(base), "\n".join(base).upper()]
        # half template, half own: alike but not linked
        texts.append(" ".join(template + list(rng.choice(VOCABULARY, 40))))
        # at the threshold
        own = list(rng.choice(VOCABULARY, 14))
        texts.append(" ".join(template + own))
        texts.append(" ".join(template + own[:7] + list(rng.choice(VOCABULARY, 7))))
    return list(enumerate(texts))


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    out = near_duplicates(df, width, 80).collect()
    assert {tuple(r) for r in out} == naive(rows, width, 80) and len(out) == len(rows)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (7, "a b c"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(map(tuple, near_duplicates(df, 2).collect()), key=str)
    assert out == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (7, 2, 4, False), (9, 0, 9, True)], key=str)
    assert near_duplicates(df.limit(0), 2).count() == 0


def test_sketch_estimates_similarity():
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    other = np.concatenate((base[:800], rng.integers(0, 2**63, 200).astype(np.uint64)))
    tiny = base[:3]
    made = sketches([np.unique(base), np.unique(other), np.unique(tiny), np.unique(tiny), np.zeros(0, np.uint64)])
    assert abs((made[0] == made[1]).mean() - 800 / 1200) < 0.1
    assert (made[2] == made[3]).all() and not made[4].any()


def test_short_sequences_are_sets_of_one():
    import pyarrow as pa

    a, b, c = shingle_sets(pa.array(["x y z", "x y z ", "x y"]), 5)
    assert a.tolist() == b.tolist() != c.tolist() and len(a) == len(c) == 1
