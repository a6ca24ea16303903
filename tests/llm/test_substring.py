import hashlib
import re

import numpy as np
import pytest

from pitlane.llm import substring
from pitlane.llm.substring import remove_repeats, sliding_least

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = np.random.default_rng(2)
VOCABULARY = [f"v{i}" for i in range(300)] + ["É", "Ab", "ab"]


def naive(rows, width):
    seen = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    key = lambda i: -(2**63) if i is None else i
    for i, words in split:
        for s in range(len(words) - width + 1):
            w = tuple(words[s : s + width])
            seen[w] = min(seen.get(w, (key(i), s)), (key(i), s))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - width + 1):
            if seen[tuple(words[s : s + width])] < (key(i), s):
                gone.update(range(s, s + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    passage = list(rng.choice(VOCABULARY, 55))
    rows = []
    for i in range(60):
        words = list(rng.choice(VOCABULARY, rng.integers(0, 150)))
        if i % 2:
            at = rng.integers(0, len(words) + 1)
            words[at:at] = passage[rng.integers(0, 20) :]
        rows.append((200 - i, " ".join(words)))
    rows += [(i, rows[3][1]) for i in (1, 7, 500)]
    rows += [(3, "la " * 130), (11, "x y z u v " * 5), (12, "q r s t w " * 9), (4, None), (5, ""), (6, " \t\n"), (8, "\n".join(passage) + " " + " ".join(passage))]
    rows += [(None, rows[5][1]), (9, rows[9][1]), (9, rows[9][1]), (9, rows[11][1])]
    return rows


@pytest.mark.parametrize("bucket", [4000, 3])
@pytest.mark.parametrize("width,grain", [(20, 4), (5, 2)])
def test_equal_to_brute_force(spark, monkeypatch, bucket, width, grain):
    monkeypatch.setattr(substring, "BUCKET_ROWS", bucket)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string").repartition(5)
    out = remove_repeats(df, width, grain, digest=True).collect()
    assert sorted(map(tuple, out), key=str) == naive(rows, width)


@pytest.mark.parametrize("bucket", [4000, 3])
def test_rows_without_own_id(spark, monkeypatch, bucket):
    monkeypatch.setattr(substring, "BUCKET_ROWS", bucket)
    passages = [" ".join(rng.choice(VOCABULARY, 40)) for _ in range(10)]
    rows = [(None if i % 3 else 7, f"{passages[i % 10]} own{i} {passages[(i + 3) % 10]}") for i in range(150)]
    rows += [(50 + i, p) for i, p in enumerate(passages)] + [(None, rows[1][1])] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = remove_repeats(df, digest=True).collect()
    assert sorted(map(tuple, out), key=str) == naive(rows, 20)
    # What is gathered for a row is bounded by its own text (81 words), not by all that share its id.
    runs = substring.repeated_runs(substring.keyed(df, "doc_id", "text"), 20, 4)
    assert max(len(r.runs) for r in runs.collect()) <= 81


def test_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d x"), (2, "q a b c")], "doc_id long, text string")
    out = {r.doc_id: r.kept for r in remove_repeats(df, 3, 2).collect()}
    assert out == {1: "a b c d x", 2: "q"}
    assert remove_repeats(df.limit(0)).count() == 0


def test_sliding_least():
    values = rng.integers(0, 100, 40)
    for width in (1, 2, 3, 7, 17):
        least, place = sliding_least(values, width)
        assert least.tolist() == [min(values[i : i + width]) for i in range(40 - width + 1)]
        assert place.tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(40 - width + 1)]
