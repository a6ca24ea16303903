import numpy as np
import pyarrow as pa
import pytest

from pitlane.llm import decontam
from pitlane.llm.decontam import Index, find_items, keep_clean, least_edits

rng = np.random.default_rng(6)
SYLLABLES = ["th", "er", "on", "ing", "ea", "ß", "que", "él", "an", "st"]


CAPITALS = {i: i - 32 for i in range(97, 123)}


def word():
    return "".join(rng.choice(SYLLABLES, rng.integers(1, 5)))


def passage(n):
    return [word() for _ in range(n)]


def naive_edits(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(words, share):
    out = list(words)
    for _ in range(int(share * len(words))):
        at = rng.integers(0, len(out))
        kind = rng.integers(3)
        if kind == 0:
            out[at] = word()
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, word())
    return out


ITEMS = [(i, passage(rng.integers(15, 60))) for i in range(30)] + [(90, passage(9)), (91, passage(14))]


def test_least_edits():
    for _ in range(300):
        a = "".join(rng.choice(list("abé "), rng.integers(0, 12)))
        b = "".join(rng.choice(list("abé "), rng.integers(0, 20)))
        assert least_edits(a, b) == naive_edits(a, b)


def planted(share):
    docs = []
    for i in range(120):
        body = passage(rng.integers(5, 120))
        wanted = []
        if i % 2:
            item, words = ITEMS[rng.integers(len(ITEMS))]
            at = rng.integers(0, len(body) + 1)
            body[at:at] = edited(words, share)
            wanted = [item]
        docs.append((i, "  ".join(body).translate(CAPITALS) if i % 3 == 0 else "\n".join(body), wanted))
    return docs


@pytest.mark.parametrize("share,recall", [(0.0, 1.0), (0.1, 0.95)])
def test_found_items_equal_brute_force(share, recall):
    index = Index([(i, " ".join(w)) for i, w in ITEMS], 0.2, 0.95)
    docs = planted(share)
    hits = total = 0
    for (_, text, _), found in zip(docs, index.items_in(pa.array([t for _, t, _ in docs])), strict=True):
        flat = " ".join(decontam.words_of(text))
        want = [i for i, w in ITEMS if least_edits(" ".join(decontam.words_of(" ".join(w))), flat) <= 0.2 * len(" ".join(w))]
        assert set(found) <= set(want)
        hits += len(set(found) & set(want))
        total += len(want)
    assert total >= 40 and hits >= recall * total


def retyped(text, share):
    """So many of the characters replaced, left out or put in."""
    out = list(text)
    for _ in range(int(share * len(out))):
        at = rng.integers(0, len(out))
        kind = rng.integers(3)
        if kind == 0:
            out[at] = rng.choice(list("abcdeén "))
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice(list("abcdeén ")))
    return "".join(out)


@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.19])
@pytest.mark.parametrize("words", [8, 15, 30, 60])
def test_character_edits_are_found(words, share):
    items = [(i, " ".join(passage(words))) for i in range(60)]
    index = Index(items, decontam.EDITS, decontam.RECALL)
    texts = [" ".join(passage(30)) + " " + retyped(t, share) + " " + " ".join(passage(30)) for _, t in items]
    hits = total = 0
    for (i, t), text, found in zip(items, texts, index.items_in(pa.array(texts)), strict=True):
        if least_edits(t, " ".join(decontam.words_of(text))) <= decontam.EDITS * len(t):
            hits += i in found
            total += 1
    assert total >= 50 and hits >= 0.9 * total


def test_one_long_text_and_short_items():
    body = passage(40_000)
    text = " ".join(body)
    items = [(0, " ".join(body[100:130])), (1, " ".join(body[-12:])), (2, " ".join(passage(30))), (3, body[5]), (4, "~")]
    assert Index(items, 0.2, 0.9).items_in(pa.array([text, None, "", "  "])) == [[0, 1, 3], [], [], []]
    assert Index([], 0.2, 0.9).items_in(pa.array([text])) == [[]]


def test_texts_that_meet_no_key():
    """Slices of a few unlike texts, as tables have at their ends."""
    index = Index([(i, " ".join(w)) for i, w in ITEMS], 0.2, 0.9)
    assert not len(index.candidates(decontam.Flat(pa.array(["0"])))[0])
    assert index.items_in(pa.array(["0", None, "", "0"])) == [[], [], [], []]


def test_rows_that_meet_no_key_stay(spark):
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS], "item_id long, text string")
    df = spark.createDataFrame([(1, "0"), (2, " ".join(ITEMS[3][1])), (3, None), (None, "0 0")], "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, keep_clean(df, items).collect()), key=str) == [(1, "0"), (3, None), (None, "0 0")]
    assert sorted(map(tuple, find_items(df, items).collect()), key=str) == [(1, False, 0, []), (2, True, 1, [3]), (3, False, 0, []), (None, False, 0, [])]


def test_the_filter_of_pieces_loses_nothing():
    items = [(i, " ".join(passage(rng.integers(3, 30)))) for i in range(150)]
    index = Index(items, 0.2, 0.9)
    for (i, t), share in zip(items, rng.choice([0.0, 0.1, 0.19], len(items))):
        text = retyped(t, share)
        if least_edits(t, " ".join(decontam.words_of(text))) <= 0.2 * len(t):
            flat = decontam.Flat(pa.array([text]))
            assert len(index.near(i, flat.pieces(), flat.low, flat.high)) == 1


def test_the_filter_of_pieces_counts_repeats():
    """Two of the item's pieces, and letters of other bytes, are not the item."""
    index = Index([(0, "ab" * 30), (1, "éçà" + "".join("ßüöäëï"[i * i % 6] for i in range(60)))], 0.2, 0.9)
    for i, text, many in ((0, "aba cdcd " * 9, 0), (0, "x " + "ab" * 30, 1), (1, "ãñéçà " * 12, 0), (1, index.items[1][1][5:], 1)):
        flat = decontam.Flat(pa.array([text]))
        assert len(index.near(i, flat.pieces(), flat.low, flat.high)) == many


def test_index_is_small():
    items = [(i, " ".join(passage(40))) for i in range(2000)]
    index = Index(items, 0.2, 0.9)
    size = sum(a.nbytes for t in index.tables for arrays in t.values() for a in arrays) + sum(c.nbytes for c in index.codes)
    assert size < 150 * sum(len(t) for _, t in items)


def test_rows_blocks_and_filter(spark, monkeypatch):
    docs = planted(0.0)
    rows = [(i, t, "x") for i, t, _ in docs] + [(None, None, "x"), (700, "", "x"), (1, docs[1][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, items string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS] + [(500, None), (501, " "), (None, "x")], "item_id long, text string")
    one = sorted(map(tuple, find_items(df, items).collect()), key=str)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, find_items(df, items).collect()), key=str) == one and len(one) == len(rows)
    for i, _, wanted in docs:
        got = [r for r in one if r[0] == i][0]
        assert set(wanted) <= set(got[3]) and got[1] == bool(got[3]) and got[2] == len(got[3])
    kept = keep_clean(df, items)
    assert kept.columns == df.columns and kept.count() == sum(not r[1] for r in one)
    assert find_items(df, items.limit(0)).where("contaminated").count() == 0
    assert find_items(df.limit(0), items).count() == 0
