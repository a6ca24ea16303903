import hashlib
import itertools
import re

import numpy as np
import pytest

from pitlane.llm import pii
from pitlane.llm.tagger import CLASSES, Tagger

rng = np.random.default_rng(8)


def card():
    digits = "4" + "".join(rng.choice(list("0123456789"), 14))
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def sentence():
    words = ["the", "of", "Then,", "été", "house.", "12", "v2.0", "AKIA12", "x=3", "1999"]
    items = [lambda: f"{rng.choice(['ab', 'c.d', 'ef_g'])}.{rng.integers(99)}@mail{rng.integers(9)}.example.com",
             lambda: ".".join(str(x) for x in rng.integers(1, 255, 4)), card,
             lambda: f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"]
    out = list(rng.choice(words, rng.integers(3, 12)))
    for _ in range(rng.integers(0, 3)):
        out.insert(rng.integers(0, len(out) + 1), items[rng.integers(4)]())
    return " ".join(out)


def naive(text):
    found = []
    found += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [c for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and pii.luhn("".join(d)):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


ODD = [
    "", "@", "a@b", "a@b.c@d.e", "x@@y.zz", "..@a-.b-.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.01", "+1234567 +12 (34)-56.78+99",
    "4" * 40, "1 2-3 " * 9, "é+1 (606) 555-7814é", "a" * 3000 + "@" + "b" * 3000 + ".c", "7" * 5000 + ".1.1",
]


def test_base_spans_match_a_plain_scan():
    for text in ODD + [sentence() for _ in range(300)] + ["".join(rng.choice(list("a1@.+-( 9)"), 40)) for _ in range(2000)]:
        assert pii.base_spans(text) == naive(text), text


def test_gradients():
    tagger = Tagger(labels=3, hidden=4, seed=1).start()
    x, y = rng.integers(1, CLASSES, (3, 7)), rng.integers(0, 3, (3, 7))
    mask = np.ones((3, 7))
    mask[1, 5:] = mask[2, 2:] = 0
    _, grads = tagger.loss_and_gradients(x, y, mask)
    for name, w in tagger.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if name == "x":
                at = (at[0], x[0, 0], at[2])
            old, sides = w[at], []
            for e in (1e-5, -1e-5):
                w[at] = old + e
                sides.append(tagger.loss_and_gradients(x, y, mask)[0])
            w[at] = old
            assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6), name


def test_windows_cover_every_trigger_and_overlap():
    text = "word " * 40 + "1" * 500 + " word" * 30 + " @ " + "x" * 10
    windows = pii.windows_of(text).tolist()
    inside = {p for a, b in windows for p in range(a, b)}
    assert all(m.start() in inside for m in re.finditer("[0-9@]", text)) and all(b - a <= pii.LENGTH for a, b in windows)
    joined = [b0 - a1 for (_, b0), (a1, _) in zip(windows, windows[1:])]
    assert all(n == pii.OVERLAP or n <= 0 for n in joined)


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(i, sentence()) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df, pii.train(df, per_kind=500)


def test_held_out_spans_are_read(learned):
    _, model = learned
    texts = [sentence() for _ in range(200)]
    seen = pii.seen_spans(texts, model)
    want = [set(pii.base_spans(t)) for t in texts]
    hit = sum(len(w & set(s)) for w, s in zip(want, seen))
    assert hit / sum(map(len, want)) > 0.9 and hit / sum(map(len, seen)) > 0.9


def test_kinds_without_a_pattern_are_read(learned):
    _, model = learned
    carriers = [" ".join(rng.choice(["the", "Then,", "été", "house.", "12", "v2.0", "1999", "of", "a"], 9)) for _ in range(60)]
    windows = pii.planted(carriers, 400, seed=77)
    seen = pii.seen_spans([t for t, _ in windows], model)
    right = wanted = given = 0
    for (text, marks), spans in zip(windows, seen):
        want = {s for s in pii.joined_spans({p: (0, m) for p, m in enumerate(marks)}) if s[0] in pii.LEARNED}
        got = {(k[5:], s, e) for k, s, e in pii.added(text, pii.base_spans(text), spans) if k[5:] in pii.LEARNED}
        free = {w for w in want if not any(a < w[2] and w[1] < b for _, a, b in pii.base_spans(text))}
        right, wanted, given = right + len(free & got), wanted + len(free), given + len(got)
    assert wanted > 250 and right / wanted > 0.9 and right / given > 0.9, (right, wanted, given)


def test_no_added_span_cuts_a_run():
    text = "id 9870157079875996 and AB12 3456"
    assert pii.added(text, [], [("card", 3, 17), ("card", 5, 19)]) == []
    assert pii.added(text, [], [("card", 3, 19), ("iban", 24, 33)]) == [("seen_card", 3, 19), ("seen_iban", 24, 33)]
    assert pii.added(text, [("card", 3, 19)], [("card", 3, 19)]) == []


def test_viterbi_equals_enumeration():
    tagger = Tagger(labels=3, hidden=3, seed=5).start()
    x, mask = rng.integers(1, CLASSES, (4, 6)), np.ones((4, 6))
    mask[1, 4:] = 0
    emit, _ = tagger.run(x, mask)
    for row, found in enumerate(tagger.decode(x, mask)):
        n = int(mask[row].sum())
        ways = itertools.product(range(3), repeat=n)
        best = max(ways, key=lambda y: sum(emit[row, i, y[i]] for i in range(n)) + sum(tagger.weights["move"][a, b] for a, b in zip(y, y[1:])))
        assert tuple(found[:n]) == best


def test_rows(spark, learned):
    df, model = learned
    more = spark.createDataFrame([(None, None), (5000, ""), (5001, ODD[10]), (0, df.first().text)], df.schema)
    both = df.unionByName(more).selectExpr("*", "'x' AS spans")
    out = pii.scan(both, model).collect()
    assert len(out) == 904
    texts = {r.doc_id: r.text for r in df.union(more).collect()}
    for r in out:
        base = pii.base_spans(texts[r.doc_id] or "")
        form = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(form.encode()).hexdigest() and r.spans.startswith(form)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in pii.KINDS)
    assert pii.scan(df.limit(0), model).count() == 0
    assert pii.train(df.limit(0)) is None
    assert pii.scan(df, None).count() == 900
