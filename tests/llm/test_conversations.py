import hashlib
import itertools
import re
import zlib
from functools import cache

import numpy as np
import pytest

from pitlane.llm import conversations
from pitlane.llm.conversations import MOVES, NONE, Survivors, damage, decode, repair, report, report_of_damaged, steps

COLUMNS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"
WELL_FORMED = re.compile(r"(s?(ua)+)?")


def plain_faults(rows):
    """(fault, forced to go) of each (turn, role, text) in order."""
    out, seen = [], set()
    for _, role, text in rows:
        if not text.strip(BLANKS):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if text.rstrip(BLANKS)[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired rows): backwards, so that the least string is found letter by letter."""
    faults = plain_faults(rows)

    @cache
    def best(i, kept, inserts=2):
        """From row i on; of the roles so far only the last initial matters: '', 's', 'u' or 'a'."""
        found = [(10**9, "~", ())]

        def option(cost, letter, new, *rest):
            after = best(*rest)
            found.append((cost + after[0], letter + after[1], new + after[2]))

        if i == len(rows) and kept in ("", "a"):
            found.append((0, "", ()))
        if inserts:
            for new in ("user", "assistant"):
                if kept + new[0] in ("u", "su", "ua", "au"):
                    option(3, "I", ((new, ""),), i, new[0], inserts - 1)
        if i < len(rows):
            _, role, text = rows[i]
            option(4, "D", (), i + 1, kept)
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                for letter, new, cost in [("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)]:
                    if new and kept + new[0] in ("s", "u", "su", "ua", "au"):
                        option(cost + extra, letter, ((new, text),), i + 1, new[:1])
        return min(found)

    for i in range(len(rows), 0, -1):  # from the back, so that recursion stays shallow
        for kept in ("", "s", "u", "a"):
            best(i, kept)
    return best(0, "")


def enumerated(rows):
    """The same by trying everything, for a few rows."""
    faults = plain_faults(rows)
    inserts = [("", ()), ("I", ("user",)), ("I", ("assistant",)), ("II", ("user", "assistant")), ("II", ("assistant", "user"))]
    per_row = []
    for (_, role, text), fault in zip(rows, faults):
        extra = 3 * (fault == "truncated")
        choices = [(4, "D", ())]
        if fault not in ("blank", "duplicate"):
            choices += [(extra, "K", ((role, text),)), (3 + extra, "R", (("user", text),)), (3 + extra, "R", (("assistant", text),))]
        per_row.append(choices)
    found = []
    for picks in itertools.product(*per_row):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            made, audit, cost = [], "", 0
            for gap, pick in itertools.zip_longest(gaps, picks):
                audit += gap[0] + (pick[1] if pick else "")
                cost += 3 * len(gap[0]) + (pick[0] if pick else 0)
                made += [(r, "") for r in gap[1]] + list(pick[2] if pick else ())
            if WELL_FORMED.fullmatch("".join(r[:1] or "-" for r, _ in made)):
                found.append((cost, audit, tuple(made)))
    return min(found)


def order(row):
    return (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())


def plain_report(rows):
    """{conversation: columns} of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=order)
        faults = plain_faults(own)
        cost, audit, made = plain_repair(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def conversation(rng, n, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["fine.", "yes!", "cut off", "", " \t", "why? ", None, "ok.\n"] + [f"text {i}." for i in range(30)]
    return [
        (int(t) if rng.random() > 0.05 else None, roles[rng.choice(len(roles), p=weights(len(roles)))], texts[rng.integers(len(texts))])
        for t in rng.integers(0, 2 * n, n)
    ]


def weights(n):
    w = np.array([8, 8] + [1] * (n - 2), dtype=float)[:n]
    return w / w.sum()


def table(seed, convs, longest):
    rng = np.random.default_rng(seed)
    return [(c, *r) for c in [*range(convs), None] for r in conversation(rng, int(rng.integers(1, longest)))]


def test_plain_repair_is_the_best_of_all():
    rng = np.random.default_rng(1)
    for _ in range(25):
        rows = sorted(((t, r or " ", x or " ") for t, r, x in conversation(rng, int(rng.integers(1, 4)))), key=order)
        assert plain_repair(rows) == enumerated(rows)
    assert plain_repair([]) == (0, "", ())


@pytest.mark.parametrize("piece", [200_000, 300, 1])
def test_report_equals_plain(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE_BYTES", piece)
    rows = table(2, 60, 25)
    rows += [(500, i, "user" if i % 2 else "tool", f"t{i}.") for i in range(150)]  # long ties
    rows += [(501, i, "x", f"t{i}.") for i in range(101)] + [(502, 7, "user", "same.")] * 50 + [(503, None, "user", "")] * 9
    rows += [(504, i, ("user", "user", "assistant", "assistant")[i % 4], f"t{i}") for i in range(90)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert made(report(df)) == plain_report(rows)


def test_hot_conversation_and_many_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(conversations, "PIECE_BYTES", 400)
    monkeypatch.setattr(conversations, "few", lambda df: df)
    rows = table(3, 10, 20) + [(77, *r) for r in conversation(np.random.default_rng(4), 400)]
    with hot(30):
        assert made(report(spark.createDataFrame(rows, COLUMNS))) == plain_report(rows)


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if draw:
            x = "" if draw == 1 else re.sub("[.!?]", "", x) if draw == 2 else x
            out += [(c, t, "user" if draw == 4 else r, x)] * (2 if draw == 3 else 1)
    return out


def test_damage_and_lost_conversations(spark):
    rows = table(5, 80, 12) + [(c, 0, "user", "one.") for c in range(1000, 1060)]
    df = spark.createDataFrame(rows, COLUMNS)
    left = plain_damage(rows)
    assert sorted(map(tuple, damage(df).collect()), key=repr) == sorted(left, key=repr)
    want = plain_report(left)
    lost = {r[0] for r in rows} - set(want)
    assert lost
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert made(report_of_damaged(df)) == {**want, **{c: nothing for c in lost}}


def test_repaired_rows(spark, monkeypatch):
    rows = table(6, 30, 20)
    for piece in (200_000, 200):
        monkeypatch.setattr(conversations, "PIECE_BYTES", piece)
        found = repair(spark.createDataFrame(rows, COLUMNS)).collect()
        for conv in {r[0] for r in rows}:
            own = sorted(((t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=order)
            got = [(r.role, r.text) for r in sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.piece, r["at"]))]
            assert got == list(plain_repair(own)[2])
            assert WELL_FORMED.fullmatch("".join(r[:1] for r, _ in got))


def test_memory_stays_small_where_paths_meet():
    """A tree over 20,000 rows never holds more than a few nodes; the edits come out on the way."""
    rng = np.random.default_rng(7)
    paths, most, out = Survivors([NONE]), 0, 0
    kinds = [(("u", "a")[i % 2], bool(rng.random() < 0.1)) if rng.random() < 0.9 else ("d", False) for i in range(20_000)]
    for kind in kinds:
        paths.advance(steps(kind))
        out += len(list(paths.settled()))
        nodes, todo = 0, [paths.root]
        while todo:
            nodes, todo = nodes + 1, todo[:-1] + todo[-1].children
        most = max(most, nodes)
    assert most < 400 and out > 19_000
    assert "".join(decode(kinds, NONE, None)).replace("I", "").count("") == 20_001


def test_forced_rows_are_only_deleted():
    assert {letters.strip("I") for _, _, _, letters in MOVES["d", True]} == {"D"}


def test_empty_long_and_other_columns(spark):
    assert report(spark.createDataFrame([], COLUMNS)).count() == 0
    assert report_of_damaged(spark.createDataFrame([], COLUMNS)).count() == 0
    rows = [(1, 0, "user", "x" * 500_000 + "."), (1, 1, "assistant", "y " * 300_000), (1, 2, "user", "z" * 250_000)]
    df = spark.createDataFrame([(*r, 5, "p") for r in rows], COLUMNS + ", piece int, audit string")
    assert made(report(df)) == plain_report(rows)
