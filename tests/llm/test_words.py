import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm.words import Words, grams

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\raAbBé  ", max_size=30)), max_size=6))
def test_words_and_grams(texts):
    column = pa.array(["zz z", *texts], pa.string()).slice(1)
    w = Words(column)
    low = Words(column, lower=True)
    want = [WORD.findall(t or "") for t in texts]
    got = [[w.word(i).decode() for i in range(a, b)] for a, b in zip(w.bounds, w.bounds[1:])]
    assert got == want
    flat = [x for ws in want for x in ws]
    assert len({x: h for x, h in zip(flat, w.hash)}) == len(set(flat)) == len(set(w.hash.tolist()))
    lowered = ["".join(c.lower() if c in "ABZ" else c for c in x) for x in flat]
    assert len(set(low.hash.tolist())) == len(set(lowered))
    hashes, bounds = grams(w.hash, w.bounds, 2)
    pairs = [list(zip(ws, ws[1:])) for ws in want]
    assert np.diff(bounds).tolist() == [len(p) for p in pairs]
    assert len(set(hashes.tolist())) == len({p for ps in pairs for p in ps}) and len(hashes) == sum(map(len, pairs))
