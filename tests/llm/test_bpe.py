import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm.bpe import Coder, encode, encode_digests, encode_texts, load_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def own():
    return Coder(PATH, public_tokenizers.PATTERN)


rng = np.random.default_rng(5)
LONG_WORDS = [
    "a" * 3001, "".join(rng.choice(list("abcdeé"), 900)), "".join(rng.choice(list("thean"), 2500)), "=-" * 700,
    "<|endoftext|>" * 60, "\n" * 700, " " * 900 + "x", "é" * 600,
]


def check(own, library, texts):
    for text, (n, raw, decoded) in zip(texts, encode_texts(own, texts), strict=True):
        want = library.encode_ordinary(text)
        assert np.frombuffer(raw, "<u4").tolist() == want and n == len(want)
        assert decoded == text.encode()


def test_long_words(own, library):
    check(own, library, LONG_WORDS + [" ".join(LONG_WORDS)])


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(max_size=40), max_size=5))
def test_any_text(own, library, texts):
    check(own, library, texts)


def test_queries(spark, library):
    rows = [(1, None, 0), (2, "", 0), (None, "Hello <|endoftext|> wörld  \n", 0), (3, "a b a", 1), (3, "a b a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    out = encode_digests(df, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    lists = encode(df, PATH, public_tokenizers.PATTERN).collect()
    assert {(r.doc_id, tuple(r.ids), r.decoded) for r in lists} == {
        (i, tuple(library.encode_ordinary(t or "")), t or "") for i, t, _ in rows
    }
    assert encode_digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
