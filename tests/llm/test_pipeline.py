import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from pitlane.llm import toxicity
from pitlane.llm.bpe import load_ranks
from pitlane.llm.decontam import least_edits, words_of
from pitlane.llm.secrets import masked
from tests.llm.test_neardup import naive as components

rng = np.random.default_rng(12)
WORDS = [f"{a}{b}{c}" for a in "kmt" for b in "aeiou" for c in ("l", "rn", "st", "")]
BAD = ["idiot", "moron", "scum"]


def body(n):
    return [str(w) for w in rng.choice(WORDS, n)]


def corpus():
    items = [(i, " ".join(body(30))) for i in range(4)]
    docs, toxic = [], {}
    for i in range(240):
        words = body(rng.integers(30, 90))
        if i % 6 == 0:
            for bad in rng.choice(BAD, 3):
                words.insert(int(rng.integers(0, len(words))), str(bad))
        if i % 10 == 3:
            words[5:5] = items[i % 4][1].split()
        if i % 7 == 2:
            words[3:3] = ["password=hunter2000x"]
        docs.append((i, " ".join(words)))
        toxic[i] = i % 6 == 0
    for k, i in enumerate(range(1, 60, 4)):
        near = docs[i][1].split()
        near[-1] = "changed"
        docs.append((300 + k, " ".join(near) if k % 2 else docs[i][1]))
        toxic[300 + k] = toxic[i]
    docs += [(400, None), (401, ""), (None, "one two three four five six"), (2, docs[2][1])]
    return docs, toxic, items


CORPUS = corpus()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs, toxic, items = CORPUS
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(x)) for i, x in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_equal_to_a_plain_version(spark, folder):
    docs, toxic, items = CORPUS
    # The learned stage is checked by its accuracy; the others follow exactly.
    frame, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rejected = {r.doc_id: r.predicted == 1 for r in toxicity.score(frame, toxicity.train(frame, labels)).collect()}
    assert np.mean([rejected[i] == x for i, x in toxic.items()]) > 0.97
    left = [d for d in docs if not rejected[d[0]]]
    kept = {i for i, _, _, k in components([d for d in left if d[0] is not None], 5, 80) if k}
    left = list(dict.fromkeys(d for d in left if d[0] is None or d[0] in kept))
    flat = {i: " ".join(words_of(t)) for i, t in items}
    left = [(i, t) for i, t in left if not any(least_edits(p, " ".join(words_of(t or ""))) <= 0.2 * len(p) for p in flat.values())]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for i, t in left:
        text = masked(t or "")
        ids = library.encode_ordinary(text)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode())]
        want.append((i, len(ids), *digests))
    got = list(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 100


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), folder).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_on_the_test_tables(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_a_repeated_id_keeps_its_other_text(spark, tmp_path):
    one, two, three = (" ".join(body(40)) for _ in range(3))
    rows = [(1, one, "k"), (5, one, "k"), (5, two, "k"), (5, None, "k"), (6, three, "k"), (6, three, "k"), (None, one, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set_key string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, one, "k"), (5, two, "k"), (5, None, "k"), (6, three, "k"), (None, one, "k")], key=repr)
