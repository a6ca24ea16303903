import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitlane.llm.toxicity import feature_sets, fit, keep_clean, score, score_texts, train

rng = np.random.default_rng(3)
NEUTRAL = [f"word{i}" for i in range(60)]
BAD = ["idiot", "moron", "scum"]


def sentence(toxic):
    words = list(rng.choice(NEUTRAL, rng.integers(5, 60)))
    if toxic:
        for bad in rng.choice(BAD, 2):
            words.insert(rng.integers(0, len(words)), bad)
    return " ".join(words)


ROWS = [(i, sentence(i % 4 == 0), i % 4 == 0) for i in range(600)]


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in ROWS], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(x)) for i, _, x in ROWS], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy_and_cases(spark, tables):
    docs, labels = tables
    more = spark.createDataFrame([(None, None, "x"), (9001, "", "x"), (9002, "IDIOT scum", "x"), (1, ROWS[1][1], "x")], docs.schema)
    model = train(docs, labels, per_class=300)
    out = score(docs.unionByName(more), model).collect()
    assert len(out) == len(ROWS) + 4
    truth = {i: int(x) for i, _, x in ROWS}
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.doc_id: r.predicted for r in out}[9002] == 1
    kept = keep_clean(docs.unionByName(more), model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in out)


def test_labels_of_held_out_rows_are_not_read(spark, tables):
    docs, labels = tables
    rows = [(i, 1, int(x) if zlib.crc32(str(i).encode()) % 5 else 1 - int(x)) for i, _, x in ROWS]
    other = spark.createDataFrame(rows, labels.schema)
    a, b = train(docs, labels), train(docs.repartition(3), other)
    assert np.array_equal(a.hashes, b.hashes) and np.array_equal(a.values, b.values) and a.bias == b.bias


def test_intercept_does_not_depend_on_the_sample_size(spark):
    # One word in common says little, so that the classes' odds decide.
    rows = [(i, f"{'maybe' if i % 3 == 0 else 'plain'} text", int(i % 10 == 0)) for i in range(3000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    asked = docs.limit(0).unionByName(spark.createDataFrame([(-1, "maybe text"), (-2, "plain text")], docs.schema))
    whole, part = (
        {r.doc_id: r.score for r in score(asked, train(docs, labels, per_class=n)).collect()} for n in (10_000, 200)
    )
    assert all(abs(whole[i] - part[i]) < 0.06 and part[i] < 0.25 for i in whole)


def test_weights_are_sparse_and_scoring_equals_the_definition():
    column = pa.array([t for _, t, _ in ROWS[:200]])
    sets = feature_sets(column)
    model = fit(sets, np.array([float(x) for _, _, x in ROWS[:200]]))
    assert 0 < len(model.hashes) < len(np.unique(np.concatenate(sets))) / 4
    weight = dict(zip(model.hashes.tolist(), model.values))
    want = [1 / (1 + np.exp(-(model.bias + sum(weight.get(h, 0) for h in s.tolist())))) for s in sets]
    assert np.allclose(score_texts(column, model), want)


def test_no_labels(spark, tables):
    docs, labels = tables
    model = train(docs, labels.limit(0))
    assert {r.score for r in score(docs, model).collect()} == {0.0}
    assert score(docs.limit(0), model).count() == 0
