import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitlane.llm import quality
from pitlane.llm.quality import classify, measures, site_rates, train

rng = np.random.default_rng(9)
WORDS = [f"{a}{b}" for a in ("th", "er", "on", "ing") for b in ("ea", "an", "st", "or")]


def text(good):
    words = [str(w) for w in rng.choice(WORDS, rng.integers(20, 80))]
    return " ".join(words) + "." if good else " ".join(w + "%%%" for w in words)


ROWS = [(i, text(i % 5 > 0), i % 5 > 0, f"host{i % 7}", "a" if i % 2 else None) for i in range(800)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, h, p, 1) for i, t, _, h, p in ROWS], "doc_id long, text string, source string, lang string, kept int")
    labels = spark.createDataFrame([(i, int(g)) for i, _, g, _, _ in ROWS if i % 4], "doc_id long, quality int")
    return docs, labels


def test_held_out_accuracy_and_cases(spark, tables):
    docs, labels = tables
    more = spark.createDataFrame([(None, None, None, None, 1), (9000, "", "host1", "a", 1), (1, ROWS[1][1], "new", "b", 1)], docs.schema)
    both = docs.unionByName(more)
    out = classify(both, train(docs, labels, per_class=200)).collect()
    assert len(out) == 803
    truth = {i: g for i, _, g, _, _ in ROWS}
    held = [r for r in out if r.doc_id is not None and r.doc_id < 800 and r.doc_id % 4 == 0]
    assert np.mean([r.kept == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.posterior <= 1 and r.kept == (r.posterior >= quality.CUT) for r in out)


def test_no_labels_and_no_rows(spark, tables):
    docs, labels = tables
    assert train(docs, labels.where("quality = 1")) is None
    assert {r.kept for r in classify(docs, None).collect()} == {True}
    assert classify(docs.limit(0), train(docs, labels)).count() == 0


def test_rates_are_shrunk_towards_the_level_above(spark):
    rows = [("big", "x", 0.9)] * 400 + [("big", "y", 0.2)] * 2 + [("small", "z", 0.1)] + [("low", "w", 0.2)] * 300
    scored = spark.createDataFrame(rows, "host string, path string, probability double")
    out = {r.path: r for r in site_rates(scored).withColumn(
        "rate", (F.col("total") + F.col("strength") * F.col("pull")) / (F.col("n") + F.col("strength"))).collect()}
    top = sum(r[2] for r in rows) / len(rows)
    assert 0.1 < out["z"].pull < top  # one document hardly moves its host
    assert abs(out["x"].pull - 0.9) < 0.02 and abs(out["x"].rate - 0.9) < 0.02
    assert 0.2 < out["y"].rate < out["y"].pull


def test_site_evidence_moves_documents(spark, tables):
    docs, labels = tables
    model = train(docs, labels, per_class=200)
    good, bad = text(True), text(False)
    unsure = spark.createDataFrame(
        [(i, good, "g", "p", 1) for i in range(60)] + [(i, bad, "b", "p", 1) for i in range(60)] + [(700, "one", "g", "p", 1), (701, "one", "b", "p", 1)], docs.schema
    )
    out = {r.doc_id: r for r in classify(unsure, model).where("doc_id >= 700").collect()}
    assert out[700].evidence == out[701].evidence and out[700].posterior > out[701].posterior


def test_measures_of_whole_texts():
    column = pa.array([None, "", "a a b", "A%%% 1.\n" * 3])
    x = measures(column)
    assert x.shape[0] == 4 and np.isfinite(x).all() and not x[0, 2:].any()
    assert x[2, 3] == pytest.approx(2 / 3) and x[2, 5] == pytest.approx(1 / 3) and x[3, 6] == pytest.approx(1 / 2)
    assert np.allclose(measures(column.slice(3))[0], x[3])
