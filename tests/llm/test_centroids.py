import hashlib

import numpy as np
import pytest

from pitlane.llm import centroids
from pitlane.llm.centroids import assign, cluster, clustered, squares

rng = np.random.default_rng(13)
COLUMNS = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, dimension):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v and len(v) == dimension and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            members = [v for (_, v), o in zip(kept, own) if o == j]
            if members:
                centres[j] = [sum(x) // len(members) for x in zip(*members)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, sum(r[2] for r in out if r[1] == j), sum(r[2] for r in out), marks[j]) for i, j, d in out]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def vectors(n, d):
    middle = rng.normal(size=(6, d)) / 2
    return [(i, (middle[rng.integers(6)] + rng.normal(size=d) / 8).tolist()) for i in range(n)]


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 2), (1, 1)])
def test_equal_to_plain(spark, monkeypatch, k, rounds):
    monkeypatch.setattr(centroids, "BLOCK", 23)
    rows = vectors(150, 4)
    rows += [(500 + i, rows[3][1]) for i in range(40)] + [rows[5]] * 3  # ties and repeated rows
    rows += [(None, rows[2][1]), (900, None), (901, []), (902, [0.1, None, 0.2, 0.3]), (903, [float("nan")] * 4), (904, [float("-inf")] * 4), (905, [1.0])]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert order(clustered(df, k=k, rounds=rounds, dimension=4).collect()) == order(plain(rows, k, rounds, 4))


def test_empty_clusters_and_equal_distances(spark):
    # Two equal starting vectors: the second cluster stays empty; points in the middle go to the smaller number.
    rows = [(i, [float(i % 3), 0.0]) for i in range(12)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert order(clustered(df, k=5, rounds=4, dimension=2).collect()) == order(plain(rows, 5, 4, 2))


def test_few_or_no_vectors(spark):
    rows = vectors(3, 2)
    assert order(clustered(spark.createDataFrame(rows, COLUMNS), dimension=2).collect()) == order(plain(rows, 8, 10, 2))
    assert clustered(spark.createDataFrame([], COLUMNS)).count() == 0
    assert clustered(spark.createDataFrame([(1, None)], COLUMNS)).count() == 0


def test_other_columns_and_float_input(spark):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in vectors(20, 2)], "vec_id int, embedding array<float>, cluster int, id string")
    assert clustered(df, dimension=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_range(spark):
    near = [(i, [float(2**16 * (1 - 2 * (i % 2))), float(i)]) for i in range(10)]
    assert order(clustered(spark.createDataFrame(near, COLUMNS), dimension=2).collect()) == order(plain(near, 8, 10, 2))
    with pytest.raises(Exception, match="reaches 2\\*\\*27"):
        cluster(spark.createDataFrame([(1, [1e30, 0.0])], COLUMNS), dimension=2)


def test_bounds_hold_and_save_work():
    """Displacement bounds: the same owners as a full scan, from far fewer distances."""
    d, k = 16, 12
    data = np.floor(1024 * np.array([v for _, v in vectors(2000, d)])).astype(np.int32)
    history = data[:k].astype(np.int64)[None]
    state, computed = (None, None, None), []
    for _ in range(15):
        owner, _, distance, seen, n = assign(data, history, *state)
        full = np.array([squares(data, c) for c in history[-1]]).T
        assert (owner == full.argmin(axis=1)).all()
        state, computed = (owner.astype(np.int16), distance, seen), [*computed, n]
        centres = [data[owner == j].sum(axis=0, dtype=np.int64) // max(1, (owner == j).sum()) for j in range(k)]
        history = np.concatenate([history, np.array(centres)[None]])
    assert computed[0] == 2000 * k and sum(computed[5:]) < 0.3 * 10 * 2000 * k


def test_straight_displacement_is_used():
    """A centroid that went away and came back has not moved: nothing is computed again."""
    data = np.array([[0, 0], [100, 0], [3, 4]], np.int32)
    there, away = np.array([[0, 0], [100, 0]]), np.array([[50, 50], [60, 60]])
    owner, _, distance, seen, _ = assign(data, there[None], None, None, None)
    again = assign(data, np.array([there, away, there]), owner, distance, seen)
    assert again[4] == 0 and (again[0] == owner).all()
