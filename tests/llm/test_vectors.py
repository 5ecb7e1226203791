import numpy as np
import pytest

from foretell.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    good = {}
    for i, v, *_ in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i, tuple(np.float32(x) for x in v)] = np.array(v, np.float32).astype(float)
    out = set()
    for (i, key), q in good.items():
        if i % every:
            continue
        hits = sorted((-float((x * q).sum()), j) for (j, _), x in good.items() if j != i)[:k]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(hits)}
    return out


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + r.normal(size=8) * 0.2).astype(np.float32).tolist(), 0) for i in range(900)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(400)]  # one hot vector
    return rows


def test_recall(spark, vectors):
    got = ann.search(spark.createDataFrame(vectors, SCHEMA), every=20, k=20, leaves=32).collect()
    want = brute(vectors, 20, 20)
    pairs = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == len(want) and len(pairs & {(a, c) for a, _, c, _ in want}) >= 0.9 * len(want)
    scores = {(a, c): s for a, _, c, s in brute(vectors, 20, 2000)}
    assert all(r.score == scores[r.query_id, r.vec_id] for r in got)


def test_with_all_leaves_it_is_exact(spark, vectors):
    got = ann.search(spark.createDataFrame(vectors, SCHEMA), every=50, k=5, recall=1.1, leaves=16).collect()
    assert {tuple(r) for r in got} == brute(vectors, 50, 5)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 1.0], None), (40, None, 1), (60, [0.0, 0.0], 1), (80, [None, 1.0], 1),
            (100, [float("nan"), 1.0], 1), (120, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1),
            (9, [1.0, 1.0], 1), (9, [1.0, 1.0], 1), (140, [1.0, 1.0], 1), (3, [-1.0, 0.5], 1)]
    got = ann.search(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute([r for r in rows if r[0] != 8], 20, 20)
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ann.search(spark.createDataFrame(rows[2:4], SCHEMA)).count() == 0


def test_vectors_of_every_length_are_answered(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=(4, 4, 4, 7, 3)[i % 5]).astype(np.float32).tolist(), 0) for i in range(300)]
    by_length = [brute([x for x in rows if len(x[1]) == n], 10, 5) for n in (3, 4, 7)]
    for small in (1000, 10):
        monkeypatch.setattr(ann, "SMALL", small)
        got = ann.search(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "n"), every=10, k=5, recall=1.1, leaves=8).collect()
        assert {tuple(x) for x in got} == set().union(*by_length)


def test_best_bin_first_visits_every_leaf_once():
    r = np.random.default_rng(2)
    x = r.normal(size=(500, 6))
    tree = ann.Tree(x, 20)
    assert sorted(tree.visit(x[3])) == list(range(tree.leaves))
    assert set(tree.assign(x)) == set(range(tree.leaves))
    first = [next(iter(tree.visit(v))) for v in x]
    assert np.mean(first == tree.assign(x)) > 0.99
