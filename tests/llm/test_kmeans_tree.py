import numpy as np
import pytest

from tablesync.llm.kmeans_tree import Settings, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, leaf int, id string"


def exact(rows, queries, k=10):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in rows:
        if queries(i):
            d = np.sqrt(((vectors - np.array(v, np.float32).astype(float)) ** 2).sum(axis=1))
            keep = ids != i
            order = np.lexsort((ids[keep], d[keep]))[:k]
            out[i] = list(zip(ids[keep][order].tolist(), d[keep][order].tolist()))
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        assert r.rank == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def test_recall_and_exact_scores(spark, table):
    r = np.random.default_rng(8)
    centres = r.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + 0.4 * r.normal(size=16)).tolist()) for i in range(4000)]
    got = found(neighbours(spark, table(rows), "id % 20 = 0", settings=Settings(leaf_rows=64, block_rows=50)))
    want = exact(rows, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    vectors = dict(rows)
    for q, own in got.items():
        for i, d in own:
            gap = np.array(vectors[q], np.float32).astype(float) - np.array(vectors[i], np.float32).astype(float)
            assert d == pytest.approx(np.sqrt((gap * gap).sum()), abs=1e-12)


def test_unusable_vectors_ties_and_few_rows(spark, table):
    good = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])]
    bad = [(100, None), (200, [0.0, 0.0]), (300, [float("nan"), 1.0]), (400, [None, 1.0]), (500, [float("inf"), 0.0]), (600, [1.0]), (700, []), (None, [1.0, 1.0])]
    got = found(neighbours(spark, table(good + bad), "id % 100 = 0"))
    assert got == exact(good, lambda i: i == 0)
    assert [i for i, _ in got[0]] == [1, 2, 3]
    assert neighbours(spark, table(good).where("false"), "true").count() == 0
    assert neighbours(spark, table(good), "id > 50").count() == 0


def test_a_third_of_all_rows_equal(spark, table):
    r = np.random.default_rng(2)
    rows = [(i, [0.5, 0.5, 0.5] if i % 3 == 0 else r.normal(size=3).tolist()) for i in range(1500)]
    got = found(neighbours(spark, table(rows), "id % 150 = 0", settings=Settings(leaf_rows=32, block_rows=40)))
    want = exact(rows, lambda i: i % 150 == 0)
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]] == list(range(3, 33, 3))
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_rows_that_share_an_id_are_candidates(spark, table):
    """Two query rows of one id are each other's candidates, and each has its own list."""
    rows = [(0, [1.0, 0.0]), (0, [1.1, 0.0]), (0, [9.0, 9.0]), (1, [1.0, 0.1])]
    got = neighbours(spark, table(rows), "id = 0").collect()
    lists = sorted((r.rank, r.vec_id, round(r.score, 6)) for r in got)
    want = []
    for own, (i, v) in enumerate(rows):
        if i == 0:
            near = sorted((float(np.hypot(*(np.array(v, np.float32).astype(float) - np.array(w, np.float32)))), j) for at, (j, w) in enumerate(rows) if at != own)
            want.extend((rank, j, round(d, 6)) for rank, (d, j) in enumerate(near, 1))
    assert {r.query_id for r in got} == {0} and lists == sorted(want)


def test_clustered_vectors_take_a_part_of_the_leaves(spark, table, monkeypatch):
    """Calibration stops well under a quarter of the leaves where vectors lie in clusters, with the recall kept."""
    from tablesync.llm import kmeans_tree

    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + 0.2 * r.normal(size=24)).tolist()) for i in range(4000)]
    seen, inner = [], kmeans_tree._calibrated

    def noted(indexed, asked, tree, sizes, settings):
        seen.append((inner(indexed, asked, tree, sizes, settings), len(sizes)))
        return seen[-1][0]

    monkeypatch.setattr(kmeans_tree, "_calibrated", noted)
    got = found(neighbours(spark, table(rows), "id % 20 = 0", settings=Settings(leaf_rows=64)))
    want = exact(rows, lambda i: i % 20 == 0)
    ((visits, leaves),) = seen
    assert leaves > 30 and visits < leaves / 4
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)
