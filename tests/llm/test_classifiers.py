import zlib

import numpy as np
import pytest

from tablesync.llm import mil_classifier as mil
from tablesync.llm import toxicity as tox
from tablesync.llm.mil_classifier import quality_scores
from tablesync.llm.toxicity import toxicity_scores

BAD = ["vile", "nasty", "rotten"]


@pytest.fixture
def corpus(spark, documents, prose):
    rows, labels = [], []
    for i in range(900):
        text = prose(i, 60 + i % 50)
        toxic, good = int(i % 7 == 0), int(i % 5 != 0)
        if toxic:
            words = text.split()
            for k in range(2):
                words.insert((i * 31 + k * 17) % len(words), BAD[(i // 7 + k) % 3] + ".")
            text = " ".join(words)
        if not good:
            text = text + " " + " ".join(f"{w}###" for w in prose(i + 5000, 80).split())
        rows.append((i, text, "en", "s"))
        if i % 10:
            labels.append((i, good, toxic))
    rows += [(2000, None), (2001, ""), (None, "without id vile"), (2002, prose(9, 20_000)), (2003, "..."), (5, rows[5][1])]
    labels += [(2001, None, None), (None, 1, 1), (5, 1, 0), (9999, 1, 1)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def auc(rows, wanted):
    scores = [(r.score, wanted(r.doc_id)) for r in rows]
    good, bad = [s for s, y in scores if y], [s for s, y in scores if not y]
    return np.mean([[g > b + 0 for b in bad] for g in good])


@pytest.mark.parametrize("score, column, folds, out, threshold", [
    (toxicity_scores, "toxic", 3, 1, 0.7), (quality_scores, "quality", 5, 0, 0.3),
])
def test_held_out_rows_are_told_apart(spark, corpus, score, column, folds, out, threshold):
    docs, labels = corpus
    rows = score(spark, docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == out
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    wanted = (lambda i: i % 7 == 0) if column == "toxic" else (lambda i: i % 5 != 0)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert len(held) > 100 and auc(held, wanted) > 0.95
    assert len({r.score for r in rows if r.doc_id == 5}) == 1


def test_held_out_labels_are_never_read(spark, corpus):
    docs, labels = corpus
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic")
    one, two = ({(r.doc_id, r.score) for r in toxicity_scores(spark, docs, x).collect()} for x in (labels, flipped))
    assert one == two


@pytest.mark.parametrize("score", [toxicity_scores, quality_scores])
def test_without_labels_or_documents(spark, corpus, score):
    docs, labels = corpus
    assert {r.score for r in score(spark, docs, labels.where("false")).collect()} == {0.5}
    assert score(spark, docs.where("false"), labels).count() == 0


def test_l1_keeps_rare_places_at_zero():
    learner = tox.Learner(tox.Ftrl(bits=8))
    rare, often = np.array([3], np.int32), np.array([5], np.int32)
    learner.learn(rare, 1)
    for _ in range(200):
        learner.learn(often, 1)
    assert learner.weights(rare)[0] == 0 and learner.weights(often)[0] > 0.5


def test_places_are_words_pairs_and_skips():
    one, two = set(tox.places("a b c", 20).tolist()), set(tox.places("a x c", 20).tolist())
    assert len(one) == 6 and len(one & two) == 3  # a, c, and a_c
    assert set(tox.places("A. b, c!", 20).tolist()) == one and len(tox.places("", 20)) == 0 and len(tox.places("a", 20)) == 1


def test_gradients_by_differences():
    r = np.random.default_rng(5)
    s = mil.Settings(hidden=4, attention=3)
    net = mil.Network.fresh(s, np.zeros(mil.FEATURES), np.ones(mil.FEATURES))
    x, first, y = r.normal(size=(7, mil.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        score, _ = net.forward(x, first)
        return -(y * np.log(score) + (1 - y) * np.log(1 - score)).mean()

    for name, g in net.gradients(x, first, y).items():
        at = tuple(r.integers(0, n) for n in net.w[name].shape)
        net.w[name][at] += 1e-6
        up = loss()
        net.w[name][at] -= 2e-6
        down = loss()
        net.w[name][at] += 1e-6
        assert g[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_measures_of_odd_texts():
    for text in ("", " ", "a", "\n\n", "é" * 500, "a " * 10_000, " lead", "x" * 100_000):
        found = mil.passages(text, 64)
        assert found.shape[1] == mil.FEATURES and np.isfinite(found).all() and len(found) == max(1, -(-len(text.split()) // 64))


def test_long_words_have_stems():
    one, two = set(tox.places("worthless", 20).tolist()), set(tox.places("Worthy.", 20).tolist())
    assert len(one) == len(two) == 2 and len(one & two) == 1


def test_large_samples_are_learnt_by_one_learner(spark, prose):
    """All rows in each round, whatever the partitions, against the update written out place by place."""
    rows = [(i, f"{prose(i, 12)} {'zorblat' if i % 1400 == 3 else ''} {BAD[i % 3] if i % 7 == 0 else ''}", int(i % 7 == 0 or i % 1400 == 3)) for i in range(7000)]
    settings = tox.Ftrl(bits=14, rounds=2)
    sample = spark.createDataFrame(rows, "id long, text string, y int")
    got = tox.fit(sample.repartition(5), settings)
    at = [[*np.unique(tox.places(text, settings.bits)).tolist(), 2**settings.bits - 1] for _, text, _ in rows]
    r = np.random.default_rng(1)
    examples = [(at[i], rows[i][2]) for _ in range(settings.rounds) for i in r.permutation(len(rows))]
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= settings.l1:
            return 0.0
        sign = 1.0 if z[k] > 0 else -1.0
        return -(z[k] - sign * settings.l1) / ((settings.beta + n[k] ** 0.5) / settings.alpha + settings.l2)

    for at, y in examples:
        held = {k: weight(k) for k in at}
        p = 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, sum(held.values())))))
        for k, w in held.items():
            g, before = p - y, n.get(k, 0.0)
            n[k] = before + g * g
            z[k] = z.get(k, 0.0) + g - (n[k] ** 0.5 - before**0.5) / settings.alpha * w
    want = {k: weight(k) for k in z if weight(k) != 0.0}
    assert got.keys() == want.keys() and len(got) > 3
    assert all(got[k] == pytest.approx(want[k], rel=1e-6, abs=1e-9) for k in want)
