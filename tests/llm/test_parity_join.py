import random
import re

import numpy as np
import pytest

from tablesync.llm.components import components
from tablesync.llm.parity_join import Likeness, bands, block_keys, join_keys, linked, one_of_each, parity, shingles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def by_hand(rows, rule):
    sets = {i: sets_of(t, rule.width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and rule.of * len(a & b) >= rule.least * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(words, r, share):
    return [w if r.random() > share else r.choice(["new", "other", "x", ""]) for w in words]


@pytest.mark.parametrize("rule", [Likeness(4, 85), Likeness(5, 80), Likeness(1, 50)])
def test_components_as_by_brute_force(documents, prose, rule):
    r = random.Random(rule.least)
    texts = [None, "", " \n", "one", "One", "ONE two", "one two", "a b c d", "a b c d e", "a b c d e f g h i j", "Ä ä", "ä Ä", "a\x1cb"]
    for seed in range(14):
        base = prose(seed, r.choice([6, 9, 20, 60, 200, 700])).split()
        texts.append(" ".join(base))
        for _ in range(10):
            texts.append(" ".join(edited(base, r, r.choice([0, 0.005, 0.02, 0.03, 0.04, 0.06]))))
        chain = base
        for _ in range(6):  # each near the one before, the ends far apart
            chain = edited(chain, r, 0.02)
            texts.append("\n".join(chain).upper())
    ids = r.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in linked(documents(rows), rule).collect()}
    assert got == by_hand(rows, rule)


def test_a_large_group_of_near_copies_and_a_shared_passage(documents, prose):
    r = random.Random(1)
    base, passage = prose(1, 150).split(), prose(2, 60)
    rows = [(i, " ".join(edited(base, r, 0.012))) for i in range(120)]
    rows += [(1000 + i, f"{prose(50 + i, 60)} {passage} {prose(500 + i, 60)}") for i in range(120)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in linked(documents(rows), Likeness(4, 85)).collect()}
    assert got == by_hand(rows, Likeness(4, 85))


def test_rows_without_id_repeated_rows_and_empty_table(documents, prose):
    text = prose(3, 80)
    docs = documents([(5, text), (5, text), (3, text + " end"), (None, text), (None, "alone here"), (9, None), (8, "")])
    got = sorted(((x.doc_id, x.component_id) for x in linked(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (None, None), (9, 9), (8, 8)], key=repr)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(x.doc_id) for x in kept.collect()) == ["3", "8", "9", "None", "None"]
    assert linked(docs.where("false")).count() == 0 and one_of_each(docs.where("false")).count() == 0


@pytest.mark.parametrize("rule", [Likeness(4, 85), Likeness(5, 80)])
def test_linked_sets_share_a_key_and_sketches_bound_the_difference(rule):
    r = np.random.default_rng(6)
    layout = bands(rule, 1 << 20)
    for _ in range(400):
        n = int(r.integers(2, 900))
        a = np.unique(r.integers(1, 2**63, n, dtype=np.uint64))
        gone, new = int(r.integers(0, n // 8 + 2)), int(r.integers(0, n // 8 + 2))
        b = np.unique(np.append(r.permutation(a)[min(gone, len(a)) :], r.integers(1, 2**63, new, dtype=np.uint64)))
        shared = len(np.intersect1d(a, b))
        if len(b) and rule.of * shared >= rule.least * (len(a) + len(b) - shared) and shared < max(len(a), len(b)):
            assert len(np.intersect1d(join_keys(a, rule, layout), join_keys(b, rule, layout)))
        apart = sum(bin(x ^ y).count("1") for x, y in zip(parity(a), parity(b)))
        assert apart <= len(a) + len(b) - 2 * shared


def test_shingles_count():
    for text in ("", "a", "a b c", "a b c d", "a b c d a b c d", "x " * 50):
        assert len(shingles(text, 4)) == len(sets_of(text, 4))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(500, 499), (499, 500), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)} | {499: 499, 500: 499}


@pytest.mark.parametrize("rule, keys", [(Likeness(4, 85), 0.38), (Likeness(5, 80), 0.5)])
def test_weak_share_and_keys_a_shingle(rule, keys):
    """Over 50 to 2,000 shingles: how many sets need the prefix as well, and how many keys a set has."""
    r = np.random.default_rng(9)
    layout = bands(rule, 1 << 20)
    for n in (50, 63, 64, 90, 127, 128, 200, 255, 300, 450, 600, 900, 1023, 1500, 2000):
        some = [block_keys(np.unique(r.integers(1, 2**63, n, dtype=np.uint64)), rule, layout) for _ in range(200)]
        weak_share = sum(weak for _, weak in some) / 200
        assert weak_share <= (0.06 if n < 100 else 0.02), (n, weak_share)
        assert sum(len(k) for own, _ in some for k in own) / 200 / n <= keys, n


def test_a_passage_in_a_third_of_all_documents_and_a_very_long_text(documents, prose):
    """Half of each such text is shared: many keys are, but no document links."""
    passage = prose(4, 120)
    rows = [(i, f"{prose(10 + i, 60)} {passage} {prose(400 + i, 60)}") for i in range(150)] + [(1000 + i, prose(3000 + i, 90)) for i in range(300)]
    long = prose(1, 60_000).split()
    rows += [(5000, " ".join(long)), (5001, " ".join(long[:-900]))]
    got = {x.doc_id: x.component_id for x in linked(documents(rows), Likeness(5, 80)).collect()}
    assert got == {i: i for i, _ in rows} | {5001: 5000}
