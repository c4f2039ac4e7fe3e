import hashlib
import random
from math import log2, sqrt

import numpy as np
import pytest

from tablesync.llm import rare_digest as module
from tablesync.llm.rare_digest import Kind, Settings, compared, fingerprints, levels, likeness, measured, parsed, rarity, told

SMALL = Settings(kinds=(Kind(8, 6, 2, 300, low=12), Kind(4, 3, 2, 300, high=40)), per_filter=5, together=64, part_bytes=300)


def level(window):
    sums = sum(round(window.count(c) * log2(window.count(c)) * 2**20) for c in set(window))
    most = len(window) * log2(len(window)) * 2**20
    return int(max(0, min(1000, (most - sums) * 1000 // most)))


def plain_features(text, kind, ranks):
    """A neighbourhood at a time, in whole texts."""
    windows = [text[i : i + kind.window] for i in range(len(text) - kind.window + 1)]
    if not windows:
        return [text] if text else []
    rank = [int(ranks[level(w)]) for w in windows]
    wins = [0] * len(windows)
    for start in range(max(len(windows) - kind.near, 0) + 1):
        near = range(start, min(start + kind.near, len(windows)))
        wins[min(near, key=lambda i: (rank[i], i))] += 1
    chosen = [i for i, n in enumerate(wins) if n >= kind.least_wins] or [wins.index(max(wins))]
    return list(dict.fromkeys(windows[i] for i in chosen))


def texts():
    r = random.Random(3)
    words = ["stone", "river", "aaaaaaaa", "été", "quiet ", "\n", "0101", "seven"]
    made = [" ".join(r.choice(words) + r.choice("abcdefg") for _ in range(r.randint(0, 60))) for _ in range(40)]
    return made + ["", "a", "ab" * 200, "a" * 500, made[0], made[0] + "x", "日本語" * 30]


def test_levels_agree_with_counting():
    for text in texts():
        raw = text.encode()
        for window in (4, 8):
            assert levels(np.frombuffer(raw, np.uint8), window).tolist() == [level(raw[i : i + window]) for i in range(len(raw) - window + 1)]


@pytest.mark.parametrize("together", [5, 64, 1 << 20])
def test_features_agree_with_a_neighbourhood_at_a_time(together):
    """Also when long texts are cut into pieces."""
    ranks = rarity([(7 * i) % 50 for i in range(1001)], 300)
    raw = [t.encode() for t in texts()]
    for kind in SMALL.kinds:
        got = module._features(raw, ranks, kind, together)
        for text, own in zip(raw, got, strict=True):
            hand = plain_features(text, kind, ranks)
            if len(text) < kind.window:
                assert len(own) == len(hand)
            else:
                hashed = module._hashed(np.frombuffer(b"".join(hand), np.uint8), np.arange(len(hand)) * kind.window, kind.window)
                assert own.tolist() == hashed.tolist()


def plain_likeness(a, b):
    """Bit by bit, from the parsed fingerprints."""
    if a == b:
        return 1.0
    best = 0.0
    for x, y in zip(a, b):
        if not (x.sizes and y.sizes):
            continue
        bits = lambda c: [set(np.flatnonzero(np.unpackbits(np.frombuffer(c.filters[i * 256 : i * 256 + 256], np.uint8)))) for i in range(len(c.sizes))]

        def covered(p, q):
            total = 0
            for size, own in zip(p.sizes, bits(p)):
                scores = []
                for other in bits(q):
                    chance = len(own) * len(other) / 2048
                    chance += 3 * sqrt(chance * (1 - len(own) / 2048) * (1 - len(other) / 2048))
                    most = min(len(own), len(other))
                    scores.append(min(max((len(own & other) - chance) / (most - chance), 0), 1) if most > chance else 0)
                total += size * max(scores)
            return total / sum(p.sizes)

        ways = [covered(x, y)] * (len(x.sizes) <= len(y.sizes)) + [covered(y, x)] * (len(y.sizes) <= len(x.sizes))
        best = max(best, *ways)
    return best


def test_likeness_agrees_with_sets_of_bits():
    ranks = [rarity([1] * 1001, 300)] * 2
    made = fingerprints([t.encode() for t in texts()], ranks, SMALL)
    for a in made:
        assert parsed(told(a), SMALL) == a and likeness(a, a) == 1
        for b in made[::3]:
            assert likeness(a, b) == pytest.approx(plain_likeness(a, b)) and likeness(a, b) == likeness(b, a)
    empty = made[texts().index("")]
    assert told(empty) == "" and likeness(empty, made[0]) == 0


def order(rows):
    """Descending id, nulls last, then the text's hash."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def check(docs, rows, settings):
    raw = [(i, (t or "")) for i, t in rows]
    counts = [np.bincount([level(t.encode()[i : i + k.window]) for _, t in raw if k.takes(t.encode()) for i in range(len(t.encode()) - k.window + 1)],
                          minlength=1001) for k in settings.kinds]
    found, size = measured(docs, settings)
    assert [f.tolist() for f in found] == [c.tolist() for c in counts] and size == sum(len(t.encode()) for _, t in raw)
    ranks = [rarity(c, k.floor) for c, k in zip(counts, settings.kinds)]
    hand = []
    for (i, text), (_, after) in zip(order(raw), order(raw)[1:] + order(raw)[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = fingerprints([x.encode() for x in (text, edited, after)], ranks, settings)
        hand.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), told(a), told(b), likeness(a, b), likeness(a, c)))
    out = compared(docs, settings)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(hand, key=repr)


def test_table_agrees_with_one_pass_in_order(spark, documents):
    """Many small parts; a null id, a null text."""
    rows = [(7 * i - 50, t) for i, t in enumerate(texts())] + [(1000, None), (None, "no id here"), (2**62, "far " * 30)]
    check(documents(rows), rows, SMALL)


def test_equal_rows_and_hot_ids(spark, documents):
    """A third of the rows are equal in id and text, more share an id or have none."""
    rows = [(5, "same text again")] * 30 + [(9, f"text {i}") for i in range(30)] + [(None, f"none {i}") for i in range(20)] + [(i, "t" * i) for i in range(10, 20)]
    out = compared(documents(rows), SMALL).collect()
    assert len(out) == len(rows) and len({r.fingerprint for r in out if r.doc_id == 5}) == 1
    assert sum(r.near_next == 1 for r in out if r.doc_id == 5) == 29
    docs = documents([(i, f"text {i}") for i in range(300)] + [(7, f"hot {i}") for i in range(300)] + [(None, f"null {i}") for i in range(300)])
    keyed = docs.selectExpr("doc_id id", "text", "xxhash64(text) tie")
    parts = [r["count"] for r in module._parts(keyed, 30).groupBy("part").count().collect()]
    assert max(parts) < 120


def test_one_row_none_and_a_very_long_text(spark, documents, prose):
    assert compared(documents([])).collect() == []
    (row,) = compared(documents([(4, "own next")])).collect()
    assert row.near_next == 1 and row.edited_sha256 == hashlib.sha256(b"own own ").hexdigest()
    long = prose(1, 250_000)
    first, second = sorted(compared(documents([(1, long), (2, prose(2, 300))])).collect())
    assert first.n_chars == len(long) and 0.4 < second.near_edited < 0.9 and second.near_next < 0.05 and first.near_edited > 0.9


def test_half_edited_texts_are_told_from_others(spark, documents, prose):
    out = compared(documents([(i, prose(i, 20 + 7 * i)) for i in range(80)])).collect()
    assert min(r.near_edited for r in out) > 0.2 and max(r.near_next for r in out) < 0.1
