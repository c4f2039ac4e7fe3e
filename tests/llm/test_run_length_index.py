import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from tablesync.llm.run_length_index import anchors, repeats, without_repeats


def by_hand(texts, length):
    raws = [(t or "").encode() for t in texts]
    times = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if times[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


@pytest.mark.parametrize("length, letters", [(17, "ab"), (20, "abcdefgh"), (33, "ab"), (40, "aé")])
def test_index_finds_what_brute_force_finds(length, letters):
    r = random.Random(length)
    for _ in range(25):
        base = ["".join(r.choice(letters) for _ in range(r.randint(0, 200))) for _ in range(6)]
        texts = ["".join(r.choice(base)[r.randint(0, 30) :] for _ in range(r.randint(0, 3))) for _ in range(12)]
        regions, own = [], []
        for i, t in enumerate(texts):
            raw = t.encode()
            for a, b in zip(*anchors(raw, length)[1:3]):
                regions.append(raw[a : b + length])
                own.append((i, int(a)))
        got = [np.zeros(len(t.encode()), bool) for t in texts]
        for region, a, b in repeats(regions, length):
            i, start = own[region]
            got[i][start + a : start + b] = True
        assert [int(g.sum()) for g in got] == [x[1] for x in by_hand(texts, length)]


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_documents(documents, prose, shard):
    passage, long = prose(1, 12), "lorem " * 600
    texts = [None, "", "short", prose(2, 30), prose(2, 30), f"{prose(3, 9)} {passage} {prose(4, 9)}", f"{prose(5, 20)} {passage}", passage, passage * 2]
    texts += [f"{prose(90 + i, 6)} {passage} {prose(60 + i, 6)}" for i in range(30)] + [long, long + "x", "é" * 300, prose(7, 2000)]
    docs = documents([(100 - i, t) for i, t in enumerate(texts)])
    got = removed(without_repeats(docs, 50, bucket_bytes=2000, shard_bytes=shard))
    assert got == {100 - i: x for i, x in enumerate(by_hand(texts, 50))}


def test_production_length_kept_texts_and_copies(documents, prose):
    body = prose(11, 200)
    texts = [body + prose(12, 90), prose(13, 90) + body, body[:399], prose(14, 70), prose(14, 70), prose(15, 30)]
    frame = without_repeats(documents([(i, t) for i, t in enumerate(texts)]))
    assert removed(frame) == {i: x for i, x in enumerate(by_hand(texts, 400))}
    kept = {r.doc_id: r.kept for r in frame.collect()}
    assert kept[5] is None and hashlib.sha256(bytes(kept[0])).hexdigest() == by_hand(texts, 400)[0][3]


def test_repeated_rows_and_empty_table(documents, prose):
    docs = documents([(1, prose(1, 100))] * 3)
    assert {tuple(r)[1:4] for r in without_repeats(docs).collect()} == {(len(prose(1, 100)), len(prose(1, 100)), 1)}
    assert without_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        without_repeats(docs, 16)


@pytest.mark.parametrize("shard, rows", [(1 << 20, 1_000_000), (200, 1_000_000), (1 << 20, 0), (200, 0)])
def test_ids_that_are_null_or_name_several_texts(documents, prose, monkeypatch, shard, rows):
    monkeypatch.setattr("tablesync.llm.run_length_index.BROADCAST_ROWS", rows)
    passage, copied = prose(1, 12), prose(2, 40)
    halves = passage[: len(passage) // 2 + 30], passage[len(passage) // 2 - 30 :]
    texts = [f"{prose(3, 9)} {passage} {prose(4, 9)}", f"{prose(5, 20)} {passage}", f"{passage} {prose(6, 25)}", f"{prose(7, 9)} {halves[0]}", f"{halves[1]} {prose(8, 9)}"]
    texts += [copied, copied, copied, f"{prose(9, 9)} {copied[20:120]} {prose(10, 9)}", prose(11, 30), None, "short"]
    ids = [None, None, 7, 7, 7, None, None, 7, 8, 7, None, None]
    docs = documents(list(zip(ids, texts)))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(docs, 50, bucket_bytes=2000, shard_bytes=shard).collect()]
    assert Counter(got) == Counter((i, *x) for i, x in zip(ids, by_hand(texts, 50)))


def test_memory_of_a_shard():
    """A megabyte of regions that share their middle, below 80 bytes a byte; few runs for many bytes."""
    import tracemalloc

    from tablesync.llm.run_length_index import RunLengthIndex

    r = random.Random(4)
    middle = r.randbytes(300)
    regions = [r.randbytes(200) + middle + r.randbytes(200) for _ in range(700)] + [middle * 2 + bytes([i % 256, i // 256]) for i in range(700)]
    tracemalloc.start()
    found = repeats(regions, 300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(map(len, regions))
    assert size > 800_000 and peak < 80 * size
    assert [i for i, a, b in sorted(found)] == list(range(1400))  # a stretch each, longer by chance
    assert all((150 < a <= 200 and 500 <= b < 550) if i < 700 else (a == 0 and 600 <= b <= 602) for i, a, b in found)
    index = RunLengthIndex(regions[700:])
    assert len(index.row) < 3000 and int(index.size.sum()) == sum(map(len, regions[700:])) + 700  # and a row for each end


def test_one_anchor_with_30_000_regions(spark):
    """22 MB under one anchor, refined until pieces fit shards: a passage within text of each document's own."""
    rows = spark.range(30_000).selectExpr("id doc_id", "sha2(string(id), 256) a", "sha2(string(-id - 1), 256) b")
    own = "concat(a, b, a, reverse(b), a, b)"
    r = random.Random(8)
    passage = "".join(r.choice("ghijklmnop") for _ in range(450))
    docs = rows.selectExpr("doc_id", f"concat(substr({own}, 1, 300), '{passage}', substr(reverse({own}), 1, 300)) text")
    sides = [(r.text[:300][::-1], r.text[750:]) for r in docs.collect()]

    def shared(texts):
        """How far each text goes along with another one: with a neighbour in their order."""
        order = sorted(range(len(texts)), key=texts.__getitem__)
        far = [0] * len(texts)
        for x, y in zip(order, order[1:]):
            n = len(os.path.commonprefix([texts[x], texts[y]]))
            far[x], far[y] = max(far[x], n), max(far[y], n)
        return far

    hand = Counter(450 + x + y for x, y in zip(shared([s[0] for s in sides]), shared([s[1] for s in sides])))
    got = without_repeats(docs, shard_bytes=1 << 19).groupBy("n_removed", "n_spans").count().collect()
    assert {(r.n_removed, r.n_spans): r["count"] for r in got} == {(n, 1): times for n, times in hand.items()}


def test_a_text_over_four_mebibytes(documents, prose):
    """Windows are anchored in pieces of 4 Mi; one repeat lies over such an edge."""
    r = random.Random(6)
    long = "".join(r.choice("abcdefghijklmnop") for _ in range(4_500_000))
    edge = (1 << 22) - 200
    texts = [long, "x" + long[edge : edge + 900], long[100:700] + "y"]
    assert removed(without_repeats(documents(list(enumerate(texts))))) == {
        i: x for i, x in enumerate([
            (len(long), 1500, 2, hashlib.sha256((long[:100] + long[700:edge] + long[edge + 900 :]).encode()).hexdigest()),
            (901, 900, 1, hashlib.sha256(b"x").hexdigest()), (601, 600, 1, hashlib.sha256(b"y").hexdigest())])}
