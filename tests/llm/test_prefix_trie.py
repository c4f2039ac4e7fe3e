import hashlib
import random
import zlib

import pytest

from tablesync.llm.prefix_trie import Settings, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, k long, depth int, b1 string, n_convs long"


def by_hand(rows):
    """The contract, a node at a time."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [r[2:] for r in sorted(v)] for c, v in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(talks.get(c - int(c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    made = []
    for path, members in nodes.items():
        under = {p: m for p, m in nodes.items() if p[: len(path)] == path}
        leaves = [p for p in under if not any(q[:-1] == p and q for q in nodes)]
        saved = sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in under.items() if p)
        ends = ",".join(str(c) for c in sorted(members) if built[c] == path)
        made.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                     sum(len(q) == len(path) + 1 for q in under), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(made, key=repr)


def nodes_of(spark, rows, settings=Settings()):
    table = spark.createDataFrame([(*r, 9, 9, "x", 9) for r in rows], SCHEMA)
    out = prefix_trie(*rebuilt(table), settings)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 3, 4])
def test_agrees_with_a_node_at_a_time(spark, block):
    """Few words, so prefixes are shared; nulls, ties, repeated rows, absent donors, turnless conversations."""
    r = random.Random(block)
    rows = []
    for c in [*range(40), 41, 63, 97, 1_000_003, -7, -5]:
        for t in range(r.choice([1, 2, 3, 6, 9, 13])):
            rows.append((c, t if r.random() < 0.9 else None, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "é" * 3])))
    rows += rows[:5] + [(None, 1, "user", "lost")]
    assert nodes_of(spark, rows, Settings(block=block, chunk=3, ids_per_task=7)) == by_hand(rows)


def test_copies_a_long_talk_and_a_long_text(spark):
    """A third of the conversations are copies; one has 200 turns, one text 300,000 bytes."""
    rows = [(5 * c, t, "user", f"same {t}") for c in range(60) for t in range(6)]
    rows += [(5 * c, t, "user", f"own {c} {t // 2}") for c in range(60, 120) for t in range(4)]
    rows += [(1000, t, "user", f"same {t}") for t in range(200)] + [(2000, 0, "user", "ab " * 100_000), (2005, 0, "user", "ab " * 100_000)]
    assert nodes_of(spark, rows) == by_hand(rows)


def test_nothing(spark):
    assert nodes_of(spark, []) == [] and nodes_of(spark, [(None, 0, "user", "x")]) == []
    # 3 takes its first turns from 0, which is absent, and has none of its own after them
    assert zlib.crc32(b"3") % 9 >= 1 and nodes_of(spark, [(3, 0, "user", "x")]) == by_hand([(3, 0, "user", "x")])


def test_undiverged_blocks_are_not_opened_again(spark):
    """Where one block follows a prefix its turns are nodes without being grouped."""
    from tablesync.llm import prefix_trie as module

    rows = [(5 * c, t, "user", f"t{t}") for c in range(20) for t in range(8)] + [(500, t, "user", f"t{min(t, 5)}") for t in range(8)]
    _, turns = rebuilt(spark.createDataFrame([(*r, 9, 9, "x", 9) for r in rows], SCHEMA))
    blocks = module._blocks(turns, 4, 8)
    distinct, groups = module._distinct_blocks(blocks)
    assert sorted((r.k, r.kinds) for r in groups.collect()) == [(0, 1), (1, 2)]
    assert sorted(r.n_convs for r in distinct.collect()) == [1, 20, 21]
