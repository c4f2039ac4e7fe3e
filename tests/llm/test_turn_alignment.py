import hashlib
import random
import re
import time
import zlib
from functools import lru_cache

import pytest

from tablesync.llm import turn_alignment as module
from tablesync.llm.turn_alignment import damaged, repair_digests, repaired

SCHEMA = "conv_id long, turn long, role string, text string, copy string, was int, tie long, present string"


def by_states(codes):
    """The cheapest audit by another way: the grammar's states (0 start, 1 after s, 2 expects a, 3 whole)."""

    @lru_cache(None)
    def go(i, state, inserted):
        ways = [(0, "")] if i == len(codes) and state in (0, 3) else []
        want, then = [("u", 2), ("u", 2), ("a", 3), ("u", 2)][state]
        steps = [] if inserted > 3 else [(2, "I", i, then, inserted + 1)]
        if i < len(codes):
            code, extra = codes[i], int(codes[i].isupper())
            steps.append((3, "D", i + 1, state, 0))
            if code != "x":
                if state == 0 and code in "sS":
                    steps.append((extra, "K", i + 1, 1, 0))
                same = code.lower() == want
                steps.append((extra + 2 * (not same), "K" if same else "R", i + 1, then, 0))
        for cost, edit, *to in steps:
            more, audit = go(*to)
            ways.append((cost + more, edit + audit))
        return min(ways, default=(10**9, ""))

    return go(0, 0, 0)


@pytest.mark.parametrize("kept", [2, 256])
def test_alignment_agrees_with_the_states_of_the_grammar(monkeypatch, kept):
    monkeypatch.setattr(module, "_KEPT", kept)
    r = random.Random(kept)
    assert module._align("") == (0, "") and module._align("s") == (3, "D") and module._align("x") == (3, "D")
    for _ in range(1500):
        codes = "".join(r.choice("ssuuuaaaoSUAOxx") for _ in range(r.randint(0, 11)))
        assert module._align(codes) == by_states(codes), codes
    for _ in range(60):
        codes = "".join(r.choice("su" + "ua" * 6 + "oSUAOxx") for _ in range(r.randint(20, 80)))
        assert module._align(codes) == by_states(codes), codes


def test_a_long_conversation_stays_in_its_band():
    r = random.Random(0)
    start = time.time()
    cost, audit = module._align("".join("ua"[i % 2] if r.random() < 0.8 else r.choice("uUAxo") for i in range(5000)))
    assert time.time() - start < 30 and cost < 5000 and len(audit) >= 5000


def by_hand(rows):
    """The contract, a conversation at a time."""
    space = " \t\n\x0b\f\r"
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, [])
        told = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        was, text = told(role), told(text)
        order = (turn is not None, turn or 0, was, hashlib.md5(text.encode()).hexdigest())
        new = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            talks[conv] += [(order, turn, "user" if fault == 4 else was, new)] * (2 if fault == 3 else 1)
    made = []
    for conv, talk in talks.items():
        talk.sort(key=lambda row: row[0])
        turns = [row[1] for row in talk if row[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, codes = set(), ""
        for _, _, role, text in talk:
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not text.strip(space):
                code = "b"
            elif (role, text) in seen:
                code = "d"
            elif text.rstrip(space)[-1] not in ".!?":
                code = code.upper()
            seen.add((role, text))
            codes += code
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(talk, talk[1:])]
        cost, audit = by_states(re.sub("[bd]", "x", codes))
        out, left, lead = [], list(talk), 0
        for edit in audit:
            want = "assistant" if (len(out) - lead) % 2 else "user"
            row = left.pop(0) if edit != "I" else None
            if edit == "K" and not out and row[2][:1] == "s":
                lead = 1
            if edit != "D":
                out.append((want if edit in "IR" else row[2], row[3] if row else ""))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))
        text = "\n".join(f"{role}:{text}" for role, text in out)
        made.append(((conv, gaps, codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes),
                      sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()), out))
    return made


def talks():
    r = random.Random(5)
    rows = []
    for c in range(150):
        for t in range(r.choice([1, 2, 5, 8, 30])):
            role = r.choice(["user", "assistant"]) if r.random() < 0.3 else ["user", "assistant"][t % 2]
            if r.random() < 0.1:
                role = r.choice(["system", "tool", "", None, "sys"])
            rows.append((c, None if r.random() < 0.05 else t + (t > 4), role, r.choice(["Yes.", "No!", "é?", "open", " ", "", None, "a.\n", f"t{t}. "])))
    return rows + rows[:40] + [(None, 1, "user", "who?"), (None, None, None, None), (-3, 2, "user", "long. " * 60_000)]


def test_agrees_with_a_conversation_at_a_time(spark):
    rows = talks()
    table = damaged(spark.createDataFrame([(*r, "x", 1, 2, "no") for r in rows], SCHEMA))
    hand = by_hand(rows)
    out = repair_digests(table)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((row for row, _ in hand), key=repr)
    audits, turns = repaired(table)
    assert audits.count() == len(hand)
    got = {}
    for row in turns.orderBy("conv_id", "place").collect():
        got.setdefault(row.conv_id, []).append((row.role, row.text))
    assert got == {row[0]: out for row, out in hand if out}


def test_nothing(spark):
    assert repair_digests(damaged(spark.createDataFrame([], SCHEMA))).collect() == []
