import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from tablesync.llm import pii
from tablesync.llm.pii import KINDS, added_spans, all_spans, base_spans, fit, personal_data, redact, redacted

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.findall("[0-9]", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = (True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                    13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0, 9 <= len(digits) <= 15)[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


@pytest.fixture(scope="module")
def weights():
    return fit([])


def test_base_is_that_of_the_plain_patterns():
    r = random.Random(7)
    bits = ["1", "23", "4", "a", "b", ".", "@", "-", " ", "+", "(", ")", "@", ".", "é", "255", "4111111111111111", "+1 619", "0" * 30, "😀"]
    for _ in range(20_000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 30)))
        assert base_spans(text) == plain(text), text


def test_hostile_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "a.b@c." * 30_000):
        base_spans(text)


def test_field_finds_whole_spans_and_their_kinds(weights):
    r = random.Random(3)
    right = wrong = total = 0
    for _ in range(300):
        kind, own = pii._made_up(r)
        text = f"there were {own} for them"
        found = added_spans(text, [], weights, 0.85)
        if kind >= 0:
            total += 1
            right += found == [(kind, 11, 11 + len(own))]
        else:
            wrong += bool(found)
    assert right >= 0.6 * total and wrong <= 6


def test_field_recovers_what_the_patterns_run_together(weights):
    text = "call +1 (855) 555-4208 4866351201689520 now"
    assert base_spans(text)[0][0] == 2 if base_spans(text) else True
    kinds = {k for (k, _, _), _ in all_spans(text, weights, 0.5)}
    assert 2 in kinds


def test_dynamic_programming_agrees_with_enumeration(weights):
    text = "at 10.0.0.1 or +1 22"
    w = pii.window(text, 0, len(text), [])
    scores = pii.scores_of(w, weights)

    def segmentations(at):
        if at == w.n:
            yield 0.0, ()
            return
        for value, rest in segmentations(at + 1):
            yield value, rest
        for i in np.flatnonzero(w.first == at):
            for value, rest in segmentations(int(w.last[i])):
                for kind in range(4):
                    yield value + scores[i, kind], ((int(i), kind), *rest)

    every = list(segmentations(0))
    assert list(max(every, key=lambda x: x[0])[1]) == pii._best(w, scores)
    ahead, behind = pii._passes(w, scores)
    total = np.logaddexp.reduce([v for v, _ in every])
    assert ahead[-1] == pytest.approx(total) and behind[0] == pytest.approx(total)


def test_query_columns(documents, prose):
    texts = [None, "", f"{prose(1, 40)} a.b@c.example é😀 10.1.2.3\n+1 (619) 555-0053 4111 1111 1111 1111 {prose(2, 500)}", prose(3, 30), "x@y.z 999.1.1.1"]
    docs = documents([(i, t) for i, t in enumerate([*texts, *texts])])
    rows = {r.doc_id: r for r in personal_data(docs).collect()}
    for i, text in enumerate([*texts, *texts]):
        base = sorted(plain(text or ""))
        digest = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        spans = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and set(base) <= set(spans)


def test_redaction(documents, prose):
    assert redact("a 12 b 34 c", [((3, 2, 4), True), ((2, 2, 6), True), ((1, 7, 9), False)]) == "a [CARD] [IP] c"
    docs = documents([(1, "me a@b.co now", "en", "s"), (2, None, "fr", "t"), (3, prose(1, 50), None, None)])
    got = redacted(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].text == "me [EMAIL] now" and rows[2].text is None and rows[3].text == prose(1, 50) and rows[1].q_text == "x"
    assert redacted(docs.where("false")).count() == 0 and personal_data(docs.where("false")).count() == 0


def test_blocks_give_what_one_piece_gives(weights, monkeypatch):
    r = random.Random(5)
    bits = ["12", "4111 1111 1111 1111", "10.1.2.3", "at", "(at)", "dot", "+", "call", "a", "@", "-", "(619)", "555-0053", ".", "x@y.z", "the day was long and"]
    for _ in range(40):
        text = " ".join(r.choice(bits) for _ in range(r.randint(1, 150)))
        fixed = base_spans(text) if r.random() < 0.5 else []
        monkeypatch.setattr(pii, "BLOCK", 100_000)
        whole = added_spans(text, fixed, weights, 0.5)
        for block in (1, 7, 40):
            monkeypatch.setattr(pii, "BLOCK", block)
            assert added_spans(text, fixed, weights, 0.5) == whole


def test_long_texts_of_digits_take_little_memory(weights):
    text = "12 34 56 7,8 " * 4_000 + "call (619) 555-0053 now"
    tracemalloc.start()
    try:
        found = added_spans(text, [], weights, 0.5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 150e6 and (3, text.index("(619)"), len(text) - 4) in found


def test_written_out_addresses_in_any_case_and_brackets(weights):
    for own in ("JOHN (AT) SITE DOT COM", "john [AT] site", "name ( at ) host com", "anna {at} site", "JOHN [ AT ] SITE DOT COM"):
        text = f"the day was long and {own} of them"
        opened = list(pii._windows(text, []))
        assert opened and opened[0][0] <= text.index(own) and opened[0][1] >= text.index(own) + len(own), own
        w = pii.window(text, 0, len(text), [])
        assert any(text[w.starts[a] : w.ends[b - 1]] == own for a, b in zip(w.first, w.last)), own
    one = added_spans("mail john (at) site dot com in the end", [], weights, 0.5)
    assert one and added_spans("mail JOHN (AT) SITE DOT COM in the end", [], weights, 0.5) == one
