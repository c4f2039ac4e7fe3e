import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablesync.llm.packing import Capacity, Rule, WordMemo, best_fit, default_tokenizer, pack, packed_documents, sequences, token_pieces

TEXTS = [
    None, "", "plain words, and more!", "It's what they're 'bout; can't 12,345.67 ²³", "ÀÉÎ œuvre naïve ß µ ª", "a\x1cb\xa0c\x85d e", "<|endoftext|> x",
    "İSTANBUL ΣΑΣ", "é ́x", "日本語 text 😀", "tab\tnew\nline\r\n\x0b\x0c", "UPPER lower <|StartOfText|>", "x" * 3000, "''s ''''re !!?!", "\x00\x01\x7f",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("limit", [3, 10_000])
def test_memo_gives_the_tokenizers_ids(tokenizer, prose, limit):
    memo = WordMemo(default_tokenizer(), limit)
    texts = [*TEXTS, *[prose(i, 50) for i in range(20)]]
    for _ in range(2):
        got = [x.tolist() for first in range(0, len(texts), 4) for x in memo.encode(texts[first : first + 4])]
        assert [[*x, 1] for x in got] == [ids_of(tokenizer, t) for t in texts]


def test_a_full_memo_takes_little_memory():
    """Python workers keep it, two or more on an executor, beside what other stages leave."""
    memo, r = WordMemo(default_tokenizer()), random.Random(3)
    words = ["".join(r.choices("abcdefghijklmnop", k=9)) + "," for _ in range(20_000)]
    tracemalloc.start()
    try:
        for _ in memo.encode([" ".join(words)]):
            pass
        held = tracemalloc.get_traced_memory()[0] / len(memo)
    finally:
        tracemalloc.stop()
    assert held * memo.limit < 100 << 20


def check(rows, most):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= most
    return len(by_sequence)


def test_pieces_and_places(documents, tokenizer, prose):
    texts = [*TEXTS, prose(1, 6000), *[prose(i, 30 + 7 * i) for i in range(200)]]
    rows = packed_documents(documents([(i, t) for i, t in enumerate(texts)])).collect()
    found = {(r.doc_id, r.piece): r for r in rows}
    assert len(found) == len(rows)
    total = 0
    for i, text in enumerate(texts):
        ids = ids_of(tokenizer, text)
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            r = found.pop((i, piece))
            cut = np.array(ids[start : start + 4096], "<u4").tobytes()
            assert (r.start, r.length, r.ids_crc32) == (start, len(cut) // 4, zlib.crc32(cut))
    assert not found
    assert check(rows, 4096) <= -(-total // 4096) + 2


def test_real_sequences_hold_the_ids(documents, tokenizer, prose):
    docs = documents([(i, prose(i, 40)) for i in range(50)])
    packed = pack(token_pieces(docs, most=256), Capacity(tokens=256))
    joined = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in sequences(packed).collect()}
    for r in packed.collect():
        assert joined[r.sequence_id][r.offset : r.offset + r.length] == ids_of(tokenizer, docs.where(f"doc_id = {r.doc_id}").first().text)


@pytest.mark.parametrize("kind", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [Capacity(100), Capacity(100, 3), Capacity(100, 100, 3000)])
def test_every_constraint_holds(kind, capacity):
    lengths = np.sort(np.random.default_rng(4).integers(1, 50, 700))[::-1]
    sequence, offset = best_fit(lengths, capacity, Rule(kind))
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= capacity.tokens and len(own) <= capacity.documents and (own**2).sum() <= capacity.attention
        assert sorted(offset[sequence == s]) == sorted(np.cumsum(own) - own)
    if capacity == Capacity(100):
        assert sequence.max() + 1 <= -(-lengths.sum() // 100) + (1 if kind == "norm" else 8)


def test_repeated_rows_and_empty_table(documents, prose):
    docs = documents([(7, prose(3, 500))] * 30)
    rows = packed_documents(docs).collect()
    assert len(rows) == 30 and check(rows, 4096)
    assert packed_documents(docs.where("false")).count() == 0
