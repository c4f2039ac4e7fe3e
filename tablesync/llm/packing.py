"""Packing documents into sequences by vector best fit.

Texts become token ids where they lie; ids longer than a sequence are cut. A piece demands a vector
(tokens, one document, attention cost = the square of its length) and a sequence offers one. Pieces
are taken by falling size; each goes to the open sequence that holds it under every constraint and
that a weighted rule likes best: the largest dot product of demand and what is left, or the
smallest norm of what would be left. Only piece lengths are packed, never ids.

Pieces are dealt by hash into groups of about ``group_pieces``, each with nearly the lengths of the
whole, and a group is packed by one task; a group leaves a sequence or two partly empty.

Defined results: a null or empty text is the closing id alone; rows with equal ids are packed as
they come, each for itself; ties go to the sequence opened first; an empty table gives no rows;
other columns do not pass through the token stage (join on the id).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import parts_for, tidied, written


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. The defaults for documents and attention never bind before the tokens do."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096


@dataclass(frozen=True)
class Rule:
    kind: str = "norm"  # or "dot"
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)  # of tokens, documents, attention


# How the tokenizer file splits words, in bytes of lower-case Latin-1; and bytes that leave it to the file.
_SPLIT = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    rb"|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)
_ODD = re.compile(rb"[\x00-\x20\x7f-\xa0]")


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordMemo(dict):
    """Ids of texts, each distinct word encoded once.

    The tokenizer lower-cases, drops white space and never joins across it, so a text has the ids of
    its words, and a word those of the parts it is split into, which are words as well. Words of
    Latin-1 texts are looked up here; other texts, and words with control characters, go to the
    tokenizer whole. Emptied when it holds ``limit`` words, of some 150 bytes each, and after each task."""

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.letters = Tokenizer.from_file(path), limit, _byte_letters()
        self.model = self.tokenizer.model
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.flat = array("I")  # ids of all words, one after another
        self.starts, self.lengths = array("q"), array("q")

    def __missing__(self, word: bytes) -> int:
        """Row of a word's ids; called for words not seen yet."""
        if _ODD.search(word):
            ids = array("I", self.tokenizer.encode(word.decode("latin-1"), add_special_tokens=False).ids)
        else:
            parts = _SPLIT.findall(word)
            if len(parts) == 1:
                letters = word.decode() if word.isascii() else "".join([self.letters[b] for b in word.decode("latin-1").encode()])
                ids = array("I", [t.id for t in self.model.tokenize(letters)])
            else:
                ids = array("I")
                for row in [self[part] for part in parts]:
                    ids += self.flat[self.starts[row] : self.starts[row] + self.lengths[row]]
        self[word] = row = len(self)
        self.starts.append(len(self.flat))
        self.lengths.append(len(ids))
        self.flat.extend(ids)
        return row

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, 32-bit."""
        if len(self) > self.limit:
            self.empty()
        rows: list[np.ndarray | None] = []
        for text in texts:
            try:
                words = None if "<|" in (text or "") else (text or "").lower().encode("latin-1").split()
            except UnicodeEncodeError:
                words = None
            rows.append(None if words is None else np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        starts, lengths, flat = (np.array(x) for x in (self.starts, self.lengths, self.flat))
        for text, own in zip(texts, rows, strict=True):
            if own is None:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            n = lengths[own]
            ends = np.cumsum(n)
            yield flat[np.repeat(starts[own] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


_memos: dict[str, WordMemo] = {}


def _memo(path: str) -> WordMemo:
    """One per Python worker, which serves many tasks."""
    if path not in _memos:
        _memos[path] = WordMemo(path)
    return _memos[path]


def forget_words() -> None:
    """The tokenizers stay."""
    for memo in _memos.values():
        memo.empty()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4096, tokenizer: str | None = None,
    closing_id: int = 1,
) -> DataFrame:
    """Pieces of at most ``most`` ids: id, ``piece``, ``start``, ``length``, ``ids`` (32-bit, little-endian).

    ``tokenizer`` is the path of a tokenizer file that every node has."""
    path = tokenizer or default_tokenizer()
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                owner, piece, start, length, ids = [], [], [], [], []
                for row, own in enumerate(memo.encode(part.column(1).to_pylist())):
                    own = np.append(own, closing_id).astype("<u4")
                    for k, at in enumerate(range(0, len(own), most)):
                        cut = own[at : at + most]
                        owner.append(row)
                        piece.append(k)
                        start.append(at)
                        length.append(len(cut))
                        ids.append(cut.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidied(encode, forget_words), schema)


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each of the ``lengths``, which must come by falling size."""
    offer = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(rule.weights, float)
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left, used, names, opened, made = np.zeros((64, 3)), np.zeros(64, np.int64), np.zeros(64, np.int64), 0, 0
    for i, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1, length * length]) / offer
        if i % 512 == 0 and opened:  # sequences without room for the smallest piece of all are closed
            open_ = np.flatnonzero(left[:opened, 0] >= lengths[-1] / capacity.tokens - 1e-12)
            opened = len(open_)
            left[:opened], used[:opened], names[:opened] = left[open_], used[open_], names[open_]
        rest = left[:opened] - demand
        fits = np.flatnonzero((rest >= -1e-12).all(axis=1))
        if len(fits):
            rest = rest[fits]
            value = (rest * rest) @ weights if rule.kind == "norm" else -(left[fits] @ (weights * demand))
            at = fits[value.argmin()]
        else:
            if opened == len(left):
                left, used, names = (np.concatenate([x, np.zeros_like(x)]) for x in (left, used, names))
            at, left[opened], used[opened], names[opened] = opened, 1.0, 0, made
            opened, made = opened + 1, made + 1
        sequence[i], offset[i] = names[at], used[at]
        left[at] -= demand
        used[at] += length
    return sequence, offset


def pack(
    pieces: DataFrame, capacity: Capacity = Capacity(), rule: Rule = Rule(), group_pieces: int = 16_000
) -> DataFrame:
    """``pieces`` (with a ``length`` within the capacity) plus ``sequence_id`` and ``offset``."""
    keyed = written(pieces, "pieces")
    groups = parts_for(keyed.count(), group_pieces)
    # the row's number is fixed by the written files, so a task run again deals alike
    keyed = keyed.withColumn("pack_row", F.monotonically_increasing_id())
    keyed = keyed.withColumn("pack_group", F.pmod(F.xxhash64("pack_row", "length"), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "pack_row"], ascending=[False, True], kind="stable")
        sequence, offset = best_fit(frame["length"].to_numpy(np.int64), capacity, rule)
        group = int(frame["pack_group"].iloc[0])
        return frame.assign(sequence_id=(group << 32) + sequence, offset=offset)[schema.names]

    return keyed.groupBy("pack_group").applyInPandas(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids: ``sequence_id`` and ``ids``. ``packed`` has ``offset`` and ``ids`` of pieces."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def packed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: Capacity = Capacity(), rule: Rule = Rule(),
    tokenizer: str | None = None,
) -> DataFrame:
    """Where each piece lies, with a checksum of its ids instead of them."""
    pieces = token_pieces(docs, id_col, text_col, capacity.tokens, tokenizer)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity, rule)
