"""Repair of conversation structure: turns aligned to the alternating grammar by Wagner-Fischer.

A repaired conversation's role initials are ``(s?(ua)+)?``, so each length has one target: even lengths
are ``uaua...``, odd ones the same after an ``s``. Rows are kept (0), given another role (2) or deleted
(3; blank and repeated rows must be), empty turns inserted (2); a truncated row that is not deleted
adds 1. The table holds, for rows i and up and the last r turns of a target, the least cost. Counted
from the end, targets of all lengths share their turns, so one table answers every feasible length; the
``s`` of an odd length is a kept row before which all is deleted.

A first repair in one pass over the rows gives an incumbent cost. After Ukkonen only cells are filled
that can lie on a path at most that dear: each row of surplus or shortage costs 2 at least beyond what
no repair avoids, so the band's half width is half the incumbent less the unavoidable cost. Every length
that attains the least cost is traced back, taking the ASCII-least edit at each step, and the audits are
compared. Only every ``_KEPT``-th row of the table is kept; the others are made again while tracing.

Spark sorts a conversation's rows by shuffle. They pass as single characters first (no texts), and give
an audit; then audit and rows, in the same order, pass once more to be edited as a stream. So a task
holds of a conversation one character and one 16-byte digest a row and the kept rows of the band, never
its texts. A conversation is aligned in one task.

Defined results: a null role or text is one space; rows without turn stand first; rows of one turn stand
by role, then by a digest of the text; equal rows are repeats of the first; rows without conversation
id are one conversation, with a null id; an empty table gives no rows; a conversation without rows left
has zeros, an empty audit and the hash of nothing; other columns are left out; long texts never enter
the alignment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import written

_FAR = 1 << 30
_KEPT = 256
#: One character a row: its role's initial (o: another), upper case when truncated; x: must be deleted.
GONE = "x"


def damaged(conversations: DataFrame) -> DataFrame:
    """The table with faults by crc32 of ``conv_id:turn``; rows it drops stay, marked as not ``present``."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20).alias("fault")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), told("role").alias("was"), told("text").alias("text"), fault)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "was", F.md5(F.col("text").cast("binary")).alias("tie"),
        (F.col("fault") != 0).alias("present"), F.when(F.col("fault") == 4, "user").otherwise(F.col("was")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def repaired(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, rows): what is wrong with each conversation and its cheapest edits, and its repaired turns.

    ``turns`` as `damaged` gives them: conv_id, turn, role, text, present, and was, tie, copy for order."""
    audits = written(_audits(turns), "turn-audits")
    return audits, _edited(turns, audits, "conv_id long, place long, role string, text string", _as_rows)


def repair_digests(turns: DataFrame) -> DataFrame:
    """The audits, each with the SHA-256 of the repaired conversation's ``role:text`` lines."""
    audits = written(_audits(turns), "turn-audits")
    hashes = _edited(turns, audits, "conv_id long, repaired_sha256 string", _as_hashes)
    hashes = hashes.withColumnRenamed("conv_id", "id")
    return audits.join(hashes, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "was", "tie", "copy")


def _audits(turns: DataFrame) -> DataFrame:
    seen = lambda c: F.when(F.col("present"), c)
    solid = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    rows = turns.select(
        "conv_id", "turn", "was", "tie", "copy", "present", seen(F.substring("role", 1, 1)).alias("initial"), seen(solid == "").alias("blank"),
        seen(~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("truncated"),
        seen(F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))).alias("digest"))
    names = ["conv_id", "turn", "present", "initial", "blank", "truncated", "digest"]
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: _Talk | None = None
        for batch in batches:
            done = []
            for conv, *row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if talk is None or talk.conv != conv:
                    if talk is not None:
                        done.append(talk.result())
                    talk = _Talk(conv)
                talk.add(*row)
            yield _batch(done, schema)
        if talk is not None:
            yield _batch([talk.result()], schema)

    return _in_order(rows).select(*names).mapInArrow(audit, schema)


_ARROW = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


class _Talk:
    """What one conversation's rows say, in order."""

    def __init__(self, conv: int | None):
        self.conv, self.codes, self.seen = conv, [], set()
        self.low = self.high = self.before = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, present: bool, initial: str, blank: bool, truncated: bool, digest: bytes) -> None:
        if not present:
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        code = initial if initial in ("s", "u", "a") else "o"
        if blank:
            self.blank, code = self.blank + 1, GONE
        elif digest in self.seen:
            self.duplicate, code = self.duplicate + 1, GONE
        elif truncated:
            self.truncated, code = self.truncated + 1, code.upper()
        self.seen.add(digest)
        self.codes.append(code)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *cheapest("".join(self.codes)))


def cheapest(codes: str) -> tuple[int, str]:
    """The least cost of a repair and its ASCII-least audit."""
    return _short(codes) if len(codes) <= 32 else _align(codes)


def _incumbent(codes: str) -> int:
    """The cost of a valid repair made in one pass; deleting all is another."""
    cost, at, first = 0, 0, True  # at: 0 expects u, 1 expects a
    for code in codes:
        if code == GONE:
            cost += 3
            continue
        cost += code.isupper()
        if first and code in "sS":
            first = False
            continue
        first = False
        role = code.lower()
        if role not in "ua":
            cost += 2
            at ^= 1
        elif role == "ua"[at]:
            at ^= 1
        else:  # the missing turn is inserted, then this one kept
            cost += 2
    whole = cost + 2 * at
    if codes.strip(GONE)[:1] in ("s", "S") and sum(c != GONE for c in codes) == 1:
        whole += 4  # a lone s has u and a inserted after it
    return min(whole, 3 * len(codes))


def _align(codes: str) -> tuple[int, str]:
    n = len(codes)
    extra = [int(c.isupper()) for c in codes]
    live = np.cumsum([0, *(c != GONE for c in reversed(codes))])[::-1].tolist()  # rows from i on that may stay
    unavoidable = sum(3 if c == GONE else e for c, e in zip(codes, extra, strict=True))
    width = (_incumbent(codes) - unavoidable) // 2
    lows = [max(0, k - width) for k in live]
    steps = 2 * np.arange(live[0] + width + 2, dtype=np.int64)

    def up_from(i: int, after: np.ndarray) -> np.ndarray:
        """Row i of the table, over r in its band, from row i + 1."""
        low, high, low_after = lows[i], live[i] + width, lows[i + 1]
        row = np.full(high - low + 1, _FAR, np.int64)
        shared = slice(max(low, low_after), live[i + 1] + width + 1)
        row[shared.start - low : shared.stop - low] = after[shared.start - low_after : shared.stop - low_after] + 3
        if codes[i] != GONE:
            start = max(low, low_after + 1)  # this row is the first of the last r turns: u where r is even
            stay = after[start - 1 - low_after : high - low_after].copy()
            role = codes[i].lower()
            cost = np.full(len(stay), 2)
            if role in "ua":
                cost[(start + (role == "a")) % 2 :: 2] = 0
            stay += cost + extra[i]
            part = row[start - low : start - low + len(stay)]
            np.minimum(part, stay, out=part)
        slope = steps[: len(row)]
        return np.minimum.accumulate(row - slope) + slope  # insertions

    table = {n: steps[: width + 1].copy()}  # live[n] is 0: what is left must be inserted
    row = table[n]
    heads: dict[int, list[tuple[int, int]]] = {}  # pairs of turns -> (cost with row i as the kept s, i)
    dear = _FAR
    for i in range(n - 1, -1, -1):
        if codes[i] in "sS":
            low = lows[i + 1]
            for r in range(max(2, low + low % 2), low + len(row), 2):
                cost = 3 * i + extra[i] + int(row[r - low])
                if cost < _FAR:
                    heads.setdefault(r, []).append((cost, i))
                    dear = min(dear, cost)
        row = up_from(i, row)
        if i % _KEPT == 0:
            table[i] = row
    low = lows[0]
    even = {r: int(row[r - low]) for r in range(low + low % 2, low + len(row), 2)}
    best = min([dear, *even.values()])
    traces = [_Trace(r, None) for r, cost in even.items() if cost == best]
    traces += [_Trace(r, max(i for cost, i in at if cost == best)) for r, at in heads.items() if min(at)[0] == best]
    for start in range(0, n, _KEPT):
        stop = min(start + _KEPT, n)
        rows = {stop: table[stop]}
        for i in range(stop - 1, start - 1, -1):
            rows[i] = up_from(i, rows[i + 1])
        for trace in traces:
            trace.follow(codes, extra, rows, lows, start, stop)
        least = min(t.text() for t in traces)
        traces = [t for t in traces if least.startswith(t.text()) or t.text().startswith(least)]
    return best, min(t.text() + "I" * t.left for t in traces)


_short = lru_cache(maxsize=200_000)(_align)


class _Trace:
    """The ASCII-least audit (D, I, K, R) of one target length, from the front.

    Of several rows that might be the kept s at equal cost, the last leaves the longest run of D."""

    def __init__(self, turns: int, head: int | None):
        self.left, self.head, self.audit = turns, head, []

    def text(self) -> str:
        return "".join(self.audit)

    def follow(self, codes: str, extra: list[int], rows: dict[int, np.ndarray], lows: list[int], start: int, stop: int) -> None:
        def cost(i: int, r: int) -> int:
            return int(rows[i][r - lows[i]]) if 0 <= r - lows[i] < len(rows[i]) else _FAR

        i = start
        while i < stop:
            if self.head is not None and i <= self.head:
                self.audit.append("K" if i == self.head else "D")
                i += 1
                continue
            here = cost(i, self.left)
            if cost(i + 1, self.left) + 3 == here:
                self.audit.append("D")
                i += 1
            elif self.left and cost(i, self.left - 1) + 2 == here:
                self.audit.append("I")
                self.left -= 1
            else:
                self.audit.append("K" if codes[i].lower() == "ua"[self.left % 2] else "R")
                self.left -= 1
                i += 1


def _edited(turns: DataFrame, audits: DataFrame, schema: str, sink) -> DataFrame:
    """Audits and rows meet by shuffle, the audit first, and pass as a stream."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("was"), none("string").alias("tie"),
                          none("int").alias("copy"), none("string").alias("role"), F.col("audit").alias("text"))
    rows = turns.where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "was", "tie", "copy", "role", "text")
    ordered = _in_order(heads.unionByName(rows), "kind").select("conv_id", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sink(_replayed(batches), schema)

    return ordered.mapInArrow(run, schema)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of repaired turns; first (conv_id, None, None) for each conversation."""
    conv, audit, at, made, lead = None, "", 0, 0, 0

    def wanted() -> str:
        return "assistant" if (made - lead) % 2 else "user"

    for batch in batches:
        for new, kind, role, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if kind == 0:
                for _ in audit[at:]:  # insertions after the last row
                    yield conv, wanted(), ""
                    made += 1
                conv, audit, at, made, lead = new, text, 0, 0, 0
                yield conv, None, None
                continue
            while audit[at] == "I":
                yield conv, wanted(), ""
                at, made = at + 1, made + 1
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            lead = lead or int(not made and edit == "K" and role[:1] == "s")
            yield conv, role if edit == "K" else wanted(), text
            made += 1
    for _ in audit[at:]:
        yield conv, wanted(), ""
        made += 1


def _as_rows(turns: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    held, size, place = [], 0, 0
    for conv, role, text in turns:
        if role is None:
            place = 0
            continue
        held.append((conv, place, role, text))
        place, size = place + 1, size + len(text)
        if size > 1 << 22 or len(held) >= 4096:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _as_hashes(turns: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    held, conv, running, some = [], None, None, False
    for new, role, text in turns:
        if role is None:
            if running is not None:
                held.append((conv, running.hexdigest()))
            conv, running, some = new, hashlib.sha256(), False
            if len(held) >= 4096:
                yield _batch(held, schema)
                held = []
            continue
        running.update(f"{chr(10) if some else ''}{role}:{text}".encode())
        some = True
    if running is not None:
        held.append((conv, running.hexdigest()))
    yield _batch(held, schema)
