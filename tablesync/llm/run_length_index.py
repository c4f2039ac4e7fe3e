"""Removing long repeats with a run-length Burrows-Wheeler index.

A byte goes if a string of ``length`` bytes over it also starts anywhere else, in any document.

Equal strings are brought together by minimizers: of the grams (64 bytes, at the usual length) in
every window of ``length`` bytes the one of least hash is the window's anchor, so equal windows have
equal anchors at equal places, and other text seldom has the same. The windows of one anchor are one
region of a document. Regions are counted by content first: one that occurs twice is all repeat. Only
anchors that still have several distinct regions are indexed, each region once however often it occurs.

Regions are indexed in shards of about ``shard_bytes``. An anchor whose distinct regions hold more is
refined: its windows are dealt to two intervals by how far before the anchor they start, and keyed by
the bytes that all windows of the interval contain, which equal windows share; pieces are counted by
content again, and so on, until every key's pieces fit a shard or are the same. An interval of one
window has equal pieces only, so this ends after as many rounds as the length has binary digits.

The index of a shard is the run-compressed Burrows-Wheeler transform of its regions: of each run the
symbol, the first row, where the run's first row goes by one step back, and the text places of its
first and last rows. The sorted order itself is thrown away. Every region is then streamed over the
runs, backwards from its end, with its matching statistics against all other places: the longest match
above and below its row. While its row lies within a run a match grows by the byte read; at a run's
edge the neighbour is the end of the nearest run of the same symbol, whose sample says where to measure
again. Places with a match of ``length`` or more are marked. All regions of a shard step together.

Whole copies are one document to all of this.

Defined results: a null text is empty; documents shorter than ``length`` bytes lose nothing and
repeat nothing; overlaps count, also within a document; rows of equal texts are copies of each other
whatever their ids, and ids may be null or name several texts, as rows are told apart by content;
an empty table gives no rows; other columns are left out. Contents, regions and windows are compared
by 128 bits of hash. A shard takes some 60 bytes of memory a byte; places and rows have 32 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import parts_for, with_facts, written

GRAM = 16
#: Rows of a counted table (regions or stretches, some 50 bytes each) up to which it is broadcast and
#: texts stay where they are; beyond, they are joined by shuffle.
BROADCAST_ROWS = 20_000
_ODD = np.random.default_rng(77).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITIONS = 1 << 22  # windows handled at once; places in them fit the low 24 bits of a key
_LOW = np.uint64((1 << 24) - 1)


def gram_of(length: int) -> int:
    """Bytes of a gram: long enough that chance does not repeat it, short against the window."""
    return GRAM * max(1, min(4, length // 100))


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, first and last window of each region, and where the anchors stand."""
    found: list[tuple[np.ndarray, ...]] = []
    windows, gram = len(raw) - length + 1, gram_of(length)
    for at in range(0, max(windows, 0), _POSITIONS):
        n = min(_POSITIONS, windows - at)
        own = np.frombuffer(raw, np.uint8, n + length - 1, at)
        words = np.lib.stride_tricks.as_strided(own[: len(own) - 7].view(), (len(own) - 7, 8), (1, 1))
        words = np.ascontiguousarray(words).view("<u8").ravel()
        short = words[: len(own) - GRAM + 1] * _ODD[0] + words[8 : len(own) - 7] * _ODD[1]
        short ^= short >> np.uint64(32)
        count = len(own) - gram + 1
        grams = short[:count] * _ODD[2]
        for i in range(GRAM, gram, GRAM):
            grams += short[i : i + count] * _ODD[2 + i // GRAM]
        grams ^= grams >> np.uint64(29)
        grams *= _ODD[7]
        keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)  # by hash, then leftmost
        wide = length - gram + 1
        padded = np.full(-(-len(keys) // wide) * wide, np.uint64(2**64 - 1))
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n])
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        last = np.append(first[1:], n) - 1
        place = (least[first] & _LOW).astype(np.int64)
        found.append((grams[place], at + first, at + last, at + place))
    if not found:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _documents(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n_bytes, sha256, two hashes of the content, and its regions (of a content's first row in a task)."""
    schema = "id long, n_bytes long, sha string, c1 long, c2 long, ah array<long>, rd array<long>, start array<long>, size array<int>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows = []
                for value in part.column(1):
                    raw = (value.as_py() or "").encode("utf-8", "replace")
                    sha = hashlib.sha256(raw)
                    content = tuple(np.frombuffer(sha.digest()[:16], ">i8").tolist())
                    row = [len(raw), sha.hexdigest(), *content, None, None, None, None]
                    if content not in seen:
                        seen.add(content)
                        ah, first, last, _ = anchors(raw, length)
                        ends = last + length
                        rd = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)], np.uint64)
                        row[4:] = ah.view(np.int64), rd.view(np.int64), first, (ends - first).astype(np.int32)
                    rows.append(row)
                n, sha, c1, c2, ah, rd, start, size = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.array(ah, longs), pa.array(rd, longs), pa.array(start, longs), pa.array(size, ints)],
                    names=["id", "n_bytes", "sha", "c1", "c2", "ah", "rd", "start", "size"])

    return written(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(measure, schema), "repeat-regions")


def suffix_order(text: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of what stands there up to the region's end (``room`` bytes), by doubling;
    equal ones in the order of their places."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key <<= 9
        key[: n - i] += np.where(room[: n - i] > i, text[i:].astype(np.int64) + 1, 0)
    order = np.argsort(key, kind="stable").astype(np.int32)
    sorted_ = key[order]
    group = np.maximum.accumulate(np.where(np.append(True, sorted_[1:] != sorted_[:-1]), np.arange(n), 0))  # each row's first equal
    rank, width = np.empty(n, np.int64), 7
    rank[order] = group
    while width < depth:
        alone = np.append(group[1:] == np.arange(1, n), True) & (group == np.arange(n))
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        own = order[rows]
        after = np.where(room[own] > width, rank[np.minimum(own + width, n - 1)] + 1, 0)
        key = group[rows] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        key, own = key[by], own[by]
        order[rows] = own
        group[rows] = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), rows, 0))
        rank[own] = group[rows]
        width *= 2
    return order


class RunLengthIndex:
    """The run-compressed transform of some regions, with samples at run ends."""

    def __init__(self, regions: list[bytes]):
        sizes = np.array([len(r) for r in regions], np.int64)
        self.text = np.frombuffer(b"".join(regions), np.uint8)
        self.ends = np.cumsum(sizes).astype(np.int32)
        self.starts = (self.ends - sizes).astype(np.int32)
        n, many = len(self.text), len(regions)
        self.room = np.repeat(self.ends, sizes) - np.arange(n, dtype=np.int32)
        order = suffix_order(self.text, self.room, int(sizes.max()))
        place = np.concatenate([self.ends, order])  # the first rows are the empty suffixes of the regions
        begins = np.zeros(n + 1, bool)
        begins[self.starts] = True
        first = np.append(np.zeros(many, bool), begins[order])
        symbol = self.text[np.maximum(place - 1, 0)].astype(np.int16)
        symbol[first] = -1  # what stands before a region's first byte: a run of its own
        head = np.append(True, (symbol[1:] != symbol[:-1]) | first[1:])
        at = np.flatnonzero(head)
        self.row = at.astype(np.int32)
        self.size = np.diff(np.append(at, n + many)).astype(np.int32)
        self.symbol = symbol[at]
        self.first_place, self.last_place = place[at], place[at + self.size - 1]
        # one step back: rows are ordered by symbol, then by the run they come from
        by_symbol = np.argsort(self.symbol, kind="stable")
        counted = np.cumsum(self.size[by_symbol]) - self.size[by_symbol]
        starts_of_regions = int((self.symbol == -1).sum())
        self.back = np.empty(len(at), np.int32)
        self.back[by_symbol] = counted - starts_of_regions + many
        same = self.symbol[by_symbol][1:] == self.symbol[by_symbol][:-1]
        self.above, self.below = np.full(len(at), -1, np.int32), np.full(len(at), -1, np.int32)
        self.above[by_symbol[1:][same]] = by_symbol[:-1][same]
        self.below[by_symbol[:-1][same]] = by_symbol[1:][same]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the places a and b have in common before a region ends."""
        most = np.minimum(self.room[a], self.room[b])
        total = np.zeros(len(a), np.int32)
        going, step = np.arange(len(a)), 8
        offsets = np.arange(64, dtype=np.int32)
        last = len(self.text) - 1
        while len(going):
            x, y = (a[going] + total[going])[:, None] + offsets[:step], (b[going] + total[going])[:, None] + offsets[:step]
            same = self.text[np.minimum(x, last)] == self.text[np.minimum(y, last)]
            run = np.where(same.all(axis=1), step, same.argmin(axis=1))
            total[going] = np.minimum(total[going] + run, most[going])
            going = going[(run == step) & (total[going] < most[going])]
            step = 64
        return total

    def stream(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(regions, from, to) of the bytes under matches of ``length`` or more with another place."""
        many = len(self.ends)
        lane = np.arange(many)  # each region is a lane; those read to their first byte leave
        row, place = np.arange(many, dtype=np.int32), self.ends.copy()
        up, down = np.zeros(many, np.int32), np.zeros(many, np.int32)  # lengths of the matches above and below
        up_at, down_at = np.zeros(many, np.int32), np.zeros(many, np.int32)
        low, high = np.full(many, -1, np.int32), np.full(many, -1, np.int32)  # the marked stretch that is still growing
        while len(lane):
            run = np.searchsorted(self.row, row, "right") - 1
            inside_up, inside_down = row > self.row[run], row < self.row[run] + self.size[run] - 1
            row = self.back[run] + (row - self.row[run])
            place = place - 1
            up, up_at = self._step(up, up_at, inside_up, self.above[run], self.last_place, place)
            down, down_at = self._step(down, down_at, inside_down, self.below[run], self.first_place, place)
            match = np.maximum(up, down)
            found = match >= length
            end = place + match
            apart = found & (low >= 0) & (end < low)
            if apart.any():
                yield lane[apart], low[apart] - self.starts[lane[apart]], high[apart] - self.starts[lane[apart]]
            high = np.where(found, np.where(apart | (low < 0), end, np.maximum(high, end)), high)
            low = np.where(found, place, low)
            done = place == self.starts[lane]
            if done.any():
                last = done & (low >= 0)
                yield lane[last], low[last] - self.starts[lane[last]], high[last] - self.starts[lane[last]]
                lane, row, place, up, up_at, down, down_at, low, high = (
                    x[~done] for x in (lane, row, place, up, up_at, down, down_at, low, high))

    def _step(self, match, at, inside, near, sample, place):
        """Inside a run the neighbour is preceded by the same byte; at its edge it is the end of the nearest such run."""
        match, at = np.where(inside, match + 1, 0), at - 1
        jump = ~inside & (near >= 0)
        at[jump] = sample[near[jump]] - 1
        match[jump] = self.common(place[jump], at[jump])
        return match, at


def repeats(regions: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Stretches (region, from, to) of the regions whose windows of ``length`` occur twice or more among them."""
    regions_at = [i for i, r in enumerate(regions) if r]
    if not regions_at:
        return []
    found = []
    for lane, low, high in RunLengthIndex([regions[i] for i in regions_at]).stream(length):
        found += zip([regions_at[i] for i in lane.tolist()], low.tolist(), high.tolist(), strict=True)
    return found


def _regions(every: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("ah", "rd", "start", "size")).alias("r")
    return every.where("size(ah) > 0").select("c1", "c2", "id", zipped).select("c1", "c2", "id", "r.ah", "r.rd", "r.start", "r.size")


def _repeated(places: DataFrame, total: int) -> DataFrame:
    """The regions whose anchor occurs twice or more: others repeat nothing."""
    seen = written(places.groupBy("ah").agg(F.count("*").alias("times")).where("times > 1"), "region-anchors", large=True)
    return written(with_facts(places, seen, ["ah"], "times", total).drop("times"), "region-places", large=True)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and the two hashes of its content, as in ``_documents``."""
    sha = F.sha2(F.col(text_col).cast("binary"), 256)
    c1, c2 = (F.conv(F.substring(sha, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "c1"), (17, "c2")))
    return docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), c1, c2)


def _sent(side: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side.hint("shuffle_hash")


def _bytes_of(docs: DataFrame, wanted: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(ah, rd, hot, bytes) of the regions ``wanted`` (c1, id, ah, rd, start, size, hot), cut out of their documents.

    Rows that repeat both id and text give their regions once in each task."""
    lists = wanted.groupBy("c1", F.col("id").alias("own")).agg(F.collect_list(F.struct("ah", "rd", "start", "size", "hot")).alias("cuts"))
    texts, lists = _texts(docs, id_col, text_col).alias("t"), _sent(lists, rows).alias("l")
    same = (F.col("t.c1") == F.col("l.c1")) & F.col("id").eqNullSafe(F.col("own"))
    joined = texts.join(lists, same).select("t.c1", "id", "text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int | None]] = set()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                ah, rd, hot, own = [], [], [], []
                for c1, own_id, text, cuts in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns), strict=True):
                    if (c1, own_id) in seen:
                        continue
                    seen.add((c1, own_id))
                    raw = text.encode("utf-8", "replace")
                    for c in cuts:
                        ah.append(c["ah"])
                        rd.append(c["rd"])
                        hot.append(c["hot"])
                        own.append(raw[c["start"] : c["start"] + c["size"]])
                yield pa.RecordBatch.from_arrays([pa.array(ah, pa.int64()), pa.array(rd, pa.int64()), pa.array(hot, pa.bool_()), pa.array(own, pa.binary())], names=["ah", "rd", "hot", "bytes"])

    return joined.mapInArrow(cut, "ah long, rd long, hot boolean, bytes binary")


_PIECE = "key long, lo int, hi int, at int, ah long, rd long, off int, pd long, bytes binary"


def _halved(pieces: DataFrame, length: int) -> DataFrame:
    """Pieces dealt to the halves of their interval. A window is told by how many bytes before the anchor it starts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, lo, hi, at, ah, rd, off, _, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None:  # a whole region, as it comes
                    at = anchors(raw, length)[3][0]
                middle = (lo + hi + 1) // 2
                for first, last in ((lo, middle - 1), (middle, hi)):
                    near, far = max(first, at - (len(raw) - length)), min(last, at)
                    if near > far:
                        continue
                    piece, core = raw[at - far : at - near + length], raw[at - first : at - last + length]
                    own = xxhash.xxh3_64_intdigest(core, (key + first) % 2**64)
                    rows.append((own, first, last, far, ah, rd, off + at - far, xxhash.xxh3_64_intdigest(piece), piece))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            for i in (0, 7):
                columns[i] = np.array(columns[i], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE_TYPE, strict=True)], schema=_PIECE_TYPE)

    return pieces.select(*_PIECE_TYPE.names).mapInArrow(split, _PIECE)


_PIECE_TYPE = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]]) for f in _PIECE.split(", ")])


def _dealt(kinds: DataFrame, key: str, size: str, shard_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows whose key has several of them and fits a shard, rows whose key does not fit, how many such keys).

    Keys that do not fit are counted, and at most one to ``shard_bytes``."""
    totals = kinds.groupBy(key).agg(F.count("*").alias("kinds"), F.sum(size).alias("key_bytes")).where("kinds > 1")
    totals = written(totals, "region-keys", large=True)
    hot = totals.where(F.col("key_bytes") > shard_bytes).select(key)
    n = hot.count()
    hot = F.broadcast(hot) if n <= BROADCAST_ROWS else hot.hint("shuffle_hash")
    cool = totals.where(F.col("key_bytes") <= shard_bytes).select(key)
    return kinds.join(hot, key, "left_anti").join(cool, key, "left_semi"), kinds.join(hot, key, "left_semi"), n


def _stretches(docs: DataFrame, places: DataFrame, length: int, bucket_bytes: int, shard_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(ah, rd, from, to): the repeated stretches of each distinct region."""
    kinds = written(
        places.groupBy("ah", "rd").agg(F.count("*").alias("n"), F.min(F.struct("c1", "id", "start", "size")).alias("one")), "region-kinds", large=True)
    marks = [kinds.where("n > 1").select("ah", "rd", F.lit(0).alias("from"), F.col("one.size").alias("to"))]
    cool, hot, n_hot = _dealt(kinds, "ah", "one.size", shard_bytes)
    columns = ["one.c1", "one.id", "ah", "rd", "one.start", "one.size"]
    pieces = []
    wanted = written(cool.select(*columns, F.lit(False).alias("hot")).unionByName(hot.select(*columns, F.lit(True).alias("hot"))), "regions-wanted", large=True)
    rows, total = wanted.agg(F.count("*"), F.sum("size")).first()
    texts = written(_bytes_of(docs, wanted, rows, id_col, text_col), "region-bytes", large=True)
    pieces.append(texts.where("not hot").select(F.col("ah").alias("key"), "ah", "rd", F.lit(0).alias("off"), "bytes"))
    none = lambda kind: F.lit(None).cast(kind)
    hot = texts.where("hot").dropDuplicates(["ah", "rd"]).select(
        F.col("ah").alias("key"), F.lit(0).alias("lo"), F.lit(length - gram_of(length)).alias("hi"), none("int").alias("at"),
        "ah", "rd", F.lit(0).alias("off"), none("long").alias("pd"), "bytes")
    while n_hot:
        halves = written(_halved(hot, length), "region-halves")
        same = halves.groupBy("key", "pd").agg(
            F.count("*").alias("n"), *[F.any_value(c).alias(c) for c in ("lo", "hi", "at", "bytes")],
            F.min(F.struct("ah", "rd", "off")).alias("one"))
        same = same.select("key", "lo", "hi", "at", "one.ah", "one.rd", "one.off", "pd", "bytes", "n", F.octet_length("bytes").alias("size"))
        same = written(same, "region-pieces", large=True)
        again = same.where("n > 1").select("key", "pd")
        of_these = halves.join(_sent(again, again.count()), ["key", "pd"], "left_semi")
        marks.append(of_these.select("ah", "rd", F.col("off").alias("from"), (F.col("off") + F.octet_length("bytes")).alias("to")))
        cool, hot, n_hot = _dealt(same, "key", "size", shard_bytes)
        pieces.append(cool.select("key", "ah", "rd", "off", "bytes"))

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["key", "ah", "rd", "off"]).sort_values(["key", "ah", "rd", "off"]).reset_index(drop=True)
        size = frame["bytes"].str.len().to_numpy(np.int64)
        key = frame["key"].to_numpy()
        found, start = [], 0
        shard = np.cumsum(size) // shard_bytes
        cuts = np.flatnonzero((key[1:] != key[:-1]) & (shard[1:] != shard[:-1])) + 1  # a key is never cut
        for stop in [*cuts.tolist(), len(frame)]:
            found += [(start + i, a, b) for i, a, b in repeats(frame["bytes"].iloc[start:stop].tolist(), length)]
            start = stop
        at = [x[0] for x in found]
        off = frame["off"].to_numpy(np.int64)[at]
        return pd.DataFrame({
            "ah": frame["ah"].to_numpy()[at], "rd": frame["rd"].to_numpy()[at],
            "from": off + [x[1] for x in found], "to": off + [x[2] for x in found]}).astype("int64")

    whole = pieces[0]
    for more in pieces[1:]:
        whole = whole.unionByName(more)
    buckets = parts_for(int(total or 0), bucket_bytes)
    keyed = whole.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    found = keyed.groupBy("bucket").applyInPandas(index, "ah long, rd long, from int, to int")
    for more in marks:
        found = found.unionByName(more)
    return found


def without_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 1 << 20,
    shard_bytes: int = 1 << 20, texts: bool = True,
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, with ``texts``, ``kept`` (null: the whole
    text, unchanged)."""
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    every = _documents(docs, length, id_col, text_col)
    copies = written(every.groupBy("c1", "c2").agg(F.count("*").alias("copies")), "content-classes")
    # Copies first met in several tasks count as several; their regions are then whole repeats, as all of a copy is.
    places = _repeated(_regions(every), every.agg(F.sum(F.size("ah"))).first()[0] or 0)
    marks = written(_stretches(docs, places, length, bucket_bytes, shard_bytes, id_col, text_col), "stretches", large=True)
    marks_by_region = marks.distinct()
    marked = places.join(_sent(marks_by_region, marks.count()), ["ah", "rd"])
    marked = marked.select("c1", "c2", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
    by_content = marked.groupBy("c1", "c2").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    # all of a copy goes, so what is left has one row for each content
    by_content = by_content.join(copies.where("copies > 1"), ["c1", "c2"], "left_anti")
    by_document = written(by_content, "document-stretches", large=True)
    spans = by_document.agg(F.sum(F.size("spans"))).first()[0] or 0
    joined = _texts(docs, id_col, text_col).join(_sent(by_document, spans), ["c1", "c2"]).select("c1", "c2", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                rows = []
                for text, spans in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    raw, kept, end, runs = text.encode("utf-8", "replace"), [], 0, 0
                    for a, b in sorted((s["from"], s["to"]) for s in spans):
                        if a > end or not runs:
                            kept.append(raw[end:a])
                            runs += 1
                        end = max(end, b)
                    left = b"".join([*kept, raw[end:]])
                    rows.append((len(raw) - len(left), runs, hashlib.sha256(left).hexdigest(), left if texts else None))
                removed, runs, sha, left = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha), pa.array(left, pa.binary())],
                    names=["c1", "c2", "n_removed", "n_spans", "kept_sha256", "kept"])

    cut = joined.mapInArrow(remove, "c1 long, c2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    # what is known of a content; one that very many rows have is a whole copy, or short, and holds no text here
    facts = written(copies.join(cut, ["c1", "c2"], "left"), "content-results", large=True)
    rows = with_facts(every.select("id", "n_bytes", "sha", "c1", "c2"), facts, ["c1", "c2"], "copies", facts.agg(F.sum("copies")).first()[0] or 0)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return rows.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if texts else []))
