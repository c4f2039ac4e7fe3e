import hashlib
import io

import pytest

from tablesync.llm import warc
from tablesync.llm.warc import archived, archived_pages, encode_record, records_of, read_archives, write_archives
from tablesync.llm.common import written

SCHEMA = "page_id long, url string, html string, record_type string, digest string, payload int"


def page(i, html, url="http://a/b"):
    return (i, url, html, "x", None, 3)


def expected(rows):
    firsts = {}
    for i, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            firsts[raw] = min(i, firsts.get(raw, i))
    out = []
    for i, html in rows:
        raw = (html or "").encode()
        first = firsts.get(raw)
        to = first if first is not None and first != i else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_round_trip(spark):
    big, same = "<p>é😀" * 30_000, "<html>" + "y" * 200
    rows = [(5, same), (3, same), (9, same), (1, None), (2, ""), (4, "z" * 99), (6, "z" * 99), (7, "w" * 100), (8, "w" * 100), (10, big), (11, big), (12, same), (12, same)]
    rows += [(None, same), (None, "alone")]
    frame = spark.createDataFrame([page(i, h, None if i == 4 else "http://x/\r\nWARC-Type: fake ü") for i, h in rows], SCHEMA)
    got = sorted((tuple(r) for r in archived_pages(spark, frame).collect()), key=repr)
    assert got == expected(rows)
    payloads = {r.page_id: r.payload for r in archived(spark, frame).collect()}
    assert bytes(payloads[10]).decode() == big and payloads[11] is None
    assert archived_pages(spark, frame.where("false")).count() == 0


@pytest.mark.parametrize("size", [1, 37, 500, 10**6])
def test_ranges_own_each_record_once(size):
    """Whatever the ranges, also where false signs lie between and in front of the members."""
    members = [encode_record(i, "u", bytes([97 + i % 26]) * (i * 37 % 900), "d", None) for i in range(40)]
    noise = warc.MAGIC + b"junk" + warc.MAGIC * 3
    whole = noise + b"".join(m + (noise if i % 7 == 0 else b"") for i, m in enumerate(members))
    found = [
        (head["WARC-Record-ID"], len(block)) for start in range(0, len(whole), size)
        for _, head, block in warc._members(io.BytesIO(whole), start, min(len(whole), start + size))
    ]
    assert [x[0] for x in found] == [f"<urn:page:{i}>" for i in range(40)]


def test_small_ranges_on_files(spark, tmp_path):
    frame = spark.createDataFrame([page(i, f"{i} " * (i * 13 % 400)) for i in range(300)], SCHEMA)
    files = written(write_archives(records_of(frame), str(tmp_path / "w"), file_bytes=3000), "t")
    assert files.count() > 5
    got = read_archives(files, range_bytes=700).select("page_id", "full_bytes").collect()
    assert sorted(tuple(r) for r in got) == [(i, len(f"{i} " * (i * 13 % 400))) for i in range(300)]


def test_a_header_over_a_mebibyte_and_lost_records(spark, monkeypatch):
    """A url of 2 MiB that does not compress comes back, in small ranges too; a lost record is an error."""
    import random

    url = "data:" + random.Random(1).randbytes(1 << 20).hex()
    frame = spark.createDataFrame([page(1, "a" * 200, url), page(2, "b" * 200), page(3, "a" * 200)], SCHEMA)
    (row,) = [r for r in archived(spark, frame).collect() if r.page_id == 1]
    assert row.url == url and bytes(row.payload) == b"a" * 200
    assert sorted((r.page_id, r.refers_to) for r in archived_pages(spark, frame).collect()) == [(1, None), (2, None), (3, 1)]
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda files: read(files).where("page_id != 2"))
    with pytest.raises(RuntimeError):
        archived_pages(spark, frame)


def test_payloads_are_not_shuffled(spark, monkeypatch):
    """Repeated digests go to the pages; beyond the stated number the same rows come from a shuffle."""
    frame = spark.createDataFrame([page(i, f"<p>{i % 30}" * 60) for i in range(200)] + [page(None, "n" * 200), page(500, "n" * 200)], SCHEMA)

    def planned():
        rows = records_of(frame)
        return rows._jdf.queryExecution().executedPlan().toString(), sorted((tuple(r) for r in rows.collect()), key=repr)

    text, rows = planned()
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 3)
    other, again = planned()
    assert "hashpartitioning" in other and again == rows
    assert sum(r[5] is not None for r in rows) == 171
