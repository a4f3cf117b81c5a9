"""WARC archives: exact round trip, and damage that must be noticed."""

import gzip
import hashlib
import io
import zlib

import pytest

from gridplace.llm.warc import WarcError, archive_folder, read_records, read_warc, record_bytes, through_warc, write_warc

from .rows import by_id

LONG = "<p>" + "é日" * 700
PAGES = [
    (1, "http://a", LONG), (2, "http://b", LONG), (3, None, LONG), (4, "http://d\r\nX: y", "short"), (5, "http://e", "short"), (6, "http://f", None),
    (7, "http://g", ""), (None, "http://h", LONG), (8, "http://i", "x" * 300_000), (9, "http://j", "WARC/1.1\r\n\r\n" * 200), (9, "http://j", "WARC/1.1\r\n\r\n" * 200),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, payload string, key string")


def plain(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == data and k is not None]
        top = max(same) if len(data) >= 1000 and same else i
        revisit = i is not None and top != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return out


def test_round_trip(spark):
    assert by_id(through_warc(pages(spark)).collect()) == by_id(plain(PAGES))
    assert through_warc(pages(spark, [])).collect() == []


def test_payloads_come_back_and_archives_stay_small(spark):
    archives = write_warc(pages(spark), archive_folder(spark), archive_bytes=2000)
    assert archives.count() > 1 and sum(r.records for r in archives.collect()) == len(PAGES)
    got = read_warc(archives, with_payload=True).collect()
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted((h or "").encode() for (_, _, h), p in zip(PAGES, plain(PAGES)) if p[3] == "response")


def members():
    return [record_bytes(str(i), "http://x", f"payload {i} ".encode() * 50, None, "2024-01-01T00:00:00Z", 6) for i in range(3)]


def test_one_member_per_record_and_standard_gzip():
    data = b"".join(members())
    assert [r.payload for r in read_records(io.BytesIO(data), True)] == [f"payload {i} ".encode() * 50 for i in range(3)]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3


class Drip(io.BytesIO):
    """A source that gives a few bytes at a time."""

    def read(self, size=-1):
        return super().read(min(7, size) if size > 0 else 7)


def test_blocks_of_any_size():
    assert [r.payload_bytes for r in read_records(Drip(b"".join(members())))] == [500, 500, 500]


def pack(text: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(text) + c.flush()


def test_damage_is_an_error():
    whole = members()[0]
    with pytest.raises((WarcError, zlib.error)):
        list(read_records(io.BytesIO(whole[:-20])))
    text = gzip.decompress(whole)
    for bad in (
        text.replace(b"payload 0", b"payload 9", 1),  # payload against its digests
        text.replace(b"Content-Length: 5", b"Content-Length: 4", 1),  # framing
        text + b"more",
        text[:-4],
        text.replace(b"WARC/1.1", b"WARK/1.1", 1),
    ):
        with pytest.raises(WarcError):
            list(read_records(io.BytesIO(pack(bad))))
