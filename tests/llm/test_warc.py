import gzip
import hashlib
import json
import zlib

import pytest

from pagequarry.llm import warc
from pagequarry.session import Workspace

BIG, OTHER = b"<html>" + b"a" * 2000, b"<html>" + bytes(range(256)) * 5
PAGES = [
    (1, "https://a/1", BIG), (2, "https://a/2", BIG), (3, "https://a/3", BIG), (4, None, OTHER), (5, "u\r\nv", OTHER),
    (6, "s", b"short"), (7, "s", b"short"), (8, "n", None), (9, "e", b""), (10, "w", b"WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
    (11, "l", b"x" * 3_000_000), (None, "no id", b"z" * 1500), (3, "https://a/3", BIG),
]
SHAPE = "page_id long, url string, payload binary, digest int"


def archived(spark, rows, **options):
    ws = Workspace(spark, "test_warc")
    pages = spark.createDataFrame([(*r, 1) for r in rows], SHAPE)
    raw = ws.save(warc.write(warc.with_types(pages, ws), ws.path("raw"), **options), "files")
    return raw, ws.save(warc.normalise(raw, ws.path("members")), "member_files")


@pytest.mark.parametrize("file_bytes", [64 << 20, 3000])
def test_round_trip(spark, file_bytes):
    raw, members = archived(spark, PAGES, file_bytes=file_bytes)
    got = warc.read(members).collect()
    assert len(got) == len(PAGES) == sum(r["records"] for r in members.collect())
    last = {BIG: 3, OTHER: 5, b"x" * 3_000_000: 11}
    have = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr)
    want = []
    for page, _, payload in PAGES:
        payload = payload or b""
        first = last.get(payload, page)
        again = first != page and page is not None
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    assert have == sorted(want, key=repr)
    payloads = {r["page_id"]: r["payload"] for r in got}
    assert payloads[3] == BIG and payloads[1] is None and payloads[8] == b"" and payloads[10].startswith(b"WARC")


def test_streams_are_whole_before_and_members_after(spark):
    raw, members = archived(spark, PAGES)
    for row in raw.collect():
        data = open(row["path"].removeprefix("file:"), "rb").read()
        gz = zlib.decompressobj(31)
        text = gz.decompress(data)
        assert gz.eof and not gz.unused_data and text.count(b"WARC/1.1\r\nWARC-Type") == row["records"]
    for row in members.collect():
        data = open(row["path"].removeprefix("file:"), "rb").read()
        entries = [json.loads(x) for x in open(row["index"].removeprefix("file:"))]
        assert len(entries) == row["records"]
        whole = b""
        for entry in entries:
            one = gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]])
            headers, _ = warc.parse(one)
            assert headers["warc-record-id"] == entry["id"] and headers["warc-type"] == entry["type"]
            whole += one
        assert whole == gzip.decompress(data)


def test_normalised_archives_can_be_normalised_again(spark):
    _, members = archived(spark, PAGES)
    ws = Workspace(spark, "again")
    again = ws.save(warc.normalise(members, ws.path("members")), "files")
    assert sorted(map(repr, warc.read(again).collect())) == sorted(map(repr, warc.read(members).collect()))


def test_broken_archives_are_errors():
    import io

    data = gzip.compress(warc.record(1, "u", b"abc", "00" * 20, "response", None))
    assert len(list(warc.records_of(io.BytesIO(data + data)))) == 2
    cut = gzip.compress(warc.record(1, "u", b"abc", "00" * 20, "response", None)[:-5])
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(cut)))


def test_empty_table(spark):
    _, members = archived(spark, [])
    assert warc.read(members).collect() == []
