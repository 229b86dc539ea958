import gzip
import hashlib
import random

import pytest

from brinefold.llm import warc
from brinefold.llm.common import shared_path


def test_chunked_framing_round_trips():
    rng = random.Random(0)
    for size in (0, 1, 15, 16, 17, 1000):
        body = rng.randbytes(size)
        assert warc.unchunked(warc.chunked(body, 16)) == body
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_parsing_skips_what_is_malformed():
    good = warc._record("response", {"WARC-Record-ID": "<a>"}, b"WARC/1.1\r\nnot a record\r\n\r\n")
    bad = b"WARC/1.1\r\nContent-Length: 99999\r\n\r\nshort\r\n\r\n"
    found = list(warc.parse(b"noise" + good + bad + good + b"WARC/1.1\r\nX: y"))
    assert [(f["warc-record-id"], b) for f, b in found] == [("<a>", b"WARC/1.1\r\nnot a record\r\n\r\n")] * 2
    members = gzip.compress(good) + gzip.compress(good)
    assert len(list(warc.parse(members))) == 2


PAYLOADS = [
    (1, "a" * 1000), (2, "a" * 1000), (3, "a" * 999), (4, "a" * 999), (5, None), (6, ""), (7, "é" * 500), (8, "é" * 500), (9, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello" * 40), (10, "x" * 3_000_000), (11, "0\r\n\r\n" * 300),
    (12, "b" * 2000), (12, "b" * 2000), (13, "b" * 2000), (13, "b" * 2000), (None, "c" * 1500), (14, "c" * 1500), (None, "d" * 1200), (15, "\0\ud7ff\r\n" * 400),
]


def expected(rows):
    out = []
    for i, text in rows:
        payload = (text or "").encode()
        same = [j for j, t in rows if (t or "").encode() == payload and j is not None]
        revisit = len(payload) >= 1000 and same and max(same) != i
        out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_round_trip(spark, segment):
    pages = spark.createDataFrame([(i, f"http://x/{i}\r\nInjected: y", t, "clash") for i, t in PAYLOADS], "page_id long, url string, html string, digest string")
    path = shared_path(spark, "test-archives")
    warc.write(pages, path, segment_bytes=segment)
    back = warc.read(spark, path)
    full = {(None if r.page_id is None else int(r.page_id), bytes(r.payload)) for r in back.where("record_type = 'response'").collect()}
    assert full == {(i, (t or "").encode()) for i, t in PAYLOADS if (i, "response") in {(e[0], e[3]) for e in expected(PAYLOADS) if e[1] == len((t or "").encode())}}
    assert back.where("error is not null").count() == 0
    assert {r.url for r in back.where("page_id = 1").collect()} == {"http://x/1%0D%0AInjected: y"}
    got = warc.round_trip(pages)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr) == expected(PAYLOADS)


def test_damaged_segments_are_told(spark, tmp_path):
    records = list(warc.records_of(1, "u", b"x" * 5000, hashlib.sha1(b"x" * 5000).hexdigest(), None, None, 0, 1000))
    other = list(warc.records_of(2, "u", b"y" * 5000, hashlib.sha1(b"y" * 5000).hexdigest(), None, None, 0, 1000))
    wrong = list(warc.records_of(3, "u", b"z" * 10, hashlib.sha1(b"other").hexdigest(), None, None, 0, 1000))
    cut = [*records[:2], *records[3:]]
    random.Random(1).shuffle(other)
    (tmp_path / "a.warc").write_bytes(b"".join(cut[:2] + other[:3]))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(cut[2:] + other[3:] + wrong)))
    got = {int(r.page_id): (r.payload, r.error) for r in warc.read(spark, f"file://{tmp_path}").collect()}
    assert bytes(got[2][0]) == b"y" * 5000 and got[2][1] is None
    assert got[1][0] is None and "segment" in got[1][1]
    assert got[3] == (None, "digest differs")


def test_ids_of_other_types_and_addresses_of_revisits(spark):
    odd = ["a b", " x ", "é/%41", "10", "9", "", "line\r\nWARC-Type: y"]
    rows = [(i, f"http://x/{n}", "p" * 1000) for n, i in enumerate(odd)] + [(None, "http://x/null", "p" * 1000)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = warc.round_trip(pages).collect()
    last = max(odd)  # texts in their own order
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr) == sorted(((i, "response", None, 1000) if i == last else (i, "revisit", last, 1000) for i, *_ in rows), key=repr)
    (record,) = warc.records_of("a", "u", None, "d" * 40, "b", "http://x/there", 0)
    ((fields, _),) = warc.parse(record)
    assert fields["warc-refers-to-target-uri"] == "http://x/there" and fields["warc-refers-to-date"] == warc.DATE


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
