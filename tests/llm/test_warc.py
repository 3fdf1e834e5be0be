import base64
import gzip
import hashlib

import pytest

from netloom.llm.warc import Records, archive_pages, gzip_member, normalise, parse_record


def record(n, payload):
    return b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, len(payload), payload)


PAYLOADS = [b"", b"\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\n", bytes(range(256)) * 300, b"x" * 100_000]


@pytest.mark.parametrize("layout", ["one", "each", "mixed"])
def test_every_record_becomes_a_member(layout):
    records = [record(n, p) for n, p in enumerate(PAYLOADS)]
    if layout == "one":
        stream = gzip.compress(b"".join(records))
    elif layout == "each":
        stream = b"".join(map(gzip_member, records))
    else:
        stream = gzip.compress(b"".join(records[:3]) + records[3][:50]) + gzip.compress(records[3][50:] + records[4]) + b"\0\0"
    out, at = list(normalise(stream)), 0
    for (offset, member, fields), n, payload in zip(out, range(9), PAYLOADS):
        assert offset == at and fields["warc-record-id"] == f"<urn:page:{n}>"
        at += len(member)
        assert parse_record(gzip.decompress(member))[1] == payload
    assert len(out) == len(PAYLOADS)


def test_a_cut_archive_is_an_error():
    with pytest.raises(ValueError, match="inside a record"):
        list(normalise(gzip.compress(record(1, b"abc")[:-9])))
    with pytest.raises(ValueError, match="no record"):
        list(Records().feed(b"junk\r\n\r\n"))


def expected(rows, least):
    out, top = [], {}
    for i, _, html in rows:
        top[html or ""] = max([x for x in (top.get(html or ""), i) if x is not None], default=None)
    for i, _, html in rows:
        data = (html or "").encode()
        leader = top[html or ""] if len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if leader == i else "revisit", None if leader == i else leader))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, least):
    rows = [(n, f"http://x/{n}", f"<p>page {n % 7} é\r\n\r\n</p>") for n in range(40)]
    rows += [(100, None, None), (101, "a\r\nb", ""), (102, "u", None), (103, "u", "abc"), (104, "u", "abc"), (105, "u", "\0WARC/1.1\r\n"), (None, "u", "none")]
    rows += [(200, "u", "twice"), (200, "u", "twice"), (201, "u", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, sha string, value int")
    got = archive_pages(df, least).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(rows, least)
    assert {r.url for r in got if r.page_id == 101} == {"a b"}


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
