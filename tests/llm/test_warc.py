import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from fieldmart.llm.common import read_file
from fieldmart.llm.warc import (
    arc_head,
    arc_record,
    base32_sha1,
    convert,
    convert_arcs,
    http_response,
    page_of,
    pages_to_warc,
    parse_arc,
    parse_warc,
    read_warcs,
    record_id,
    warc_date,
    write_arcs,
)


def brute(rows, min_bytes):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    first = {}
    for page_id, data in payloads:
        if len(data) >= min_bytes and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, data in payloads:
        own = len(data) < min_bytes or first.get(data, page_id) == page_id
        kind, target = ("response", None) if own else ("revisit", first[data])
        out.append((page_id, len(data), base32_sha1(data), kind, target))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def pages(spark):
    def make(rows, partitions=4):
        return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(partitions)

    return make


ROWS = [
    (5, "http://a b/ü\n", "<p>é</p>\r\n\r\nx\n"),
    (2, None, None),
    (3, "dns:x", ""),
    (9, "http://h/", "same"),
    (-7, "http://h/2", "same"),
    (2**62 + 12345, "http://h/3", "same"),
    (None, "http://h/4", "same"),
    (None, "http://h/5", "alone"),
    (11, "", "long \n" * 200_000),
    *[(100 + i, f"http://hot/{i}", "hot page") for i in range(60)],
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_against_brute_force(pages, scratch, min_bytes):
    df = pages(ROWS).withColumns({n: F.lit("x") for n in ("part", "path", "ordinal", "digest", "rank")})
    assert found(pages_to_warc(df, scratch, f"{scratch.path}/{min_bytes}", min_bytes)) == brute(ROWS, min_bytes)


def test_repeated_rows_have_one_response(pages, scratch):
    kinds = [r.record_type for r in pages_to_warc(pages([(1, "u", "x")] * 3), scratch).collect()]
    assert sorted(kinds) == ["response", "revisit", "revisit"]


def test_empty_table(pages, scratch):
    assert pages_to_warc(pages([]), scratch, f"{scratch.path}/none").collect() == []


def test_archives_roll_and_hold_what_they_declare(pages, scratch):
    arcs = write_arcs(pages(ROWS, 2), scratch, f"{scratch.path}/legacy", roll_bytes=1000)
    assert arcs.count() > 4
    versions = set()
    for row in arcs.collect():
        data = read_file(row.path)
        for record in parse_arc(data):
            versions.add(record["version"])
            member = zlib.decompressobj(wbits=31).decompress(data[record["offset"] :])
            assert member.startswith(record["URL"].encode())
            if record["version"] == 2:
                assert int(record["Offset"]) == record["offset"] and record["Filename"] == row.path.rpartition("/")[2]
    assert versions == {1, 2}
    warcs = convert_arcs(arcs, scratch, f"{scratch.path}/converted")
    assert found(read_warcs(warcs)) == brute(ROWS, 0)
    heads = [[f for f, _ in parse_warc(read_file(r.path))] for r in warcs.collect()]
    assert all(h[0]["WARC-Type"] == "warcinfo" for h in heads)
    everything = [f for h in heads for f in h]
    assert len({f["WARC-Record-ID"] for f in everything}) == len(everything)
    assert all(f["WARC-Date"] == "2024-01-01T00:00:00Z" for f in everything)


def test_header_lines_by_version():
    for version in (1, 2):
        head = arc_head(version, "x.arc.gz", "2001")
        body = http_response(None, b"p")
        ok = arc_record(version, "http://a/", "200102", "text/html", body, 7, "x.arc.gz")
        records = list(parse_arc(gzip.compress(head) + gzip.compress(ok)))
        assert [r["Archive-date"] for r in records] == ["200102"] and records[0]["body"] == body
        short = ok.replace(f" {len(body)}\n".encode(), f" {len(body) + 9}\n".encode())
        for bad in ([short], [ok + b"more"]):
            with pytest.raises(ValueError):
                list(parse_arc(b"".join(gzip.compress(x) for x in [head, *bad])))
    with pytest.raises(ValueError):
        list(parse_arc(gzip.compress(ok)))
    with pytest.raises(ValueError):
        list(parse_arc(gzip.compress(arc_head(1, "x", "2001").replace(b"1 0 origin", b"3 0 origin"))))


def test_other_kinds_become_resources():
    record = {"body": b"127.0.0.1", "URL": "dns:a", "IP-address": "1.2.3.4", "Archive-date": "20010203040506"}
    fields, block = next(parse_warc(gzip.compress(convert(record | {"Content-type": "text/dns", "offset": 3}, "a", None, False))))
    assert fields["WARC-Type"] == "resource" and block == b"127.0.0.1" and fields["Content-Type"] == "text/dns"
    assert fields["WARC-IP-Address"] == "1.2.3.4" and fields["WARC-Date"] == "2001-02-03T04:05:06Z"


def test_identifiers_and_dates():
    for page_id in (0, 1, 2**63 - 1, -1, -(2**63), 123456789012345):
        assert page_of(record_id(page_id, "x", 1)) == page_id
    assert page_of(record_id(None, "x", 1)) is None
    assert record_id(None, "x", 1) != record_id(None, "x", 2)
    assert warc_date("1999") == "1999-01-01T00:00:00Z"
    assert warc_date("199912312359") == "1999-12-31T23:59:00Z"
