import glob
import gzip

import pytest
from pyspark.sql import functions as F

from voltlake.llm.warc import (
    ARC_FIELDS,
    ArchiveError,
    ArcRecord,
    archive_pages,
    base32_sha1,
    convert_arc,
    read_arc,
    read_warc,
    read_warc_file,
    warc_record,
    write_arc,
)

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/x y", "<p>é</p>"), (5, "http://b", "same"), (9, None, "same"), (7, "", "same"),
    (2, "http://c", None), (3, "http://d", ""), (4, "http://e", "line\r\n\r\nWARC/1.1\r\n\n" * 3),
    (6, "http://f", "z" * 300_000), (None, "http://g", "same"), (5, "http://h", "same"),
]


def plain(rows):
    bodies = [(h or "").encode() for *_, h in rows]
    last = {}
    for (i, *_), b in zip(rows, bodies):
        last[b] = max(last.get(b, -1), -1 if i is None else i)
    out, taken = [], set()
    for (i, *_), b in zip(rows, bodies):
        first = i == last[b] and b not in taken
        taken.update([b] if first else [])
        kind = "response" if first else "revisit"
        out.append((i, len(b), base32_sha1(b), kind, None if first else last[b]))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_pages_through_both_formats(spark, folder):
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("record_type", F.lit(0)).repartition(3)
    got = [tuple(r) for r in archive_pages(pages).collect()]
    assert sorted(got, key=key) == sorted(plain(ROWS), key=key)
    assert archive_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_archives_are_whole_and_reproducible(spark, folder):
    pages = spark.createDataFrame(ROWS, PAGES).coalesce(1)
    write_arc(pages, folder("arc"))
    for name in ("w1", "w2"):
        convert_arc(spark, folder("arc"), folder(name), "X-Page-Id")
    records = []
    for name in ("w1", "w2"):
        found = []
        for file in sorted(glob.glob(f"{folder(name)}/part-*")):
            with open(file, "rb") as f:
                found += list(read_warc_file(f.read()))
        records.append(found)
    assert records[0] == records[1]
    records[0] = [r for r in records[0] if r[0]["warc-type"] != "warcinfo"]
    assert len({r["warc-record-id"] for r, _ in records[0]}) == len(ROWS)
    for fields, block in records[0]:
        assert fields["warc-block-digest"] == f"sha1:{base32_sha1(block)}"
        assert int(fields["content-length"]) == len(block)
    assert all(r["intact"] for r in read_warc(spark, folder("w1")).collect())
    named = {r["warc-record-id"] for r, _ in records[0] if r["warc-type"] == "response"}
    assert {r["warc-refers-to"] for r, _ in records[0] if r["warc-type"] == "revisit"} <= named


def arc(version, *records):
    block = f"{version} 0 test\n{ARC_FIELDS[version]}\n".encode()
    head = f"filedesc://t.arc 0.0.0.0 20200102030405 text/plain {len(block)}\n".encode()
    return head + block + b"".join(b"\n" + r for r in records)


def test_versions_gaps_and_other_content():
    one = arc(1, b"dns:a 1.2.3.4 20200102 text/dns 3\nabc", b"http://x 1.2.3.4 20200102030405 t/h 2\nhi\n\n")
    two = arc(2, b"http://x 1.2.3.4 20200102030405 t/h 200 - - 0 t.arc 5\na\nb c")
    assert [r.body for r in read_arc(one)] == [b"abc", b"hi"]
    assert [r.body for r in read_arc(gzip.compress(two[:90]) + gzip.compress(two[90:]))] == [b"a\nb c"]
    record = next(read_arc(one))
    fields, block = next(read_warc_file(warc_record(record, None)))
    assert (fields["warc-type"], fields["warc-date"], block) == ("resource", "2020-01-02T00:00:00Z", b"abc")
    assert fields["warc-ip-address"] == "1.2.3.4" and fields["content-type"] == "text/dns"
    http = ArcRecord("a", 0, "u", "-", "2020", "t", b"HTTP/1.0 200 OK\r\n\r\nbody")
    fields, block = next(read_warc_file(warc_record(http, {"record_id": "r", "uri": "v", "date": "d"})))
    assert (fields["warc-type"], fields["warc-refers-to"], block) == ("revisit", "r", b"HTTP/1.0 200 OK\r\n\r\n")
    assert fields["warc-payload-digest"] == "sha1:" + base32_sha1(b"body")


@pytest.mark.parametrize(
    "content",
    [
        b"http://x 1 2 t 3\nabc",
        arc(1)[:-5],
        arc(1, b"http://x 1.2.3.4 2020 t/h 9\nhi"),
        arc(1, b"http://x 1.2.3.4 2020 t/h two\nhi"),
        arc(2, b"http://x 1.2.3.4 2020 t/h 2\nhi"),
        arc(1).replace(b"1 0 test", b"7 0 test"),
    ],
)
def test_damaged_archives_name_the_place(content):
    with pytest.raises(ArchiveError, match="file at 0|file at [0-9]+"):
        list(read_arc(content, "file"))
