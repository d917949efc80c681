"""Legacy ARC archives: writing them, converting them to WARC, and reading WARC back."""

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..workspace import Workspace
from .skew import left_lookup
from .wordhash import release_memory

# The field definitions of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: (
        "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
        "Filename Archive-length"
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_BYTES_PER_BATCH = 4 << 20
# Records of one archive, its first one included: a file is read as a whole.
RECORDS_PER_ARCHIVE = 1000
_ROWS_AT_ONCE = 64
_ID_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class ArchiveError(ValueError):
    """An archive that breaks its format, with the place."""


def base32_sha1(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def _opened(content: bytes) -> io.BufferedReader:
    """A stream over an archive's bytes, unpacked as it is read if it is gzip."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 16)


def _exactly(stream: io.BufferedReader, length: int, place: str) -> bytes:
    body = stream.read(length)
    if len(body) != length:
        raise ArchiveError(f"{place}: {length} bytes declared, {len(body)} found")
    return body


@dataclass
class ArcRecord:
    archive: str
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    body: bytes

    @property
    def record_id(self) -> str:
        """The same on every run: named after the archive and the record's place in it."""
        return f"<urn:uuid:{uuid.uuid5(_ID_NAMESPACE, f'{self.archive}#{self.offset}')}>"

    @property
    def warc_date(self) -> str:
        d = self.date.ljust(14, "0")
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    def http(self) -> tuple[bytes, bytes] | None:
        """The HTTP head, with its blank line, and the payload; None for other content."""
        if not self.body.startswith(b"HTTP/"):
            return None
        head, gap, payload = self.body.partition(b"\r\n\r\n")
        return head + gap, payload


def read_arc(content: bytes, name: str = "arc") -> Iterator[ArcRecord]:
    """The records of an ARC file. The version line of its first record says which fields follow.

    A header line has the URL first and the length last; version 2 has five more fields
    between. The declared length alone says where a body ends. Blank lines between
    records are passed over.
    """
    stream = _opened(content)
    offset, version, archive = 0, None, name
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        place = f"{name} at {start}"
        fields = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if version is None:
            if not fields[0].startswith("filedesc://"):
                raise ArchiveError(f"{place}: no version block")
            block = _exactly(stream, _length(fields[-1], place), place)
            offset += len(block)
            number = block.split(b" ", 1)[0]
            version = int(number) if number.isdigit() else 0
            if version not in ARC_FIELDS:
                raise ArchiveError(f"{place}: unknown version {number!r}")
            archive = fields[0].removeprefix("filedesc://")
            continue
        if len(fields) != len(ARC_FIELDS[version].split(" ")):
            raise ArchiveError(f"{place}: {len(fields)} fields in a version {version} header")
        url, ip, date, mime = fields[:4]
        body = _exactly(stream, _length(fields[-1], place), place)
        offset += len(body)
        yield ArcRecord(archive, start, url, ip, date, mime, body)


def _length(text: str, place: str) -> int:
    if not text.isdigit():
        raise ArchiveError(f"{place}: length {text!r}")
    return int(text)


def _header(head: bytes, name: bytes) -> bytes | None:
    """The value of the first header of this name."""
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip()
    return None


def _number(head: bytes, name: str) -> int | None:
    value = _header(head, name.lower().encode())
    return int(value) if value is not None and value.lstrip(b"-").isdigit() else None


def _small_parts(batches: Iterator[pa.RecordBatch], size: int = _ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that a whole Arrow batch never is a list of Python values as well."""
    for batch in batches:
        for begin in range(0, batch.num_rows, size):
            yield batch.slice(begin, size)


def _tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, which gives its memory back when a task ends; the worker lives on."""

    def tidied(batches):
        yield from run(batches)
        release_memory()

    return tidied


def _written(rows: DataFrame, path: str, separator: str) -> None:
    """Writes archives of ``RECORDS_PER_ARCHIVE``; ``rows.record`` are the records without what ends them."""
    (
        rows.select(F.col("record").cast("string"))
        .write.option("lineSep", separator)
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


def _in_batches(records: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows; what is long in a row counts against the batch's size."""
    rows, held = [], 0
    for row in records:
        rows.append(row)
        held += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if held > _BYTES_PER_BATCH:
            yield _batch(rows, schema)
            rows, held = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


_RECORD = pa.schema([("record", pa.binary())])


def write_arc(
    pages: DataFrame, path: str, date: str = "20240101000000", server: str = "0.0.0.0"
) -> None:
    """Writes ``pages`` (``page_id``, ``url``, ``html``) as gzipped ARC files of a bounded number of records.

    Tasks write versions 1 and 2 in turn. Each page is an HTTP response with its id in
    ``X-Page-Id``; a null id leaves that header out, a null page is empty. Blanks and
    control characters of a URL are escaped; a null or empty URL is ``missing:``.
    """

    def run(batches):
        number = TaskContext.get().partitionId()
        version = 1 + number % 2

        def records():
            n, name = 0, ""
            for batch in _small_parts(batches):
                for page, url, html in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html"))):
                    # The writer begins another file after so many records.
                    if n % RECORDS_PER_ARCHIVE == 0:
                        name = f"pages-{number:06d}-{n // RECORDS_PER_ARCHIVE:06d}.arc"
                        block = f"{version} 0 pages\n{ARC_FIELDS[version]}\n".encode()
                        head = f"filedesc://{name} {server} {date} text/plain {len(block)}\n"
                        yield (head.encode() + block,)
                        n += 1
                    n += 1
                    body = (html or "").encode()
                    known = "" if page is None else f"X-Page-Id: {page}\r\n"
                    http = (
                        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"{known}Content-Length: {len(body)}\r\n\r\n"
                    ).encode()
                    fields = [quote(url, safe="".join(map(chr, range(33, 127)))) if url else "missing:"]
                    fields += [server, date, "text/html"]
                    if version == 2:
                        fields += ["200", "-", "-", "0", name]
                    fields.append(str(len(http) + len(body)))
                    yield (" ".join(fields).encode() + b"\n" + http + body,)

        yield from _in_batches(records(), _RECORD)

    _written(pages.select("page_id", "url", "html").mapInArrow(_tidied(run), "record binary"), path, "\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


_ENTRY = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("record_id", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("digest", pa.string()),
        ("length", pa.int64()),
        ("preference", pa.int64()),
    ]
)
_ENTRY_SQL = (
    "path string, offset long, record_id string, uri string, date string, digest string, "
    "length long, preference long"
)


def _payload_entries(prefer: str | None):
    def run(batches):
        def entries():
            for batch in _small_parts(batches, 1):
                for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                    for r in read_arc(content.as_py(), path):
                        if http := r.http():
                            rank = _number(http[0], prefer) if prefer else None
                            digest = base32_sha1(http[1])
                            yield (
                                path, r.offset, r.record_id, r.url, r.warc_date, digest, len(http[1]), rank
                            )

        yield from _in_batches(entries(), _ENTRY)

    return run


def _head(fields: dict[str, str | None]) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in fields.items() if v is not None]
    return ("WARC/1.1\r\n" + "".join(lines) + "\r\n").encode()


def warc_record(record: ArcRecord, original: dict | None) -> bytes:
    """The WARC form of an ARC record, without the two line ends behind it.

    HTTP content becomes a response, or a revisit if ``original`` names the record
    that holds the same payload; a revisit keeps the HTTP head only. Other content becomes a
    resource.
    """
    fields = {
        "WARC-Type": "resource",
        "WARC-Record-ID": record.record_id,
        "WARC-Date": record.warc_date,
        "WARC-Target-URI": record.url,
        "WARC-IP-Address": None if record.ip in ("", "-", "0.0.0.0") else record.ip,
        "Content-Type": record.mime,
    }
    block = record.body
    if http := record.http():
        fields["WARC-Type"] = "response"
        fields["Content-Type"] = "application/http;msgtype=response"
        fields["WARC-Payload-Digest"] = f"sha1:{base32_sha1(http[1])}"
        if original:
            block = http[0]
            fields["WARC-Type"] = "revisit"
            fields["WARC-Profile"] = REVISIT_PROFILE
            fields["WARC-Refers-To"] = original["record_id"]
            fields["WARC-Refers-To-Target-URI"] = original["uri"]
            fields["WARC-Refers-To-Date"] = original["date"]
    fields["WARC-Block-Digest"] = f"sha1:{base32_sha1(block)}"
    fields["Content-Length"] = str(len(block))
    return _head(fields) + block


def _info(first: ArcRecord) -> bytes:
    """The record that opens a WARC file, named after the first record in it."""
    block = f"software: voltlake\r\nformat: WARC File Format 1.1\r\nfirst-from: {first.archive}\r\n".encode()
    fields = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_ID_NAMESPACE, 'info ' + first.record_id)}>",
        "WARC-Date": first.warc_date,
        "Content-Type": "application/warc-fields",
        "Content-Length": str(len(block)),
    }
    return _head(fields) + block


_ARC_ROW = pa.schema(
    [("path", pa.string()), ("offset", pa.int64())]
    + [(name, pa.string()) for name in ("archive", "url", "ip", "date", "mime")]
    + [("body", pa.binary())]
)
_ARC_SQL = (
    "path string, offset long, archive string, url string, ip string, date string, mime string, "
    "body binary"
)


def _arc_rows(batches):
    def rows():
        for batch in _small_parts(batches, 1):
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                for r in read_arc(content.as_py(), path):
                    yield path, r.offset, r.archive, r.url, r.ip, r.date, r.mime, r.body

    yield from _in_batches(rows(), _ARC_ROW)


def _converted(batches):
    def records():
        n = 0
        for batch in _small_parts(batches):
            for row in batch.to_pylist():
                original = row.pop("original")
                del row["path"]
                record = ArcRecord(**row)
                if n % RECORDS_PER_ARCHIVE == 0:
                    yield (_info(record),)
                    n += 1
                yield (warc_record(record, original),)
                n += 1

    yield from _in_batches(records(), _RECORD)


def convert_arc(
    spark: SparkSession,
    arc_path: str,
    warc_path: str,
    prefer: str | None = None,
    workspace: Workspace | None = None,
) -> None:
    """Converts the ARC files below ``arc_path`` into gzipped WARC files below ``warc_path``.

    Of records with equal payloads (SHA-1 of the HTTP entity, the empty one included), one
    stays a response and all others become revisits of it: the one with the largest
    number in the HTTP header ``prefer``, if given, then the last by file and
    place. Records without that number come after those with it.

    The first pass finds each record's payload digest. The second reads the records once
    more and joins them, by file and place, with the originals of the revisits. A damaged archive fails the
    job with its file and place. A folder without records gives no WARC file.
    """
    workspace = workspace or Workspace(spark)
    files = _files(spark, arc_path)
    entries = workspace.save(files.mapInArrow(_tidied(_payload_entries(prefer)), _ENTRY_SQL), "entries")
    order = F.struct(
        F.col("preference").isNotNull().alias("known"), "preference", "path", "offset",
        "record_id", "uri", "date",
    )
    originals = workspace.save(
        entries.groupBy("digest", "length")
        .agg(F.max(order).alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1"),
        "originals",
    )
    placed = left_lookup(entries, originals, ["digest", "length"], "n", entries.count())
    original = F.struct("original.record_id", "original.uri", "original.date").alias("original")
    revisits = placed.filter("original is not null and original.record_id <> record_id").select(
        "path", "offset", original
    )
    records = files.mapInArrow(_tidied(_arc_rows), _ARC_SQL)
    joined = records.join(revisits, ["path", "offset"], "left").sortWithinPartitions("path", "offset")
    _written(joined.mapInArrow(_tidied(_converted), "record binary"), warc_path, "\r\n\r\n")


_WARC_ROW = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
        ("uri", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("intact", pa.bool_()),
        ("head", pa.binary()),
    ]
)
_WARC_SQL = (
    "record_type string, record_id string, refers_to_id string, uri string, "
    "payload_digest string, payload_bytes long, intact boolean, head binary"
)


def read_warc_file(content: bytes, name: str = "warc") -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a WARC file."""
    stream = _opened(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"{name}: {line[:40]!r} where a record should begin")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        yield fields, _exactly(stream, _length(fields.get("content-length", ""), name), name)


def _warc_rows(batches):
    def rows():
        for batch in _small_parts(batches, 1):
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                for fields, block in read_warc_file(content.as_py(), path):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    head, gap, payload = block.partition(b"\r\n\r\n")
                    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    revisit = fields["warc-type"] == "revisit"
                    size = _number(head, "Content-Length") if revisit else len(payload)
                    intact = revisit or base32_sha1(payload) == declared
                    yield (
                        fields["warc-type"], fields["warc-record-id"], fields.get("warc-refers-to"),
                        fields.get("warc-target-uri"), declared, size, intact, head + gap,
                    )

    yield from _in_batches(rows(), _WARC_ROW)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of the WARC files below ``path``.

    A revisit has the digest and the length of the whole payload, though it does not hold it.
    ``intact`` is whether a response's payload has the digest that its header declares.
    """
    return _files(spark, path).mapInArrow(_tidied(_warc_rows), _WARC_SQL)


def archive_pages(pages: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Writes ``pages`` as ARC, converts them to WARC and reads the archives back.

    One row per page: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``, the page id of the response that a revisit points to. A null page has an
    empty payload. Repeated ids are archived one by one. Further columns are ignored.
    """
    spark = pages.sparkSession
    workspace = workspace or Workspace(spark)
    arcs, warcs = workspace.path("arc"), workspace.path("warc")
    write_arc(pages, arcs)
    if spark.read.format("binaryFile").load(arcs).select("path").isEmpty():
        spark.createDataFrame([], "record string").write.text(warcs)
    else:
        convert_arc(spark, arcs, warcs, "X-Page-Id", workspace)
    page_id = F.regexp_extract(F.col("head").cast("string"), r"(?i)\r\nX-Page-Id: *(-?\d+)", 1)
    rows = workspace.save(
        read_warc(spark, warcs).select(
            F.when(page_id != "", page_id.cast("long")).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            F.coalesce("refers_to_id", "record_id").alias("_original"),
        ),
        "records",
    )
    responses = rows.groupBy("_original").agg(
        F.max(F.when(F.col("record_type") == "response", F.col("page_id"))).alias("_response"),
        F.count(F.lit(1)).alias("_n"),
    )
    found = left_lookup(rows, workspace.save(responses, "responses"), ["_original"], "_n", rows.count())
    return found.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_response")).alias("refers_to"),
    )
