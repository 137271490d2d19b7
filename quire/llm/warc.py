"""Web archives (WARC 1.1) as a Spark data source, and pages archived with revisit records."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as D

from quire.llm.common import table
from quire.llm.registry import query
from quire.session import new_shared_path

FORMAT = "quire_warc"
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES, READ_BYTES = 256 << 20, 128 << 20, 16 << 20, 1 << 16
LONGEST_HEADER = 1 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: The version line, the revisit profile, the base-32 digits, the field for skip lengths in a gzip header.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SKIP_FIELD = b"sl"
HTTP = "application/http; msgtype=response"
#: Columns that a record's header holds, and the header field of each.
HEADER_FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "record_date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "content_type": "Content-Type",
}
READ_SCHEMA = (", ".join(f"{c} string" for c in HEADER_FIELDS)
               + ", content_length long, headers map<string,string>, payload_bytes long, payload binary")
ARROW_SCHEMA = pa.schema([(c, pa.string()) for c in HEADER_FIELDS] + [
    ("content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()),
    ("payload", pa.binary())])
_FILES = "_files.json"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Archives(D.InputPartition):
    """Files that one task reads."""

    files: list[str]


@dataclass
class Written(D.WriterCommitMessage):
    files: list[tuple[str, int]]


class Member:
    """One record: a gzip member of its own, or a stretch of a plain file. Bytes are read and inflated on demand."""

    def __init__(self, source: pa.NativeFile, at: int, plain: bool):
        self.source, self.at, self.plain, self.start = source, at, plain, at
        self.data, self.skip = b"", None
        self.inflate = None if plain else zlib.decompressobj(31)
        self.ended = False

    def more(self) -> bool:
        """Take in the next stretch; False at the end of the member or the file."""
        if self.ended:
            return False
        self.source.seek(self.at)
        raw = self.source.read(READ_BYTES)
        if not raw:
            if not self.plain and self.at > self.start:
                raise ValueError("an archive ends inside a gzip member")
            self.ended = True
            return False
        if self.plain:
            self.at += len(raw)
            self.data += raw
            return True
        if self.at == self.start:
            self.skip = _skip_length(raw)
        self.data += self.inflate.decompress(raw)
        self.at += len(raw)
        if self.inflate.eof:
            self.at -= len(self.inflate.unused_data)
            self.ended = True
        return True

    def until(self, mark: bytes, start: int = 0) -> int:
        """Place after the first ``mark`` from ``start`` on, or -1."""
        while (found := self.data.find(mark, start)) < 0:
            if len(self.data) - start > LONGEST_HEADER:
                raise ValueError("an archive holds a header without an end")
            if not self.more():
                return -1
        return found + len(mark)

    def upto(self, size: int) -> bytes:
        parts = None
        while len(self.data) < size:
            # Long payloads are gathered in a list of stretches, not by growing one string.
            parts = parts or []
            parts.append(self.data)
            size -= len(self.data)
            self.data = b""
            if not self.more():
                raise ValueError("an archive ends inside a record")
        if parts:
            size += sum(map(len, parts))
            self.data = b"".join([*parts, self.data])
        return self.data

    def after(self, size: int) -> int:
        """Where the next record starts; ``size`` is that of this one without its closing line ends."""
        if self.plain:
            return self.start + size + 4
        if self.skip and not self.ended:
            return self.start + self.skip
        while not self.ended:
            self.data = b""
            self.more()
        return self.at


def _skip_length(raw: bytes) -> int | None:
    """Compressed length of the gzip member that starts ``raw``, if its header has a field for it."""
    if len(raw) < 12 or raw[:2] != b"\x1f\x8b" or not raw[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", raw, 10)[0]
    while at + 4 <= min(end, len(raw)):
        size = struct.unpack_from("<H", raw, at + 2)[0]
        if raw[at:at + 2] == SKIP_FIELD and size == 8 and at + 12 <= len(raw):
            return struct.unpack_from("<I", raw, at + 4)[0]
        at += 4 + size
    return None


def _fields(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip(), value.strip())
    return found


def _test(item: D.Filter) -> Callable[[dict], bool] | None:
    """A pushed filter as a test of header columns; None if it asks for something that headers do not hold."""
    if isinstance(item, D.Not):
        inner = _test(item.child)
        # Only comparisons, which are null for a missing value, and so no match either way.
        if inner is None or isinstance(item.child, (D.IsNull, D.IsNotNull, D.EqualNullSafe, D.Not)):
            return None
        name = item.child.attribute[0]
        return lambda row: row[name] is not None and not inner(row)
    if len(item.attribute) != 1 or item.attribute[0] not in (*HEADER_FIELDS, "content_length"):
        return None
    name, value = item.attribute[0], getattr(item, "value", None)
    compared = {
        D.EqualTo: lambda x: x == value, D.GreaterThan: lambda x: x > value, D.GreaterThanOrEqual: lambda x: x >= value,
        D.LessThan: lambda x: x < value, D.LessThanOrEqual: lambda x: x <= value, D.In: lambda x: x in value,
        D.StringStartsWith: lambda x: x.startswith(value), D.StringEndsWith: lambda x: x.endswith(value),
        D.StringContains: lambda x: value in x, D.IsNotNull: lambda x: True,
    }.get(type(item))
    if compared is not None:
        return lambda row: row[name] is not None and compared(row[name])
    if isinstance(item, D.IsNull):
        return lambda row: row[name] is None
    if isinstance(item, D.EqualNullSafe):
        return lambda row: row[name] == value
    return None


def records(source: pa.NativeFile, size: int, tests: list[D.Filter] = (), payload: bool = True) -> Iterator[dict]:
    """Records of an open archive that pass all ``tests``, headers first.

    A record that does not pass is left where its header ends: a plain file is read on from the next record,
    and a compressed one too if its member states its length; else it is inflated in stretches that are not kept.
    Without ``payload`` a record is left after its headers and those of HTTP.
    """
    checks = [_test(t) for t in tests]
    source.seek(0)
    plain = source.read(2) != b"\x1f\x8b"
    at = 0
    while at < size:
        member = Member(source, at, plain)
        end = member.until(b"\r\n\r\n")
        if end < 0:
            if member.data.strip():
                raise ValueError("an archive ends inside a header")
            return
        head = member.data[:end]
        if not head.startswith(b"WARC/"):
            raise ValueError("an archive holds something that is no record")
        headers = _fields(head)
        length = int(headers["Content-Length"])
        named = {name.lower(): value for name, value in headers.items()}
        row = {c: named.get(f.lower()) for c, f in HEADER_FIELDS.items()} | {"content_length": length}
        if all(check(row) for check in checks):
            row |= {"headers": list(headers.items()), "payload_bytes": length, "payload": None}
            body = end
            if (row["content_type"] or "").startswith("application/http"):
                member.upto(min(end + 4, end + length))
                body = member.until(b"\r\n\r\n", end)
                if body < 0:
                    raise ValueError("an archive ends inside a header")
                http = {k.lower(): v for k, v in _fields(member.data[end:body]).items()}
                stated = http.get("content-length", "")
                row["payload_bytes"] = int(stated) if row["record_type"] == "revisit" and stated.isdigit() else end + length - body
            if payload and row["record_type"] != "revisit":
                row["payload"] = member.upto(end + length)[body:end + length]
            yield row
        at = member.after(end + length)


#: Tests that a list of conditions may name.
CONDITIONS = {
    "=": D.EqualTo, "<>": lambda c, v: D.Not(D.EqualTo(c, v)), "in": lambda c, v: D.In(c, tuple(v)), ">": D.GreaterThan,
    ">=": D.GreaterThanOrEqual, "<": D.LessThan, "<=": D.LessThanOrEqual, "starts": D.StringStartsWith,
    "ends": D.StringEndsWith, "contains": D.StringContains, "null": lambda c, _: D.IsNull(c),
    "not null": lambda c, _: D.IsNotNull(c),
}


def _condition(column: str, operation: str, value: object = None) -> D.Filter:
    found = CONDITIONS[operation]((column,), value)
    if _test(found) is None:
        raise ValueError(f"{column!r} is no column of a header")
    return found


class WarcReader(D.DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.tests = [_condition(*c) for c in json.loads(options.get("conditions", "[]"))]
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Archives]:
        """Committed files, dealt into stretches of about ``partitionBytes``."""
        store, root = _opened(self.path)
        if store.get_file_info(f"{root}/{_FILES}").type == pafs.FileType.File:
            with store.open_input_stream(f"{root}/{_FILES}") as listed:
                sized = [(f"{root}/{name}", size) for name, size in json.loads(listed.read())]
        else:
            found = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=False))
            sized = sorted((f.path, f.size) for f in found if f.path.endswith((".warc", ".warc.gz")))
        dealt, held = [], 0
        for name, size in sized:
            if not dealt or held + size > self.partition_bytes:
                dealt.append(Archives([]))
                held = 0
            dealt[-1].files.append(name)
            held += size
        return dealt or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.path)
        rows, held = [], 0
        for name in partition.files:
            with store.open_input_file(name) as source:
                for row in records(source, source.size(), self.tests, self.payload):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 1000
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)


class PushingReader(WarcReader):
    """Takes the filters of the query too, where they are on header columns."""

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for item in filters:
            if _test(item) is None:
                yield item
            else:
                self.tests.append(item)


def _header_value(text: str) -> str:
    """``text`` on one line: what could end a header, or is no UTF-8 text, is escaped by percent signs."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def _record(row: dict) -> bytes:
    """A record's bytes. A revisit has the HTTP headers of its response without the payload."""
    body = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    size = row["payload_bytes"] if revisit else len(body)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if not revisit:
        block += body
    fields = [(HEADER_FIELDS[c], row[c]) for c in ("record_type", "record_id", "record_date", "target_uri", "refers_to")]
    fields += [("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("WARC-Profile", PROFILE if revisit else None),
               ("Content-Type", HTTP), *(row["headers"] or [])]
    return _framed(fields, block)


def _framed(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {_header_value(value)}".encode() for name, value in fields if value is not None),
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """A gzip member whose header states its length, so that a reader passes over it without inflating it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(record) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(packed) + 8
    if size >= 1 << 32 or len(record) >= 1 << 32:
        return struct.pack("<2sBBIBB", b"\x1f\x8b", 8, 0, 0, 0, 255) + packed + tail
    extra = SKIP_FIELD + struct.pack("<HII", 8, size, len(record))
    return struct.pack("<2sBBIBBH", b"\x1f\x8b", 8, 4, 0, 0, 255, len(extra)) + extra + packed + tail


class WarcWriter(D.DataSourceArrowWriter):
    """Each task writes files under names of its own; the list of files, written last, makes them the archive."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _opened(self.path)
        store.create_dir(root)
        files, out, held, run = [], None, 0, uuid4().hex
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"part-{run}-{len(files):05d}.warc.gz"
                    out, held = store.open_output_stream(f"{root}/{name}", compression=None), 0
                    held += out.write(_member(_framed(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"), ("WARC-Filename", name),
                         ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                    files.append([name, 0])
                held += out.write(_member(_record(batch.slice(i, 1).to_pylist()[0])))
                files[-1][1] = held
                if held >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written([tuple(f) for f in files])

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _opened(self.path)
        store.create_dir(root)
        listed = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{root}/{_FILES}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _opened(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{root}/{name}")


class WarcSource(D.DataSource):
    """``spark.read.format("quire_warc").option("path", folder)``: a row per record.

    ``path`` is in a store that Arrow opens (file, hdfs, s3, gs). Options: ``conditions``, a JSON list of tests of
    header columns that a record must pass; ``payload`` (false: headers only); ``partitionBytes``; ``fileBytes``; and
    ``pushdown``: true takes the query's own filters on header columns as well. Spark keeps one set of pushed
    filters for a loaded table, the last one, so with ``pushdown`` load a table for each scan; ``conditions`` stay
    with the table whatever is done with it.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        options = {name: self.options[name] for name in ("path", "conditions", "payload", "partitionBytes", "pushdown")
                   if name in self.options}
        return (PushingReader if options.get("pushdown", "").lower() == "true" else WarcReader)(options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({name: self.options[name] for name in ("path", "fileBytes") if name in self.options})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")  # Spark refuses a reader that can take filters while this is off.


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 40 bits of it are eight digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _uuid(row: Column) -> Column:
    h = F.md5(row.cast("string"))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def archive_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as an archive at ``path``.

    The payload is the text in UTF-8; a null text is empty. Of rows with one payload of at least ``least_bytes``
    bytes, the one with the smallest page_id (null ids last; ties by url, null last, then any one row) is a response
    and the others are revisits of it, without the payload. Shorter payloads are responses each. Other columns
    are not looked at; control characters of an address are escaped. Rows are numbered in a written table, so a task
    that runs again writes the same records. First rows are combined before they are shuffled, and the table that a
    hot payload is joined to has one row for it, so the join can be split.
    """
    spark = pages.sparkSession
    register(spark)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    staged_path = new_shared_path(spark, "warc-pages")
    (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
     .withColumns({"row": F.monotonically_increasing_id(), "same": F.unhex(F.sha2("payload", 256))})
     .write.option("compression", "zstd").parquet(staged_path))
    staged = spark.read.parquet(staged_path)
    size = F.octet_length("payload").cast("long")
    first = staged.where(size >= least_bytes).groupBy("same").agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "row")).alias("first"))
    joined = staged.join(first.select("same", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_page")),
                         "same", "left")
    again = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    run = uuid4().hex
    of = lambda c: _uuid(F.concat_ws(":", F.lit(run), c.cast("string")))
    entry = lambda name, value: F.struct(F.lit(name).alias("_1"), value.cast("string").alias("_2"))
    extra = F.filter(F.array(entry("Page-ID", F.col("page_id")), entry("Refers-To-Page-ID", F.when(again, F.col("first_page")))),
                     lambda e: e["_2"].isNotNull())
    joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), of(F.col("row")).alias("record_id"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("record_date"),
        F.col("url").alias("target_uri"), F.when(again, of(F.col("first_row"))).alias("refers_to"),
        base32_sha1(F.col("payload")).alias("payload_digest"), F.map_from_entries(extra).alias("headers"),
        size.alias("payload_bytes"), F.when(~again, F.col("payload")).alias("payload"),
    ).write.format(FORMAT).mode("append").option("path", path).save()


def read_archive(spark: SparkSession, path: str, *conditions: tuple, payload: bool = True) -> DataFrame:
    """Records that pass all ``conditions``, (column, operation, value) of header columns, e.g.
    ``("record_type", "in", ["response", "revisit"])``. Payloads of the others are not decoded."""
    register(spark)
    return (spark.read.format(FORMAT).option("path", path).option("conditions", json.dumps(conditions))
            .option("payload", str(payload).lower()).load())


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri) of the pages in an archive.

    A response's size and digest are taken from the payload read back, and must be those of its header; a revisit's
    are those that it states, as it has no payload.
    """
    found = read_archive(spark, path, ("record_type", "in", ["response", "revisit"]))
    stated = F.regexp_replace("payload_digest", "^sha1:", "")
    held = F.when(F.col("payload").isNull(), stated).otherwise(base32_sha1(F.col("payload")))
    field = lambda name: F.try_element_at("headers", F.lit(name)).cast("long")
    return found.select(
        field("Page-ID").alias("page_id"), F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.when(held == stated, held).otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"),
        "record_type", field("Refers-To-Page-ID").alias("refers_to"), "target_uri")


_SQL = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
  r AS (SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first_page FROM p WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first_page END AS refers_to, url AS target_uri FROM r"""


@query("op12_warc_archive", _SQL)
def op12_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "warc")
    archive_pages(table(spark, folder, "pages"), path)
    return archived_pages(spark, path)
