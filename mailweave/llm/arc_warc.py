"""Converter from legacy ARC archives to WARC archives.

An ARC file opens with a version block; its version says which fields the header
line of every record has, and the last field of that line declares how many bytes
follow. `read_arc` parses this as a stream, one record in memory at a time.
`convert` gives every record what WARC asks for and ARC does not have: an
identifier from its place in its archive, an ISO timestamp, a type, and SHA-1
digests of the payload and of the block. Of responses with equal payloads the
largest key (page number, then place) stays a response, the others become
revisits that refer to it.

Archives are written with Spark's text writer, one row per record: the line end
that the writer adds is the last byte of the record. They are gzip files, which a
reader never splits; an archive that is not compressed must fit one split, else the
reader raises an error.

Hot payloads: records are matched with the winner of their payload on rows
without payloads, which adaptive execution can split; payloads move once, by the
unique place of their record.

Defined cases: a null or empty payload is a payload of 0 bytes; a null URL is
written as ``-``; white space in a URL is percent-encoded; a null key sorts below
every number; rows that are equal in everything are records of their own; an empty
table gives archives without records; a malformed archive is an error. Only the
named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.llm.common import removed, slices, written

# The header fields of both ARC versions, as their format states them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    "Filename Archive-length",
}
PAGE_HEADER = "X-Page-Id"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def timestamp(date: str) -> str:
    """An ARC date (4 to 14 digits, missing parts at their least) as a WARC date."""
    if not re.fullmatch(r"\d{4}(\d\d){0,5}", date):
        raise ValueError(f"not an archive date: {date!r}")
    full = date + "00000101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


# ---- writing ----------------------------------------------------------------


def _arc_header(version: int, url: str, date: str, mime: str, status: int, name: str, size: int):
    url = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url) or "-"
    if version == 1:
        return f"{url} 0.0.0.0 {date} {mime} {size}\n".encode()
    return f"{url} 0.0.0.0 {date} {mime} {status} - - 0 {name} {size}\n".encode()


def _text_files(rows: DataFrame, path: str) -> None:
    value = F.col("record").cast("string").alias("value")
    writer = rows.select(value).write.option("lineSep", "\n").option("maxRecordsPerFile", 0)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(
    df: DataFrame,
    path: str,
    url_col: str = "url",
    payload_col: str = "html",
    key_col: str = "page_id",
    date: str = "20010101000000",
) -> None:
    """Write one ARC file per partition, of version 1 and 2 by turns: an HTTP response per
    row, whose payload is the UTF-8 text (or the bytes) of ``payload_col``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version, name = 1 + number % 2, f"part-{number:05d}.arc"
        about = f"{version} 0 mailweave\n{ARC_FIELDS[version]}\n".encode()
        head = _arc_header(version, f"filedesc://{name}", date, "text/plain", 200, name, len(about))
        yield pa.RecordBatch.from_arrays([pa.array([head + about], pa.binary())], ["record"])
        for part in slices(batches, 2):
            out = []
            for key, url, payload in zip(*(part.column(i).to_pylist() for i in range(3))):
                payload = payload or b""
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
                lines.append(f"Content-Length: {len(payload)}")
                if key is not None:
                    lines.append(f"{PAGE_HEADER}: {key}")
                content = "\r\n".join([*lines, "", ""]).encode() + payload
                head = _arc_header(version, url or "", date, "text/html", 200, name, len(content))
                out.append(head + content)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    rows = df.select(
        F.col(key_col).cast("long").alias("key"),
        F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).cast("binary").alias("payload"),
    )
    _text_files(rows.mapInArrow(run, "record binary"), path)


# ---- reading ----------------------------------------------------------------


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.xxhash64("_metadata.file_path").alias("archive"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.col("value").cast("binary").alias("line"),
        )
    )


class _Blocks:
    """Collects a record's declared number of bytes from lines without their line ends."""

    #: What may stand between a block and the end of its last line.
    line_ends: tuple[bytes, ...] = (b"",)

    def __init__(self):
        self.offset = 0
        self._need, self._parts = 0, []

    def expect(self, size: int) -> None:
        self._need, self._parts = size, []

    def take(self, line: bytes) -> bytes | None:
        """The block if it is complete with this line."""
        if self._need > len(line):
            self._parts += (line, b"\n")
            self._need -= len(line) + 1
            if self._need:
                return None
        elif line[self._need :] in self.line_ends:
            self._parts.append(line[: self._need])
        else:
            raise ValueError(f"a record before byte {self.offset} is longer than it declares")
        return b"".join(self._parts)


class ArcParser(_Blocks):
    def __init__(self, archive: int):
        super().__init__()
        self._archive, self._version, self._head = archive, 0, None

    def feed(self, line: bytes):
        at, self.offset = self.offset, self.offset + len(line) + 1
        if self._head is None:
            if not line:
                return None
            self._start = at
            url, *rest = line.decode("utf-8", "replace").rsplit(" ", self._fields(line) - 1)
            if not rest or not rest[-1].isdigit():
                raise ValueError(f"no header line of version {self._version}: {line[:200]!r}")
            self._head = (url, rest)
            self.expect(int(rest[-1]))
            return self._done(b"") if not int(rest[-1]) else None
        block = self.take(line)
        return None if block is None else self._done(block)

    def _fields(self, line: bytes) -> int:
        if self._version:
            return len(ARC_FIELDS[self._version].split())
        if not line.startswith(b"filedesc:"):
            raise ValueError("an archive must open with a version block")
        # the version block's own line has the fields of the version that it declares
        return 10 if line.count(b" ") >= 9 else 5

    def _done(self, block: bytes):
        (url, rest), self._head = self._head, None
        if not self._version:
            self._version = int(block.split(b" ", 1)[0])
            if self._version not in ARC_FIELDS:
                raise ValueError(f"archive version {self._version} is unknown")
            return None
        head, http = b"", block.startswith(b"HTTP/")
        if http:
            end = block.find(b"\r\n\r\n")
            head, block = (block[: end + 4], block[end + 4 :]) if end >= 0 else (block, b"")
        return (self._archive, self._start, url, rest[0], rest[1], rest[2], http, head, block)

    def close(self) -> None:
        if self._head is not None:
            raise ValueError(f"the archive ends within the record at byte {self._start}")


class WarcParser(_Blocks):
    line_ends = (b"", b"\r")

    def __init__(self, archive: int):
        super().__init__()
        self._archive, self._fields, self._in_block = archive, None, False

    def feed(self, line: bytes):
        at, self.offset = self.offset, self.offset + len(line) + 1
        if self._in_block:
            block = self.take(line)
            return None if block is None else self._done(block)
        text = line.removesuffix(b"\r")
        if self._fields is None:
            if text:
                if not text.startswith(b"WARC/"):
                    raise ValueError(f"no record at byte {at}: {text[:200]!r}")
                self._start, self._fields = at, {}
            return None
        if text:
            name, _, value = text.decode("utf-8", "replace").partition(":")
            self._fields[name.lower()] = value.strip()
            return None
        size = int(self._fields["content-length"])
        self._in_block = True
        self.expect(size)
        return self._done(b"") if not size else None

    def _done(self, block: bytes):
        fields, self._fields, self._in_block = self._fields, None, False
        head = b""
        if fields.get("content-type", "").startswith("application/http"):
            end = block.find(b"\r\n\r\n")
            head, block = (block[: end + 4], block[end + 4 :]) if end >= 0 else (block, b"")
        known = [fields.get(n) for n in ("warc-type", "warc-record-id", "warc-target-uri")]
        known += [fields.get(n) for n in ("warc-date", "warc-payload-digest", "warc-refers-to")]
        known.append(fields.get("x-refers-to-page-id"))
        return (self._archive, self._start, *known, head, block)

    def close(self) -> None:
        if self._fields is not None:
            raise ValueError(f"the archive ends within the record at byte {self._start}")


def _parse(
    lines: DataFrame, parser: Callable[[int], ArcParser | WarcParser], schema: str, finish=None
) -> DataFrame:
    """Records of all files, in batches of bounded size; ``finish`` may replace a record."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, archive, rows, held = None, None, [], 0
        for part in slices(batches, 2):
            archives, starts = part.column(0).to_pylist(), part.column(1)
            if pc.max(starts).as_py():
                raise ValueError("an archive was split; compress it, or raise maxPartitionBytes")
            for name, line in zip(archives, part.column(2).to_pylist()):
                if name != archive:
                    if own is not None:
                        own.close()
                    own, archive = parser(name), name
                record = own.feed(line)
                if record is not None:
                    held += len(record[-1])
                    rows.append(finish(record) if finish else record)
            if held >= 1 << 22 or len(rows) >= 10_000:
                yield _batch(rows, layout)
                rows, held = [], 0
        if own is not None:
            own.close()
        if rows:
            yield _batch(rows, layout)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    layout = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])
    return lines.mapInArrow(run, schema)


def _batch(rows: list[tuple], layout: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), layout)], schema=layout
    )


_ARC = (
    "archive long, offset long, url string, ip string, date string, mime string, "
    "http boolean, head binary, payload binary"
)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """All records but the version blocks: place, header fields, HTTP head and payload."""
    return _parse(_file_lines(spark, path), ArcParser, _ARC)


_WARC = (
    "archive long, offset long, type string, record_id string, target_uri string, date string, "
    "payload_digest string, refers_to_id string, refers_to_page string, head binary, payload binary"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records: place, the named fields that are used here, HTTP head and payload."""
    return _parse(_file_lines(spark, path), WarcParser, _WARC)


def header_number(head, name: str):
    """The number in a field of an HTTP head (bytes that are ASCII here), else null."""
    text = F.regexp_extract(head.cast("string"), rf"(?im)^{name}: *(-?[0-9]+)\r?$", 1)
    return F.when(text != "", text.cast("long"))


# ---- conversion -------------------------------------------------------------


def record_id(archive: int, offset: int) -> str:
    """An identifier that depends on the record's place alone, so a repeated task agrees."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{archive}:{offset}')}>"


def _summary(record: tuple) -> tuple:
    archive, offset, *_, http, head, payload = record
    return archive, offset, http, head, len(payload), digest(payload)


def convert(spark: SparkSession, arc_path: str, warc_path: str, revisit_from: int = 0) -> None:
    """Write the records of the ARC files as WARC files.

    Responses of equal payloads of at least ``revisit_from`` bytes become one response and
    revisits of it. Records that are not HTTP responses become resources.
    """
    lines = _file_lines(spark, arc_path)
    small = _parse(
        lines,
        ArcParser,
        "archive long, offset long, http boolean, head binary, n_bytes long, digest string",
        _summary,
    )
    key = header_number(F.col("head"), PAGE_HEADER)
    keyed = written(small.withColumn("key", key).drop("head"), "arc-keys")
    same = keyed.where(F.col("http") & (F.col("n_bytes") >= revisit_from))
    winner = F.max(F.struct("key", "archive", "offset")).alias("winner")
    winners = written(same.groupBy("digest", "n_bytes").agg(winner), "arc-winners")
    decided = same.join(winners, ["digest", "n_bytes"]).select(
        "archive", "offset", "winner"
    )
    decided = written(
        decided.where(
            (F.col("winner.archive") != F.col("archive")) | (F.col("winner.offset") != F.col("offset"))
        ),
        "arc-revisits",
    )
    records = read_arc(spark, arc_path).join(decided, ["archive", "offset"], "left")
    chosen = records.select(
        *("archive", "offset", "url", "ip", "date", "mime", "http", "head", "payload"),
        F.col("winner.archive").alias("to_archive"),
        F.col("winner.offset").alias("to_offset"),
        F.col("winner.key").alias("to_key"),
    )
    _text_files(chosen.mapInArrow(_warc_records, "record binary"), warc_path)
    removed(keyed, winners, decided)


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its last byte, the line end that the text writer adds."""
    fields = [*fields, ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r"


def _warc_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId()
    info = b"software: mailweave\r\nformat: WARC File Format 1.0\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(-1, number))]
    fields += [("WARC-Date", timestamp("1970")), ("Content-Type", "application/warc-fields")]
    yield pa.RecordBatch.from_arrays([pa.array([_warc_record(fields, info)], pa.binary())], ["record"])
    for part in slices(batches, 8):
        out = []
        for row in zip(*(column.to_pylist() for column in part.columns)):
            archive, offset, url, ip, date, mime, http, head, payload, *to = row
            revisit = to[0] is not None
            kind = "revisit" if revisit else "response" if http else "resource"
            fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(archive, offset))]
            fields += [("WARC-Target-URI", url), ("WARC-Date", timestamp(date))]
            fields += [("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
            if revisit:
                profile = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
                fields += [("WARC-Profile", profile), ("WARC-Refers-To", record_id(*to[:2]))]
                if to[2] is not None:
                    fields.append(("X-Refers-To-Page-Id", str(to[2])))
            content = "application/http; msgtype=response" if http else mime
            block = head + (b"" if revisit else payload)
            out.append(_warc_record([*fields, ("Content-Type", content)], block))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
