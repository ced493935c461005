"""ARC files, the archives that came before WARC: writing, and parsing record by record.

A file begins with a version block: the URL record ``filedesc://name``, whose body names the version and the fields of
the header lines that follow. Version 1 has five fields, version 2 ten. Each record is its header line, a body of the
declared length and a line break; in compressed files each record is a gzip member of its own.

A header line is matched from both ends, so URLs and types with spaces in them are read as they stand. A record that
does not hold what it declares is returned with an ``error``; parsing goes on at the next gzip member, or in a plain
file at the next line that is a header line of the file's version.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

# Fields of the header lines by version.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_START = rb"(?P<uri>\S.*?) (?P<ip>\S+) (?P<date>\d{4,17}) (?P<type>.*?)"
_HEADER = {
    1: re.compile(_START + rb" (?P<length>\d+)"),
    2: re.compile(_START + rb" (?P<code>\d+|-) (?P<checksum>\S+) (?P<location>\S+) (?P<place>\d+|-) (?P<file>\S+) (?P<length>\d+)"),
}
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_KEY = re.compile(rb"^X-Record-Key:[ \t]*(\S+)[ \t]*\r?$", re.IGNORECASE | re.MULTILINE)
_LONGEST_LINE = 1 << 16
_BLOCK = 1 << 18
_LOST = "no header line, or one with a wrong length"


def one_line(value: str | None, missing: str = "-") -> str:
    """A text that stands in a header line: white space and control characters are percent-encoded."""
    return "".join(quote(c) if c.isspace() or ord(c) < 33 or ord(c) == 127 else c for c in value) if value else missing


def iso_date(digits: str | None) -> str | None:
    """``YYYYMMDDhhmmss``, or its beginning, as an ISO 8601 time; None if it is none."""
    if not digits or not digits.isdigit() or len(digits) not in (4, 6, 8, 10, 12) and len(digits) < 14:
        return None
    padded = digits[:14] + "00000101000000"[min(14, len(digits)) :]
    try:
        return datetime.strptime(padded, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").zfill(20)
    except ValueError:
        return None


def http_response(payload: bytes, content_type: str, key: object | None) -> bytes:
    """A response as a crawler stored it, with the key of the row it came from as a header field."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n"
    if key is not None:
        head += f"X-Record-Key: {one_line(str(key))}\r\n"
    return head.encode() + b"\r\n" + payload


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Header and payload of a stored response; a body that is no HTTP response is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    end = _HEAD_END.search(body)
    return (body[: end.end()], body[end.end() :]) if end else (body, b"")


def record_key(head: bytes) -> str | None:
    found = _KEY.search(head)
    return found[1].decode("utf-8", "replace") if found else None


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class ArcWriter:
    """Writes one ARC file of a version."""

    def __init__(self, out, name: str, version: int, date: str, level: int | None):
        self._out, self._name, self._version, self._level = out, name, version, level
        self.size = 0
        about = f"{version} 0 tiermill\n{FIELDS[version]}\n".encode()
        self.add(f"filedesc://{name}", date, "text/plain", about)

    def add(self, uri: str, date: str, content_type: str, body: bytes) -> None:
        more = f" 200 {hashlib.md5(body).hexdigest()} - {self.size} {self._name}" if self._version == 2 else ""
        data = b"".join((f"{uri} 0.0.0.0 {date} {content_type}{more} {len(body)}\n".encode(), body, b"\n"))
        packed = data if self._level is None else gzip_member(data, self._level)
        self._out.write(packed)
        self.size += len(packed)


@dataclass
class ArcRecord:
    """One record: where it lies in the file, its header and body, and what is wrong with it."""

    at: int
    size: int
    uri: str | None = None
    ip: str | None = None
    date: str | None = None
    content_type: str | None = None
    checksum: str = "-"
    body: bytes = b""
    error: str | None = None

    @property
    def is_description(self) -> bool:
        return (self.uri or "").startswith("filedesc:")


def gzip_members(source, begin: int = 0) -> Iterator[tuple[int, int, bytes, str | None]]:
    """Place, size, content and error of each member of a compressed file, one member in memory at a time."""
    at, block = begin, source.read(_BLOCK)
    while block:
        unpack, parts, used, error = zlib.decompressobj(31), [], 0, None
        while block and not unpack.eof:
            try:
                parts.append(unpack.decompress(block))
            except zlib.error as problem:
                error = f"not gzip: {problem}"
                break
            used += len(block) - len(unpack.unused_data)
            block = unpack.unused_data or source.read(_BLOCK)
        if error:  # go on at the next place that looks like the start of a member
            skip = block.find(b"\x1f\x8b\x08", 1)
            while skip < 0 and (more := source.read(_BLOCK)):
                used, block = used + max(0, len(block) - 2), block[-2:] + more
                skip = block.find(b"\x1f\x8b\x08")
            if skip < 0:
                used, block = used + len(block), b""
            else:
                used, block = used + skip, block[skip:]
        elif not unpack.eof:
            error = "file ends inside a member"
        yield at, used, b"".join(parts), error
        at += used


class ArcReader:
    """The records of one file in order, the version block first; one record in memory at a time."""

    def __init__(self, source):
        self._source = io.BufferedReader(source, _BLOCK)
        self.version = 1

    def __iter__(self) -> Iterator[ArcRecord]:
        packed = self._source.peek(2)[:2] == b"\x1f\x8b"
        for record in self._packed() if packed else self._plain():
            if record.is_description and not record.error:
                first = record.body.split(None, 1)[:1]
                self.version = int(first[0]) if first and first[0] in (b"1", b"2") else 1
            yield record

    def parse(self, line: bytes) -> ArcRecord | None:
        """The header of a record, without its body; the version block has the five fields of version 1, whatever it announces."""
        line = line.rstrip(b"\r\n")
        found = _HEADER[self.version].fullmatch(line) if not line.startswith(b"filedesc:") else None
        if found is None and (self.version == 1 or line.startswith(b"filedesc:")):
            found = _HEADER[2].fullmatch(line) or _HEADER[1].fullmatch(line)
        if found is None:
            return None
        text = {k: v.decode("utf-8", "replace") for k, v in found.groupdict().items()}
        return ArcRecord(0, int(text["length"]), text["uri"], text["ip"], text["date"], text["type"] or "no-type", text.get("checksum", "-"))

    def _packed(self) -> Iterator[ArcRecord]:
        for at, size, data, error in gzip_members(self._source):
            begin = len(data) - len(data.lstrip(b"\r\n"))
            line_end = data.find(b"\n", begin) + 1
            record = self.parse(data[begin:line_end]) if line_end else None
            if record is None:
                if data.strip() or error:
                    yield ArcRecord(at, size, error=error or "no header line")
                continue
            until = line_end + record.size
            if data[until:].strip(b"\r\n"):
                error = error or f"{len(data) - until} bytes beyond the declared length"
            yield self._filled(record, data[line_end:until], at, size, error)

    def _plain(self) -> Iterator[ArcRecord]:
        at, lost = 0, None
        while line := self._source.readline(_LONGEST_LINE):
            begin, at = at, at + len(line)
            record = self.parse(line) if line.strip() else None
            if record is None:
                if line.strip() and lost is None:
                    lost = begin
                continue
            if lost is not None:
                yield ArcRecord(lost, begin - lost, error=_LOST)
                lost = None
            body = self._source.read(record.size)
            if self._source.peek(1)[:1] not in (b"", b"\r", b"\n"):
                lost = begin  # the declared length is wrong: look for the next header line behind this one
                self._source.seek(at)
                continue
            at += len(body)
            yield self._filled(record, body, begin, at - begin, None)
        if lost is not None:
            yield ArcRecord(lost, at - lost, error=_LOST)

    def _filled(self, record: ArcRecord, body: bytes, at: int, size: int, error: str | None) -> ArcRecord:
        declared = record.size
        record.at, record.size, record.body, record.error = at, size, body, error
        if len(body) < declared:
            record.error = error or f"{declared} bytes declared, {len(body)} found"
        elif re.fullmatch(r"[0-9a-f]{32}", record.checksum) and hashlib.md5(body).hexdigest() != record.checksum:
            record.error = error or "checksum differs"
        return record


def record_at(source, at: int, size: int) -> bytes:
    """Header line and body of the record that lies at a place of a file."""
    data = source.read_at(size, at)
    return zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
