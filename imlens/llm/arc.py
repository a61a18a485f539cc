"""Byte formats: legacy ARC files (versions 1 and 2) and WARC 1.1 records."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

#: Fixed values of the two published ARC versions: the field names their version blocks declare.
V1_FIELDS = b"URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"

_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_url(url: bytes) -> bytes:
    """A URL that fits a space-separated header line: white space and control bytes percent-encoded."""
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url) or b"-"


def arc_open(name: str, version: int, date: bytes) -> bytes:
    """The file's first record: its ``filedesc`` line and version block."""
    fields = V2_FIELDS if version == 2 else V1_FIELDS
    block = b"%d 0 InternetArchive\n%s\n" % (version, fields)
    lead = b"filedesc://%s 0.0.0.0 %s text/plain " % (name.encode(), date)
    extra = b"200 - - 0 %s " % name.encode() if version == 2 else b""
    return lead + extra + b"%d\n" % len(block) + block


def arc_record(name: str, version: int, offset: int, url: bytes, ip: bytes, date: bytes, kind: bytes, body: bytes) -> bytes:
    extra = b"200 - - %d %s " % (offset, name.encode()) if version == 2 else b""
    return b"\n%s %s %s %s %s%d\n" % (arc_url(url), ip, date, kind, extra, len(body)) + body


def parse_arc(content: bytes):
    """(offset, fields, body) of each record; ends with (offset, error text, None) at the first fault.

    The version block of the file names the header fields, so both versions are read by their own
    declaration; the last field declares the body's length. The URL comes first and may hold spaces.
    """
    at, names, size = 0, None, len(content)
    while at < size:
        if content[at] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            yield at, "header line without an end", None
            return
        line = content[at:end].rstrip(b"\r")
        parts = line.split(b" ") if names is None else line.rsplit(b" ", len(names) - 1)
        if not parts[-1].isdigit() or (names is not None and len(parts) != len(names)):
            yield at, "header line does not fit the version's fields", None
            return
        length = int(parts[-1])
        body = content[end + 1:end + 1 + length]
        if len(body) < length:
            yield at, "body is shorter than declared", None
            return
        if names is None:
            lines = body.split(b"\n")
            if not parts[0].startswith(b"filedesc://") or len(lines) < 2 or lines[0].split(b" ")[0] not in (b"1", b"2"):
                yield at, "no version block", None
                return
            names = [x.decode("latin-1") for x in lines[1].strip().split(b" ")]
            yield at, {"URL": parts[0], "Archive-date": parts[2] if len(parts) > 2 else b"", "Version": lines[0].split(b" ")[0]}, body
        else:
            yield at, dict(zip(names, parts)), body
        at = end + 1 + length


def http_parts(body: bytes) -> tuple[bytes, bytes] | None:
    """(status line and headers with their blank line, payload) of an HTTP response."""
    if not body.startswith(b"HTTP/"):
        return None
    ends = [(i, n) for i, n in ((body.find(b"\r\n\r\n"), 4), (body.find(b"\n\n"), 2)) if i >= 0]
    if not ends:
        return body, b""
    i, n = min(ends)
    return body[:i + n], body[i + n:]


def http_field(head: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*?)[ \t]*\r?$", head)
    return m[1].decode("latin-1") if m else None


def warc_date(date: bytes) -> str:
    """ARC's 14 digits (shorter ones padded) as the W3C form."""
    d = re.sub(r"\D", "", date.decode("latin-1"))[:14]
    d += "00000101000000"[len(d):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(archive: str, offset: int) -> str:
    """A stable identifier: the same archive and offset give the same record."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}"


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_warc(content: bytes):
    """(fields, block) of each record; raises ValueError on a record that breaks its declared length."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/1.", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in content[at:end].decode().split("\r\n")[1:])
        start, n = end + 4, int(fields["Content-Length"])
        if content[start + n:start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} breaks its declared length")
        yield fields, content[start:start + n]
        at = start + n + 4
