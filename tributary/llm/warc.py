"""WARC records and the seekable Zstandard container, as bytes. No Spark here; ``archive`` distributes the work.

A bundle is a sequence of independent Zstandard frames, each holding whole records, and a last skippable frame with
the seek table: per frame its compressed and its decompressed length, then the number of frames, a descriptor byte and
a magic number. Any Zstandard reader decompresses the bundle as it is; a seeking reader reads the table from the end.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import zstandard

# Fixed values of the container format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
HEADER = struct.Struct("<II")
# Fixed values of the record format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = b"\r\n"


def record(kind: str, own: str, payload: bytes, digest: str, length: int, url: str | None, refers_to: str | None, date: str) -> bytes:
    """One record; a revisit keeps the HTTP head with the payload's length but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    body = http if kind == "revisit" else http + payload
    lines = [
        VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <%s>" % own.encode(), b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + one_line(url))
    if kind == "revisit":
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <%s>" % refers_to.encode()]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    return LINE.join(lines) + LINE + LINE + body + LINE + LINE


def one_line(url: str) -> bytes:
    """A header value: control characters are percent-encoded, so a value cannot start a line of its own."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url).encode()


@dataclass
class Record:
    headers: dict[str, str]
    payload: bytes
    #: Length in the HTTP head, which a revisit has too.
    length: int
    offset: int


def records(frame: bytes) -> Iterator[Record]:
    """The records of one decompressed frame, in order, with their offsets in it."""
    at = 0
    while at < len(frame):
        head_end = frame.index(LINE + LINE, at)
        first, *lines = frame[at:head_end].split(LINE)
        if first != VERSION:
            raise ValueError(f"no record at offset {at}")
        headers = dict(line.decode().split(": ", 1) for line in lines)
        start = head_end + 4
        end = start + int(headers["Content-Length"])
        http_end = frame.index(LINE + LINE, start, end) + 4
        http = dict(line.split(b": ", 1) for line in frame[start : http_end - 4].split(LINE)[1:])
        if frame[end : end + 4] != LINE + LINE:
            raise ValueError(f"record at offset {at} does not end where it says")
        yield Record(headers, frame[http_end:end], int(http[b"Content-Length"]), at)
        at = end + 4


@dataclass
class Bundle:
    """Writes records into frames of about ``frame_size`` bytes; ``write`` receives the compressed bytes."""

    write: Callable[[bytes], object]
    frame_size: int
    level: int = 3
    written: int = 0
    frames: list[tuple[int, int]] = field(default_factory=list)
    _open: list[bytes] = field(default_factory=list)
    _size: int = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame number, offset in the decompressed frame and length of the record."""
        if self._size and self._size + len(data) > self.frame_size:
            self.end_frame()
        place = (len(self.frames), self._size, len(data))
        self._open.append(data)
        self._size += len(data)
        return place

    def end_frame(self) -> None:
        if not self._size:
            return
        packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(b"".join(self._open))
        self.write(packed)
        self.frames.append((len(packed), self._size))
        self.written += len(packed)
        self._open, self._size = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(ENTRY.pack(*f) for f in self.frames) + FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        self.write(HEADER.pack(SKIPPABLE_MAGIC, len(table)) + table)


def seek_table(file) -> list[tuple[int, int, int]]:
    """Start, compressed and decompressed length of each frame of an open bundle, from its end."""
    size = file.seek(0, 2)
    file.seek(size - FOOTER.size)
    count, descriptor, magic = FOOTER.unpack(file.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    if descriptor & 0x80:
        raise ValueError("seek tables with checksums are not written here")
    file.seek(size - FOOTER.size - count * ENTRY.size)
    start, out = 0, []
    for packed, plain in ENTRY.iter_unpack(file.read(count * ENTRY.size)):
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(file, entry: tuple[int, int, int]) -> bytes:
    start, packed, plain = entry
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
