"""ZIP packages in any file system that pyarrow opens: a writer of stored members, and a reader of directories and ranges.

The reader loads the end of the file, the central directory (ZIP64 or not) and the local headers it needs; members are
read by range and never unpacked to a disk.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

from pyarrow import fs

# Fixed values of the ZIP format: signatures and record layouts.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
LOCAL_HEAD = struct.Struct("<IHHHHHIIIHH")
CENTRAL_HEAD = struct.Struct("<IHHHHHHIIIHHHHHII")
END_RECORD = struct.Struct("<IHHHHIIH")
END64_RECORD = struct.Struct("<IQHHIIQQQQ")
LOCATOR = struct.Struct("<IIQI")
STORED, UTF8_NAMES, VERSION64, DATE = 0, 0x800, 45, 0x21
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class Member(NamedTuple):
    name: str
    method: int
    size: int
    stored: int
    header: int


class Writer:
    """A package of stored members, written front to back.

    With ``wide`` all sizes and places are in ZIP64 records; otherwise only those that need it.
    """

    def __init__(self, stream, wide: bool = True) -> None:
        self.stream, self.wide, self.at = stream, wide, 0
        self.central: list[bytes] = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> None:
        raw, crc, start = name.encode(), zlib.crc32(data), self.at
        wide = self.wide or max(len(data), start) >= FULL32
        size = FULL32 if wide else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b""
        self._put(LOCAL_HEAD.pack(LOCAL, VERSION64, UTF8_NAMES, STORED, 0, DATE, crc, size, size, len(raw), len(extra)))
        self._put(raw + extra)
        self._put(data)
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), start) if wide else b""
        head = CENTRAL_HEAD.pack(
            CENTRAL, VERSION64, VERSION64, UTF8_NAMES, STORED, 0, DATE, crc, size, size, len(raw), len(extra), 0, 0, 0, 0,
            FULL32 if wide else start,
        )
        self.central.append(head + raw + extra)

    def close(self) -> int:
        """Writes the directory; gives the size of the package."""
        start, count = self.at, len(self.central)
        for entry in self.central:
            self._put(entry)
        size, wide = self.at - start, self.wide or count >= FULL16 or self.at >= FULL32
        if wide:
            end = self.at
            self._put(END64_RECORD.pack(END64, END64_RECORD.size - 12, VERSION64, VERSION64, 0, 0, count, count, size, start))
            self._put(LOCATOR.pack(LOCATOR64, 0, end, 1))
        self._put(END_RECORD.pack(END, 0, 0, *[FULL16 if wide else count] * 2, *((FULL32, FULL32) if wide else (size, start)), 0))
        self.stream.close()
        return self.at


class Reader:
    """The directory of a package, and byte ranges of its stored members."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.path, self.file = path, system.open_input_file(path)
        self.size = self.file.size()
        self.members = self._directory()

    def read(self, at: int, size: int) -> bytes:
        data = self.file.read_at(size, at) if size > 0 else b""
        if len(data) != max(size, 0):
            raise ValueError(f"{self.path} ends before byte {at + size}")
        return data

    def close(self) -> None:
        self.file.close()

    def _end(self) -> tuple[int, tuple]:
        """The place and fields of the end record: the last signature whose comment reaches the end of the file."""
        base = max(0, self.size - END_RECORD.size - FULL16)
        tail = self.read(base, self.size - base)
        at = len(tail) - END_RECORD.size + 1
        while (at := tail.rfind(struct.pack("<I", END), 0, max(at, 0) + 3)) >= 0:
            if at + END_RECORD.size <= len(tail):
                fields = END_RECORD.unpack_from(tail, at)
                if at + END_RECORD.size + fields[7] == len(tail):
                    return base + at, fields
        raise ValueError(f"{self.path} has no end of a ZIP directory")

    def _directory(self) -> list[Member]:
        end, (_, _, _, _, count, size, start, _) = self._end()
        moved = end - size - start  # bytes that stand before the package
        at = end - LOCATOR.size
        if at >= 0 and (locator := LOCATOR.unpack(self.read(at, LOCATOR.size)))[0] == LOCATOR64:
            # The record stands before its locator, also where bytes stand before the package.
            place = next((p for p in (locator[2], at - END64_RECORD.size) if 0 <= p <= at - END64_RECORD.size
                          and self.read(p, 4) == struct.pack("<I", END64)), None)
            if place is None:
                raise ValueError(f"{self.path} has no ZIP64 end record where its locator says")
            count, size, start = END64_RECORD.unpack(self.read(place, END64_RECORD.size))[7:]
            moved = place - size - start
        if moved < 0:
            raise ValueError(f"{self.path} has a ZIP directory beyond its end record")
        data, at, found = self.read(start + moved, size), 0, []
        for _ in range(count):
            head = CENTRAL_HEAD.unpack_from(data, at)
            if head[0] != CENTRAL:
                raise ValueError(f"{self.path} has a broken ZIP directory")
            flags, method, stored, full, name_size, extra_size, note_size, header = head[3], head[4], *head[8:13], head[16]
            at += CENTRAL_HEAD.size
            name = data[at : at + name_size].decode("utf-8" if flags & UTF8_NAMES else "cp437")
            wide = _wide(data[at + name_size : at + name_size + extra_size], [full, stored, header])
            found.append(Member(name, method, wide[0], wide[1], wide[2] + moved))
            at += name_size + extra_size + note_size
        return found

    def start(self, member: Member) -> int:
        """The place of the first byte of a stored member."""
        if member.method != STORED:
            raise ValueError(f"{member.name} in {self.path} is compressed by the package, so it has no ranges")
        head = LOCAL_HEAD.unpack(self.read(member.header, LOCAL_HEAD.size))
        if head[0] != LOCAL:
            raise ValueError(f"{member.name} in {self.path} has no local header")
        return member.header + LOCAL_HEAD.size + head[9] + head[10]


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Size, stored size and place; those that are full in 32 bits stand, in this order, in the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            more = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(more) if v == FULL32 else v for v in values]
        at += 4 + size
    return values
