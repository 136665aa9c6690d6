"""Range reads of stored members in a ZIP file: directories are parsed, nothing is extracted."""

from __future__ import annotations

import struct
from dataclasses import dataclass

# Fixed values of the format: signatures, record sizes, and the marks that send a reader to ZIP64 fields.
_END, _END_SIZE = b"PK\x05\x06", 22
_LOCATOR, _LOCATOR_SIZE = b"PK\x06\x07", 20
_END64 = b"PK\x06\x06"
_ENTRY, _ENTRY_SIZE = b"PK\x01\x02", 46
_LOCAL, _LOCAL_SIZE = b"PK\x03\x04", 30
_MORE16, _MORE32 = 0xFFFF, 0xFFFFFFFF
_COMMENT = 0xFFFF


class BadArchive(ValueError):
    pass


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int

    @property
    def stored(self) -> bool:
        return self.method == 0


def _unpack(kind: str, data: bytes, at: int = 0) -> tuple:
    try:
        return struct.unpack_from(kind, data, at)
    except struct.error as short:
        raise BadArchive("the archive ends inside a record") from short


def _wide(extra: bytes, fields: list[int], marks: list[bool]) -> list[int]:
    """``fields`` with those that are marked taken from the ZIP64 part of ``extra``."""
    if not any(marks):
        return fields
    at = 0
    while at + 4 <= len(extra):
        tag, length = _unpack("<HH", extra, at)
        if tag == 1:
            values = iter(_unpack(f"<{length // 8}Q", extra, at + 4))
            try:
                return [next(values) if marked else f for f, marked in zip(fields, marks)]
            except StopIteration:
                break
        at += 4 + length
    raise BadArchive("a ZIP64 field is missing")


def directory(read, size: int) -> list[Member]:
    """Members of the archive. ``read(start, length)`` returns bytes of the file of ``size`` bytes."""
    start = max(0, size - _END_SIZE - _COMMENT - _LOCATOR_SIZE)
    tail = read(start, size - start)
    at = tail.rfind(_END)
    # A comment may hold the signature; the true record's comment ends with the file.
    while at >= 0 and at + _END_SIZE + _unpack("<H", tail + b"\0\0", at + 20)[0] != len(tail):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise BadArchive("no end of central directory")
    count, length, offset = _unpack("<HII", tail, at + 10)
    if (count == _MORE16 or _MORE32 in (length, offset)) and at >= _LOCATOR_SIZE:
        if tail[at - _LOCATOR_SIZE : at - _LOCATOR_SIZE + 4] == _LOCATOR:
            (place,) = _unpack("<Q", tail, at - _LOCATOR_SIZE + 8)
            record = read(place, 56)
            if record[:4] != _END64:
                raise BadArchive("no ZIP64 end of central directory")
            count, length, offset = _unpack("<QQQ", record, 32)
    data, at, members = read(offset, length), 0, []
    for _ in range(count):
        if data[at : at + 4] != _ENTRY:
            raise BadArchive("the central directory is broken")
        method, packed, plain = _unpack("<H8xII", data, at + 10)[:3]
        name_size, extra_size, comment_size = _unpack("<HHH", data, at + 28)
        (header,) = _unpack("<I", data, at + 42)
        name = data[at + _ENTRY_SIZE : at + _ENTRY_SIZE + name_size]
        extra = data[at + _ENTRY_SIZE + name_size :][:extra_size]
        plain, packed, header = _wide(extra, [plain, packed, header], [x == _MORE32 for x in (plain, packed, header)])
        members.append(Member(name.decode(), method, packed, plain, header))
        at += _ENTRY_SIZE + name_size + extra_size + comment_size
    return members


def data_start(read, member: Member) -> int:
    """Where a stored member's bytes begin in the file."""
    if not member.stored:
        raise BadArchive(f"{member.name} is compressed and can't be read by range")
    local = read(member.header, _LOCAL_SIZE)
    if local[:4] != _LOCAL:
        raise BadArchive(f"no local header of {member.name}")
    name_size, extra_size = _unpack("<HH", local, 26)
    return member.header + _LOCAL_SIZE + name_size + extra_size
