"""Parts of zip archives, as office files are."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

_ENTRY = struct.Struct("<4s4B4HL2L5H2L")
_LOCAL = struct.Struct("<4s22xHH")
#: Fixed value: flags that do not change how a part is read: levels of deflate, sizes behind the data, names in UTF-8.
_HARMLESS = 0x080E


class Archive:
    """The parts of an archive, each read when it is asked for. An archive of the usual form (one directory at the end,
    parts stored or deflated, in its order) is read as it lies; all others, and parts that are damaged, by the library."""

    def __init__(self, data: bytes):
        self.data = data
        self.places = self._directory()
        self.library = None if self.places is not None else zipfile.ZipFile(io.BytesIO(data))

    def _directory(self) -> dict[str, tuple[int, int, int, int, int]] | None:
        """(place, size, method, checksum, size when read) of each part by name; None for an archive of another form."""
        data, end = self.data, len(self.data) - 22
        if end < 0 or data[end : end + 4] != b"PK\5\6" or data[-2:] != b"\0\0" or data[end - 20 : end - 16] == b"PK\6\7":
            return None
        size, at = struct.unpack_from("<2L", data, end + 12)
        if at + size != end:
            return None
        out: dict[str, tuple[int, int, int, int, int]] = {}
        start, last = at, 0
        while at < end:
            if at + 46 > end:
                return None
            sign, _, _, needs, _, flags, method, _, _, check, packed, whole, n, extra, comment, _, _, _, offset = _ENTRY.unpack_from(data, at)
            name = data[at + 46 : at + 46 + n]
            if sign != b"PK\1\2" or flags & ~_HARMLESS or method not in (0, 8) or needs > 63 or extra or offset < last or offset + 30 > start or not name.isascii() or b"\0" in name:
                return None
            local, own, more = _LOCAL.unpack_from(data, offset)
            place = offset + 30 + own + more
            last = place + packed
            if local != b"PK\3\4" or data[offset + 30 : offset + 30 + own] != name or data[offset + 6] & ~_HARMLESS or last > start or name.decode() in out:
                return None
            out[name.decode()] = place, packed, method, check, whole
            at += 46 + n + comment
        return out if at == end else None

    def names(self) -> list[str]:
        return list(self.places) if self.places is not None else self.library.namelist()

    def __contains__(self, name: str) -> bool:
        return name in self.places if self.places is not None else name in self.library.NameToInfo

    def read(self, name: str) -> bytes:
        if self.places is not None:
            place, size, method, check, whole = self.places[name]
            raw = self.data[place : place + size]
            try:
                raw = zlib.decompress(raw, -15) if method else raw
            except zlib.error:
                check = -1
            if len(raw) == whole and zlib.crc32(raw) == check:
                return raw
        return (self.library or zipfile.ZipFile(io.BytesIO(self.data))).read(name)
