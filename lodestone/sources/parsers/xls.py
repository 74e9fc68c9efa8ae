"""Legacy Excel workbooks: the cells of BIFF8 records in a compound file."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from lodestone.sources.parsers.mail import Compound

Cells = dict[int, dict[int, object]]

# Fixed values of the format: record numbers, and the texts of error codes.
FORMULA, EOF, DATEMODE, FILEPASS, CONTINUE, BOUNDSHEET, MULRK, RSTRING, XF, SST = 0x06, 0x0A, 0x22, 0x2F, 0x3C, 0x85, 0xBD, 0xD6, 0xE0, 0xFC
LABELSST, NUMBER, LABEL, BOOLERR, STRING, RK, FORMAT, BOF = 0xFD, 0x203, 0x204, 0x205, 0x207, 0x27E, 0x41E, 0x809
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}


class _Text:
    """Strings in a record and those that continue it, read in order."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 0

    def _left(self) -> int:
        while self.at >= len(self.parts[self.part]) and self.part + 1 < len(self.parts):
            self.part, self.at = self.part + 1, 0
        return len(self.parts[self.part]) - self.at

    def raw(self, n: int) -> bytes:
        out = b""
        while n and (left := self._left()):
            take = self.parts[self.part][self.at : self.at + min(n, left)]
            out, self.at, n = out + take, self.at + len(take), n - len(take)
        return out.ljust(n + len(out), b"\0")

    def number(self, kind: str) -> int:
        return struct.unpack(f"<{kind}", self.raw(struct.calcsize(kind)))[0]

    def chars(self, n: int, wide: int) -> str:
        """n characters; where a further record goes on, it tells anew whether they are wide."""
        out = []
        while n:
            if self.at >= len(self.parts[self.part]):
                if self.part + 1 >= len(self.parts):
                    break
                self._left()
                wide = self.number("B") & 1
            have = (len(self.parts[self.part]) - self.at) // (1 + wide)
            take = min(n, have)
            if not take:
                break
            raw = self.raw(take * (1 + wide))
            out.append(raw if wide else raw.decode("latin-1").encode("utf-16-le"))
            n -= take
        return b"".join(out).decode("utf-16-le", "replace")

    def string(self, count: str = "H") -> str:
        n, flags = self.number(count), self.number("B")
        runs = self.number("H") if flags & 8 else 0
        more = self.number("I") if flags & 4 else 0
        text = self.chars(n, flags & 1)
        self.raw(4 * runs + more)  # fonts of its parts, and how it is spoken
        return text


def _records(data: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(number, its bytes and those of the records that continue it), to the end of the stream or sheet."""
    held: tuple[int, list[bytes]] | None = None
    depth = 0
    while at + 4 <= len(data):
        kind, size = struct.unpack_from("<HH", data, at)
        body, at = data[at + 4 : at + 4 + size], at + 4 + size
        if kind == CONTINUE and held:
            held[1].append(body)
            continue
        if held:
            yield held
        # a sheet may hold charts, which begin and end like sheets; what is in them is not the sheet's
        depth += (kind == BOF) - (kind == EOF)
        held = (kind, [body]) if depth == 1 else None
        if kind == EOF and depth <= 0:
            return
    if held:
        yield held


def rk(n: int) -> float:
    """A number in 30 bits: whole or the head of a double, perhaps in hundredths."""
    v = float(n - (1 << 32) >> 2 if n >> 31 else n >> 2) if n & 2 else struct.unpack("<d", struct.pack("<II", 0, n & 0xFFFFFFFC))[0]
    return v / 100 if n & 1 else v


def read(data: bytes, dated: Callable[[int, dict[int, str]], bool]) -> list[tuple[str, Cells]]:
    """The name and cells of each sheet, as parse_xlsx has them. dated: whether a number format, by its number and
    the workbook's own formats, is one of dates. ValueError for other workbooks than BIFF8, and for encrypted ones."""
    streams = {p[-1].lower(): v for p, v in Compound(data).streams.items() if len(p) == 1}
    if "encryptedpackage" in streams:
        raise ValueError("Encrypted workbook")
    book = streams.get("workbook")
    if book is None:
        raise ValueError("Not a BIFF8 workbook")
    strings: list[str] = []
    sheets: list[tuple[str, int]] = []
    formats: dict[int, str] = {}
    styles: list[int] = []
    epoch = datetime(1899, 12, 30)
    for kind, parts in _records(book):
        body = parts[0]
        if kind == FILEPASS:
            raise ValueError("Encrypted workbook")
        if kind == DATEMODE and body[:2] == b"\1\0":
            epoch = datetime(1904, 1, 1)
        elif kind == BOUNDSHEET and body[5] == 0:  # a sheet of cells
            sheets.append((_Text([body[6:]]).string("B"), struct.unpack_from("<I", body)[0]))
        elif kind == FORMAT:
            formats[struct.unpack_from("<H", body)[0]] = _Text([body[2:]]).string()
        elif kind == XF:
            styles.append(struct.unpack_from("<H", body, 2)[0])
        elif kind == SST:
            text = _Text([body[8:], *parts[1:]])
            strings = [text.string() for _ in range(struct.unpack_from("<I", body, 4)[0]) if text._left()]
    dates = [dated(f, formats) for f in styles]

    def number(v: float, style: int) -> object:
        return epoch + timedelta(days=v) if style < len(dates) and dates[style] else v

    return [(name, _cells(book, at, strings, number)) for name, at in sheets]


def _cells(book: bytes, at: int, strings: list[str], number: Callable[[float, int], object]) -> Cells:
    out: Cells = {}
    named: tuple[int, int] | None = None  # a formula's cell whose text comes in a record of its own
    for kind, parts in _records(book, at):
        b = parts[0]
        if kind == STRING and named:
            _put(out, *named, _Text(parts).string())
            named = None
            continue
        if kind not in (LABELSST, NUMBER, LABEL, RSTRING, BOOLERR, RK, MULRK, FORMULA) or len(b) < 8:
            continue
        row, col, style = struct.unpack_from("<HHH", b)
        if kind == LABELSST:
            k = struct.unpack_from("<I", b, 6)[0]
            _put(out, row, col, strings[k] if k < len(strings) else "")
        elif kind == NUMBER:
            _put(out, row, col, number(struct.unpack_from("<d", b, 6)[0], style))
        elif kind in (LABEL, RSTRING):
            _put(out, row, col, _Text([b[6:], *parts[1:]]).string())
        elif kind == BOOLERR:
            _put(out, row, col, ERRORS.get(b[6], "#N/A") if b[7] else b[6] == 1)
        elif kind == RK:
            _put(out, row, col, number(rk(struct.unpack_from("<I", b, 6)[0]), style))
        elif kind == MULRK:
            for k in range((len(b) - 6) // 6):
                style, n = struct.unpack_from("<HI", b, 4 + 6 * k)
                _put(out, row, col + k, number(rk(n), style))
        elif b[12:14] != b"\xff\xff":  # a formula with a number
            _put(out, row, col, number(struct.unpack_from("<d", b, 6)[0], style))
        elif b[6] == 0:
            named = row, col
        elif b[6] in (1, 2):
            _put(out, row, col, b[8] == 1 if b[6] == 1 else ERRORS.get(b[8], "#N/A"))
    return out


def _put(cells: Cells, row: int, col: int, value: object) -> None:
    if value != "":
        cells.setdefault(row, {})[col] = value
