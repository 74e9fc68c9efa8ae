"""PDF: the text layer of pages, then headings, tables and paragraphs by their shape.

Streams are plain or Flate-compressed; object streams, character maps of fonts and nested
forms are read, as are files that are encrypted but open without a password; others give an error.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

from lodestone.functions.splitter import trim, units
from lodestone.functions.text import WS
from lodestone.sources.parsers import crypt
from lodestone.sources.parsers.common import Block, block, is_list, paragraphs, runs

_NUMBER = re.compile(rf"([0-9]+(?:\.[0-9]+)*\.?)[{WS}]+([^\n\r\u2028\u2029]+)\Z")
_CAPS = re.compile(rf"[A-Z][A-Z0-9{WS}\-_&:,.]+\Z")
_PART = re.compile(rf"(Chapter|Section|Part|Article)[{WS}]+([0-9]+|[IVXLC]+)[.:]*", re.I)
#: Groups: a whole number, a name, a string with nothing escaped or nested, an operator of letters; then all the rest.
_TOKEN = re.compile(rb"([+-]?[0-9]+)(?=[\s()<>\[\]{}/%])|(/[^\s()<>\[\]{}/%]*)|\(([^\\()]*)\)|([A-HJ-MO-Za-hj-mo-z][^\s()<>\[\]{}/%]*)|%[^\r\n]*|<<|>>|[\[\]{}]|/[^\s()<>\[\]{}/%]*|\((?:\\.|[^\\()])*|<[0-9A-Fa-f\s]*>|[^\s()<>\[\]{}/%]+", re.S)
_OCTAL = re.compile(rb"[0-7]{1,3}")
_REF = re.compile(rb"\s+([0-9]+)\s+R(?![A-Za-z])")
_HASH = re.compile(rb"#([0-9A-Fa-f]{2})")
_BLANK = re.compile(rb"\s")
_OBJECT = re.compile(rb"(?<![0-9])([0-9]+)\s+([0-9]+)\s+obj\b")
_STREAM = re.compile(rb"\s*stream\r?\n")
_STREAM_END = re.compile(rb"\s*endstream")
_TRAILER = re.compile(rb"\btrailer\b")
_NUMBERS = re.compile("[0-9]+")
#: What a number can begin with, inf and nan among them.
_NUMERIC = frozenset(b"0123456789+-.iInN")


_SHOWS = frozenset((b"Tj", b"'", b'"'))


class Name(str):
    """A name object."""

    __slots__ = ()


class Ref(tuple):
    """A reference to an object."""

    __slots__ = ()


@lru_cache(1024)
def _name(t: bytes) -> Name:
    return Name((_HASH.sub(lambda h: bytes([int(h[1], 16)]), t[1:]) if b"#" in t else t[1:]).decode("latin-1"))


class Scanner:
    """Values of the syntax shared by files and content streams."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def next(self):
        """The next value or operator (as bytes); None at the end."""
        m = _TOKEN.search(self.data, self.at)
        if not m:
            return None
        self.at, kind = m.end(), m.lastindex
        if kind == 1:
            return int(m[1])
        if kind == 2:
            return _name(m[2])
        if kind == 3:
            return bytearray(m[3])
        if kind == 4:
            return m[4]
        t = m[0]
        c = t[0]
        if c == 0x25:  # a comment
            return self.next()
        if c in _NUMERIC:
            try:
                return int(t)
            except ValueError:
                try:
                    return float(t)
                except ValueError:
                    return t
        if c == 0x28:
            return self._string(m.start())
        if t == b"<<":
            return self._dictionary()
        if t == b"[":
            out = []
            while (v := self.next()) is not None and v != b"]":
                if v == b"R" and len(out) > 1:
                    out[-2:] = [Ref(out[-2:])]
                else:
                    out.append(v)
            return out
        if c == 0x3C:
            h = _BLANK.sub(b"", t[1:-1])
            return bytearray.fromhex((h + b"0" * (len(h) % 2)).decode())
        return t

    def _dictionary(self) -> dict:
        out, key, search = {}, None, _TOKEN.search
        while m := search(self.data, self.at):
            kind = m.lastindex
            if kind == 2:
                self.at, v = m.end(), _name(m[2])
            elif kind == 1:
                self.at, v = m.end(), int(m[1])
            else:
                v = self.next()
                if v is None or v == b">>":
                    break
                if v == b"R" and key is None:
                    continue
            if key is None:
                key = v
            else:
                out[key] = self._ref(v) if kind == 1 or type(v) is int else v
                key = None
        return out

    def _ref(self, v: int):
        if m := _REF.match(self.data, self.at):
            self.at = m.end()
            return Ref((v, int(m[1])))
        return v

    def _string(self, at: int) -> bytearray:
        out, depth, d = bytearray(), 0, self.data
        i = at
        while i < len(d):
            c = d[i : i + 1]
            if c == b"\\":
                i += 1
                e = d[i : i + 1]
                if m := _OCTAL.match(d, i):
                    out.append(int(m[0], 8) & 255)
                    i = m.end() - 1
                elif e == b"\r":
                    i += d[i + 1 : i + 2] == b"\n"
                elif e != b"\n":
                    out += {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}.get(e, e)
            elif c == b"(":
                depth += 1
                if depth > 1:
                    out += c
            elif c == b")":
                depth -= 1
                if not depth:
                    break
                out += c
            else:
                out += c
            i += 1
        self.at = i + 1
        return out


class File:
    """The objects of a file; later ones replace earlier ones."""

    def __init__(self, data: bytes):
        if b"%PDF" not in data[:1024]:
            raise ValueError("not a PDF file")
        self.objects: dict[int, object] = {}
        self.streams: dict[int, bytes] = {}
        self.trailer: dict = {}
        self.generations: dict[int, int] = {}
        self.handler: crypt.Handler | None = None
        for m in _OBJECT.finditer(data):
            s = Scanner(data, m.end())
            value = s.next()
            self.objects[int(m[1])], self.generations[int(m[1])] = value, int(m[2])
            if isinstance(value, dict) and (b := _STREAM.match(data, s.at)):
                n = value.get("Length")
                end = b.end() + n if isinstance(n, int) and (n >= -b.end() and _STREAM_END.match(data, b.end() + n)) else data.find(b"endstream", b.end())
                self.streams[int(m[1])] = data[b.end() : end if end >= 0 else None]
                if value.get("Type") == "XRef":
                    self.trailer = value | self.trailer
        for m in _TRAILER.finditer(data):
            t = Scanner(data, m.end()).next()
            self.trailer |= t if isinstance(t, dict) else {}
        if "Encrypt" in self.trailer:
            self._open(self.trailer["Encrypt"])
        for n in [k for k, v in self.objects.items() if isinstance(v, dict) and v.get("Type") == "ObjStm"]:
            head, raw = self.objects[n], self.stream(n)
            s = Scanner(raw)
            pairs = [(s.next(), s.next()) for _ in range(self.get(head.get("N")) or 0)]
            for number, at in pairs:
                self.objects.setdefault(number, Scanner(raw, self.get(head["First"]) + at).next())

    def _open(self, entry) -> None:
        """Decrypts strings, and lets streams be decrypted as they are read."""
        ids = self.get(self.trailer.get("ID")) or [b""]
        held = {k: self.get(v) for k, v in (self.get(entry) or {}).items()}
        self.handler = crypt.Handler(held, bytes(self.get(ids[0])))
        for n, value in self.objects.items():
            if not (isinstance(entry, Ref) and entry[0] == n):
                self.objects[n] = self.handler.strings(value, n, self.generations[n])

    def _raw(self, number: int, head: dict) -> bytes:
        raw, h = self.streams.get(number, b""), self.handler
        clear = h is None or head.get("Type") == "XRef" or head.get("Type") == "Metadata" and h.plain_metadata
        return raw if clear else h.decrypted(raw, number, self.generations.get(number, 0), h.of_streams)

    def get(self, v):
        seen = 0
        while isinstance(v, Ref) and seen < 50:
            v, seen = self.objects.get(v[0]), seen + 1
        return v

    def stream(self, number: int) -> bytes:
        head = self.objects.get(number) or {}
        raw = self._raw(number, head)
        filters = self.get(head.get("Filter")) or []
        for f in filters if isinstance(filters, list) else [filters]:
            if self.get(f) in ("FlateDecode", "Fl"):
                d = zlib.decompressobj()
                try:
                    raw = d.decompress(raw) + d.flush()
                except zlib.error:
                    raw = b""
            elif self.get(f) in ("ASCIIHexDecode", "AHx"):
                raw = bytes.fromhex(re.sub(rb"[^0-9A-Fa-f]", b"", raw).decode())
            else:
                return b""
        return raw

    def pages(self) -> list[dict]:
        root = self.get(self.trailer.get("Root")) or next((v for v in self.objects.values() if isinstance(v, dict) and v.get("Type") == "Catalog"), {})
        out, todo, seen = [], [(root.get("Pages"), {})], set()
        while todo:
            ref, above = todo.pop()
            if isinstance(ref, Ref):
                if ref in seen:
                    continue
                seen.add(ref)
            node = self.get(ref)
            if not isinstance(node, dict):
                continue
            held = above | {k: node[k] for k in ("Resources",) if k in node}
            if "Kids" in node:
                todo += [(k, held) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                out.append(held | node)
        return out


class Font:
    """Codes to text: by the font's own map, else as Latin text."""

    def __init__(self, file: File, font: dict):
        self.wide = font.get("Subtype") == "Type0"
        self.map: dict[int, str] = {}
        ref = font.get("ToUnicode")
        if isinstance(ref, Ref):
            self._read(file.stream(ref[0]))

    def _read(self, raw: bytes) -> None:
        s, args = Scanner(raw), []
        text = lambda b: bytes(b).decode("utf-16-be", "replace")
        number = lambda b: int.from_bytes(bytes(b), "big")
        while (v := s.next()) is not None:
            if v == b"endbfchar":
                for a, b in zip(args[::2], args[1::2]):
                    self.map[number(a)] = text(b)
            elif v == b"endbfrange":
                for a, z, b in zip(args[::3], args[1::3], args[2::3]):
                    for k in range(min(number(z) - number(a) + 1, 65536)):
                        self.map[number(a) + k] = text(b[k]) if isinstance(b, list) and k < len(b) else text(b)[:-1] + chr(ord(text(b)[-1]) + k) if not isinstance(b, list) and text(b) else ""
            if isinstance(v, bytes) and not isinstance(v, bytearray):
                args = []
            else:
                args.append(v)

    def text(self, raw: bytearray) -> str:
        if self.wide:
            return "".join(self.map.get(int.from_bytes(raw[k : k + 2], "big"), "") for k in range(0, len(raw), 2))
        if not self.map:
            return raw.decode("cp1252", "replace")
        return "".join(self.map.get(c) or bytes([c]).decode("cp1252", "replace") for c in raw)


def page_text(file: File, page: dict) -> str:
    """The text of a page; a new line wherever an item's height differs from the last's."""
    out: list[str] = []
    state = {"last": None}

    def show(content: bytes, resources: dict, depth: int) -> None:
        fonts: dict[str, Font] = {}
        named = file.get(resources.get("Font")) or {}
        font = None
        lead, x, y, line_y, scale = 0.0, 0.0, 0.0, 0.0, 1.0
        s, args, found = Scanner(content), [], _TOKEN.finditer(content)

        def put(text: str) -> None:
            if not text:
                return
            if state["last"] is not None and state["last"] != y:
                out.append("\n")
            out.append(text)
            state["last"] = y

        while (m := next(found, None)) is not None:
            kind = m.lastindex
            if kind == 4:
                v = m[4]
            elif kind == 3:
                args.append(bytearray(m[3]))
                continue
            elif kind == 1:
                args.append(int(m[1]))
                continue
            else:  # what may go on beyond the token
                s.at = m.start()
                v = s.next()
                found = _TOKEN.finditer(content, s.at)
                if not isinstance(v, bytes):
                    args.append(v)
                    continue
            try:
                if v == b"Tj":
                    pass
                elif v == b"BT":
                    line_y, y, scale = 0.0, 0.0, 1.0
                elif v == b"Tf":
                    if args[0] not in fonts:
                        fonts[args[0]] = Font(file, file.get(named.get(args[0])) or {})
                    font = fonts[args[0]]
                elif v == b"TL":
                    lead = args[0]
                elif v == b"Tm":
                    scale, line_y = args[3], args[5]
                    y = line_y
                elif v == b"Td" or v == b"TD":
                    lead = -args[1] if v == b"TD" else lead
                    line_y += args[1] * scale
                    y = line_y
                elif v in (b"T*", b"'", b'"'):
                    line_y -= lead * scale
                    y = line_y
                if v in _SHOWS:
                    if args and isinstance(args[-1], bytearray):
                        put(font.text(args[-1]) if font else args[-1].decode("cp1252", "replace"))
                elif v == b"TJ":
                    put("".join((font.text(a) if font else a.decode("cp1252", "replace")) if isinstance(a, bytearray) else " " if isinstance(a, int | float) and a < -200 else "" for a in args[-1]))
                elif v == b"Do" and depth < 5:
                    ref = (file.get(resources.get("XObject")) or {}).get(args[-1])
                    form = file.get(ref)
                    if isinstance(form, dict) and form.get("Subtype") == "Form":
                        show(file.stream(ref[0]), file.get(form.get("Resources")) or resources, depth + 1)
                elif v == b"BI":
                    k = content.find(b"EI", m.end())
                    found = _TOKEN.finditer(content, k + 2 if k >= 0 else len(content))
            except (IndexError, TypeError, KeyError):
                pass
            args = []

    parts = page.get("Contents")
    held = parts if isinstance(parts, Ref) and not isinstance(file.get(parts), list) else file.get(parts)
    refs = held if isinstance(held, list) else [held]
    show(b"\n".join(file.stream(r[0]) for r in refs if isinstance(r, Ref)), file.get(page.get("Resources")) or {}, 0)
    return "".join(out)


def heading(line: str, above: str, below: str) -> int | None:
    """The level of a line that reads as a heading."""
    t = trim(line)
    n = units(t)
    if n < 2:
        return None
    if m := _NUMBER.match(t):
        return min(len(_NUMBERS.findall(m[1])), 6)
    if 3 <= n <= 100 and _CAPS.match(t) and not trim(above):
        return 1 if n > 50 else 2
    if m := _PART.match(t):
        return 1 if m[1].lower() == "chapter" else 2
    if 3 <= n <= 60 and "A" <= t[0] <= "Z" and not trim(above) and not trim(below):
        return 2
    return None


def _table_end(lines: list[str], i: int) -> int:
    """Where the table that begins at a line ends; i itself if none does."""
    if i + 1 >= len(lines) or runs(lines[i]) < 2 or runs(lines[i + 1]) < 2 or abs(runs(lines[i]) - runs(lines[i + 1])) > 1:
        return i
    k = i
    while k < len(lines) and k - i < 101:
        if trim(lines[k]):
            if runs(lines[k]) < 2:
                break
        elif k + 1 >= len(lines) or runs(lines[k + 1]) < 2 or abs(runs(lines[k + 1]) - runs(lines[i])) > 1:
            break
        k += 1
    return k


def page_blocks(text: str, number: int) -> list[Block]:
    lines, out, held = text.split("\n"), [], []

    def flush() -> None:
        out.extend(block("list" if is_list(p) else "paragraph", p, page_number=number) for p in paragraphs(trim("\n".join(held))))
        held.clear()

    i = 0
    while i < len(lines):
        level = heading(lines[i], lines[i - 1] if i else "", lines[i + 1] if i + 1 < len(lines) else "")
        end = i if level else _table_end(lines, i)
        if level:
            flush()
            out.append(block("heading", trim(lines[i]), level, page_number=number))
        elif end > i:
            flush()
            out.append(block("table", "\n".join(lines[i:end]), page_number=number))
        else:
            held.append(lines[i])
        i = max(end, i + 1)
    flush()
    return out


def parse(data: bytes) -> tuple[list[Block], dict]:
    file = File(data)
    pages = file.pages()
    out: list[Block] = []
    for number, page in enumerate(pages, 1):
        if t := trim(page_text(file, page)):
            out += page_blocks(t, number)
    info = file.get(file.trailer.get("Info")) or {}
    text = lambda v: bytes(v).decode("utf-16" if v[:2] in (b"\xfe\xff", b"\xff\xfe") else "latin-1", "replace")
    return out, {"pageCount": len(pages), "info": {k: text(file.get(v)) for k, v in info.items() if isinstance(file.get(v), bytearray)}}
