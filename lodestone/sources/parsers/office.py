"""Word, Excel and PowerPoint files: zip archives of XML parts; and legacy Excel files."""

from __future__ import annotations

import posixpath
import re
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree as ET

from lodestone.functions.splitter import trim, units
from lodestone.functions.text import WS
from lodestone.sources.parsers import xls
from lodestone.sources.parsers.archive import Archive
from lodestone.sources.parsers.common import Block, block, text_table

_CAPS = re.compile(rf"[A-Z][A-Z0-9{WS}\-_&:]+\Z")
_NUMBER = re.compile(rf"([0-9]+(?:\.[0-9]+)*\.?)[{WS}]+(.+)\Z")
_REF = re.compile(r"([A-Z]+)([0-9]+)")
_BULLETS = re.compile(rf"[{WS}]*(?:[-•*]|[0-9]+[.)])[{WS}]")


def _xml(data: bytes) -> ET.Element:
    """The tree of a part; its elements have their local names."""
    root = ET.fromstring(data)
    for e in root.iter():
        name = e.tag
        if name[0] == "{":
            e.tag = _local(name)
    return root


@lru_cache(1024)
def _local(name: str) -> str:
    return name.rpartition("}")[2]


def _attr(e: ET.Element | None, name: str) -> str | None:
    if e is not None:
        for k, v in e.attrib.items():
            if k == name or k.rpartition("}")[2] == name:
                return v
    return None


def _at(e: ET.Element | None, *path: str) -> ET.Element | None:
    """The first element down a path of names."""
    for name in path:
        if e is None:
            return None
        e = e.find(name)
    return e


def _each(e: ET.Element | None, name: str) -> list[ET.Element]:
    return e.findall(name) if e is not None else []


def _part(z: Archive, name: str) -> ET.Element | None:
    return _xml(z.read(name)) if name in z else None


def _targets(z: Archive, part: str) -> dict[str, str]:
    """Paths of the parts that a part relates to, by id."""
    folder, name = posixpath.split(part)
    rels = _part(z, f"{folder}/_rels/{name}.rels")
    return {r.get("Id"): posixpath.normpath(posixpath.join("/" + folder, r.get("Target", ""))).lstrip("/") for r in rels} if rels is not None else {}


# Word ---------------------------------------------------------------------------------


def implicit_heading(t: str) -> int | None:
    """The level of a paragraph that reads as a heading: capitals, or a number before it."""
    if 3 <= units(t) <= 80 and _CAPS.match(t):
        return 1 if units(t) > 40 else 2
    if (m := _NUMBER.match(t)) and units(t) <= 100:
        return min(len(re.findall("[0-9]+", m[1])), 6)
    return None


#: Elements that stand for a character, and the levels of styles.
_MARKS = frozenset(("tab", "br", "cr", "noBreakHyphen"))
_LEVELS = {f"heading {k}": k for k in range(1, 7)} | {"title": 1, "subtitle": 2}


class _Word:
    """A document's paragraphs, lists and tables as blocks.

    A nested list takes the place of the items before it in its outer list, and what
    follows it there is read as paragraphs: the known behaviour of the format's readers.
    """

    def __init__(self, z: Archive):
        self.z = z
        self.styles = {_attr(s, "styleId"): (_attr(_at(s, "name"), "val") or "").lower() for s in _each(_part(z, "word/styles.xml"), "style")}
        self.ordered = self._numbering(_part(z, "word/numbering.xml"))
        self.out: list[Block] = []
        self.warnings: list[str] = []
        self.stack: list[bool] = []  # open lists: whether ordered
        self.items: list[str] | None = None
        self.loose = ""
        body = _at(_part(z, "word/document.xml"), "body")
        for e in self._flow(body):
            if e.tag == "p":
                self._paragraph(e)
            else:
                self._close(0)
                rows = [[trim("".join(map(self._text, self._flow(c)))) for c in _each(r, "tc")] for r in _each(e, "tr")]
                if content := text_table([r for r in rows if r]):
                    self.out.append(block("table", content))
        self._close(0)

    def _flow(self, e: ET.Element | None) -> list[ET.Element]:
        out = []
        for c in e if e is not None else ():
            if c.tag in ("p", "tbl"):
                out.append(c)
            elif c.tag in ("sdt", "sdtContent", "customXml", "smartTag", "ins"):
                out += self._flow(c)
        return out

    def _numbering(self, root: ET.Element | None) -> dict[tuple[str | None, str | None], bool]:
        kinds = {_attr(a, "abstractNumId"): {_attr(v, "ilvl"): _attr(_at(v, "numFmt"), "val") != "bullet" for v in _each(a, "lvl")} for a in _each(root, "abstractNum")}
        return {(_attr(n, "numId"), level): o for n in _each(root, "num") for level, o in kinds.get(_attr(_at(n, "abstractNumId"), "val"), {}).items()}

    def _text(self, p: ET.Element) -> str:
        out = []
        for e in p.iter():
            name = e.tag
            if name == "t":
                out.append(e.text or "")
            elif name not in _MARKS:
                continue
            elif name == "tab" and not _attr(e, "val"):
                out.append("\t")
            elif name in ("br", "cr") and _attr(e, "type") in (None, "textWrapping"):
                out.append("\n")
            elif name == "noBreakHyphen":
                out.append("‑")
        t = "".join(out)
        if "&" not in t:
            return t
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
            t = t.replace(a, b)
        return t

    def _plain(self, text: str) -> None:
        if t := trim(text):
            level = implicit_heading(t)
            self.out.append(block("heading", t, level) if level else block("paragraph", t))

    def _flush_list(self) -> None:
        if self.items is not None:
            ordered = self.stack[-1]
            lines = [f"{k}. {t}" if ordered else f"- {t}" for k, t in enumerate(map(trim, self.items), 1) if t]
            if lines:
                self.out.append(block("list", "\n".join(lines)))
            self.items = None

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._flush_list()
            self._plain(self.loose)
            self.loose = ""
            self.stack.pop()

    def _paragraph(self, p: ET.Element) -> None:
        props = _at(p, "pPr")
        style = self.styles.get(_attr(_at(props, "pStyle"), "val"), "")
        num = _at(props, "numPr")
        text = self._text(p)
        level = _LEVELS.get(style)
        if num is not None and level is None and (number := _attr(_at(num, "numId"), "val") or "0") != "0":
            depth = int(_attr(_at(num, "ilvl"), "val") or 0) + 1
            ordered = self.ordered.get((number, str(depth - 1)), False)
            if not trim(text):
                return
            if len(self.stack) >= depth:
                self._close(depth if self.stack[depth - 1] == ordered else depth - 1)
            while len(self.stack) < depth:
                self._plain(self.loose)
                self.loose = ""
                self.stack.append(ordered)
                self.items = []
            if self.items is None:
                self.loose += text
            else:
                self.items.append(text)
            return
        self._close(0)
        if level is not None:
            if t := trim(text):
                self.out.append(block("heading", t, level))
        else:
            if style and style not in ("normal", "body text", "list paragraph"):
                self.warnings.append(f"Unrecognised paragraph style: {style}")
            self._plain(text)


def parse_docx(data: bytes) -> tuple[list[Block], dict]:
    w = _Word(Archive(data))
    return w.out, {"parserWarnings": w.warnings} if w.warnings else {}


# Excel --------------------------------------------------------------------------------

#: Fixed value: number formats of dates among the built-in ones.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _cell_text(v: object) -> str:
    if isinstance(v, datetime):
        return f"{v.month}/{v.day}/{v.year}"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return str(int(v)) if v == int(v) and abs(v) < 1e21 else repr(v)
    return str(v)


def _place(ref: str) -> tuple[int, int]:
    letters, row = _REF.match(ref).groups()
    col = 0
    for c in letters:
        col = col * 26 + ord(c) - 64
    return int(row) - 1, col - 1


def _dates(z: Archive) -> list[bool]:
    """Of each cell style: whether its number format is one of dates."""
    root = _part(z, "xl/styles.xml")
    own = {int(n.get("numFmtId") or 0): n.get("formatCode", "") for n in _each(_at(root, "numFmts"), "numFmt")} if root is not None else {}
    return [_dated(int(x.get("numFmtId") or 0), own) for x in _each(_at(root, "cellXfs"), "xf")]


def _dated(number: int, own: dict[int, str]) -> bool:
    """Whether a number format is one of dates: of a file's own formats by its letters."""
    if number in own:
        return bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own[number].lower())))
    return number in DATE_FORMATS


def _sheet(root: ET.Element, strings: list[str], dates: list[bool], epoch: datetime) -> list[list[object]]:
    """Runs of a sheet's rows that hold cells, each from its first used column to its last, ''
    where a cell is empty and an empty row after each run: no more than what the runs span."""
    cells: dict[int, dict[int, object]] = {}
    for c in root.iter():
        if c.tag != "c" or not c.get("r"):
            continue
        kind, v = c.get("t", "n"), _at(c, "v")
        raw = v.text if v is not None and v.text else ""
        if kind == "s":
            value: object = strings[int(raw)] if raw else ""
        elif kind == "inlineStr":
            value = "".join(t.text or "" for t in c.iter() if t.tag == "t")
        elif kind == "b":
            value = raw == "1"
        elif kind in ("str", "e", "d"):
            value = raw
        elif raw:
            value = float(raw)
            style = int(c.get("s") or 0)
            if style < len(dates) and dates[style]:
                value = epoch + timedelta(days=value)
        else:
            continue
        if value not in ("", None):
            row, col = _place(c.get("r"))
            cells.setdefault(row, {})[col] = value
    return _laid(cells)


def _laid(cells: dict[int, dict[int, object]]) -> list[list[object]]:
    """Runs of rows that hold cells (see _sheet)."""
    out: list[list[object]] = []
    for run in _runs(sorted(cells)):
        used = [c for r in run for c in cells[r]]
        out += [[cells[r].get(c, "") for c in range(min(used), max(used) + 1)] for r in run]
        out.append([])
    return out


def _runs(numbers: list[int]) -> list[list[int]]:
    """Sorted numbers by runs without a gap."""
    out: list[list[int]] = []
    for n in numbers:
        if not out or n > out[-1][-1] + 1:
            out.append([])
        out[-1].append(n)
    return out


def regions(rows: list[list[object]]) -> list[list[list[object]]]:
    """Runs of rows that are not empty, each cut to its used columns."""
    out, run = [], []
    for r in [*rows, []]:
        if any(c not in ("", None) for c in r):
            run.append(r)
        elif run:
            used = [k for x in run for k, c in enumerate(x) if c not in ("", None)]
            out.append([x[min(used) : max(used) + 1] for x in run])
            run = []
    return out


def has_header(rows: list[list[object]]) -> bool:
    """Whether a region's first row, all text, heads it: other rows have numbers or dates,
    or its words differ."""
    if len(rows) < 2 or not all(isinstance(c, str) or c is None for c in rows[0]):
        return False
    named = [c.lower() for c in rows[0] if c]
    other = any(isinstance(c, float | int | datetime) and not isinstance(c, bool) for r in rows[1:] for c in r)
    return other or len(set(named)) == len(named)


def sheet_table(rows: list[list[object]]) -> str:
    return text_table([["" if c in ("", None) else _cell_text(c) for c in r] for r in rows], most=50, header=has_header(rows), even=True)


def parse_xlsx(data: bytes) -> tuple[list[Block], dict]:
    out: list[Block] = []
    if data[:4] == b"\xd0\xcf\x11\xe0":
        sheets = xls.read(data, _dated)
        for name, cells in sheets:
            out.append(block("heading", name, 1, sheet_name=name))
            out += [block("table", t, sheet_name=name) for r in regions(_laid(cells)) if (t := sheet_table(r))]
        return out, {"sheetNames": [n for n, _ in sheets], "sheetCount": len(sheets)}
    z = Archive(data)
    book = _part(z, "xl/workbook.xml")
    paths = _targets(z, "xl/workbook.xml")
    shared = _part(z, "xl/sharedStrings.xml")
    strings = ["".join(t.text or "" for r in ([s] if _at(s, "t") is not None else _each(s, "r")) for t in _each(r, "t")) for s in _each(shared, "si")]
    epoch = datetime(1904, 1, 1) if _attr(_at(book, "workbookPr"), "date1904") in ("1", "true") else datetime(1899, 12, 30)
    dates, names = _dates(z), []
    for s in _each(_at(book, "sheets"), "sheet"):
        name = s.get("name", "")
        names.append(name)
        out.append(block("heading", name, 1, sheet_name=name))
        root = _part(z, paths.get(_attr(s, "id") or "", ""))
        if root is not None:
            out += [block("table", t, sheet_name=name) for r in regions(_sheet(root, strings, dates, epoch)) if (t := sheet_table(r))]
    return out, {"sheetNames": names, "sheetCount": len(names)}


# PowerPoint ---------------------------------------------------------------------------


def _body(e: ET.Element | None) -> str:
    """The paragraphs of a text body; explicit bullets become '• '."""
    out = []
    for p in _each(e, "p"):
        t = "".join((_at(r, "t").text or "") if _at(r, "t") is not None else "" for r in _each(p, "r"))
        props = _at(p, "pPr")
        if _at(props, "buChar") is not None or _at(props, "buAutoNum") is not None:
            t = "• " + t
        if trim(t):
            out.append(t)
    return "\n".join(out)


def _holder(shape: ET.Element) -> str | None:
    return _attr(_at(shape, "nvSpPr", "nvPr", "ph"), "type")


def _slide(root: ET.Element, number: int) -> list[Block]:
    tree = _at(root, "cSld", "spTree")
    if root.tag != "sld" or tree is None:
        return []
    title, texts = "", []
    for s in _each(tree, "sp"):
        t = _body(_at(s, "txBody"))
        if t and not title and _holder(s) in ("title", "ctrTitle"):
            title = t
        elif t:
            texts.append(t)
    out = [block("heading", title or f"Slide {number}", 1, slide_number=number)]
    for t in texts:
        lines = [x for x in t.split("\n") if trim(x)]
        listed = len(lines) > 1 and all(_BULLETS.match(x) for x in lines)
        out.append(block("list" if listed else "paragraph", t, slide_number=number))
    for f in _each(tree, "graphicFrame"):
        rows = [[trim(_body(_at(c, "txBody")).replace("\n", " ")) for c in _each(r, "tc")] for r in _each(_at(f, "graphic", "graphicData", "tbl"), "tr")]
        if t := text_table([r for r in rows if r]):
            out.append(block("table", t, slide_number=number))
    return out


def parse_pptx(data: bytes) -> tuple[list[Block], dict]:
    out: list[Block] = []
    z = Archive(data)
    slides = sorted((int(m[1]), n) for n in z.names() if (m := re.fullmatch(r"ppt/slides/slide([0-9]+)\.xml", n)))
    for number, (_, name) in enumerate(slides, 1):
        try:
            out += _slide(_xml(z.read(name)), number)
        except ET.ParseError:
            continue
        notes = _part(z, f"ppt/notesSlides/notesSlide{number}.xml")
        body = next((_at(s, "txBody") for s in _each(_at(notes, "cSld", "spTree"), "sp") if _holder(s) == "body"), None)
        if out and body is not None and (t := _body(body)):
            out[-1]["metadata"] = (out[-1]["metadata"] or {}) | {"speakerNotes": t}
    return out, {"slideCount": len(slides)}


def parse_ppt(data: bytes) -> tuple[list[Block], dict]:
    """Binary slides are not read; a note stands in their place."""
    note = "[Binary PPT format detected. For full parsing support, please convert to PPTX format.]"
    return [block("paragraph", note)], {"format": "binary", "note": "Binary PPT format has limited parsing support"}
