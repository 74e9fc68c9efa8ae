"""Small files of each format, made from a few strings: what the decoder queries read."""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache
from xml.sax.saxutils import escape

from lodestone.sources.parsers import crypt


def archive(parts: dict[str, str]) -> bytes:
    """A zip file of text parts, stored as they are."""
    out, directory, at = [], [], 0
    for name, text in parts.items():
        raw, path = text.encode(), name.encode()
        told = struct.pack("<4HL2L2H", 0, 0, 0, 33, zlib.crc32(raw), len(raw), len(raw), len(path), 0)  # made on 1980-01-01
        out += [b"PK\3\4\x14\0", told, path, raw]
        directory += [b"PK\1\2\x14\3\x14\0", told, struct.pack("<3H2L", 0, 0, 0, 0o600 << 16, at), path]
        at += 30 + len(path) + len(raw)
    held = b"".join(directory)
    return b"".join([*out, held, struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, len(parts), len(parts), len(held), at, 0)])


@lru_cache
def encoded(size: int) -> bytes:
    """An attachment of a size as it stands in a message."""
    return base64.encodebytes(b"x" * size)


def word_paragraph(text: str, style: str = "", num: str = "") -> str:
    """A paragraph with a style id, or of a list: num is its level and its numbering id."""
    of_style = f'<w:pStyle w:val="{style}"/>' if style else ""
    of_list = f'<w:numPr><w:ilvl w:val="{num[0]}"/><w:numId w:val="{num[1]}"/></w:numPr>' if num else ""
    return f"<w:p><w:pPr>{of_style}{of_list}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>"


def word_table(rows: list[list[str]]) -> str:
    cell = lambda t: f"<w:tc>{word_paragraph(escape(t))}</w:tc>"
    return f"<w:tbl>{''.join(f'<w:tr>{"".join(map(cell, r))}</w:tr>' for r in rows)}</w:tbl>"


def word(body: str, styles: str = "", numbering: str = "") -> bytes:
    ns = 'xmlns:w="w"'
    return archive({"word/document.xml": f"<w:document {ns}><w:body>{body}</w:body></w:document>", "word/styles.xml": f"<w:styles {ns}>{styles}</w:styles>", "word/numbering.xml": f"<w:numbering {ns}>{numbering}</w:numbering>"})


def docx(key: int, name: str, segment: str, nation: int) -> bytes:
    styles = '<w:style w:styleId="H2"><w:name w:val="heading 2"/></w:style><w:style w:styleId="T"><w:name w:val="Title"/></w:style>'
    numbering = '<w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:numFmt w:val="decimal"/></w:lvl></w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="0"/></w:num>'
    p = word_paragraph
    body = p(name, "T") + p(f"Plain &amp;lt;{segment}&amp;gt;") + p(f"Part {nation}", "H2") + p(f"{segment} NOTES") + p(f"{nation}.2 About {name}")
    return word(body + p(segment, num="05") + p(f"key {key}", num="05") + word_table([["key", name], [str(key), segment]]) + p(f"end of {key}"), styles, numbering)


def xlsx(key: int, name: str, segment: str, nation: int) -> bytes:
    """A sheet with a table of a number and a date, a row apart, and one of text only."""
    cell = lambda ref, v, t="", s="": f'<c r="{ref}"{f" t={chr(34)}{t}{chr(34)}" if t else ""}{f" s={chr(34)}{s}{chr(34)}" if s else ""}><v>{v}</v></c>'
    rows = (
        f"<row>{cell('B2', 0, 's')}{cell('C2', 1, 's')}</row><row>{cell('B3', key + 0.5)}{cell('C3', 45292 + nation, s='1')}</row><row>{cell('B5', 2, 's')}</row>"
        f"<row>{cell('D7', segment, 'str')}{cell('E7', segment, 'str')}</row><row>{cell('D8', 'x', 'str')}{cell('E8', 1, 'b')}</row>"
    )
    return archive({
        "xl/workbook.xml": f'<workbook xmlns:r="r"><sheets><sheet name="{escape(name)}" r:id="x1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="x1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{rows}</sheetData></worksheet>", "xl/sharedStrings.xml": f"<sst><si><t>Name</t></si><si><r><t>Wh</t></r><r><t>en</t></r></si><si><t>{escape(segment * 8)}</t></si></sst>",
        "xl/styles.xml": '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    })


def pptx(key: int, name: str, segment: str, nation: int) -> bytes:
    ns = 'xmlns:p="p" xmlns:a="a"'
    shape = lambda kind, *lines: f'<p:sp><p:nvSpPr><p:nvPr>{f"<p:ph type={chr(34)}{kind}{chr(34)}/>" if kind else ""}</p:nvPr></p:nvSpPr><p:txBody>{"".join(f"<a:p>{x}</a:p>" for x in lines)}</p:txBody></p:sp>'
    run = lambda t, bullet="": f"{'<a:pPr><a:buChar/></a:pPr>' if bullet else ''}<a:r><a:t>{escape(str(t))}</a:t></a:r>"
    slide = lambda inner: f"<p:sld {ns}><p:cSld><p:spTree>{inner}</p:spTree></p:cSld></p:sld>"
    row = lambda *cells: f"<a:tr>{''.join(f'<a:tc><a:txBody><a:p>{run(c)}</a:p></a:txBody></a:tc>' for c in cells)}</a:tr>"
    frame = f"<p:graphicFrame><a:graphic><a:graphicData><a:tbl>{row('key', name)}{row(key, segment)}</a:tbl></a:graphicData></a:graphic></p:graphicFrame>"
    return archive({
        "ppt/slides/slide10.xml": slide(shape("", run(f"text {nation}"))), "ppt/slides/slide2.xml": slide(shape("title", run(name)) + shape("", run(segment, 1), run(key, 1)) + frame), "ppt/slides/slide11.xml": "<broken",
        "ppt/notesSlides/notesSlide1.xml": f"<p:notes {ns}><p:cSld><p:spTree>{shape('body', run(f'say {segment}'))}</p:spTree></p:cSld></p:notes>",
    })


def eml(key: int, name: str, segment: str, nation: int) -> bytes:
    """A message with an attachment, as the email package writes it; all strings are short and ASCII."""
    edge = f"==============={key:019d}=="
    head = (
        f"Subject: About {name}\nFrom: {segment} <c{key}@x.org>\nTo: a@b.c, Bo <n{nation}@b.c>\nCc: c@d.e\nDate: Tue, 02 Jan 2024 15:{nation:02d}:05 +0000\n"
        f'MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="{edge}"\n\n--{edge}\nContent-Type: text/plain; charset="utf-8"\nContent-Transfer-Encoding: 7bit\n\n'
        f"Hello {name}\n\nRegards,\n{segment}\n\nOn Monday he wrote:\n> old {key}\n> text\n\n--{edge}\nContent-Type: application/pdf\nContent-Transfer-Encoding: base64\n"
        f'Content-Disposition: attachment; filename="f{key}.pdf"\nMIME-Version: 1.0\n\n'
    )
    return head.encode() + encoded(512 * nation) + f"\n--{edge}--\n".encode()


def eml_of_html(key: int, name: str, segment: str, nation: int) -> bytes:
    head = 'Content-Type: text/html; charset="utf-8"\nContent-Transfer-Encoding: 7bit\nMIME-Version: 1.0\n\n'
    return f"{head}<style>x</style><p>A &amp; {segment}</p><p>C<br>{key}</p>\n".encode()


def compound(streams: dict[tuple[str, ...], bytes]) -> bytes:
    """A compound file with small streams, by path."""
    names = sorted({p[:k] for p in streams for k in range(1, len(p) + 1)})
    mini, mini_fat, starts = b"", [], {}
    for p, v in streams.items():
        starts[p] = len(mini) // 64 if v else 0xFFFFFFFE
        n = -(-len(v) // 64)
        mini += v.ljust(n * 64, b"\0")
        mini_fat += [len(mini_fat) + k + 1 for k in range(n - 1)] + [0xFFFFFFFE] * bool(n)
    kids: dict[tuple[str, ...], list[int]] = {}
    for k, p in enumerate(names, 1):
        kids.setdefault(p[:-1], []).append(k)
    none = 0xFFFFFFFF

    def entry(name: str, kind: int, right: int, child: int, start: int, size: int) -> bytes:
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, none, right, child) + b"\0" * 36 + struct.pack("<IQ", start, size)

    mini_sectors = -(-len(mini) // 512)
    dir_sectors = -(-(len(names) + 1) // 4)
    # sectors: 0 fat, 1 mini fat, then directory, then mini stream
    first_mini = 2 + dir_sectors
    out = entry("Root Entry", 5, none, kids[()][0], first_mini, len(mini))
    for k, p in enumerate(names, 1):
        siblings = kids[p[:-1]]
        right = next((s for s in siblings if s > k), none)
        out += entry(p[-1], 2 if p in streams else 1, right, kids[p][0] if p in kids else none, starts.get(p, 0), len(streams.get(p, b"")))
    fat = [0xFFFFFFFD, 0xFFFFFFFE] + [2 + k + 1 for k in range(dir_sectors - 1)] + [0xFFFFFFFE] + [first_mini + k + 1 for k in range(mini_sectors - 1)] + [0xFFFFFFFE]
    table = lambda x: struct.pack("<128I", *x, *[none] * (128 - len(x)))
    head = bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<IIIIIIIII", 1, 2, 0, 4096, 1, 1, 0xFFFFFFFE, 0, 0)
    return (head + struct.pack("<108I", *[none] * 108)).ljust(512, b"\xff")[:512] + table(fat) + table(mini_fat) + out.ljust(dir_sectors * 512, b"\0") + mini.ljust(mini_sectors * 512, b"\0")


def msg(key: int, name: str, segment: str, nation: int) -> bytes:
    """An Outlook message of the second day of 2024, `nation` minutes after 20:07."""
    u = lambda t: t.encode("utf-16-le")
    when = struct.pack("<II", 0x30070040, 0) + struct.pack("<Q", 133486996200000000 + nation * 600000000)
    return compound({
        ("__substg1.0_0037001F",): u(f"Topic {name}"), ("__substg1.0_0C1F001F",): u(f"c{key}@x.org"), ("__substg1.0_1000001F",): u(f"Line {segment}\r\n\r\n--\r\nS"), ("__properties_version1.0",): b"\0" * 32 + when,
        ("__recip_version1.0_#00000000", "__substg1.0_39FE001F"): u(f"n{nation}@x.org"), ("__attach_version1.0_#00000000", "__substg1.0_3707001F"): u(f"a{key}.bin"), ("__attach_version1.0_#00000000", "__substg1.0_37010102"): b"12345",
    })


def biff(kind: int, body: bytes = b"") -> bytes:
    """A record of a legacy workbook."""
    return struct.pack("<HH", kind, len(body)) + body


def biff_text(text: str, count: str = "H") -> bytes:
    wide = max(map(ord, text), default=0) > 255
    return struct.pack(f"<{count}B", len(text.encode("utf-16-le")) // 2, wide) + text.encode("utf-16-le" if wide else "latin-1")


def workbook(sheets: dict[str, bytes], strings: list[str], head: bytes = b"", cut: int = 8000) -> bytes:
    """A legacy workbook of sheets of records; the table of strings goes on in a further record after `cut` bytes."""
    parts = [struct.pack("<II", len(strings), len(strings))]
    for text in strings:
        raw = biff_text(text)
        if len(parts[-1]) + 3 > cut:
            parts.append(b"")
        parts[-1] += raw[:3]
        wide, raw = raw[2], raw[3:]
        while raw:
            room = (cut - len(parts[-1])) // (1 + wide) * (1 + wide)
            if room <= 0:  # what goes on tells anew whether it is wide
                parts.append(bytes([wide]))
            else:
                parts[-1] += raw[:room]
                raw = raw[room:]
    begin = biff(0x809, struct.pack("<HHHH", 0x600, 5, 0, 0)) + head + biff(0xFC, parts[0]) + b"".join(biff(0x3C, p) for p in parts[1:])
    at = len(begin) + sum(4 + 6 + len(biff_text(n, "B")) for n in sheets) + 4
    index = data = b""
    for name, records in sheets.items():
        index += biff(0x85, struct.pack("<IBB", at + len(data), 0, 0) + biff_text(name, "B"))
        data += biff(0x809, struct.pack("<HHHH", 0x600, 0x10, 0, 0)) + records + biff(0xA)
    return compound({("Workbook",): begin + index + biff(0xA) + data})


def xls(key: int, name: str, segment: str, nation: int) -> bytes:
    """The sheet of `xlsx` as a legacy workbook."""
    at = lambda row, col, style=0: struct.pack("<HHH", row, col, style)
    whole = lambda n: (n << 2 | 2) & 0xFFFFFFFF
    formula = biff(0x06, at(6, 3) + b"\0" * 6 + b"\xff\xff" + b"\0" * 8) + biff(0x207, biff_text(segment))
    cells = (
        biff(0xFD, at(1, 1) + struct.pack("<I", 0)) + biff(0xFD, at(1, 2) + struct.pack("<I", 1)) + biff(0x203, at(2, 1) + struct.pack("<d", key + 0.5)) + biff(0x27E, at(2, 2, 1) + struct.pack("<I", whole(45292 + nation)))
        + biff(0xFD, at(4, 1) + struct.pack("<I", 2)) + formula + biff(0x204, at(6, 4) + biff_text(segment)) + biff(0x204, at(7, 3) + biff_text("x")) + biff(0x205, at(7, 4) + b"\1\0")
    )
    styles = biff(0xE0, struct.pack("<HH", 0, 0) + b"\0" * 16) + biff(0xE0, struct.pack("<HH", 0, 14) + b"\0" * 16)
    return workbook({name: cells}, ["Name", "When", segment * 8], styles)


@lru_cache
def encryption(r: int, first_id: bytes) -> tuple[str, Callable[[int, bytes], bytes]]:
    """The entries of an encryption dictionary of revision r for an empty password, and what encrypts an object's data."""
    v = {2: 1, 3: 2, 4: 4}.get(r, 5)
    text = f"/Filter /Standard /V {v} /R {r} /P -44 /Length 128"
    if v < 5:
        owner = bytes(range(32))
        key = crypt.early_key({"V": v, "R": r, "O": owner, "P": -44, "Length": 128}, first_id)
        text += f" /O <{owner.hex()}> /U <{crypt.early_check(key, r, first_id).ljust(32, bytes(1)).hex()}>"
    else:
        key = bytes(range(100, 132))
        user = crypt.hardened(b"validate", r) + b"validate" + b"key salt"
        text += f" /O <{bytes(48).hex()}> /OE <{bytes(32).hex()}> /U <{user.hex()}> /UE <{crypt.cbc_encrypt(crypt.hardened(b'key salt', r), bytes(16), key).hex()}>"
    if v >= 4:
        text += f" /CF << /StdCF << /CFM /{'AESV2' if v == 4 else 'AESV3'} >> >> /StmF /StdCF /StrF /StdCF"

    def seal(number: int, data: bytes) -> bytes:
        salted = key + struct.pack("<I", number)[:3] + bytes(2) + (b"sAlT" if v == 4 else b"")
        own = key if v == 5 else hashlib.md5(salted).digest()[: min(len(key) + 5, 16)]
        fill = 16 - len(data) % 16
        return crypt.rc4(own, data) if v < 4 else bytes(16) + crypt.cbc_encrypt(own, bytes(16), data + bytes([fill]) * fill)

    return text, seal


def pdf(key: int, name: str, segment: str, nation: int, revision: int = 0) -> bytes:
    """Two pages, their streams deflated; encrypted by a revision of the standard handler."""
    entries, seal = encryption(revision, b"id of file") if revision else ("", lambda _, data: data)
    page = lambda lines: zlib.compress(("BT /F1 12 Tf 14 TL 50 700 Td " + " ".join(f"({x}) Tj T*" if x else "T*" for x in lines) + " ET").encode())
    first = [f"{nation}. Intro {name}", f"some text \\({segment}\\)", f"goes on {key}", f"a   b   {key}", "d   e   f", "end of it", "", f"Chapter {nation}: {segment}", f"- item {key}", "- item two"]
    streams = [page(first), page([f"Second page of {name}"])]
    objects = ["<< /Type /Catalog /Pages 2 0 R >>", "<< /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 >>", "<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>", "<< /Type /Page /Parent 2 0 R /Contents [6 0 R] >>"]
    data = b"%PDF-1.4\n" + b"".join(f"{k} 0 obj {o} endobj\n".encode() for k, o in enumerate(objects, 1))
    for k, s in enumerate(streams, 5):
        s = seal(k, s)
        data += f"{k} 0 obj << /Length {len(s)} /Filter /FlateDecode >> stream\n".encode() + s + b"\nendstream endobj\n"
    data += f"7 0 obj << /Title <{seal(7, segment.encode()).hex()}> >> endobj\n".encode()
    if revision:
        return data + f"8 0 obj << {entries} >> endobj\ntrailer << /Root 1 0 R /Info 7 0 R /Encrypt 8 0 R /ID [(id of file) (x)] >>\n%%EOF".encode()
    return data + b"trailer << /Root 1 0 R /Info 7 0 R >>\n%%EOF"


def pdf_encrypted(key: int, name: str, segment: str, nation: int) -> bytes:
    """The same file, encrypted by one of the revisions 2 to 5."""
    return pdf(key, name, segment, nation, 2 + nation % 4)


def md(key: int, name: str, segment: str, nation: int) -> bytes:
    return (
        f"# {name} #\n\npara **{segment}**\nsecond {key}\n\n{segment}\n---\n\n```py\nx = {key}\n```\n\n    indented {nation}\n\n| a | b |\n|---|:-:|\n| {key} | 2 \\| {segment} |\n| {nation} |\n\n"
        f"4. {segment}\n   - in {key}\n   - side\n5. two\n\n> quote {key}\n> more\n\n<div>html <b>{segment}</b></div>\n\n***\n[ref]: http://x\n"
    ).encode()


def html(key: int, name: str, segment: str, nation: int) -> bytes:
    return (
        f"<html><head><title> {name} </title><meta name=description content='{segment}'></head><body><header><h1>gone</h1></header><nav>n</nav><p>One <code>c</code> &amp; {segment}<div>loose text of {key}</div>tiny"
        f"<h2>Head {nation}</h2>short<!-- c --><p>P {key}</p> tail <code>inline</code><pre>a\n  {key}</pre><table><tr><th>k</th><th>{name}</th></tr><tr><td>{key}</td></tr></table>"
        f"<ol><li>{segment}<ul><li>y</li></ul></li><li>z</li></ol><blockquote>q\n{segment}</blockquote><figure><figcaption>cap {key}</figcaption></figure><custom>leaf</custom></body></html>"
    ).encode()


MAKERS = {"docx": docx, "xlsx": xlsx, "xls": xls, "pptx": pptx, "eml": eml, "eml_of_html": eml_of_html, "msg": msg, "pdf": pdf, "pdf_encrypted": pdf_encrypted, "md": md, "html": html}
