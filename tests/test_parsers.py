"""Format decoders on small documents made here."""

import io
import random
import re
import struct
import time
import zipfile
import zlib
from email.message import EmailMessage

import pytest

from lodestone.operators.documents import chunks
from lodestone.plans import samples
from lodestone.sources.parsers import crypt, html, parse


def shapes(blocks):
    return [(b["type"], b["content"], b.get("level")) for b in blocks]


def pack(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_txt():
    text = "Title\n=====\n\nBody one\nline two\n\n---\nafter rule\n\n- a\n- b\n\nName  Age  City\nJo    30   Ulm\n\nNOTES\n\nx\n    code a\n    code b\n    code c\n    code d\n"
    blocks, _ = parse(text.encode(), "txt")
    assert shapes(blocks) == [
        ("heading", "Title", 1), ("paragraph", "Body one\nline two", None), ("heading", "", 2), ("paragraph", "after rule", None), ("list", "- a\n- b", None),
        ("table", "Name  Age  City\nJo    30   Ulm", None), ("heading", "NOTES", 1), ("code", "x\n    code a\n    code b\n    code c\n    code d", None),
    ]
    got = chunks(blocks, "d", "txt", "p", {})
    assert [c["heading_path"] for c in got] == [["Title"], ["Title", ""], ["NOTES"]]
    assert got[1]["title_text"] == "Title" and got[1]["section_title"] == "" and got[1]["is_table"] and got[2]["is_code"]


def test_md():
    text = "# A #\n\npara **bold**\nsecond\n\nSet\n---\n\n```py\nx = 1\n```\n\n    indented\n\n| a | b |\n|---|:-:|\n| 1 | 2 \\| 3 |\n| 4 |\n\n1. one\n   - in\n   - side\n2. two\n\n> quote\n> more\n\n<div>html <b>x</b></div>\n\n***\n[ref]: http://x\n"
    blocks, _ = parse(text.encode(), "md")
    assert shapes(blocks) == [
        ("heading", "A", 1), ("paragraph", "para **bold**\nsecond", None), ("heading", "Set", 2), ("code", "x = 1", None), ("code", "indented", None),
        ("table", "a | b\n--- | ---\n1 | 2 | 3\n4 | ", None), ("list", "1. one\n  - in\n  - side\n2. two", None), ("paragraph", "> quote\n> more", None), ("paragraph", "html x", None),
    ]
    assert blocks[3]["metadata"] == {"language": "py"}
    assert shapes(parse(b"- a\n\n- b\n\npara", "md")[0]) == [("list", "- a\n- b", None), ("paragraph", "para", None)]


def test_html():
    page = """<html><head><title> T </title><meta name=description content="D"></head><body><header><h1>gone</h1></header><nav>n</nav>
    <p>One <code>c</code> &amp; two<div>loose text of some length</div>tiny<h2>Head</h2>short<!-- c --><p>P</p> tail <code>inline</code>
    <pre>a
  b</pre><table><tr><th>k</th><th>value</th></tr><tr><td>1</td></tr></table><ol><li>x<ul><li>y</li></ul></li><li>z</li></ol><blockquote>q
r</blockquote><figure><figcaption>cap</figcaption></figure><custom>leaf</custom><p><b>un<p>closed</body></html>"""
    blocks, meta = parse(page.encode(), "html")
    assert meta == {"title": "T", "description": "D"}
    assert shapes(blocks) == [
        ("paragraph", "One c & two loose text of some length tiny", None), ("heading", "Head", 2), ("paragraph", "P tail `inline`", None), ("code", "a\n  b", None),
        ("table", "k   | value\n----+------\n1  ", None), ("list", "1. x\n  - y\n2. z", None),
        ("paragraph", "> q\n> r", None), ("paragraph", "cap", None), ("paragraph", "leaf", None), ("paragraph", "un", None), ("paragraph", "closed", None),
    ]
    assert parse(b"plain text without any body", "html")[0][0]["content"] == "plain text without any body"


W = 'xmlns:w="w"'


def word(body, styles="", numbering=""):
    return pack({"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", "word/styles.xml": f"<w:styles {W}>{styles}</w:styles>", "word/numbering.xml": f"<w:numbering {W}>{numbering}</w:numbering>"})


def para(text, style="", num=""):
    level = f'<w:numPr><w:ilvl w:val="{num[0]}"/><w:numId w:val="{num[1]}"/></w:numPr>' if num else ""
    return f'<w:p><w:pPr>{f"<w:pStyle w:val={chr(34)}{style}{chr(34)}/>" if style else ""}{level}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'


def test_docx():
    styles = '<w:style w:styleId="H2"><w:name w:val="heading 2"/></w:style><w:style w:styleId="T"><w:name w:val="Title"/></w:style>'
    numbering = '<w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:numFmt w:val="decimal"/></w:lvl></w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="0"/></w:num>'
    table = f"<w:tbl><w:tr><w:tc>{para('k')}</w:tc><w:tc>{para('v1')}{para('v2')}</w:tc></w:tr><w:tr><w:tc>{para('a')}</w:tc><w:tc>{para('')}</w:tc></w:tr></w:tbl>"
    data = word(para("Doc", "T") + para("Plain &amp;lt;x&amp;gt;") + para("Sub", "H2") + para("ALL CAPS") + para("1.2 Numbered part") + para("one", num="05") + para("two", num="05") + table, styles, numbering)
    blocks, _ = parse(data, "docx")
    assert shapes(blocks) == [
        ("heading", "Doc", 1), ("paragraph", "Plain <x>", None), ("heading", "Sub", 2), ("heading", "ALL CAPS", 2), ("heading", "1.2 Numbered part", 2), ("list", "1. one\n2. two", None),
        ("table", "k   | v1v2\n----+-----\na   |     ", None),
    ]


def test_docx_nested_list_takes_the_outer_items_place():
    data = word(para("a", num="01") + para("b", num="11") + para("c", num="01"))
    assert shapes(parse(data, "docx")[0]) == [("list", "- b", None), ("paragraph", "c", None)]


def test_xlsx():
    s = '<row r="{r}">{c}</row>'
    cell = lambda ref, v, t="", st="": f'<c r="{ref}"{f" t={chr(34)}{t}{chr(34)}" if t else ""}{f" s={chr(34)}{st}{chr(34)}" if st else ""}><v>{v}</v></c>'
    rows = s.format(r=2, c=cell("B2", 0, "s") + cell("C2", 1, "s")) + s.format(r=3, c=cell("B3", 1.5) + cell("C3", 45292, st="1")) + s.format(r=5, c=cell("B5", 2, "s"))
    data = pack({
        "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="S1" r:id="x1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="x1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{rows}</sheetData></worksheet>", "xl/sharedStrings.xml": f"<sst><si><t>Name</t></si><si><r><t>Wh</t></r><r><t>en</t></r></si><si><t>{'z' * 60}</t></si></sst>",
        "xl/styles.xml": '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    })
    blocks, meta = parse(data, "xlsx")
    assert meta == {"sheetNames": ["S1"], "sheetCount": 1}
    assert shapes(blocks) == [("heading", "S1", 1), ("table", "Name | When    \n-----+---------\n1.5  | 1/1/2024", None), ("table", "z" * 47 + "...", None)]
    assert {b["sheet_name"] for b in blocks} == {"S1"}


def test_pptx():
    ns = 'xmlns:p="p" xmlns:a="a"'
    shape = lambda kind, *lines: f'<p:sp><p:nvSpPr><p:nvPr>{f"<p:ph type={chr(34)}{kind}{chr(34)}/>" if kind else ""}</p:nvPr></p:nvSpPr><p:txBody>{"".join(f"<a:p>{x}</a:p>" for x in lines)}</p:txBody></p:sp>'
    run = lambda t, bullet="": f"{'<a:pPr><a:buChar/></a:pPr>' if bullet else ''}<a:r><a:t>{t}</a:t></a:r>"
    slide = lambda inner: f"<p:sld {ns}><p:cSld><p:spTree>{inner}</p:spTree></p:cSld></p:sld>"
    frame = f"<p:graphicFrame><a:graphic><a:graphicData><a:tbl><a:tr><a:tc><a:txBody><a:p>{run('k')}</a:p></a:txBody></a:tc></a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>"
    data = pack({
        "ppt/slides/slide10.xml": slide(shape("", run("text"))), "ppt/slides/slide2.xml": slide(shape("title", run("Hello")) + shape("", run("a", 1), run("b", 1)) + frame), "ppt/slides/slide11.xml": "<broken",
        "ppt/notesSlides/notesSlide1.xml": f"<p:notes {ns}><p:cSld><p:spTree>{shape('body', run('say this'))}</p:spTree></p:cSld></p:notes>",
    })
    blocks, meta = parse(data, "pptx")
    assert meta == {"slideCount": 3}
    assert shapes(blocks) == [("heading", "Hello", 1), ("list", "• a\n• b", None), ("table", "k  ", None), ("heading", "Slide 2", 1), ("paragraph", "text", None)]
    assert blocks[2]["metadata"] == {"speakerNotes": "say this"} and [b["slide_number"] for b in blocks] == [1, 1, 1, 2, 2]
    blocks, meta = parse(b"any", "ppt")
    assert blocks[0]["content"].startswith("[Binary PPT") and meta["format"] == "binary"


def test_eml():
    m = EmailMessage()
    m["Subject"], m["From"], m["To"], m["Cc"], m["Date"] = "Hi", "Jo <jo@x.org>", "a@b.c, Bo <bo@b.c>", "c@d.e", "Tue, 02 Jan 2024 15:04:05 +0000"
    m.set_content("Hello\n\nRegards,\nJo\n\nOn Monday he wrote:\n> old\n> text\n")
    m.add_attachment(b"x" * 2048, maintype="application", subtype="pdf", filename="f.pdf")
    blocks, meta = parse(m.as_bytes(), "eml")
    assert shapes(blocks) == [
        ("heading", "Hi", 1), ("email-header", "From: Jo <jo@x.org>\nTo: a@b.c, Bo <bo@b.c>\nCC: c@d.e\nDate: 1/2/2024, 3:04:05 PM", None), ("paragraph", "Hello", None), ("paragraph", "Regards,\nJo", None),
        ("paragraph", "On Monday he wrote:\n> old\n> text", None), ("attachment-list", "Attachments:\n• f.pdf (2.0 KB)", None),
    ]
    assert meta["date"] == "2024-01-02T15:04:05.000Z" and blocks[3]["metadata"] == {"isSignature": True} and blocks[4]["metadata"] == {"isQuotedReply": True}
    html = EmailMessage()
    html.set_content("<p>A &amp; B</p><p>C<br>D</p>", subtype="html")
    assert [b["content"] for b in parse(html.as_bytes(), "eml")[0]] == ["No Subject", "A & B", "C\nD"]


def compound(streams):
    """A compound file with small streams, by path."""
    names = sorted({p[:k] for p in streams for k in range(1, len(p) + 1)})
    mini, mini_fat, starts = b"", [], {}
    for p, v in streams.items():
        starts[p] = len(mini) // 64 if v else 0xFFFFFFFE
        n = -(-len(v) // 64)
        mini += v.ljust(n * 64, b"\0")
        mini_fat += [len(mini_fat) + k + 1 for k in range(n - 1)] + [0xFFFFFFFE] * bool(n)
    kids = {}
    for k, p in enumerate(names, 1):
        kids.setdefault(p[:-1], []).append(k)
    none = 0xFFFFFFFF

    def entry(name, kind, right, child, start, size):
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


def test_msg():
    u = lambda t: t.encode("utf-16-le")
    when = struct.pack("<II", 0x30070040, 0) + struct.pack("<Q", 133486600450000000)
    data = compound({
        ("__substg1.0_0037001F",): u("Topic"), ("__substg1.0_0C1F001F",): u("s@x.org"), ("__substg1.0_1000001F",): u("Line\r\n\r\n--\r\nS"), ("__properties_version1.0",): b"\0" * 32 + when,
        ("__recip_version1.0_#00000000", "__substg1.0_39FE001F"): u("r@x.org"), ("__attach_version1.0_#00000000", "__substg1.0_3707001F"): u("a.bin"), ("__attach_version1.0_#00000000", "__substg1.0_37010102"): b"12345",
    })
    blocks, meta = parse(data, "msg")
    assert meta["subject"] == "Topic" and meta["from"] == "s@x.org" and meta["to"] == "r@x.org" and meta["date"].startswith("2024-01-02T")
    assert [b["content"] for b in blocks if b["type"] != "email-header"] == ["Topic", "Line", "--\nS", "Attachments:\n• a.bin"]


def test_pdf():
    page = lambda lines: zlib.compress(("BT /F1 12 Tf 14 TL 50 700 Td " + " ".join(f"({x}) Tj T*" if x else "T*" for x in lines) + " ET").encode())
    streams = [page(["1. Intro", "Some text \\(here\\)", "goes on", "a   b   c", "d   e   f", "end of it"]), page(["Second page text"])]
    objects = ["<< /Type /Catalog /Pages 2 0 R >>", "<< /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 >>", "<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>", "<< /Type /Page /Parent 2 0 R /Contents [6 0 R] >>"]
    data = b"%PDF-1.4\n" + b"".join(f"{k} 0 obj {o} endobj\n".encode() for k, o in enumerate(objects, 1))
    for k, s in enumerate(streams, 5):
        data += f"{k} 0 obj << /Length {len(s)} /Filter /FlateDecode >> stream\n".encode() + s + b"\nendstream endobj\n"
    data += b"7 0 obj << /Title (The Title) >> endobj\ntrailer << /Root 1 0 R /Info 7 0 R >>\n%%EOF"
    blocks, meta = parse(data, "pdf")
    assert meta == {"pageCount": 2, "info": {"Title": "The Title"}}
    assert shapes(blocks) == [("heading", "1. Intro", 1), ("paragraph", "Some text (here)\ngoes on", None), ("table", "a   b   c\nd   e   f", None), ("paragraph", "end of it", None), ("heading", "Second page text", 2)]
    assert [b["page_number"] for b in blocks] == [1, 1, 1, 1, 2]
    with pytest.raises(ValueError):
        parse(b"no pdf", "pdf")


def test_ciphers():
    """Vectors of the published standards: AES of 128 and 256 bits, RC4."""
    plain, key = bytes.fromhex("00112233445566778899aabbccddeeff"), bytes(range(32))
    for k, coded in ((key[:16], "69c4e0d86a7b0430d8cdb78070b4c55a"), (key, "8ea2b7ca516745bfeafc49904b496089")):
        assert crypt.cbc_encrypt(k, bytes(16), plain).hex() == coded
        assert crypt.cbc_decrypt(k, bytes(16), bytes.fromhex(coded)) == plain
    long = bytes(range(256)) * 3
    assert crypt.cbc_decrypt(key, plain, crypt.cbc_encrypt(key, plain, long)) == long
    assert crypt.rc4(b"Key", b"Plaintext").hex() == "bbf316e8d940af0ad3"


@pytest.mark.parametrize("revision", [2, 3, 4, 5, 6])
def test_encrypted_pdf(revision):
    args = (7, "Name", "SEGMENT", 3)
    plain, sealed = samples.pdf(*args), samples.pdf(*args, revision)
    assert b"SEGMENT" not in sealed and parse(sealed, "pdf") == parse(plain, "pdf")
    u = re.search(rb"/U <(..)", sealed)
    other = sealed[: u.start(1)] + (b"00" if u[1] != b"00" else b"01") + sealed[u.end(1) :]
    with pytest.raises(ValueError, match="password"):
        parse(other, "pdf")
    with pytest.raises(ValueError, match="unknown"):
        parse(sealed.replace(b"/Standard", b"/Elsewhere"), "pdf")


def test_xls_equals_its_twin():
    """A legacy workbook gives the blocks of the same sheet in the newer format."""
    from lodestone.plans import samples

    for args in ((1, "Customer#1", "BUILDING", 3), (77, "Ünï — 表", "HOUSEHOLD CÔ", 24)):
        old, meta = parse(samples.xls(*args), "xlsx")
        assert (old, meta) == parse(samples.xlsx(*args), "xlsx") and len(old) == 4


def test_xls_strings_over_records():
    """Shared strings that a record's end cuts anywhere, narrow and wide ones."""
    from lodestone.plans.samples import biff, workbook

    strings = ["", "plain text of some length", "wide — " * 5, "é" * 40, "", "x"]
    cells = b"".join(biff(0xFD, struct.pack("<HHHI", k, 0, 0, k)) for k in range(len(strings)))
    for cut in range(12, 90):
        data = workbook({"S": cells}, strings, cut=cut)
        shown = [r[0] for t in parse(data, "xlsx")[0] if t["type"] == "table" for r in [x.split(" | ") for x in t["content"].split("\n")]]
        want = [x if len(x) <= 50 else x[:47] + "..." for x in strings if x]
        assert [x.strip() for x in shown if set(x) != {"-"}] == [x.strip() for x in want], cut


def test_xls_numbers_and_formats():
    from lodestone.plans.samples import biff, biff_text, workbook
    from lodestone.sources.parsers.xls import rk

    assert [rk(n) for n in (0x3FF00000, 0x3FF00001, 5 << 2 | 2, (5 << 2 | 3), (-7 << 2 | 2) & 0xFFFFFFFF)] == [1.0, 0.01, 5.0, 0.05, -7.0]
    xf = lambda f: biff(0xE0, struct.pack("<HH", 0, f) + b"\0" * 16)
    head = biff(0x22, b"\1\0") + biff(0x41E, struct.pack("<H", 164) + biff_text("yyyy-mm")) + biff(0x41E, struct.pack("<H", 165) + biff_text('0 "days"')) + xf(0) + xf(164) + xf(165)
    many = biff(0xBD, struct.pack("<HH", 0, 1) + b"".join(struct.pack("<HI", k, 10 << 2 | 2) for k in range(3)) + struct.pack("<H", 3))
    formula = lambda row, result: biff(0x06, struct.pack("<HHH", row, 1, 0) + result + b"\0" * 8)
    cells = many + formula(1, struct.pack("<d", 2.5)) + formula(2, b"\1\0\1\0\0\0\xff\xff") + formula(3, b"\2\0\7\0\0\0\xff\xff") + biff(0x205, struct.pack("<HHHBB", 4, 1, 0, 0x2A, 1))
    chart = biff(0x809, b"\0\6\x20\0") + biff(0x203, struct.pack("<HHHd", 1, 9, 0, 9.0)) + biff(0xA)
    blocks, _ = parse(workbook({"N": cells + chart + biff(0x201, b"\5\0\1\0\0\0")}, [], head), "xlsx")
    assert [[c.strip() for c in x.split(" | ")] for x in blocks[1]["content"].split("\n")] == [["10", "1/11/1904", "10"], ["2.5", "", ""], ["true", "", ""], ["#DIV/0!", "", ""], ["#N/A", "", ""]]
    from lodestone.plans.samples import compound as make

    for streams in ({("Workbook",): biff(0x809, b"\0\6\5\0") + biff(0x2F, b"\0\0") + biff(0xA)}, {("EncryptedPackage",): b"x"}, {("Book",): b"old"}):
        with pytest.raises(ValueError, match="Encrypted|BIFF8"):
            parse(make(streams), "xlsx")


def shown(node):
    return "".join(c if isinstance(c, str) else f"<{c.name}>{shown(c)}</{c.name}>" for c in node.children)


# the standard's own examples of misnested markup, and cases of the published tests of tree construction
TREES = {
    "<p>1<b>2<i>3</b>4</i>5</p>": "<p>1<b>2<i>3</i></b><i>4</i>5</p>",
    "<b>1<p>2</b>3</p>": "<b>1</b><p><b>2</b>3</p>",
    "<table><b><tr><td>aaa</td></tr>bbb</table>ccc": "<b></b><b>bbb</b><table><tbody><tr><td>aaa</td></tr></tbody></table><b>ccc</b>",
    "<a>1<p>2</a>3</p>": "<a>1</a><p><a>2</a>3</p>",
    "<a href=x>1<a href=y>2": "<a>1</a><a>2</a>",
    "<font><p>hello<b>cruel</font>world": "<font></font><p><font>hello<b>cruel</b></font><b>world</b></p>",
    "<b><em><foo><foob><fooc><aside></b></em>": "<b><em><foo><foob><fooc></fooc></foob></foo></em></b><aside><b></b></aside>",
    "<b>1<div>2<div>3</b>4</div>5</div>": "<b>1</b><div><b>2</b><div><b>3</b>4</div>5</div>",
    "<a><table><td><a><table></table><a></tr><a></table><b>X</b>C<a>Y": "<a><a></a><table><tbody><tr><td><a><table></table></a><a></a></td></tr></tbody></table></a><a><b>X</b>C</a><a>Y</a>",
    "<table>x<tr><td>y</table>z": "x<table><tbody><tr><td>y</td></tr></tbody></table>z",
    "<table><tr><p>a</p><td>b<table><td>c</table>d</table>": "<p>a</p><table><tbody><tr><td>b<table><tbody><tr><td>c</td></tr></tbody></table>d</td></tr></tbody></table>",
    "<table><td>a<td>b<tr><th>c<caption>d": "<table><tbody><tr><td>a</td><td>b</td></tr><tr><th>c</th></tr></tbody><caption>d</caption></table>",
    "<table><tr><td><b>a</td><td>c</table>d": "<table><tbody><tr><td><b>a</b></td><td>c</td></tr></tbody></table>d",
    "<p>a<table><tr><td>b</table>c": "<p>a<table><tbody><tr><td>b</td></tr></tbody></table>c</p>",
    "<!doctype html><p>a<table><tr><td>b</table>c": "<p>a</p><table><tbody><tr><td>b</td></tr></tbody></table>c",
    "<ul><li>a<ul><li>b</ul><li>c</ul>": "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>",
    "<dl><dt>a<dd>b<p>c<dt>d</dl>e": "<dl><dt>a</dt><dd>b<p>c</p></dd><dt>d</dt></dl>e",
    "<select><option>a<p>b<option>c</select>d": "<select><option>ab</option><option>c</option></select>d",
    "<title>t</title>x</body>y</html>z": "xyz",
    "<td>orphan</td> t</p>": "orphan t<p></p>",
    "<h1>a<h2>b</h1>c": "<h1>a</h1><h2>b</h2>c",
    "<p>a<svg><g><path/><path/></g></svg>b": "<p>a<svg><g><path></path><path></path></g></svg>b</p>",
    "": "",
}


@pytest.mark.parametrize("page", TREES)
def test_html_trees(page):
    tree = html.Tree(page)
    assert shown(tree.body) == TREES[page] and [c.name for c in tree.html.children] == ["head", "body"]


def test_html_strays():
    blocks, meta = html.parse(b"<title>T</title><table><tr>Stray words of a row<td>a<td>b</table><b>Bold <p>inside of it</b> and after it</p>")
    assert [(b["type"], b["content"]) for b in blocks] == [("paragraph", "Stray words of a row"), ("table", "a   | b  "), ("paragraph", "Bold"), ("paragraph", "inside of it and after it")]
    assert meta == {"title": "T"}


def test_html_of_any_nesting():
    """Random tags leave a tree in which each node has one parent and no text is lost."""
    rng = random.Random(5)
    names = "p b i a div table tr td th tbody caption ul li h1 h2 select option form button span em svg br hr nobr object dl dd".split()
    for _ in range(300):
        page, words = [], []
        for k in range(rng.randint(1, 40)):
            page.append(rng.choice([f"<{rng.choice(names)}>", f"</{rng.choice(names)}>", f" w{k} "]))
            words += [page[-1].strip()] if page[-1][0] == " " else []
        tree = html.Tree("".join(page))
        seen, todo = set(), [tree.root]
        while todo:
            x = todo.pop()
            assert id(x) not in seen
            seen.add(id(x))
            for c in x.children:
                if not isinstance(c, str):
                    assert c.parent is x
                    todo.append(c)
        assert sorted(tree.root.text().split()) == sorted(words)


def test_deep_html_is_read_in_linear_time():
    for part in ("<div><p>x", "<div><b>x", "<div class=a>"):
        began = time.perf_counter()
        html.Tree(part * 40_000)
        assert time.perf_counter() - began < 10
