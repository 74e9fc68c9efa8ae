"""Mail: RFC 822 messages, and Outlook messages in compound files."""

from __future__ import annotations

import binascii
import math
import quopri
import re
import struct
from base64 import b64decode
from datetime import UTC, datetime, timedelta
from email import message_from_bytes, policy
from email.headerregistry import HeaderRegistry
from email.message import EmailMessage
from email.utils import parsedate_to_datetime
from functools import lru_cache

from lodestone.functions.splitter import trim
from lodestone.functions.text import WS
from lodestone.sources.parsers.common import Block, block, paragraphs

_ORIGINAL, _SENT = re.compile("-{3,} ?Original Message ?-{3,}"), re.compile("From:.*Sent:.*To:", re.S)
_WROTE = re.compile(r"On [^\n\r\u2028\u2029]+ wrote:\Z")
_DASHES = re.compile(rf"^--[{WS}]*$", re.M)
_CLOSING = re.compile(rf"^(?:(?:Regards|Best|Thanks|Sincerely),?[{WS}]*$|Sent from my)", re.M | re.I)


def is_signature(t: str) -> bool:
    return bool(_DASHES.search(t) or _CLOSING.search(t))


def is_quote(line: str) -> bool:
    first = line[:1]
    if first == ">" or first == "-" and _ORIGINAL.match(line) or first == "F" and _SENT.match(line):
        return True
    line = trim(line)
    return line.startswith("On ") and bool(_WROTE.match(line))


def body_blocks(body: str) -> list[Block]:
    """Runs of quoted lines are one block each; the rest goes by paragraphs."""
    runs: list[tuple[bool, list[str]]] = []
    for line in body.split("\n"):
        quoted = is_quote(line)
        if not runs or runs[-1][0] != quoted:
            runs.append((quoted, []))
        runs[-1][1].append(line)
    out: list[Block] = []
    for quoted, lines in runs:
        t = trim("\n".join(lines))
        if quoted and t:
            out.append(block("paragraph", t, metadata={"isQuotedReply": True}))
        elif not quoted:
            out += [block("paragraph", p, metadata={"isSignature": True} if is_signature(p) else None) for p in paragraphs(t)]
    return out


def strip_html(t: str) -> str:
    for pattern, by in (
        (r"(?is)<(style|script)[^>]*>.*?</\1>", ""), (rf"(?i)<br[{WS}]*/?>", "\n"), (r"(?i)</p>", "\n\n"), (r"(?i)</div>", "\n"), (r"<[^>]+>", ""),
        ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), (r"\n{3,}", "\n\n"),
    ):
        t = re.sub(pattern, by, t)
    return trim(t)


def size_text(n: int | None) -> str:
    if not n:
        return "unknown size"
    one = lambda x: f"{math.floor(x * 10 + 0.5) / 10:.1f}"  # halves go up
    return f"{n} B" if n < 1024 else f"{one(n / 1024)} KB" if n < 1 << 20 else f"{one(n / (1 << 20))} MB"


def iso(d: datetime) -> str:
    return d.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.") + f"{d.microsecond // 1000:03d}Z"


def local(d: datetime) -> str:
    """A date as en-US writes it, in UTC."""
    d = d.astimezone(UTC)
    return f"{d.month}/{d.day}/{d.year}, {d.hour % 12 or 12}:{d.minute:02d}:{d.second:02d} {'AM' if d.hour < 12 else 'PM'}"


def _assemble(meta: dict, lines: list[str], body: str, attached: list[dict], sizes: bool) -> tuple[list[Block], dict]:
    out = [block("heading", meta["subject"], 1)]
    if lines:
        out.append(block("email-header", "\n".join(lines), metadata=dict(meta)))
    if body:
        out += body_blocks(body)
    if attached:
        names = "\n".join(f"• {a['name'] or 'Unnamed attachment'}" + f" ({size_text(a['size'])})" * sizes for a in attached)
        out.append(block("attachment-list", f"Attachments:\n{names}", metadata={"attachmentCount": len(attached), "attachments": attached}))
    return out, meta


def _addresses(message: EmailMessage | dict, name: str) -> str:
    header = message.get(name)
    return ", ".join(f"{a.display_name} <{a.addr_spec}>" if a.display_name else a.addr_spec for a in getattr(header, "addresses", ())) if header else ""


class _Registry(HeaderRegistry):
    """Header classes by name, each made once."""

    def __init__(self):
        super().__init__()
        self.made: dict[str, type] = {}

    def __getitem__(self, name: str) -> type:
        # a fixed number: all names without a class of their own share one
        key = name.lower() if name.lower() in self.registry else ""
        if key not in self.made:
            self.made[key] = super().__getitem__(name)
        return self.made[key]


#: The library asks for the same headers of a message again and again, and parses them each time.
_POLICY = policy.default.clone(header_factory=lru_cache(64)(_Registry()))


#: What is read without the library: plain lists of addresses, dates, and values with plain parameters.
_ATOMS = r"[A-Za-z0-9_+-]+(?:\.[A-Za-z0-9_+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
_ADDRESS = re.compile(rf"(?:([A-Za-z0-9]+(?: [A-Za-z0-9]+)*) <({_ATOMS})>|({_ATOMS}))(?:, ?|\Z)")
_DATE = re.compile(r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), [0-9]{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}")
_FIELDS = re.compile(r"(?:[!-9;-~]+:[^\n]*\n(?:[ \t][^\n]*\n)*+)++(?=\n)")
_FIELD = re.compile(r"([!-9;-~]+):([^\n]*(?:\n[ \t][^\n]*)*)\n")
_VALUE = re.compile(r"([a-z]+(?:/[a-z0-9.+-]+)?)((?:;[ \t]*[a-z]+=(?:[A-Za-z0-9._-]+|\"[A-Za-z0-9._=+/-]+(?: [A-Za-z0-9._=+/-]+)*\"))*)")
_PARAMETER = re.compile(r'([a-z]+)=(?:"([^"]*)"|([^;]+))')
_ENCODINGS = ("", "7bit", "8bit", "base64", "quoted-printable")


class _Unusual(Exception):
    """A message that only the library reads."""


def _people(name: str, value: str) -> str:
    """The addresses of a header's value."""
    out, at = [], 0
    while at < len(value) and (m := _ADDRESS.match(value, at)):
        out.append(f"{m[1]} <{m[2]}>" if m[1] else m[3])
        at = m.end()
    if at < len(value) or value.endswith((",", ", ")):
        return _addresses({name: _POLICY.header_factory(name, value)}, name)
    return ", ".join(out)


class _Part:
    """A part of a message of the usual form: its fields, type, disposition and content."""

    def __init__(self, text: str, crlf: bool):
        m = _FIELDS.match(text)
        if m is None or not m[0].isascii():
            raise _Unusual
        self.fields: dict[str, str] = {}
        for name, value in _FIELD.findall(m[0]):
            value = value.lstrip(" \t").replace("\n", "")
            if not value.replace("\t", " ").isprintable():
                raise _Unusual
            self.fields.setdefault(name.lower(), value)
        self.text, self.crlf = text[m.end() + 1 :], crlf
        self.type, self.parameters = self._value("content-type") if "content-type" in self.fields else ("text/plain", {})
        self.disposition, named = self._value("content-disposition") if "content-disposition" in self.fields else ("", {})
        self.encoding = self.fields.get("content-transfer-encoding", "").lower()
        if self.encoding not in _ENCODINGS or "/" not in self.type or "/" in self.disposition:
            raise _Unusual
        self.name = named.get("filename", self.parameters.get("name"))

    def _value(self, name: str) -> tuple[str, dict[str, str]]:
        """What stands first in a field, and its parameters."""
        m = _VALUE.fullmatch(self.fields[name])
        if m is None:
            raise _Unusual
        found = [(k, a or b) for k, a, b in _PARAMETER.findall(m[2])]
        if len(dict(found)) < len(found):
            raise _Unusual
        return m[1], dict(found)

    def content(self) -> bytes:
        raw = (self.text.replace("\n", "\r\n") if self.crlf else self.text).encode("ascii", "surrogateescape")
        if self.encoding == "base64":
            try:
                return b64decode(raw.translate(None, b"\r\n"), validate=True)
            except binascii.Error:
                raise _Unusual from None
        return quopri.decodestring(raw) if self.encoding == "quoted-printable" else raw

    def body(self) -> str:
        try:
            return self.content().decode(self.parameters.get("charset", "ascii"), "replace").replace("\r\n", "\n")
        except LookupError:
            raise _Unusual from None

    def parts(self) -> list[_Part]:
        """Those of a multipart, which holds no further multipart or message."""
        if self.type not in ("multipart/mixed", "multipart/alternative") or "boundary" not in self.parameters or self.encoding in _ENCODINGS[3:]:
            raise _Unusual
        pieces = f"\n{self.text}".split(f"\n--{self.parameters['boundary']}")
        if len(pieces) < 3 or not all(p.startswith("\n") for p in pieces[1:-1]) or not (pieces[-1] == "--" or pieces[-1].startswith("--\n")):
            raise _Unusual
        out = [_Part(p[1:], self.crlf) for p in pieces[1:-1]]
        if any(p.type.startswith(("multipart/", "message/")) for p in out):
            raise _Unusual
        return out


def _usual(data: bytes) -> tuple[dict, str, list[dict]]:
    """What `_read` gives, of a message of the usual form: one text, or parts that are not nested. The library
    parses each line and each word of a header; here only what is asked for is looked at."""
    text, crlf = data.decode("ascii", "surrogateescape"), False
    if "\r" in text:
        if not text.count("\r") == text.count("\n") == text.count("\r\n"):
            raise _Unusual
        text, crlf = text.replace("\r\n", "\n"), True
    top = _Part(text, crlf)
    if top.type in ("text/plain", "text/html") and not top.disposition:
        parts, attached = [top], []
    else:
        parts, attached = top.parts(), []
        if top.disposition:
            raise _Unusual
    seen: dict[str, _Part] = {}
    for p in parts:
        if p.type in ("text/plain", "text/html") and p.disposition != "attachment" and p.type not in seen:
            seen[p.type] = p
        elif top.type == "multipart/mixed":
            attached.append({"name": p.name, "size": len(p.content()), "contentType": p.type})
    body = seen["text/plain"].body() if "text/plain" in seen else ""
    if not body and "text/html" in seen:
        body = strip_html(seen["text/html"].body())
    return top.fields, body, attached


def _read(data: bytes) -> tuple[dict, str, list[dict]]:
    """A message's headers by name, its text and its attachments, by the library."""
    message: EmailMessage = message_from_bytes(data, policy=_POLICY)

    def text_of(kind: str) -> str:
        part = message.get_body((kind,))
        if part is None:
            return ""
        try:
            return part.get_content().replace("\r\n", "\n")
        except (LookupError, UnicodeError):
            return part.get_payload(decode=True).decode("utf-8", "replace").replace("\r\n", "\n")

    body = text_of("plain") or strip_html(text_of("html"))
    attached = []
    for p in message.iter_attachments() if message.is_multipart() else ():
        raw = p.get_payload(decode=True) if not p.is_multipart() else p.as_bytes()
        attached.append({"name": p.get_filename(), "size": len(raw or b""), "contentType": p.get_content_type()})
    return {n: h for n in ("from", "to", "cc", "subject", "date", "message-id") if (h := message.get(n)) is not None}, body, attached


def _header(name: str, value: object) -> object:
    """A header, parsed by the library if it is not yet."""
    return _POLICY.header_factory(name, value) if type(value) is str else value


def _moment(value: object) -> datetime | None:
    """The time of a date's header."""
    if value is None or type(value) is not str or not _DATE.fullmatch(value):
        return getattr(_header("date", value), "datetime", None)
    try:
        return parsedate_to_datetime(value)
    except ValueError:
        return None


def parse_eml(data: bytes) -> tuple[list[Block], dict]:
    try:
        fields, body, attached = _usual(data)
    except _Unusual:
        fields, body, attached = _read(data)
    sender, to, cc = (_people(n, v) if type(v := fields.get(n)) is str else _addresses(fields, n) for n in ("from", "to", "cc"))
    subject = fields.get("subject")
    if type(subject) is str and ("=?" in subject or "\t" in subject):
        subject = _header("subject", subject)
    meta: dict = {"from": sender, "to": to} | ({"cc": cc} if cc else {}) | {"subject": str(subject or "No Subject")}
    if date := _moment(fields.get("date")):
        date = date if date.tzinfo else date.replace(tzinfo=UTC)
        meta["date"] = iso(date)
    if fields.get("message-id"):
        meta["messageId"] = str(_header("message-id", fields["message-id"]))
    lines = [f"{k}: {v}" for k, v in (("From", sender), ("To", to), ("CC", cc), ("Date", local(date) if date else "")) if v]
    return _assemble(meta, lines, body, attached, True)


class Compound:
    """A compound file: the streams of its storages, by path."""

    FREE, END = 0xFFFFFFFF, 0xFFFFFFFE

    def __init__(self, data: bytes):
        if data[:8] != bytes.fromhex("d0cf11e0a1b11ae1"):
            raise ValueError("not a compound file")
        self.data = data
        shift, mini = struct.unpack_from("<HH", data, 30)
        self.size, self.mini_size = 1 << shift, 1 << mini
        first_dir, _, self.cutoff, first_mini, _, first_more, n_more = struct.unpack_from("<IIIIIII", data, 48)
        places = list(struct.unpack_from("<109I", data, 76))
        while n_more and first_more < self.END:
            more = struct.unpack_from(f"<{self.size // 4}I", data, self._at(first_more))
            places, first_more, n_more = places + list(more[:-1]), more[-1], n_more - 1
        self.fat = [x for p in places if p < self.END for x in struct.unpack_from(f"<{self.size // 4}I", data, self._at(p))]
        entries = self._chain(first_dir)
        self.entries = [self._entry(entries[k : k + 128]) for k in range(0, len(entries) - 127, 128)]
        raw = self._chain(first_mini) if first_mini < self.END else b""
        self.mini_fat = struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4])
        self.mini = self._chain(self.entries[0]["start"]) if self.entries[0]["start"] < self.END else b""
        self.streams: dict[tuple[str, ...], bytes] = {}
        self._walk(self.entries[0]["child"], ())

    def _at(self, sector: int) -> int:
        return (sector + 1) * self.size

    def _chain(self, sector: int) -> bytes:
        out = []
        while sector < self.END and len(out) <= len(self.fat):
            out.append(self.data[self._at(sector) : self._at(sector) + self.size])
            sector = self.fat[sector] if sector < len(self.fat) else self.END
        return b"".join(out)

    def _entry(self, raw: bytes) -> dict:
        n, kind = struct.unpack_from("<HB", raw, 64)
        left, right, child = struct.unpack_from("<III", raw, 68)
        start, size = struct.unpack_from("<IQ", raw, 116)
        return {"name": raw[: max(n - 2, 0)].decode("utf-16-le", "replace"), "kind": kind, "left": left, "right": right, "child": child, "start": start, "size": size & 0xFFFFFFFF}

    def _read(self, e: dict) -> bytes:
        if e["size"] >= self.cutoff:
            return self._chain(e["start"])[: e["size"]]
        out, at = [], e["start"]
        while at < self.END and len(out) <= len(self.mini_fat):
            out.append(self.mini[at * self.mini_size : (at + 1) * self.mini_size])
            at = self.mini_fat[at] if at < len(self.mini_fat) else self.END
        return b"".join(out)[: e["size"]]

    def _walk(self, first: int, path: tuple[str, ...]) -> None:
        todo, seen = [first], set()
        while todo:
            k = todo.pop()
            if k >= len(self.entries) or k in seen:
                continue
            seen.add(k)
            e = self.entries[k]
            todo += [e["left"], e["right"]]
            if e["kind"] == 2:
                self.streams[(*path, e["name"])] = self._read(e)
            elif e["kind"] == 1:
                self._walk(e["child"], (*path, e["name"]))


class _Properties:
    """MAPI properties of a storage."""

    def __init__(self, file: Compound, path: tuple[str, ...], head: int):
        self.of = {p[-1]: v for p, v in file.streams.items() if p[:-1] == path}
        raw = self.of.get("__properties_version1.0", b"")[head:]
        self.fixed = {struct.unpack_from("<I", raw, k)[0]: raw[k + 8 : k + 16] for k in range(0, len(raw) - 15, 16)}

    def text(self, *tags: str) -> str:
        for tag in tags:
            for kind, codec in (("001F", "utf-16-le"), ("001E", "cp1252")):
                if (raw := self.of.get(f"__substg1.0_{tag}{kind}")) is not None:
                    return raw.decode(codec, "replace").rstrip("\0")
        return ""

    def time(self, tag: int) -> datetime | None:
        raw = self.fixed.get(tag << 16 | 0x40)
        n = struct.unpack("<Q", raw)[0] if raw else 0
        return datetime(1601, 1, 1, tzinfo=UTC) + timedelta(microseconds=n // 10) if n else None


def parse_msg(data: bytes) -> tuple[list[Block], dict]:
    file = Compound(data)
    top = _Properties(file, (), 32)
    storages = sorted({p[0] for p in file.streams if len(p) > 1})
    people = [_Properties(file, (s,), 8) for s in storages if s.startswith("__recip_version1.0_")]
    files = [_Properties(file, (s,), 8) for s in storages if s.startswith("__attach_version1.0_")]
    sender = top.text("5D01", "0C1F") or top.text("0C1A")
    to = ", ".join(filter(None, (p.text("39FE", "3003") or p.text("3001") for p in people)))
    date = top.time(0x3007) or top.time(0x0E06)
    meta = {"from": sender, "to": to, "subject": top.text("0037") or "No Subject"} | ({"date": iso(date)} if date else {})
    lines = [f"{k}: {v}" for k, v in (("From", sender), ("To", to), ("Date", local(date) if date else "")) if v]
    attached = []
    for f in files:
        content = f.of.get("__substg1.0_37010102")
        attached.append({"name": f.text("3707", "3704", "3001") or None, "size": len(content) if content is not None else None})
    return _assemble(meta, lines, top.text("1000").replace("\r\n", "\n"), attached, False)
