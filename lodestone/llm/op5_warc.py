"""WARC derivatives: a metadata and a plain-text conversion record for each response.

Input rows hold the bytes of one WARC record or of several, plain or in gzip members, each
member of one record or more. A response with a record id gives two records, in this order:

- `metadata` (application/warc-fields): the source's content type, HTTP status and server,
  length and digest of the payload, title (character references decoded) and number of links
  of an HTML page, then the source's own headers, in order and with repeats: each WARC header as
  `source-warc-header-NAME`, the HTTP status line, each HTTP header as
  `source-http-header-NAME`;
- `conversion` (text/plain, UTF-8): all visible text of the page, one block a line.

Both carry WARC-Refers-To (the response's id), its target URI, date, IP address and
payload digest, a block digest of their own (SHA-1 in base 32), and an id of their own: a
name-based UUID of the response's id and the type, so a task that runs again after a lost
executor makes the same records. The metadata record names the conversion in
WARC-Concurrent-To.

Records of other types give no rows. A row that is null or empty, and a record that cannot be
parsed, give one row with `error` and no record; records after one whose length is known are
read on. Chunked bodies are joined, and the content encodings gzip, deflate and zstd are undone;
digests and lengths are of the payload as it was sent. Text is decoded by its byte order mark, the
charset of the HTTP header or that of an early `meta`, else as UTF-8, bad bytes as U+FFFD.
Payloads that are not text, or in an encoding that is not known or broken, give a metadata record
only (`source-undecoded` tells why). Repeated responses give repeated derivatives. Payloads
are converted whole. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.op3_extract import visible_text
from lodestone.llm.shared import mapped

VERSION = "WARC/1.1"
#: Bytes of records in a batch of results.
OUT_BYTES = 4 << 20
CAPTURED = "2024-01-01T00:00:00Z"
FIELDS = ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "payload_digest", "block_digest", "content_type")
SCHEMA = ", ".join(["page_id long", *(f"{f} string" for f in FIELDS), "content_length long", "n_links long", "record binary", "error string"])
CHARSET = re.compile(r"""charset\s*=\s*["']?([\w.:-]+)""", re.I)
META = re.compile(r"""<meta\b[^>]*?\bcharset\s*=\s*["']?([\w.:-]+)""", re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
LINK = re.compile(r"<a\s[^>]*\bhref\b", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_in(data: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """First line, all headers in order (folded lines joined) and the rest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        head, mark, rest = data.partition(b"\n\n")
    first, *lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}".strip())
        elif line.strip():
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return first, out, rest


def headers_of(data: bytes) -> tuple[str, dict[str, str], bytes]:
    """First line, headers by lower-cased name (the last of repeated ones) and the rest."""
    first, headers, rest = headers_in(data)
    return first, {k.lower(): v for k, v in headers}, rest


def unchunked(body: bytes) -> bytes:
    """The bytes of a chunked HTTP body; as far as it is well formed."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body if not out else b"".join(out)
        if n == 0:
            break
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n
    return b"".join(out)


def inflated(data: bytes) -> bytes:
    """The bytes of one or more gzip members; what follows them, and is none, is left out."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out += [member.decompress(data), member.flush()]
        except zlib.error as e:
            raise ValueError(f"broken gzip member: {e}") from e
        if not member.eof:
            raise ValueError("a gzip member is cut off")
        data = member.unused_data
    return b"".join(out)


#: Bytes that a file is read on by at a time.
STEP = 1 << 18


def _steps(data: bytes) -> Iterator[bytes]:
    """The bytes of a file, those of gzip members inflated, in parts; ValueError where a member is broken."""
    view, at = memoryview(data), 0
    if data[:2] != b"\x1f\x8b":
        for at in range(0, len(view), STEP):
            yield bytes(view[at : at + STEP])
        return
    while bytes(view[at : at + 2]) == b"\x1f\x8b":  # what follows the members, and is none, is left out
        member = zlib.decompressobj(31)
        while not member.eof:
            part = member.unconsumed_tail or bytes(view[at : at + STEP])
            if not part:
                raise ValueError("a gzip member is cut off")
            at += 0 if member.unconsumed_tail else len(part)
            try:
                out = member.decompress(part, STEP)
            except zlib.error as e:
                raise ValueError(f"broken gzip member: {e}") from e
            if out:
                yield out
        at -= len(member.unused_data)


class _Reader:
    """Reads on in a file's parts; what is behind is let go."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.held, self.at = parts, bytearray(), 0

    def more(self) -> bool:
        if self.at > STEP:
            del self.held[: self.at]
            self.at = 0
        part = next(self.parts, None)
        self.held += part or b""
        return part is not None

    def skip_breaks(self) -> bool:
        """To the next byte that ends no line; False at the end."""
        while True:
            while self.at < len(self.held) and self.held[self.at] in b"\r\n":
                self.at += 1
            if self.at < len(self.held):
                return True
            if not self.more():
                return False

    def head(self) -> bytes:
        """All up to an empty line, or the end."""
        seen = 0
        while True:
            end = self.held.find(b"\r\n\r\n", self.at + seen)
            bare = self.held.find(b"\n\n", self.at + seen, end if end >= 0 else len(self.held))
            end, mark = (bare, 2) if bare >= 0 else (end, 4)
            if end >= 0:
                break
            seen = max(0, len(self.held) - self.at - 3)
            if not self.more():
                end, mark = len(self.held), 0
                break
        out = bytes(self.held[self.at : end])
        self.at = end + mark
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n and self.more():
            pass
        out = bytes(self.held[self.at : self.at + n])
        self.at += len(out)
        return out

    def to_record(self) -> bool:
        """To the next line that begins a record; False if there is none."""
        while True:
            k = self.held.find(b"\nWARC/", self.at)
            if k >= 0:
                self.at = k + 1
                return True
            self.at = max(self.at, len(self.held) - 5)
            if not self.more():
                return False


def records_in(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes] | ValueError]:
    """(headers, block) of each WARC record, or what is wrong with it. One pass that holds a record at a time;
    where a record's end is not known, reading goes on at the next line that begins one."""
    r = _Reader(_steps(data))
    try:
        if not r.skip_breaks():
            yield ValueError("no WARC version line")
        while r.skip_breaks():
            first, headers, _ = headers_in(r.head() + b"\r\n\r\n")
            size = next((v for k, v in headers if k.lower() == "content-length"), None)
            if not first.startswith("WARC/"):
                yield ValueError("no WARC version line")
            elif size is None or not re.fullmatch("[0-9]+", size):
                yield ValueError("no content-length" if size is None else f"content-length is {size}")
            else:
                block = r.take(int(size))
                yield (headers, block) if len(block) == int(size) else ValueError("the block is cut off")
                continue
            r.at = max(0, r.at - 4)  # the line may come right after the head
            if not r.to_record():
                return
    except ValueError as e:
        yield e


def unencoded(body: bytes, encodings: str) -> bytes:
    """The payload without its content encodings, the last one first."""
    for name in reversed([x.strip().lower() for x in encodings.split(",")]):
        try:
            if name in ("gzip", "x-gzip"):
                body = inflated(body) if body else body
            elif name == "deflate":
                # by the standard with a header, but some send none
                body = zlib.decompress(body, 15 if body[:1] and body[0] & 15 == 8 and int.from_bytes(body[:2]) % 31 == 0 else -15)
            elif name == "zstd":
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            elif name not in ("", "identity"):
                raise ValueError(f"content encoding {name}")
        except (zlib.error, zstandard.ZstdError) as e:
            raise ValueError(f"broken {name}: {e}") from e
    return body


def decoded(body: bytes, kind: str, is_html: bool) -> str:
    """The text of a payload: by a byte order mark, the header's charset or a `meta`'s."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if body.startswith(mark):
            return body[len(mark) :].decode(name, "replace")
    found = CHARSET.search(kind) or (META.search(body[:1024].decode("latin-1")) if is_html else None)
    name = found[1].lower() if found else "utf-8"
    # fixed values: labels that browsers read as windows-1252
    name = "cp1252" if name in ("iso-8859-1", "latin1", "latin-1", "us-ascii", "ascii") else name
    try:
        return body.decode(name, "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derivatives(data: bytes) -> list[dict]:
    return list(each_derivative(data))


def each_derivative(data: bytes) -> Iterator[dict]:
    """The rows of all records in some bytes: records derived from responses, and errors."""
    for r in records_in(data):
        try:
            if isinstance(r, ValueError):
                raise r
            yield from derived_from(*r)
        except (ValueError, KeyError) as e:
            yield {"error": str(e) if isinstance(e, ValueError) else f"no {e.args[0]}"}


def derived_from(warc_all: list[tuple[str, str]], block: bytes) -> list[dict]:
    """The records derived from one WARC record."""
    warc = {k.lower(): v for k, v in warc_all}
    if warc.get("warc-type") != "response":
        return []
    source = warc["warc-record-id"]
    status, http_all, body = headers_in(block)
    http = {k.lower(): v for k, v in http_all}
    if http.get("transfer-encoding", "").lower() == "chunked":
        body = unchunked(body)
    kind = http.get("content-type", "")
    payload = warc.get("warc-payload-digest") or digest(body)
    is_html, undecoded = "html" in kind.lower() or not kind, ""
    try:
        text = decoded(unencoded(body, ",".join(v for k, v in http_all if k.lower() == "content-encoding")), kind, is_html)
    except ValueError as e:
        text, undecoded = "", str(e)
    title = TITLE.search(text) if is_html else None
    links = len(LINK.findall(text)) if is_html else 0
    ids = {t: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, source + ' ' + t)}>" for t in ("metadata", "conversion")}
    plain = (visible_text(text) if is_html else text) if not undecoded and (is_html or kind.lower().startswith("text/")) else None
    fields = [("source-content-type", kind), ("source-http-status", " ".join(status.split()[1:2])), ("source-server", http.get("server", "")), ("source-length", str(len(body))), ("source-digest", payload), ("title", " ".join(html.unescape(title[1]).split()) if title else ""), ("outlinks", str(links)), ("source-undecoded", undecoded)]
    # all headers of the source, in order and with repeats
    sources = [(f"source-warc-header-{k}", v) for k, v in warc_all] + [("source-http-status-line", status.strip())] + [(f"source-http-header-{k}", v) for k, v in http_all]
    lines = [f"{k}: {v}\r\n" for k, v in fields if v] + [f"{k}: {v}".rstrip() + "\r\n" for k, v in sources]
    blocks = [("metadata", "application/warc-fields", "".join(lines).encode("utf-8", "replace"))]
    if plain is not None:
        blocks.append(("conversion", "text/plain; charset=utf-8", plain.encode("utf-8", "replace")))
    out = []
    for t, content, b in blocks:
        other = ids["conversion"] if t == "metadata" and plain is not None else None
        row = dict(zip(FIELDS, (t, ids[t], source, other, warc.get("warc-target-uri"), warc.get("warc-date"), payload, digest(b), content)))
        heads = [("WARC-Type", t), ("WARC-Record-ID", ids[t]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]), ("WARC-IP-Address", warc.get("warc-ip-address")), ("WARC-Refers-To", source), ("WARC-Concurrent-To", other), ("WARC-Payload-Digest", payload), ("WARC-Block-Digest", row["block_digest"]), ("Content-Type", content)]
        out.append(row | {"content_length": len(b), "n_links": links, "record": record(heads, b), "error": None})
    return out


def derived(records: DataFrame) -> DataFrame:
    """Rows of SCHEMA from rows (page_id, record binary): the derivatives of each record."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = dict(zip(names, (pa.int64(), *[pa.string()] * len(FIELDS), pa.int64(), pa.int64(), pa.binary(), pa.string())))
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], types[n]) for n in names], names=names)
        for b in batches:
            rows, size = [], 0
            for page, data in zip(b.column(0), b.column(1)):
                for r in each_derivative(data.as_py() or b""):
                    rows.append({"page_id": page.as_py()} | r)
                    size += len(r.get("record", b"")) + 500
                    if size > OUT_BYTES:
                        yield table(rows)
                        rows, size = [], 0
            yield table(rows)

    return mapped(records.select("page_id", "record"), run, SCHEMA)


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record) of response records for rows (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                ids, out = b.column(0).slice(i, 1024), []
                for page, url, page_html in zip(ids.to_pylist(), b.column(1).slice(i, 1024).to_pylist(), b.column(2).slice(i, 1024).to_pylist()):
                    body = (page_html or "").encode()
                    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
                    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url}')}>"
                    heads = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", CAPTURED), ("WARC-Target-URI", (url or "").replace("\r", "").replace("\n", "")), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")]
                    out.append(record(heads, block))
                yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], names=["page_id", "record"])

    return mapped(pages.select("page_id", "url", "html"), run, "page_id long, record binary")


def warc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the derivatives of every page hang together: ids, digest and date, without contents."""
    out = derived(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return out.select("page_id", "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "payload_digest", "content_type")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derivatives of a response made from every page; the record itself as its SHA-256."""
    out = derived(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return out.withColumn("record_sha256", F.sha2("record", 256)).drop("record", "error")


def _uuid(name: str) -> str:
    """SQL of a name-based UUID of the URL namespace, as a record id."""
    h = f"sha1(unhex('{uuid.NAMESPACE_URL.hex}') || encode({name}))"
    variant = f"substr('89ab', (CAST('0x' || substr({h}, 17, 1) AS INTEGER) & 3) + 1, 1)"
    return f"concat('<urn:uuid:', substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', {variant}, substr({h}, 18, 3), '-', substr({h}, 21, 12), '>')"


#: The rows of warc_links in DuckDB. A digest is base 32: four letters for each five hex digits.
LINKS_SQL = f"""
WITH p AS (SELECT page_id, nullif(replace(replace(coalesce(url, ''), chr(13), ''), chr(10), ''), '') AS uri, {_uuid("page_id || ' ' || coalesce(url, 'None')")} AS source, sha1(encode(coalesce(html, ''))) AS h FROM pages
), r AS (SELECT *, {_uuid("source || ' metadata'")} AS m, {_uuid("source || ' conversion'")} AS c,
    'sha1:' || array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '') AS digest FROM p)
SELECT page_id, 'metadata' AS warc_type, m AS record_id, source AS refers_to, c AS concurrent_to, uri AS target_uri, '{CAPTURED}' AS date, digest AS payload_digest, 'application/warc-fields' AS content_type FROM r
UNION ALL SELECT page_id, 'conversion', c, source, NULL, uri, '{CAPTURED}', digest, 'text/plain; charset=utf-8' FROM r
"""
