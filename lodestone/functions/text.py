"""Scalar text functions as Column expressions, whole-stage and JVM-side.

White space is that of ECMAScript, spelled out in one class, so every engine agrees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space of ECMAScript, for a character class.
WS = "\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
#: The same characters, one by one.
SPACE = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
SUMMARY_CHARS, SUMMARY_LEAST = 200, 150
CHARS_PER_TOKEN = 4
USD_PER_1K_TOKENS = 0.00013

#: Fixed value: document types by file extension.
DOC_TYPES = {
    "txt": "txt", "md": "md", "markdown": "md", "html": "html", "htm": "html", "pdf": "pdf", "docx": "docx",
    "xlsx": "xlsx", "xls": "xlsx", "ppt": "ppt", "pptx": "pptx", "eml": "eml", "msg": "msg",
}
#: Fixed value: extensions that a directory scan takes.
SCANNED = ("pdf", "docx", "xlsx", "pptx", "ppt", "txt", "md", "html", "eml", "msg")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def js_trim(x: Column | str) -> Column:
    return F.trim(_c(x), F.lit(SPACE))


def js_length(x: Column | str) -> Column:
    """Length in UTF-16 units: characters beyond U+FFFF count twice."""
    c = _c(x)
    # most texts need no second look: each character is a byte
    return F.when(F.octet_length(c) == F.length(c), F.length(c)).otherwise((F.octet_length(F.encode(c, "UTF-16LE")) / 2).cast("int"))


def js_fits(x: Column | str, most: int) -> Column:
    """Whether a text has at most `most` UTF-16 units; looks at no more of it."""
    return js_length(F.substring(_c(x), 1, most + 1)) <= most


def js_prefix(x: Column | str, most: int) -> Column:
    """The first `most` UTF-16 units of a text, one less where that would split a pair."""
    head = F.substring(_c(x), 1, most)
    raw = F.substring(F.encode(head, "UTF-16LE"), 1, 2 * most)
    # the upper byte of the last unit tells the first of a pair
    split = F.hex(F.substring(raw, 2 * most, 1)).isin("D8", "D9", "DA", "DB")
    whole = F.when(split, F.substring(raw, 1, 2 * most - 2)).otherwise(raw)
    return F.when(js_length(head) == F.length(head), head).otherwise(F.decode(whole, "UTF-16LE"))


def _cut_head(head: Column, beyond: int) -> Column:
    """A head cut at its last blank if that stands beyond a number of UTF-16 units, with '...'."""
    at = _last_index(head, " ")
    before = F.substring(head, F.lit(1), at)
    units = F.when(at < 0, -1).otherwise(js_length(before))
    return F.concat(F.when(units > beyond, before).otherwise(head), F.lit("..."))


def blank(x: Column | str) -> Column:
    return F.ltrim(_c(x), F.lit(SPACE)) == ""


def count_matches(x: Column | str, pattern: str) -> Column:
    return F.regexp_count(_c(x), F.lit(pattern))


def join_heading_path(path: Column | str) -> Column:
    """Headings that are not blank, joined by ' > '."""
    return F.array_join(F.filter(_c(path), lambda h: ~blank(h)), " > ")


def _last_index(x: Column, what: str) -> Column:
    """0-based place of the last occurrence, -1 for none."""
    at = F.instr(F.reverse(x), what)
    return F.when(at == 0, -1).otherwise(F.length(x) - at)


def generate_summary(x: Column | str) -> Column:
    """The first sentence if it has at most 200 UTF-16 units, else the text if it has, else
    its first 200 units, cut at a blank beyond the 150th if there is one, with '...'."""
    t = js_trim(F.coalesce(_c(x), F.lit("")))
    sentence = F.regexp_extract(t, rf"(?s)^(.*?[.!?])(?:[{WS}]|\z)", 1)
    short = F.when((sentence != "") & js_fits(sentence, SUMMARY_CHARS), sentence).when(js_fits(t, SUMMARY_CHARS), t)
    return short.otherwise(_cut_head(js_prefix(t, SUMMARY_CHARS), SUMMARY_LEAST))


def estimate_tokens(x: Column | str) -> Column:
    return F.ceil(js_length(F.coalesce(_c(x), F.lit(""))) / CHARS_PER_TOKEN).cast("int")


def clean_text(x: Column | str) -> Column:
    """Control characters out (tab, line feed and carriage return stay), blanks and tabs
    to one blank, more than two line feeds to two, trimmed."""
    t = F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    return js_trim(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def _lines(x: Column | str) -> Column:
    return F.split(_c(x), "\n")


def _solid_lines(x: Column | str) -> Column:
    return F.filter(_lines(x), lambda s: ~blank(s))


def is_table_like(x: Column | str) -> Column:
    """Two or more lines that all have two pipes, or a tab, or two runs of white space."""
    s = _solid_lines(x)
    every = lambda test: F.forall(s, test)
    return (F.size(s) >= 2) & (
        every(lambda c: count_matches(c, r"\|") >= 2) | every(lambda c: F.contains(c, F.lit("\t"))) | every(lambda c: count_matches(c, rf"[{WS}]{{2,}}") >= 2)
    )


def _share(of: Column, test) -> Column:
    return F.size(F.filter(of, test)) / F.size(of)


def is_code_like(x: Column | str) -> Column:
    """Two or more lines of which 80 % are blank or indented by four."""
    s = _lines(x)
    return F.when(F.size(s) < 2, False).otherwise(_share(s, lambda c: c.rlike(rf"^([{WS}]{{4,}}|\t)") | blank(c)) >= 0.8)


def is_list_like(x: Column | str) -> Column:
    """Two or more lines of which 70 % begin with a bullet, a number or a letter."""
    s = _solid_lines(x)
    item = rf"^[{WS}]*(?:[-*•]|[0-9]+[.)]|[a-zA-Z][.)])[{WS}]+"
    return F.when(F.size(s) < 2, False).otherwise(_share(s, lambda c: c.rlike(item)) >= 0.7)


def block_type(x: Column | str) -> Column:
    """The class of a plain-text paragraph."""
    return F.when(is_table_like(x), "table").when(is_code_like(x), "code").when(is_list_like(x), "list").otherwise("paragraph")


def paragraphs(x: Column | str) -> Column:
    return F.filter(F.split(_c(x), rf"\n[{WS}]*\n"), lambda p: ~blank(p))


def sentences(x: Column | str) -> Column:
    return F.split(_c(x), rf"(?<=[.!?])[{WS}]+")


def doc_id(path: Column | str) -> Column:
    return F.substring(F.sha2(_c(path), 256), 1, 16)


def chunk_id(doc: Column | str, index: Column | str) -> Column:
    return F.concat_ws("::", _c(doc), _c(index).cast("string"))


def point_uuid(chunk: Column | str) -> Column:
    h = F.sha2(_c(chunk), 256)
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def extension(path: Column | str) -> Column:
    """The lower-cased extension of a path's last part; none for a name that only begins with a dot."""
    name = F.substring_index(_c(path), "/", -1)
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]*)$", 1))


def doc_type(path: Column | str) -> Column:
    """The document type of a path; null where its extension is not supported."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in DOC_TYPES.items() for x in kv)), extension(path))


def filename(path: Column | str) -> Column:
    """What follows the last slash; the path itself where that is nothing."""
    name = F.substring_index(_c(path), "/", -1)
    return F.when(name == "", _c(path)).otherwise(name)


def truncate_text(x: Column | str, most: int) -> Column:
    """At most `most` UTF-16 units, cut at a blank in the last 50 if there is one, with '...'."""
    t = _c(x)
    return F.when(js_fits(t, most) | t.isNull(), t).otherwise(_cut_head(js_prefix(t, most), most - 50))


def format_count(n: Column | str) -> Column:
    return F.format_number(_c(n), 0)


def format_size(n: Column | str) -> Column:
    c = _c(n)
    one = lambda by: F.format_string("%.1f", c / by)
    return (
        F.when(c.isNull() | (c == 0), "unknown size")
        .when(c < 1024, F.concat(c.cast("string"), F.lit(" B")))
        .when(c < 1024 * 1024, F.concat(one(1024.0), F.lit(" KB")))
        .otherwise(F.concat(one(1024.0 * 1024), F.lit(" MB")))
    )


def embedding_cost(chunks: Column | str, average_tokens: int = 500) -> Column:
    """Two vectors for each chunk, at the price of 1000 tokens."""
    return F.concat(F.lit("$"), F.format_string("%.2f", _c(chunks) * 2 * average_tokens / 1000 * USD_PER_1K_TOKENS))


def pad_end(x: Column, width: Column) -> Column:
    """Blanks up to a width; a longer text stays whole."""
    return F.rpad(x, F.greatest(F.length(x), width), F.lit(" "))


def strip_html(x: Column | str) -> Column:
    """The text of a mail's HTML part."""
    t = _c(x)
    for pattern, by in (
        (r"(?is)<style[^>]*>.*?</style>", ""), (r"(?is)<script[^>]*>.*?</script>", ""), (rf"(?i)<br[{WS}]*/?>", "\n"), (r"(?i)</p>", "\n\n"), (r"(?i)</div>", "\n"),
        (r"<[^>]+>", ""), ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), (r"\n{3,}", "\n\n"),
    ):
        t = F.regexp_replace(t, pattern, by)
    return js_trim(t)


def is_signature(x: Column | str) -> Column:
    c = _c(x)
    return c.rlike(rf"(?m)^--[{WS}]*$") | c.rlike(rf"(?im)^(?:(?:Regards|Best|Thanks|Sincerely),?[{WS}]*$|Sent from my)")


def is_quote_line(x: Column | str) -> Column:
    c = _c(x)
    return c.rlike("^>") | js_trim(c).rlike(r"^On .+ wrote:\z") | c.rlike("^-{3,} ?Original Message ?-{3,}") | c.rlike("(?s)^From:.*Sent:.*To:")
