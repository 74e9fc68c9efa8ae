"""Plain text: underlined and detected headings, paragraphs by kind."""

from __future__ import annotations

import re

from lodestone.functions.splitter import trim, units
from lodestone.functions.text import WS
from lodestone.sources.parsers.common import Block, block, decoded, is_code, is_list, is_table, paragraphs

_CAPS = re.compile(rf"[A-Z][A-Z0-9{WS}\-_&:,.]+\Z")
_NUMBER = re.compile(rf"([0-9]+\.(?:[0-9]+\.)*|[{WS}]*Chapter[{WS}]+[0-9]+[:.]*)[{WS}]*(?:[^\n\r\u2028\u2029]+)?\Z", re.I)


def heading(line: str, above: str, below: str) -> tuple[str, int] | None:
    """Text and level of a line that reads as a heading between its neighbours."""
    t = trim(line)
    n, free, clear = units(t), not trim(above), not trim(below)
    if n < 2 or not free:
        return None
    if clear and 3 <= n <= 100 and _CAPS.match(t):
        return t, 1
    if m := _NUMBER.match(t):
        return t, min(max(m[1].count("."), 1), 6)
    if t.endswith(":") and n <= 80 and not clear:
        return t[:-1], 2
    if clear and 3 <= n <= 60 and "." not in t and "A" <= t[0] <= "Z":
        return t, 2
    return None


def kind(text: str) -> str:
    return "table" if is_table(text) else "code" if is_code(text) else "list" if is_list(text) else "paragraph"


def parse(data: bytes) -> tuple[list[Block], dict]:
    lines = decoded(data).split("\n")
    out: list[Block] = []
    held: list[str] = []

    def flush() -> None:
        out.extend(block(kind(p), p) for p in paragraphs(trim("\n".join(held))))
        held.clear()

    i, n = 0, len(lines)
    while i < n:
        below = lines[i + 1] if i + 1 < n else ""
        rule = trim(below)
        level = 1 if re.fullmatch("={3,}", rule) else 2 if re.fullmatch("-{3,}", rule) else 0
        found = (trim(lines[i]), level) if level else heading(lines[i], lines[i - 1] if i else "", below)
        if found:
            flush()
            out.append(block("heading", *found))
        else:
            held.append(lines[i])
        i += 2 if level else 1
    flush()
    return out, {}
