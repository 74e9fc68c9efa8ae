"""What the format decoders share: blocks, text tables, shapes of lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from lodestone.functions.splitter import trim, units
from lodestone.functions.text import WS

Block = dict
_RUN = re.compile(f"[{WS}]{{2,}}")
_ITEM = re.compile(f"[{WS}]*(?:[-*•]|[0-9]+[.)]|[a-zA-Z][.)])[{WS}]+")
_INDENT = re.compile(f"[{WS}]{{4,}}|\t")
_GAP = re.compile(f"\n[{WS}]*\n")


def block(kind: str, content: str, level: int | None = None, metadata: dict | None = None, **at) -> Block:
    return {"type": kind, "content": content, "level": level, "is_table": kind == "table", "is_code": kind == "code", "metadata": metadata} | at


def decoded(data: bytes) -> str:
    """UTF-8 text; bad bytes become U+FFFD, a byte order mark stays."""
    return data.decode("utf-8", "replace")


def padded(cell: str, width: int) -> str:
    return cell + " " * (width - units(cell))


def text_table(rows: Sequence[Sequence[str]], least: int = 3, most: int | None = None, header: bool | None = None, even: bool = False) -> str:
    """Rows as aligned text with a rule below the first. header: by default where more
    rows follow; most: longer cells are cut to it, with '...'; even: short rows are filled."""
    if not rows:
        return ""
    n = max(map(len, rows))
    if even:
        rows = [[*r, *[""] * (n - len(r))] for r in rows]
    sizes = [list(map(units, r)) for r in rows]
    widths = [max([least, *(s[c] for s in sizes if c < len(s))]) for c in range(n)]
    if most is not None and max(widths, default=0) > most:
        widths = [min(w, most) for w in widths]
        rows = [[c if k <= most else c[: most - 3] + "..." for c, k in zip(r, s)] for r, s in zip(rows, sizes)]
        sizes = [list(map(units, r)) for r in rows]
    out = [" | ".join([c + " " * (w - k) for c, w, k in zip(r, widths, s)]) for r, s in zip(rows, sizes)]
    if len(rows) > 1 if header is None else header:
        out.insert(1, "-+-".join("-" * w for w in widths))
    return "\n".join(out)


def paragraphs(text: str) -> list[str]:
    return [trim(p) for p in _GAP.split(text) if trim(p)]


def runs(line: str) -> int:
    """Runs of two or more white space characters."""
    return len(_RUN.findall(line))


def is_list(text: str) -> bool:
    lines = [x for x in text.split("\n") if trim(x)]
    return len(lines) >= 2 and sum(bool(_ITEM.match(x)) for x in lines) / len(lines) >= 0.7


def is_code(text: str) -> bool:
    lines = text.split("\n")
    return len(lines) >= 2 and sum(bool(_INDENT.match(x)) or not trim(x) for x in lines) / len(lines) >= 0.8


def is_table(text: str) -> bool:
    lines = [x for x in text.split("\n") if trim(x)]
    return len(lines) >= 2 and (all(x.count("|") >= 2 for x in lines) or all("\t" in x for x in lines) or all(runs(x) >= 2 for x in lines))
