"""HTML documents: a small tree, then blocks in page order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

from lodestone.functions.splitter import trim
from lodestone.sources.parsers.common import Block, block, decoded, text_table

# Element names of HTML, in the groups of the standard's tree construction.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style nav footer header aside noscript iframe".split())
THROUGH = frozenset("div article section main span".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OF_HEAD = frozenset("base link meta noframes noscript script style template title".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
MARKED = frozenset("applet caption marquee object td template th".split())
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup listing main menu nav ol p pre search section summary ul".split())
ENDS_BLOCK = (BLOCKS - {"p"}) | {"button", "applet", "marquee", "object"}
IMPLIED = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
OF_TABLE = frozenset("caption col colgroup tbody td tfoot th thead tr".split())
ROW_GROUPS = frozenset("tbody tfoot thead".split())
FOSTERING = ROW_GROUPS | {"table", "tr"}
SPECIAL = BLOCKS | HEADINGS | OF_TABLE | OF_HEAD | VOID - {"track"} | frozenset("applet body button dd dt frame frameset head html iframe li marquee noembed object plaintext select table textarea xmp".split())
SCOPE = frozenset("applet caption html marquee object table td template th".split())
ITEM_SCOPE, BUTTON_SCOPE, TABLE_SCOPE = SCOPE | {"ol", "ul"}, SCOPE | {"button"}, frozenset("html table template".split())
#: Elements whose content the library reads as raw text, and groups that are asked for at every tag.
RAW = frozenset([*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"])
P, LISTED, CHOICES, CELLS, HOLDERS = frozenset({"p"}), frozenset({"li", "dd", "dt"}), frozenset({"option", "optgroup"}), frozenset({"td", "th", "caption"}), frozenset({"html", "head", "body"})
#: Tags as they mostly are; all others are left to the standard library.
_OPENING = r"""([a-zA-Z][a-zA-Z0-9]*)((?:\s+[a-zA-Z][a-zA-Z-]*=(?:"[^"&]*"|'[^'&]*'|[a-zA-Z0-9_.:#-]+(?=[\s>])))*)>"""
_START = re.compile(f"<{_OPENING}")
_END = re.compile("</([a-zA-Z][a-zA-Z0-9]*)>")
_RUN = re.compile(f"([^<]*)<(?:{_OPENING}|/([a-zA-Z][a-zA-Z0-9]*)>)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z-]*)=(?:"([^"]*)"|'([^']*)'|([^\s"']+))""")


class Node:
    """An element; children are nodes and strings. `open`: it is on the stack of open elements."""

    __slots__ = ("attrs", "children", "name", "open", "parent")

    def __init__(self, name: str, attrs: dict[str, str] | None = None):
        self.name, self.attrs, self.children, self.parent, self.open = name, attrs or {}, [], None, False

    def put(self, x: Node | str, before: Node | None = None) -> None:
        """Adds a child or text, at the end or before a child; text joins the text that it follows."""
        at = len(self.children)
        if before is None:
            if isinstance(x, str):
                if at and isinstance(self.children[-1], str):
                    self.children[-1] += x
                else:
                    self.children.append(x)
                return
        else:  # a table that takes in stray content is among the last children
            at = next(k for k in range(at - 1, -1, -1) if self.children[k] is before)
        if isinstance(x, Node):
            if x.parent is not None:
                x.leave()
            x.parent = self
            self.children.insert(at, x)
        elif at and isinstance(self.children[at - 1], str):
            self.children[at - 1] += x
        else:
            self.children.insert(at, x)

    def leave(self) -> None:
        if self.parent is not None:
            siblings = self.parent.children
            del siblings[next(k for k in range(len(siblings) - 1, -1, -1) if siblings[k] is self)]
            self.parent = None

    def all(self, *names: str) -> Iterator[Node]:
        stack = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, Node):
                if c.name in names:
                    yield c
                stack += reversed(c.children)

    def text(self) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            else:
                stack += reversed(c.children)
        return "".join(out)


class Tree(HTMLParser):
    """The tree that browsers build: html, head and body always there, end tags implied, formatting elements that
    are closed out of turn split by the adoption agency and opened again where they still hold, and content that
    strays into a table put before it. Not followed: frames, raw text but of scripts and styles, and the rules that
    take markup out of svg and math, whose elements are nested as written."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root, self.html, self.head, self.body = Node("#root"), Node("html"), Node("head"), Node("body")
        self.root.put(self.html)
        self.html.put(self.head)
        self.html.put(self.body)
        self.stack: list[Node] = []
        self.counts: dict[str, int] = {}
        #: Formatting elements that hold, and the elements that part them from those outside.
        self.formatting: list[Node] = []
        self.quirks = True
        self._push(self.html)
        self._push(self.head)
        self.feed(page[self._plainly(page) :])
        self.close()

    # tags as they mostly are, read without the many patterns of the library

    def _plainly(self, page: str) -> int:
        """Reads on while there is nothing but text, tags as they mostly are, and comments; returns where that ends."""
        self.rawdata, i = page, 0
        while True:
            if m := _RUN.match(page, i):
                text, tag, attrs, ended = m.groups()
                if tag is not None and (tag := tag.lower()) in RAW:
                    break
                if text:
                    self.handle_data(unescape(text))
                if tag is None:
                    self.handle_endtag(ended.lower())
                else:
                    self.lasttag = tag
                    self.handle_starttag(tag, self._attributes(attrs) if attrs else [])
                i = m.end()
                continue
            k = page.find("<", i)
            if k < 0 or not page.startswith(("<!--", "<!doctype", "<!DOCTYPE"), k):
                break
            if k > i:
                self.handle_data(unescape(page[i:k]))
            i = k
            k = self.parse_comment(i) if page.startswith("<!--", i) else self.parse_html_declaration(i)
            if k < 0:
                break
            i = k
        self.rawdata = ""
        return i

    @staticmethod
    def _attributes(text: str) -> list[tuple[str, str | None]]:
        return [(k.lower(), a or b or c) for k, a, b, c in _ATTRIBUTE.findall(text)]

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for lines

    def parse_starttag(self, i: int) -> int:
        m = _START.match(self.rawdata, i)
        if m is None or (tag := m[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, self._attributes(m[2]) if m[2] else [])
        return m.end()

    def parse_endtag(self, i: int) -> int:
        m = _END.match(self.rawdata, i)
        if m is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    # the stack of open elements

    def _push(self, node: Node) -> None:
        self.stack.append(node)
        node.open = True
        self.counts[node.name] = self.counts.get(node.name, 0) + 1

    def _take(self, node: Node) -> None:
        node.open = False
        self.counts[node.name] -= 1
        if node.name in MARKED and node in self.formatting:
            del self.formatting[self.formatting.index(node) :]

    def _pop_to(self, node: Node) -> None:
        """Pops the node and all above it."""
        while node.open:
            self._take(self.stack.pop())

    def _above(self, names: frozenset[str]) -> None:
        """Pops what stands above the nearest of the names."""
        while self.stack[-1].name not in names:
            self._take(self.stack.pop())

    def _within(self, names: frozenset[str], scope: frozenset[str]) -> Node | None:
        """The nearest open element of the names, if nothing of the scope's bounds lies between."""
        for n in names:
            if self.counts.get(n):
                break
        else:
            return None
        for x in reversed(self.stack):
            if x.name in names:
                return x
            if x.name in scope:
                return None
        return None

    def _imply_ends(self, but: str = "") -> None:
        while self.stack[-1].name in IMPLIED and self.stack[-1].name != but:
            self._take(self.stack.pop())

    def _close_p(self) -> None:
        if self.counts.get("p") and (p := self._within(P, BUTTON_SCOPE)):
            self._pop_to(p)

    # insertion

    def _put(self, x: Node | str, target: Node | None = None) -> None:
        """Into the target, the current node; what tables do not hold goes before the innermost table."""
        target = target or self.stack[-1]
        if target.name in FOSTERING and not (isinstance(x, Node) and x.name in OF_TABLE):
            table = next((t for t in reversed(self.stack) if t.name == "table"), None)
            if table is not None and table.parent is not None:
                table.parent.put(x, table)
                return
        target.put(x)

    def _open(self, tag: str, attrs: dict[str, str], inside: bool = False) -> Node:
        node, top = Node(tag, attrs), self.stack[-1]
        if inside or tag in OF_TABLE or top.name not in FOSTERING:
            node.parent = top
            top.children.append(node)
        else:
            self._put(node)
        if tag not in VOID:
            self._push(node)
            if tag in MARKED:
                self.formatting.append(node)
        return node

    # formatting elements

    def _reopen(self) -> None:
        k = len(self.formatting)
        if not k:
            return
        while k and not self.formatting[k - 1].open and self.formatting[k - 1].name not in MARKED:
            k -= 1
        for k in range(k, len(self.formatting)):
            self.formatting[k] = self._open(self.formatting[k].name, self.formatting[k].attrs)

    def _holding(self, tag: str) -> Node | None:
        for x in reversed(self.formatting):
            if x.name in MARKED:
                return None
            if x.name == tag:
                return x
        return None

    def _format(self, tag: str, attrs: dict[str, str]) -> None:
        """Opens an element that holds; of more than three alike the first no longer does."""
        alike: list[Node] = []
        for x in reversed(self.formatting):
            if x.name in MARKED:
                break
            if x.name == tag and x.attrs == attrs:
                alike.append(x)
        if len(alike) >= 3:
            self.formatting.remove(alike[-1])
        self.formatting.append(self._open(tag, attrs))

    def _adopt(self, tag: str) -> None:
        """The adoption agency: ends a formatting element though blocks that began in it are still open."""
        if self.stack[-1].name == tag and self.stack[-1] not in self.formatting:
            self._pop_to(self.stack[-1])
            return
        for _ in range(8):
            ended = self._holding(tag)
            if ended is None:
                self._end_other(tag)
                return
            if not ended.open:
                self.formatting.remove(ended)
                return
            if self._within(frozenset({tag}), SCOPE) is None:
                return
            at = self.stack.index(ended)
            far = next((k for k in range(at + 1, len(self.stack)) if self.stack[k].name in SPECIAL), None)
            if far is None:
                self._pop_to(ended)
                self.formatting.remove(ended)
                return
            block, mark, last = self.stack[far], self.formatting.index(ended), self.stack[far]
            for steps, k in enumerate(range(far - 1, at, -1), 1):
                node = self.stack[k]
                if node in self.formatting and steps > 3:
                    mark -= self.formatting.index(node) < mark
                    self.formatting.remove(node)
                if node not in self.formatting:
                    del self.stack[k]
                    self._take(node)
                    continue
                copy = Node(node.name, node.attrs)
                self.formatting[self.formatting.index(node)] = self.stack[k] = copy
                copy.open, node.open = True, False
                if last is block:
                    mark = self.formatting.index(copy) + 1
                copy.put(last)
                last = copy
            last.leave()
            self._put(last, self.stack[at - 1])
            copy = Node(ended.name, ended.attrs)
            copy.children, block.children = block.children, []
            for x in copy.children:
                if isinstance(x, Node):
                    x.parent = copy
            block.put(copy)
            mark -= self.formatting.index(ended) < mark
            self.formatting.remove(ended)
            self.formatting.insert(mark, copy)
            self.stack.remove(ended)
            ended.open, copy.open = False, True
            self.stack.insert(self.stack.index(block) + 1, copy)

    # tokens

    def handle_decl(self, decl: str) -> None:
        if decl.lower().startswith("doctype"):
            self.quirks = False

    def _begin_body(self) -> None:
        if not self.body.open:
            self._pop_to(self.head)
            self._push(self.body)

    def handle_data(self, data: str) -> None:
        if not self.body.open and self.stack[-1] is self.head:
            if not trim(data):
                return
            self._begin_body()
        now = self.stack[-1]
        if now.name == "colgroup" and trim(data):
            self._pop_to(now)
            now = self.stack[-1]
        if now.name in FOSTERING and not trim(data):
            now.put(data)
            return
        if self.body.open and now.name not in ("script", "style", "title", "textarea", "select", "option"):
            self._reopen()
        self._put(data)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if (self.counts.get("svg") or self.counts.get("math")) and self.stack[-1].name == tag:
            self._pop_to(self.stack[-1])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in reversed(attrs)} if attrs else {}  # the first of a name counts
        if tag in HOLDERS:
            node = {"html": self.html, "head": self.head, "body": self.body}[tag]
            node.attrs = given | node.attrs
            if tag == "body":
                self._begin_body()
            return
        if not self.body.open:
            if tag in OF_HEAD:
                self._open(tag, given, inside=True)
                return
            if self.stack[-1] is self.head:
                self._begin_body()
        if self.counts.get("select") and self._start_in_select(tag, given):
            return
        if tag in OF_TABLE:
            self._start_of_table(tag, given)
            return
        if self.stack[-1].name == "colgroup" and tag != "template":
            self._pop_to(self.stack[-1])
        strays = self.stack[-1].name in FOSTERING
        if tag in OF_HEAD or (strays and tag == "input" and given.get("type", "").lower() == "hidden"):
            self._open(tag, given, inside=True)
            return
        if tag == "form":
            if self.counts.get("form"):
                return
            if strays:
                return
        if tag == "table":
            if self._within(FOSTERING, SCOPE - {"table"} | {"caption"}):  # not in a cell of the one that is open
                self._end_of_table("table")
            elif not self.quirks:
                self._close_p()
            self._open(tag, given)
            return
        self._start_in_body(tag, given)

    def _start_in_body(self, tag: str, given: dict[str, str]) -> None:
        if tag in BLOCKS or tag == "hr" or tag in HEADINGS:
            self._close_p()
            if tag in HEADINGS and self.stack[-1].name in HEADINGS:
                self._pop_to(self.stack[-1])
            self._open(tag, given)
        elif tag in LISTED:
            ends = {"li"} if tag == "li" else {"dd", "dt"}
            for x in reversed(self.stack):
                if x.name in ends:
                    self._pop_to(x)
                    break
                if x.name in SPECIAL and x.name not in ("address", "div", "p"):
                    break
            self._close_p()
            self._open(tag, given)
        elif tag in FORMATTING:
            if tag == "a" and (held := self._holding("a")):
                self._adopt("a")
                if held in self.formatting:
                    self.formatting.remove(held)
                if held.open:
                    self.stack.remove(held)
                    self._take(held)
            self._reopen()
            if tag == "nobr" and self._within(frozenset({"nobr"}), SCOPE):
                self._adopt("nobr")
                self._reopen()
            self._format(tag, given)
        elif tag in ("rb", "rtc", "rp", "rt"):
            if self._within(frozenset({"ruby"}), SCOPE):
                self._imply_ends("rtc" if tag in ("rp", "rt") else "")
            self._open(tag, given)
        else:
            if tag == "button" and (x := self._within(frozenset({"button"}), SCOPE)):
                self._pop_to(x)
            if tag in ("option", "optgroup") and self.stack[-1].name == "option":
                self._pop_to(self.stack[-1])
            if tag not in ("param", "source", "track"):
                self._reopen()
            self._open("img" if tag == "image" else tag, given)

    def _start_in_select(self, tag: str, given: dict[str, str]) -> bool:
        """True if the tag has been dealt with: lists of choices hold choices, scripts and templates alone."""
        select = self._within(frozenset({"select"}), frozenset({"html", "template"}))
        if select is None or self._within(frozenset({"td", "th", "caption"}), frozenset({"select", "html"})):
            return False
        if tag in ("input", "textarea", "select", "keygen") or (tag in OF_TABLE | {"table"} and self.counts.get("table")):
            self._pop_to(select)
            return tag == "select"
        if tag in ("option", "optgroup", "hr"):
            for name in ("option",) if tag == "option" else ("option", "optgroup"):
                if self.stack[-1].name == name:
                    self._pop_to(self.stack[-1])
            self._open(tag, given)
        elif tag in ("script", "template"):
            self._open(tag, given)
        return True

    def _start_of_table(self, tag: str, given: dict[str, str]) -> None:
        """Parts of a table open the parts that they need around them and end those that they follow; outside of
        tables they are nothing."""
        if not self._within(frozenset({"table"}), TABLE_SCOPE - {"table"}):
            return
        if tag == "col" and self.stack[-1].name == "colgroup":
            self._open(tag, given, inside=True)
            return
        if inner := self._within(CELLS, TABLE_SCOPE):
            self._pop_to(inner)
        if tag in ("td", "th"):
            if not self._within(frozenset({"tr"}), TABLE_SCOPE):
                self._start_of_table("tr", {})
            self._above(frozenset({"tr"}) | TABLE_SCOPE)
        elif tag == "tr":
            if not self._within(ROW_GROUPS, TABLE_SCOPE):
                self._start_of_table("tbody", {})
            self._above(ROW_GROUPS | TABLE_SCOPE)
        else:
            self._above(TABLE_SCOPE)
            if tag == "col":
                self._open("colgroup", {}, inside=True)
        self._open(tag, given, inside=True)

    def _end_of_table(self, tag: str) -> None:
        if x := self._within(frozenset({tag}), TABLE_SCOPE):
            self._pop_to(x)

    def handle_endtag(self, tag: str) -> None:
        if tag in HOLDERS:
            return  # what follows still belongs to the body, or to the head if it is of it
        if self.stack[-1].name == tag and tag not in FORMATTING:
            self._take(self.stack.pop())
            return
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag in VOID:
            return
        elif not self.body.open:
            if x := self._within(frozenset({tag}), frozenset({"head"})):
                self._pop_to(x)
        elif tag in OF_TABLE or tag == "table":
            self._end_of_table(tag)
        elif tag == "p":
            if not self._within(P, BUTTON_SCOPE):
                self._open("p", {})
            self._close_p()
        elif tag in FORMATTING:
            self._adopt(tag)
        elif tag in HEADINGS or tag in ENDS_BLOCK or tag in ("li", "dd", "dt"):
            names = HEADINGS if tag in HEADINGS else frozenset({tag})
            if x := self._within(names, ITEM_SCOPE if tag == "li" else SCOPE):
                self._pop_to(x)
        elif tag == "select":
            if x := self._within(frozenset({"select"}), TABLE_SCOPE):
                self._pop_to(x)
        else:
            self._end_other(tag)

    def _end_other(self, tag: str) -> None:
        for x in reversed(self.stack):
            if x.name == tag:
                self._pop_to(x)
                return
            if x.name in SPECIAL:
                return


def _drop(node: Node) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        x.children = [c for c in x.children if isinstance(c, str) or c.name not in DROPPED]
        stack += [c for c in x.children if isinstance(c, Node)]


def table(node: Node) -> str:
    rows = [[trim(c.text()) for c in tr.all("th", "td")] for tr in node.all("tr")]
    return text_table([r for r in rows if r])


def listing(node: Node, indent: int = 0) -> str:
    """List items by bullet or number; nested lists below their item, indented by two."""
    out: list[str] = []
    items = [c for c in node.children if isinstance(c, Node) and c.name == "li"]
    for k, item in enumerate(items, 1):
        own = trim("".join(c if isinstance(c, str) else c.text() for c in item.children if isinstance(c, str) or c.name not in ("ul", "ol")))
        if own:
            out.append("  " * indent + (f"{k}." if node.name == "ol" else "-") + f" {own}")
        out += filter(None, (listing(c, indent + 1) for c in item.children if isinstance(c, Node) and c.name in ("ul", "ol")))
    return "\n".join(out)


def _blocks(top: Node) -> list[Block]:
    out: list[Block] = []
    stack: list[Node | str] = list(reversed(top.children))

    def joins() -> bool:
        return bool(out) and out[-1]["type"] == "paragraph"

    while stack:
        x = stack.pop()
        if isinstance(x, str):
            t = trim(x)
            if t and joins():
                out[-1]["content"] += " " + t
            elif len(t) > 10:
                out.append(block("paragraph", t))
            continue
        name = x.name
        if name in THROUGH:
            stack += reversed(x.children)
            continue
        if name == "table":
            t, kind = table(x), "table"
        elif name in ("ul", "ol"):
            t, kind = listing(x), "list"
        else:
            t, kind = trim(x.text()), "paragraph"
        if name in HEADINGS:
            if t:
                out.append(block("heading", t, int(name[1])))
        elif name == "code" and "\n" not in t and len(t) <= 100:
            if t and joins():
                out[-1]["content"] += f" `{t}`"
        elif name in ("pre", "code"):
            if t:
                out.append(block("code", t))
        elif name == "blockquote":
            if t:
                out.append(block("paragraph", "\n".join(f"> {line}" for line in t.split("\n"))))
        elif name in ("p", "table", "ul", "ol"):
            if t:
                out.append(block(kind, t))
        elif any(isinstance(c, Node) for c in x.children):
            stack += reversed(x.children)
        elif t:
            out.append(block("paragraph", t))
    return out


def parse(data: bytes) -> tuple[list[Block], dict]:
    tree = Tree(decoded(data))
    root = tree.root
    if not DROPPED.isdisjoint(tree.counts):
        _drop(root)
    titles, described = [], None
    for x in root.all("title", "meta"):
        if x.name == "title":
            titles.append(x.text())
        elif described is None and x.attrs.get("name") == "description" and x.attrs.get("content"):
            described = x.attrs["content"]
    metadata = {}
    if title := trim("".join(titles)):
        metadata["title"] = title
    if described is not None:
        metadata["description"] = described
    return _blocks(tree.body), metadata
