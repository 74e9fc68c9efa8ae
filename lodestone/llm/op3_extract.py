"""Main text of web pages: blocks, then two passes of rules.

A page is cut into blocks at block-level tags. Blocks inside menus, headers, footers,
sidebars, notices, adverts, forms and reader comments (by tag, role, class or id) go, as
do scripts, styles, comments of the markup and the head. Words of a class or id that follow
`has`, `with`, `no` and the like do not count. Words for parts of a layout (sidebar, menu) do
not drop an element with over half of the page's prose, or with its marked article if
no other is outside; those for comments, adverts and notices do unless nothing else is text.

Pass 1 decides each remaining block by link density, length and stop-word density: good,
bad, or undecided: short blocks, headings, and sentences without stop words. Where letters
are not Latin, marks of sentences stand for stop words, and in scripts without spaces
characters for words. Marks of an article
(`article`, `main`, or a role, itemprop, class or id that says so) are evidence: they are
believed where the marked part holds at least half of the words that pass 1 finds good (of
the undecided ones, where none is good). Then a marked block without links is good, one
with links goes up a level unless it is nearly all links, and one outside must be long to be
good. Marks that are not believed, as of a teaser beside the text, count for nothing.

Pass 2 gives an undecided block the label of its nearest decided neighbours: good if both
sides are good; where they differ, that of the nearer one, a heading that of the one after.
With believed marks, each run of blocks in or outside them is decided by itself; what its
neighbours leave open is good if it is marked. If no block of another page is decided,
its undecided ones are the text.

Character references are decoded as browsers do, white space inside a block becomes one
space, and blocks are joined by one space in page order. Nothing else is dropped or cut.
A tag that the end of the page cuts off is dropped; an unclosed container holds all that
follows in its parent. Null, empty and tagless pages: null and empty give an empty text;
plain text is one block, judged by the rules. Repeated rows are kept, other columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.shared import mapped

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: comment, declaration, raw-text element, tag, or what the end of the page cuts off
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|noembed|noframes|xmp)(?=[\s/>]){_ATTRS}>(?:.*?</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|.*\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?:(?P<attrs>{_ATTRS})>|[^>]*+(?:>|\Z))|</?\Z",
    re.S | re.I,
)
#: one attribute: its whole name and its value
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
) | {""}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AWAY = frozenset("head nav header footer aside form button select option datalist dialog menu fieldset object audio video canvas map".split())
#: Words in a class or id that mark what is no part of an article.
AWAY_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies disqus "
    "discussion footer gdpr header infobar login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promoted promotion "
    "reactions related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar".split()
)
#: Those of AWAY_WORDS that mark reader comments, adverts and notices, which may be longer
#: than the article; the others name parts of a layout.
FOREIGN_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising captcha comment comments commentlist consent cookie cookies disqus discussion gdpr newsletter "
    "notice notices paywall promo promoted promotion reactions related replies reply respond sponsor sponsored".split()
)
#: What follows one of these in a name tells of a layout: has-sidebar, no-comments.
MODIFIERS = frozenset("has with no non not without hide show enable enabled disable disabled".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ARTICLE_WORDS = frozenset({"articlebody", "article", "main"})
#: Pairs of words in a class or id that mark an article's text.
ARTICLE_PAIRS = tuple(frozenset(x.split()) for x in ("article body", "article content", "article text", "entry content", "main content", "post body", "post content", "story body"))
#: Frequent function words of five languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was with as on be by this are from or an at not have but which you "
    "der die das und ist nicht ein eine zu den von mit sich des auf im dem für als auch es werden aus "
    "de la le les et des en un une du que est dans pour qui sur pas au par ce il se "
    "el los las y del por con no su para al lo como más o pero sus "
    "di che è per non una il della sono con".split()
)
#: Containers, and tags whose end tags do not reach out of them.
WALLS = ("td", "th", "table", "article", "main")
BEHIND_WALLS = frozenset("p li div span a b i".split())
_CLOSES_P = HEADINGS | frozenset("address article aside blockquote div dl fieldset footer form header hr main nav ol p pre section table ul".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
#: what is beyond the Latin letters
_BEYOND = re.compile("[^\u0000-\u024f]")
_SENTENCE_END = re.compile(r"""[.!?…。！？]["'”’»)\]]*$""")
_MARKS = re.compile("[.,;:!?…。、，！？；：،؟।]")
#: Characters of scripts that are written without spaces.
_SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
MIN_WORDS, LONG_WORDS, STOP_LOW, STOP_HIGH, LINKS, ALL_LINKS = 10, 30, 0.10, 0.20, 0.33, 0.8


def kind(tag: str, attrs: str) -> str:
    """'away', 'article' or '' for an element; 'named' or 'foreign' where only a class
    or id says away."""
    if tag in AWAY:
        return "away"
    out, seen = "article" if tag in ("article", "main") else "", set()
    for name, a, b, c in ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), (a or b or c).lower()
        if name in seen:  # the first one counts
            continue
        seen.add(name)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "away"
        if name == "role":
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & AWAY_ROLES:
                return "away"
            out = "article" if words & ARTICLE_WORDS else out
        elif name == "itemprop":
            words = set(re.split(r"[^a-z0-9]+", value))
            out = "article" if "articlebody" in words else "foreign" if "comment" in words else out
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            out = named(tag, value) or out
    return out


def named(tag: str, value: str) -> str:
    """What a class or id says of its element."""
    words: set[str] = set()
    marked = False
    for token in value.split():
        own = list(takewhile(lambda w: w not in MODIFIERS, re.findall(r"[a-z0-9]+", token)))
        marked |= any(pair <= set(own) for pair in ARTICLE_PAIRS) and not AWAY_WORDS & set(own)
        words.update(own)
    if marked:
        return "article"
    if words & AWAY_WORDS or "header" in words and tag in ("div", "section", "table") and not words & {"article", "post", "entry"}:
        return "foreign" if words & FOREIGN_WORDS else "named"
    return "article" if any(pair <= words for pair in ARTICLE_PAIRS) else ""


class Block:
    """Text between two block-level tags, with what the rules look at."""

    __slots__ = ("_label", "_words", "article", "away", "heading", "held", "item", "linked", "text")

    def __init__(self, text: str, linked: int, away: bool, article: bool, heading: bool, item: bool, held: tuple[tuple[int, bool, bool], ...]):
        self.text, self.linked, self.away, self.article, self.heading, self.item = text, linked, away, article, heading, item
        #: elements around it that a class or id names away: number, foreign, an article begins in it
        self.held = held
        self._words, self._label = -1, ""

    @property
    def words(self) -> int:
        """`n_words` of its text, counted once."""
        if self._words < 0:
            self._words = n_words(self.text)
        return self._words

    @property
    def label(self) -> str:
        """What `first_pass` says of it, judged once."""
        self._label = self._label or first_pass(self)
        return self._label


def blocks(page: str) -> list[Block]:
    """All blocks of a page with text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    # open elements, those of each tag by their places, and the places of block-level ones
    stack: list[tuple[str, str]] = []
    places: dict[str, list[int]] = {}
    boxes: list[int] = []
    away = article = heading = item = link = 0
    linked = at = 0
    named_away: list[tuple[int, bool, int]] = []
    n_named = 0
    has_link = False

    def flush() -> None:
        nonlocal linked, has_link
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, linked if has_link else 0, away > 0, article > 0, heading > 0, item > 0, tuple((k, of, article > n) for k, of, n in named_away)))
            parts.clear()
        linked, has_link = 0, False

    def count(tag: str, what: str, by: int) -> None:
        nonlocal away, article, heading, item, link, n_named
        if what in ("named", "foreign"):
            if by > 0:
                n_named += 1
                named_away.append((n_named, what == "foreign", article))
            else:
                named_away.pop()
        away += by * (what == "away")
        article += by * (what == "article")
        heading += by * (tag in HEADINGS)
        item += by * (tag == "li")
        link += by * (tag == "a")

    def pop() -> None:
        tag, what = stack.pop()
        if tag:
            places[tag].pop()
        if tag not in INLINE:
            boxes.pop()
            flush()
        count(tag, what, -1)

    def top(*tags: str) -> int:
        """Where the innermost open element of some tags stands; -1 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def close(k: int) -> None:
        while len(stack) > k:
            pop()

    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(text := page[at : m.start()])
            if link:
                linked, has_link = linked + len(text), True
        at = m.end()
        if m["tag"] is None:
            if m["raw"]:
                parts.append(" ")
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "br":
                parts.append(" ")
                continue
            # an end tag closes its element and what is open in it; one inside a container never closes that
            k, wall = top(tag), top(*WALLS) if tag in BEHIND_WALLS else -1
            if k > wall:
                close(k)
            elif k < 0 and wall < 0 and tag not in INLINE:
                flush()
            continue
        if m["attrs"] is None:  # cut off by the end of the page
            continue
        if tag not in INLINE:
            flush() if tag != "br" else parts.append(" ")
            if tag in _CLOSES_P and boxes and stack[boxes[-1]][0] == "p":
                close(boxes[-1])
            if (closed := _CLOSED_BY.get(tag)) and (k := top(*closed)) > top("ul", "ol", "dl", "table", "select"):
                close(k)
        elif tag == "a" and link:
            # a link ends where the next begins; what its element is named holds on
            k = places["a"].pop()
            stack[k] = ("", stack[k][1])
            link -= 1
        if tag not in VOID:
            what = kind(tag, m["attrs"])
            places.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                boxes.append(len(stack))
            stack.append((tag, what))
            count(tag, what, 1)
    if at < len(page):
        parts.append(text := page[at:])
        if link:
            linked, has_link = linked + len(text), True
    flush()
    return out


def n_words(text: str) -> int:
    """White-space words; of scripts without spaces, two characters count as one more."""
    return len(text.split()) + (0 if text.isascii() else len(_SPACELESS.findall(text)) // 2)


def stop_density(text: str, words: int) -> float:
    """The share of stop words. Texts mostly in other scripts than Latin, of which no stop
    words are known, have that of prose if one in 25 words has a mark of a sentence."""
    # most texts have few characters beyond Latin, or none, so letters are counted for the others only
    if not text.isascii() and (beyond := sum(map(str.isalpha, _BEYOND.findall(text)))) and 2 * beyond > sum(map(str.isalpha, text)):
        return STOP_HIGH if 25 * len(_MARKS.findall(text)) >= words else 0.0
    found = text.lower().split()
    # a word of letters alone has no edges to strip
    stops = sum(map(STOP_WORDS.__contains__, found))
    return (stops + sum(_EDGES.sub("", w) in STOP_WORDS for w in found if not w.isalpha())) / max(words, 1)


def first_pass(b: Block) -> str:
    """'good', 'bad' or '?' of a block by its own text."""
    words = b.words
    if b.linked > LINKS * len(b.text):
        return "bad"
    if b.heading:
        return "?"
    if words < MIN_WORDS:
        return "bad" if b.linked else "?"
    stops = stop_density(b.text, words)
    if stops >= STOP_HIGH:
        return "good" if words >= LONG_WORDS or not b.linked else "?"
    if stops >= STOP_LOW:
        return "good" if words >= LONG_WORDS else "?"
    # what ends as a sentence does may be prose without stop words
    return "?" if not b.linked and (words >= LONG_WORDS or _SENTENCE_END.search(b.text)) else "bad"


def weights(found: list[Block]) -> list[int]:
    """The words of each block with the best label there is, 0 of the others."""
    labels = [b.label for b in found]
    best = next((x for x in ("good", "?") if x in labels), "bad")
    return [b.words if x == best else 0 for b, x in zip(found, labels)]


def believed(found: list[Block]) -> bool:
    """Whether marked blocks hold at least half of the words with the best label."""
    words = weights(found)
    marked = sum(n for n, b in zip(words, found) if b.article)
    return marked > 0 and 2 * marked >= sum(words)


def with_mark(b: Block, label: str) -> str:
    """The label of a block of a page whose marks are believed."""
    if b.article:
        if b.linked > ALL_LINKS * len(b.text) and not b.heading:
            return "bad"
        return "?" if b.heading or b.linked and label == "bad" else "good"
    return "?" if label == "good" and b.words < LONG_WORDS else label


def second_pass(labels: list[str], headings: list[bool], alone: str = "good", tied: str = "bad") -> list[str]:
    """Undecided blocks take the label of their nearest decided neighbours; `alone` if no
    block is decided, `tied` if two that differ are equally near."""
    n = len(labels)
    if all(x == "?" for x in labels):
        return [alone] * n
    before: list[tuple[str, int]] = []
    near = ("bad", n + 1)
    for x in labels:
        near = (x, 0) if x != "?" else (near[0], near[1] + 1)
        before.append(near)
    near, out = ("bad", n + 1), list(labels)
    for k in range(n - 1, -1, -1):
        near = (labels[k], 0) if labels[k] != "?" else (near[0], near[1] + 1)
        if labels[k] == "?":
            a, z = before[k], near
            out[k] = a[0] if a[0] == z[0] else z[0] if headings[k] and z[1] <= n else a[0] if a[1] < z[1] else z[0] if z[1] < a[1] else tied
    return out


def shown(page: str) -> list[Block]:
    """The blocks of a page that may be its text. What a class or id names away goes, but
    not the element that holds the marked article or most of the page's text: such a name can
    tell of its layout. Comments and adverts go if there is text elsewhere."""
    found = [b for b in blocks(page) if not b.away]
    if not any(b.held for b in found):
        return found
    clear = [b for b in found if not b.held]
    marked = any(b.article for b in clear)
    text = marked or any(b.label == "good" for b in clear)
    # good and long undecided blocks tell where the text is; of all that is short, the words do
    sizes = [b.words for b in found]
    prose = [n * (b.label == "good" or b.label == "?" and n >= LONG_WORDS) for b, n in zip(found, sizes)]
    short = not clear and not any(prose)
    words: Counter[int] = Counter()
    for b, n in zip(found, sizes if short else prose):
        words.update({k: n for k, _, _ in b.held})
    total = sum(sizes if short else prose)
    with_article = {k for b in found for k, _, holds in b.held if holds}

    def stays(k: int, foreign: bool) -> bool:
        if foreign and (text or short):
            return False
        return not marked and k in with_article or 2 * words[k] > total

    return [b for b in found if all(stays(k, foreign) for k, foreign, _ in b.held)]


def decided(found: list[Block]) -> list[str]:
    """'good' or 'bad' of each block, by both passes."""
    labels = [b.label for b in found]
    if not any(b.article for b in found) or not believed(found):
        return second_pass(labels, [b.heading for b in found])
    out: list[str] = []
    for marked, run in groupby(zip(found, labels), lambda x: x[0].article):
        part, prior = list(run), "good" if marked else "bad"
        out += second_pass([with_mark(b, x) for b, x in part], [b.heading for b, _ in part], prior, prior)
    return out


def main_text(page: str | None) -> str:
    """The article of a page as one line."""
    if not page:
        return ""
    found = shown(page)
    return " ".join(b.text for b, x in zip(found, decided(found)) if x == "good")


def visible_text(page: str | None) -> str:
    """All text that a reader sees, one block a line."""
    return "\n".join(b.text for b in blocks(page or ""))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return mapped(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
