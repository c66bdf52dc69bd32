"""HTML pages as sequences of leaf text blocks with their tag paths.

Markup is read leniently, by one regular expression over the whole page: comments, scripts,
styles and other raw text fall away, an unclosed comment or raw element runs to the end, ``/>``
leaves a raw element empty, open ``p``, ``li`` and similar elements are closed by their next
sibling, and a stray ``<`` is text.  What graphics, objects and templates hold falls away up to
their own closing tag; without one (but for templates) they are elements like any other.
A block is the text between two block-level tags; its path is the chain of open elements, of any
depth: below ``DEEP`` it leaves out elements whose names have their places on it already.
"""
from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

RAW = ("script", "style", "noscript", "iframe", "title", "textarea", "xmp")
HIDDEN = frozenset({"svg", "object", "canvas", "template"})      # markup whose text isn't the page's
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an opening tag that closes an open element of these, up to the nearest of the second set
CLOSES = {
    **{t: (frozenset({"p"}), frozenset({"button", "td", "th", "table", "body"})) for t in BLOCK - {"body", "html", "head"}},
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "optgroup"})),
}
DEEP = 256           # open elements all shown on the path; of deeper ones, those that add something
PATH = 256           # places that names on the path are told apart by
#: attributes; a quoted value may hold anything, others end at white space or '>'
ATTRS = r"""(?>\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+)*+"""
_token = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<raw>%s)(?=[\s/>])%s>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>?|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>%s)(?P<empty>/?)>|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)" % ("|".join(RAW), ATTRS, ATTRS),
    re.DOTALL | re.IGNORECASE)
_hidden = re.compile(r"<(?:%s)[\s/>]" % "|".join(sorted(HIDDEN)), re.IGNORECASE)
_label = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_word = re.compile(r"[^\W_]+")


def place(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


def names_of(tag: str, rest: str) -> tuple[str, ...]:
    """An element's tag and the words of its class, id and role."""
    if "=" not in rest:
        return (tag,)
    labels = [w.lower() for m in _label.finditer(rest) for w in _word.findall(html.unescape(m[1] or m[2] or m[3] or ""))]
    return (tag, *("." + w for w in labels))


def hidden(page: str) -> dict[int, int]:
    """Where each closed element of ``HIDDEN`` starts and ends; an unclosed template ends with the page."""
    ends: dict[int, int] = {}
    if not _hidden.search(page):
        return ends
    opened: dict[str, list[int]] = {name: [] for name in HIDDEN}
    for m in _token.finditer(page):
        if m["name"] and (starts := opened.get(m["name"].lower())) is not None:
            if not m["close"]:
                if not m["empty"] and not m["rest"].endswith("/"):
                    starts.append(m.start())
            elif starts:
                ends[starts.pop()] = m.end()
    return ends | {i: len(page) for i in opened["template"]}


class Open:
    """The open elements, with the depths of every tag, so that no tag costs a walk over all of them."""

    def __init__(self):
        self.elements: list[tuple[str, ...]] = []
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.shown: list[tuple[int, set]] = []     # depths on the path, and what each adds to it
        self.seen: set = set()

    def push(self, element: tuple[str, ...]) -> None:
        depth = len(self.elements)
        adds = {place(n, PATH) for n in element} - self.seen
        if element[0] in BLOCK and element[0] not in self.seen:
            adds.add(element[0])
        if adds or depth < DEEP:
            self.shown.append((depth, adds))
            self.seen |= adds
        self.elements.append(element)
        self.at[element[0]].append(depth)

    def cut(self, depth: int) -> None:
        """Closes all elements from ``depth`` on."""
        while len(self.elements) > depth:
            self.at[self.elements.pop()[0]].pop()
        while self.shown and self.shown[-1][0] >= depth:
            self.seen -= self.shown.pop()[1]

    def close(self, tag: str) -> None:
        if self.at[tag]:
            self.cut(self.at[tag][-1])

    def close_before(self, tag: str) -> None:
        """Closes what the opening ``tag`` closes."""
        closed, stop = CLOSES[tag]
        held = max((self.at[t][-1] for t in stop if self.at[t]), default=-1)
        firsts = [some[i] for t in closed if (i := bisect_right(some := self.at[t], held)) < len(some)]
        if firsts:
            self.cut(min(firsts))

    def path(self) -> tuple[tuple[str, ...], ...]:
        n = len(self.elements)
        if n <= DEEP:
            return tuple(self.elements)
        return *(self.elements[d] for d, _ in self.shown if d < n - 2), *self.elements[-2:]


def leaves(page: str | None) -> Iterator[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """(path, text, characters inside links) of every block with text, in page order.

    Character references are decoded, white space is one space, ends are trimmed.  Null has none.
    """
    if not page:
        return
    path = Open()
    held, linked, links = [], 0, path.at["a"]

    def block():
        nonlocal held, linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            inside, held, linked = linked, [], 0
            if text:
                return path.path(), text, inside
        return None

    ends, until = hidden(page), 0
    for m in _token.finditer(page):
        if m.start() < until:
            continue
        if m.start() in ends:
            until = ends[m.start()]
            continue
        if (text := m["text"]) is not None:
            held.append(text)
            if links:
                linked += len(text)
            continue
        tag = m["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK and (found := block()):
            yield found
        if tag == "br":
            held.append(" ")
        elif m["close"]:
            path.close(tag)
        elif tag not in VOID:
            if tag in CLOSES:
                path.close_before(tag)
            empty = m["empty"] or tag in HIDDEN and m["rest"].endswith("/")
            if not empty or tag in BLOCK:
                path.push(names_of(tag, m["rest"]))
    if found := block():
        yield found
