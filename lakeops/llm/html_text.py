"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form its tree. Each has a hidden label (main content or not), a unary
potential from its tag, its class, id and role words, its text length, its share of linked text and its
punctuation, and a pairwise potential with its parent that depends on whether its tag or words say
something of their own. Sum-product messages go upward (children before parents) and downward (parents
before children); together they give every element's exact marginal. The text of elements whose marginal
is above one half is the main text.

The weights are trained by gradient ascent on the likelihood of labelled pages (`html_pages.PAGES`, a
fixed small set, and ``MADE`` pages that `made_pages` puts together by rule): observed minus expected features, the expectations coming from the same messages.

Blocks: each stretch of text between two block tags. Character references are decoded, white space is
made one space, blocks are trimmed and joined in page order by a newline. ``br`` is white space. Heads,
scripts, styles, frames, templates, noscript and svg elements and comments have no text. A head without
its end tag ends at the body, the first text, or the first element that no head holds. A noscript,
svg or template element without its end tag ends where its parent does; in the body itself, where the
next block begins.

Defined cases: a null or empty page has the empty text. Markup may be broken: an end tag closes the
nearest open element of its name, or nothing; ``<`` that starts no tag is text. Whole pages are read,
at any length and depth (no recursion), in linear time; bytes that are not UTF-8 are read as U+FFFD. Repeated rows get equal results. Empty tables give empty
results. Other columns are carried along where asked for; text and n_chars give way to the results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts
from .html_pages import PAGES, made_pages

MADE, SEED = 240, 1  # training pages that are made by rule

_OPENING = re.compile(r"<(?:(!--)|[!?]|(/?)([a-z][^\s/>]*))", re.I)
_MARK = re.compile(r"""[>"']""")
#: Elements whose content is text up to their end tag, and is left out. (Fixed values.)
_RAW = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in ("script", "style", "iframe", "title")}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|main|rest)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Elements that start and end blocks. (Fixed values.)
BLOCKS = frozenset(
    "address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr label legend li main menu nav ol option p pre section "
    "select summary table tbody td textarea tfoot th thead tr ul".split()
)
_EMPTY = frozenset(("hr",))
#: Tags that end an open element of the same kind, up to the named containers. (Fixed values.)
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot select menu".split())


_SKIPPED = frozenset("noscript svg template".split())
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript template".split())


class Tags:
    """The tags of a page, read from left to right in linear time.

    A ``>`` in a quoted attribute value does not end a tag; where a quote is never closed, the first ``>`` does. A quote at
    which that was found once is not followed again, and behind the last ``>`` there are no tags.
    """

    def __init__(self, html: str):
        self.html, self.limit, self.open_quotes = html, html.rfind(">"), set()

    def _end(self, at: int) -> int:
        """The ``>`` that ends the tag whose name ends at ``at``."""
        seen, pos = [], at
        while mark := _MARK.search(self.html, pos):
            if mark[0] == ">":
                return mark.start()
            if mark.start() in self.open_quotes:
                break
            seen.append(mark.start())
            pos = self.html.find(mark[0], mark.end()) + 1
            if not pos:
                break
        self.open_quotes.update(seen)
        return self.html.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag from ``at`` on; comments and raw elements have no name."""
        hit = _OPENING.search(self.html, at)
        if hit is None:
            return None
        if hit[1]:
            end = self.html.find("-->", hit.end())
            return hit.start(), end + 3 if end >= 0 else len(self.html), "", "", ""
        if hit.end() > self.limit:
            end = self.html.find("<!--", hit.end())  # only a comment can follow
            return (end, len(self.html), "", "", "") if end >= 0 else None
        name = (hit[3] or "").lower()
        if not name:
            return hit.start(), self.html.find(">", hit.end()) + 1, "", "", ""
        if name in _RAW and not hit[2]:
            close = _RAW[name].search(self.html, self.html.find(">", hit.end()) + 1)
            return hit.start(), close.end() if close else len(self.html), "", "", ""
        end = self._end(hit.end())
        return hit.start(), end + 1, hit[2], name, self.html[hit.end() : end]


def _head_end(tags: Tags, at: int) -> int:
    """Where the head ends whose start tag ends at ``at``."""
    other = -1  # the first thing that no head holds
    while hit := tags.next(at):
        start, end, slash, tag, _ = hit
        if other < 0 and tags.html[at:start].strip():
            other = at
        at = end
        if tag == "head" and slash:
            return end
        if tag == "body" or tag in BLOCKS:
            return start if other < 0 else other
        if other < 0 and tag and tag not in _IN_HEAD:
            other = start
    return other if other >= 0 else at


def _skipped_end(tags: Tags, at: int, tag: str, open_at: dict[str, list[int]], top: bool) -> int:
    """Where the element ends whose start tag ends at ``at``; ``open_at``: the open elements around it; ``top``: it is in none."""
    inner: dict[str, int] = {}
    block = -1  # the first block in it
    while hit := tags.next(at):
        start, at, slash, name, _ = hit
        if name == tag:
            if slash:
                return at
            if block >= 0:  # the end tag to come is that of this one
                return block
        elif name in BLOCKS and not slash:
            inner[name] = inner.get(name, 0) + 1
            block = start if block < 0 else block
        elif name in BLOCKS and inner.get(name):
            inner[name] -= 1
        elif slash and (name in ("body", "html") or name in BLOCKS and open_at.get(name)):
            return start if not top or block < 0 else block
    return block if block >= 0 else len(tags.html)


class Node:
    __slots__ = ("parent", "tag", "names", "chars", "linked", "stops", "main")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...], main: bool):
        self.parent, self.tag, self.names, self.main = parent, tag, names, main
        self.chars = self.linked = self.stops = 0


def _attributes(text: str) -> tuple[tuple[str, ...], bool, bool]:
    """Words of class, id and role; whether the labels ``main`` and ``rest`` are there."""
    words, main, rest = [], False, False
    for name, value in _ATTRIBUTE.findall(text):
        name = name.lower()
        if name in ("main", "rest"):
            main, rest = main or (name == "main" and not value), rest or (name == "rest" and not value)
        else:
            words += _WORD.findall(value.lower())
    return tuple(words), main, rest


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements, parents first, and the (node, text) blocks in page order."""
    nodes, blocks = [Node(-1, "body", (), False)], []
    stack, text, linked, links = [0], [], [], 0
    open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of a tag

    def flush() -> None:
        found = " ".join(unescape("".join(text)).split()) if text else ""
        if found:
            node = nodes[stack[-1]]
            node.chars += len(found)
            node.linked += min(len(found), len(" ".join(unescape("".join(linked)).split())))
            node.stops += found.count(". ") + found.count(", ") + (found[-1] in ".!?")
            blocks.append((stack[-1], found))
        text.clear()
        linked.clear()

    def close(depth: int) -> None:
        nonlocal links
        flush()
        for i in reversed(stack[depth:]):
            open_at[nodes[i].tag].pop()
        del stack[depth:]
        links = 0

    def nearest(names: tuple[str, ...] | frozenset[str]) -> int:
        """Place of the innermost open element of these tags; 0 if there is none."""
        return max((open_at[x][-1] for x in names if open_at.get(x)), default=0)

    tags = Tags(html)
    at, headed = 0, False
    while hit := tags.next(at):
        start, stop, end, tag, rest = hit
        if start > at:
            text.append(html[at:start])
            if links:
                linked.append(text[-1])
        at = stop
        if not tag:
            continue
        if tag == "head":
            if not (end or headed):  # a page has one head
                headed, at = True, _head_end(tags, at)
        elif tag in _SKIPPED and not end and not (tag == "svg" and rest.endswith("/")):
            at = _skipped_end(tags, at, tag, open_at, len(stack) == 1)
        elif tag == "a":
            links = 0 if end else 1
        elif tag == "br":
            text.append(" ")
        elif tag in ("html", "body"):
            flush()  # both stand for the root
            words, main, _ = _attributes(rest)
            nodes[0].names, nodes[0].main = nodes[0].names + words, nodes[0].main or main
        elif tag in BLOCKS:
            if end:
                if depth := nearest((tag,)):
                    close(depth)
                else:
                    flush()
                continue
            flush()
            links = 0
            if nodes[stack[-1]].tag == "p":
                close(len(stack) - 1)
            if tag in _CLOSES:
                while (depth := nearest(_CLOSES[tag])) > nearest(_HOLDERS):
                    over = nodes[stack[depth]].tag
                    close(depth)
                    if tag != "tr" or over == "tr":
                        break
            words, main, off = _attributes(rest) if rest else ((), False, False)
            nodes.append(Node(stack[-1], tag, words, (nodes[stack[-1]].main or main) and not off))
            if tag not in _EMPTY:
                open_at.setdefault(tag, []).append(len(stack))
                stack.append(len(nodes) - 1)
    if at < len(html):
        text.append(html[at:])
    flush()
    return nodes, blocks


def features(node: Node) -> list[str]:
    """Names of the unary features of an element."""
    found = [f"tag {node.tag}"]
    found += [f"word {w}" for w in dict.fromkeys(node.names)]
    if node.chars:
        found.append(f"length {min(4, node.chars.bit_length() // 2)}")
        found.append(f"links {round(2 * node.linked / node.chars)}")
        found.append(f"stops {min(3, node.stops)}")
    return found


#: Plain containers and text elements: what they are is what their parent is. (Fixed values.)
_PLAIN = frozenset(
    "p div li ul ol td tr th table tbody thead tfoot h1 h2 h3 h4 h5 h6 dd dt dl pre blockquote section figure "
    "figcaption hr caption center address".split()
)


#: Parts of forms. (Fixed values.)
_FORMS = frozenset("form fieldset legend label select option button textarea".split())


def _bond(node: Node, known: frozenset[str] | set[str]) -> str:
    """Kind of the potential between an element and its parent. What is linked text for the most part or belongs to a form
    has one of its own: such elements stand inside articles as well as around them, and say little about their parent."""
    if node.tag in _FORMS or 2 * node.linked > node.chars:
        return "apart"
    if node.tag not in _PLAIN or any(w in known for w in node.names):
        return "told"
    return "plain" if node.parent else "top"


class Model:
    """Weights of unary features (towards label 1) and a 2 x 2 table per kind of bond."""

    def __init__(self) -> None:
        self.unary: dict[str, float] = {}
        self.bonds = {kind: [[0.0, 0.0], [0.0, 0.0]] for kind in ("plain", "told", "top", "apart")}
        self.words: set[str] = set()

    def marginals(self, nodes: list[Node], named: list[list[str]] | None = None) -> tuple[list[float], list[tuple]]:
        """P(label 1) of each node, and of each bond the joint probabilities, by sum-product."""
        n, unary = len(nodes), self.unary
        kinds = [_bond(x, self.words) for x in nodes]
        tables = {k: [[math.exp(v) for v in row] for row in t] for k, t in self.bonds.items()}
        own = []
        for found in named or map(features, nodes):
            w = sum(unary.get(f, 0.0) for f in found)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, w))))
            own.append((1 - p, p))
        up0, up1 = [x[0] for x in own], [x[1] for x in own]  # own potential times messages of the children
        message = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):  # a child's number is above its parent's
            t = tables[kinds[i]]
            m0 = t[0][0] * up0[i] + t[0][1] * up1[i]
            m1 = t[1][0] * up0[i] + t[1][1] * up1[i]
            total = m0 + m1
            message[i] = (m0 / total, m1 / total)
            p = nodes[i].parent
            a, b = up0[p] * message[i][0], up1[p] * message[i][1]
            total = a + b
            up0[p], up1[p] = a / total, b / total
        belief = [(0.0, 0.0)] * n
        belief[0] = (up0[0] / (up0[0] + up1[0]), up1[0] / (up0[0] + up1[0]))
        joint: list[tuple] = [()] * n
        for i in range(1, n):
            p, t = nodes[i].parent, tables[kinds[i]]
            # the parent's belief without what this child told it
            d0, d1 = belief[p][0] / message[i][0], belief[p][1] / message[i][1]
            j = (d0 * t[0][0] * up0[i], d0 * t[0][1] * up1[i], d1 * t[1][0] * up0[i], d1 * t[1][1] * up1[i])
            total = sum(j)
            joint[i] = (kinds[i], *(x / total for x in j))
            belief[i] = (joint[i][1] + joint[i][3], joint[i][2] + joint[i][4])
        return [b[1] for b in belief], joint

    def train(self, pages: list[str], rounds: int = 300, rate: float = 0.4, decay: float = 0.002) -> None:
        trees = [parse(p)[0] for p in pages]
        scale = 15 / len(pages)  # the rate is for 15 pages
        self.words = {w for t in trees for x in t for w in x.names}
        named = [list(map(features, t)) for t in trees]
        for _ in range(rounds):
            change: dict[str, float] = {}
            bonds = {k: [[0.0, 0.0], [0.0, 0.0]] for k in self.bonds}
            for nodes, found in zip(trees, named, strict=True):
                marginal, joint = self.marginals(nodes, found)
                for i, node in enumerate(nodes):
                    for f in found[i]:
                        change[f] = change.get(f, 0.0) + node.main - marginal[i]
                    if i:
                        kind, a, b, c, d = joint[i]
                        bonds[kind][nodes[node.parent].main][node.main] += 1
                        for k, v in enumerate((a, b, c, d)):
                            bonds[kind][k >> 1][k & 1] -= v
            for f, v in change.items():
                old = self.unary.get(f, 0.0)
                self.unary[f] = old + rate * (v * scale / 4 - decay * 15 * old)
            for kind, table in bonds.items():
                for a in (0, 1):
                    for b in (0, 1):
                        old = self.bonds[kind][a][b]
                        self.bonds[kind][a][b] = max(-8.0, min(8.0, old + rate * (table[a][b] * scale / 8 - decay * 15 * old)))


@lru_cache(maxsize=1)
def trained() -> Model:
    model = Model()
    model.train(PAGES * 8 + made_pages(MADE, SEED), rounds=150, rate=0.8, decay=0.0002)
    return model


def main_text(model: Model, html: str | None) -> str:
    nodes, blocks = parse(html or "")
    if not blocks:
        return ""
    marginal, _ = model.marginals(nodes)
    return "\n".join(text for node, text in blocks if marginal[node] > 0.5)


def extract(pages: DataFrame, carry: list[str], html: str = "html", model: Model | None = None) -> DataFrame:
    """The ``carry`` columns, ``text`` and ``n_chars`` (its code points)."""
    carry = [c for c in carry if c not in ("text", "n_chars")]
    # a few hundred weights
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html, 8 << 20):
            found = [main_text(shared.value, x) for x in texts(batch.column(html))]
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "text", "n_chars"])

    types = dict(pages.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "text string, n_chars long"])
    return pages.select(*dict.fromkeys([*carry, html])).mapInArrow(run, schema)
