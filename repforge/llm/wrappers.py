"""Main text of pages by wrapper induction over pages of one host.

Of each host one page of every frequent layout is a reference. Every page's
DOM tree is aligned with the reference most like it by simple tree matching,
and the aligned nodes are counted over all pages of the layout: how often a
node's text equals the reference's (constant nodes are template) and how much
text it holds (varying slots). The wrapper is the reference tree with the slot
that holds the article, and its constant nodes. A page's text is what its own
aligned slot holds, or a slot of its own where that misses some of its varying
text, without template and without blocks whose whole class, id or role is the
name of menus, notices, adverts and the like.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, join_owners, map_arrow

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset("address article aside blockquote body br center dd details div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select "
                  "summary table tbody td tfoot th thead title tr ul".split())
SKIPPED = frozenset("script style noscript template iframe svg title head nav header footer aside form button select "
                    "input textarea dialog menu".split())
SKIPPED_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
                          "cookies consent disclaimer footer header menu modal nav navbar navigation newsletter notice "
                          "notices popup promo related respond share sharing sidebar signup social sponsor sponsored "
                          "subscribe toolbar widget".split())
NO_TEXT = frozenset("#root html head body ul ol dl table tr".split())
CONTAINERS = frozenset("html body div main article section center".split())
FRAMES = CONTAINERS | {"header", "nav", "footer", "aside"}
MAIN = frozenset("article main".split())
#: Never skipped for a name, nor is anything that holds one.
KEPT = frozenset("html body main article".split())
#: May be put around a whole page: not skipped if it holds one of these, or at
#: least half of the page's text.
AROUND = frozenset("form header dialog".split())

#: Elements nested deeper, and what they hold, are siblings at this depth.
MAX_DEPTH = 200
#: A text node is template if at least this share of its pages agree ...
CONSTANT = 0.95
#: ... out of at least so many pages.
PAGES = 8
#: An article or main element is the slot if it holds at least this share of
#: the varying text; another slot holds all of it.
SHARE = 0.7
#: Pages whose skeletons align to this share have one layout.
SAME_LAYOUT = 0.9
#: Layouts with a reference of their own in a host, out of the first pages of
#: its most frequent sequences of tags. A page of any other layout meets the
#: reference that is most like it, or is its own.
LAYOUTS, CANDIDATES = 8, 32

#: A quote opens a value only after an equals sign.
_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>", re.S)
_NAME = re.compile(r"(?<![\w:-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: An open element of the key is closed by a start tag of the values.
_CLOSES = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
           "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_CLOSED_BY = {t: [k for k, v in _CLOSES.items() if t in v] for t in frozenset().union(*_CLOSES.values())}


class Node:
    __slots__ = ("tag", "names", "children", "text", "shape", "number", "named", "kept", "main", "around")

    def __init__(self, tag: str, names: tuple[str, ...] = (), text: str = "", named: bool = False):
        self.tag, self.names, self.text, self.named = tag, names, text, named
        self.children: list[Node] = []
        self.shape, self.number = "", -1
        self.kept, self.main = tag in KEPT, tag in MAIN  # or holds such an element, see _finish
        self.around = False

    @property
    def skipped(self) -> bool:
        return (self.tag in SKIPPED and not self.around) or self.named and not self.kept


def parse(html: str) -> Node:
    """DOM tree of a page; text nodes have the tag '#'. Unclosed elements
    end with their parent. An element at MAX_DEPTH is open as any other, but
    what it holds goes to its parent, or to itself where it is skipped."""
    root = Node("#root")
    stack = [("#root", root, 0)]  # tag, node that takes the children, its depth
    opened: Counter[str] = Counter()  # open elements by tag
    at = 0
    raw_until = -1

    def say(text: str) -> None:
        if text and not text.isspace():
            stack[-1][1].children.append(Node("#", text=unescape(text) if "&" in text else text))
        elif text:
            stack[-1][1].children.append(Node("#", text=" "))

    def close(i: int) -> None:
        for tag, _, _ in stack[i:]:
            opened[tag] -= 1
        del stack[i:]

    last = html.rfind(">") + 1  # no tag ends later
    tail = html.find("<!", last)
    html = html if tail < 0 else html[:tail]
    for m in _TAG.finditer(html, 0, last):
        if m.start() < raw_until:
            continue
        say(html[at: m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(html)  # a comment without an end
            continue
        if m[1]:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        if any(opened[t] for t in _CLOSED_BY.get(tag, ())):
            for i in range(len(stack) - 1, 0, -1):
                if tag in _CLOSES.get(stack[i][0], ()):
                    close(i)
                    break
                if stack[i][0] in CONTAINERS or stack[i][0] in ("table", "ul", "ol", "dl"):
                    break
        values = ["".join(g).strip().lower() for g in _NAME.findall(m[3])]
        names = tuple(w for v in values for w in re.split(r"[\s_-]+", v) if w)
        node = Node(tag, names, named=not SKIPPED_NAMES.isdisjoint(values))
        _, parent, depth = stack[-1]
        parent.children.append(node)
        slashed = m[3].rstrip().endswith("/")
        end = _raw_end(html, tag, at, slashed) if tag in RAW else None
        if end:
            node.children.append(Node("#", text=html[at: end[0]]))
            at = raw_until = end[1]
        elif tag not in VOID and not slashed:
            deeper = depth < MAX_DEPTH - 1 or depth == MAX_DEPTH - 1 and node.skipped
            stack.append((tag, node, depth + 1) if deeper else (tag, parent, depth))
            opened[tag] += 1
    say(html[at:] if at >= raw_until else "")
    _finish(root)
    return root


_RAW_ENDS = {tag: re.compile(rf"<(/?){tag}(?![^\s/>])[^>]*>", re.I) for tag in RAW}


def _raw_end(html: str, tag: str, at: int, slashed: bool) -> tuple[int, int] | None:
    """Where the text of a raw element stops and where its end tag ends; None
    where it has no text of its own. Script and style without an end tag go
    to the end of the page, others close with their parent. A slash closes
    an svg, and any other whose end tag does not come before the next start."""
    if slashed and tag == "svg":
        return None
    marks = _RAW_ENDS[tag].finditer(html, at)
    if slashed:
        first = next(marks, None)
        return (first.start(), first.end()) if first and first[1] else None
    end = next((m for m in marks if m[1]), None)
    if end:
        return end.start(), end.end()
    return (len(html), len(html)) if tag in ("script", "style") else None


def _finish(root: Node) -> None:
    """Shape of every subtree (children first), whether it holds an element
    that is never skipped for a name or a main one, whether it is put around
    the page, and numbers in page order."""
    order, stack = [], [root]
    frames, said, raw = [], [], False
    while stack:
        node = stack.pop()
        if node.tag in NO_TEXT:  # blanks between their children mean nothing
            node.children = [c for c in node.children if c.tag != "#" or c.text != " "]
        node.number = len(order)
        order.append(node)
        said.append(0 if raw else len(node.text))  # the text of a raw element comes right after it
        raw = node.tag in RAW
        if node.tag in AROUND:
            frames.append(node)
        stack.extend(reversed(node.children))
    for node in reversed(order):
        for c in node.children:
            if c.kept:
                node.kept = True
                if c.main:
                    node.main = True
        _shape(node)
    upto = [0, *accumulate(said)] if frames else []
    for node in frames:
        last = node
        while last.children:
            last = last.children[-1]
        node.around = node.main or 2 * (upto[last.number + 1] - upto[node.number]) >= upto[-1] > 0


def _shape(node: Node) -> None:
    label = ".".join((node.tag, *node.names[:2]))
    node.shape = label if not node.children else (
        label + xxhash.xxh64_hexdigest("|".join(c.shape for c in node.children))[:10])


def _label(node: Node) -> tuple:
    return (node.tag, *node.names[:2])


def _size(node: Node) -> int:
    return 1 + sum(map(_size, node.children))


def match(a: Node, b: Node, known: dict | None = None) -> int:
    """Simple tree matching: nodes in the largest alignment of two trees that
    keeps roots, order and levels."""
    if _label(a) != _label(b):
        return 0
    known = {} if known is None else known
    key = (a.shape, b.shape)
    if key not in known:
        known[key] = _size(a) if a.shape == b.shape else 1 + sum(
            match(x, y, known) for x, y in _align(a.children, b.children, known))
    return known[key]


def _align(xs: list[Node], ys: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """Best in-order pairs of two lists of children."""
    low = 0
    while low < min(len(xs), len(ys)) and xs[low].shape == ys[low].shape:
        low += 1
    high = 0
    while high < min(len(xs), len(ys)) - low and xs[-1 - high].shape == ys[-1 - high].shape:
        high += 1
    pairs = list(zip(xs[:low], ys[:low]))
    tail = list(zip(xs[len(xs) - high:], ys[len(ys) - high:]))
    xs, ys = xs[low: len(xs) - high], ys[low: len(ys) - high]
    if xs and ys:
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs):
            above, row = best[i], best[i + 1]
            for j, y in enumerate(ys):
                row[j + 1] = max(above[j + 1], row[j], above[j] + match(x, y, known))
        i, j, middle = len(xs), len(ys), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                middle.append((xs[i], ys[j]))
        pairs += reversed(middle)
    return pairs + tail


def aligned(reference: Node, page: Node) -> list[tuple[Node, Node]]:
    """Pairs of aligned nodes, parents first."""
    known: dict = {}
    out, stack = [], [(reference, page)] if _label(reference) == _label(page) else []
    while stack:
        a, b = stack.pop()
        out.append((a, b))
        if a.children and b.children:
            stack.extend(p for p in _align(a.children, b.children, known) if match(*p, known))
    return out


# --- reference and wrapper as text ---------------------------------------------

def _digest(text: str) -> str:
    return xxhash.xxh64_hexdigest(" ".join(text.split()))


def pack_tree(node: Node) -> list:
    """[tag, names, digest of a text node or children, 1 where named as no
    content plus 2 where put around the page]."""
    return [node.tag, node.names[:2], _digest(node.text) if node.tag == "#" else [pack_tree(c) for c in node.children],
            int(node.named) + 2 * node.around]


def unpack_tree(packed: str) -> Node:
    return _unpack(json.loads(packed))


def _unpack(tree: list) -> Node:
    def build(p: list) -> Node:
        node = Node(p[0], tuple(p[1]), named=bool(p[3] & 1))
        around.append((node, p[3] > 1))
        if p[0] == "#":
            node.text = p[2]
        else:
            node.children = [build(c) for c in p[2]]
        return node
    around: list[tuple[Node, bool]] = []
    root = build(tree)
    _finish(root)
    for node, flag in around:  # known from the whole texts, not from digests
        node.around = flag
    return root


@lru_cache(maxsize=512)
def unpack_layouts(packed: str) -> list[tuple[Node, Node]]:
    """Reference trees of a host's layouts and their skeletons."""
    trees = [_unpack(t) for t in json.loads(packed)]
    return [(t, skeleton(t)) for t in trees]


def skeleton(page: Node) -> Node:
    """The page's containers alone; of a run of equal ones the first two."""
    def build(node: Node) -> Node:
        out = Node(node.tag, node.names[:2])
        for c in [] if node.skipped else node.children:
            if c.tag in FRAMES:
                part = build(c)
                _shape(part)
                if [k.shape for k in out.children[-2:]] != [part.shape] * 2:
                    out.children.append(part)
        return out
    root = build(page)
    _shape(root)
    return root


def likeness(a: Node, b: Node) -> float:
    return 2 * match(a, b) / (_size(a) + _size(b))


def layouts(trees: list[str]) -> list[str]:
    """Of packed trees, the most frequent first, those unlike all before."""
    kept: list[tuple[str, Node]] = []
    for tree in trees:
        own = skeleton(unpack_tree(tree))
        if len(kept) < LAYOUTS and all(likeness(s, own) < SAME_LAYOUT for _, s in kept):
            kept.append((tree, own))
    return [t for t, _ in kept]


def nearest(references: list[tuple[Node, Node]], page: Node) -> int:
    """Number of the reference whose layout is most like the page's."""
    if len(references) == 1:
        return 0
    own = skeleton(page)
    return max(range(len(references)), key=lambda i: (likeness(references[i][1], own), -i))


def _mass(node: Node, out: dict[int, int], drop: frozenset[int] | set[int] = frozenset(), link: bool = False) -> int:
    """Characters of plain text (not links, not in ``drop``) under every node
    that is not skipped."""
    if node.skipped:
        return 0
    link = link or node.tag == "a"
    if node.tag == "#":
        n = 0 if link or id(node) in drop else len(node.text.strip())
    else:
        n = sum(_mass(c, out, drop, link) for c in node.children)
    out[id(node)] = n
    return n


def votes(reference: Node, page: Node) -> list[tuple[int, int, int]]:
    """(reference node, whether its text is the page's, characters held) of
    the nodes that are neither blank nor skipped."""
    mass: dict[int, int] = {}
    _mass(page, mass)
    return [(a.number, int(a.tag == "#" and a.text == _digest(b.text)), mass[id(b)])
            for a, b in aligned(reference, page) if id(b) in mass and (b.tag != "#" or not b.text.isspace())]


def induce(reference: Node, counts: dict[int, tuple[int, int, int]]) -> tuple[int, list[int]]:
    """(number of the article's slot, numbers of the template nodes) from
    (pages, equal texts, characters) by reference node; pages that are copies
    of one another count once."""
    template = constants(reference, counts)
    varying = {n: c[2] for n, c in counts.items()}
    fixed = {n: varying[n] for n in template}
    order, stack = [], [reference]
    while stack:
        order.append(stack.pop())
        stack.extend(order[-1].children)
    for node in reversed(order):
        if node.children:
            fixed[node.number] = sum(fixed.get(c.number, 0) for c in node.children)
    return descend(reference, lambda n: varying.get(n.number, 0) - fixed.get(n.number, 0)).number, template


def descend(root: Node, held: Callable[[Node], int]) -> Node:
    """The innermost container with all of the text ``held`` under the root,
    or the only article with most of it."""
    slot = root
    while slot.tag not in MAIN and not any(c.tag in ("h1", "h2") for c in slot.children):
        inner = max((c for c in slot.children if c.tag in CONTAINERS and not c.skipped), key=held, default=None)
        if inner is None or not held(inner):
            break
        if held(inner) < held(slot) and not (inner.main and held(inner) >= SHARE * held(slot) and not any(
                c.main and c is not inner and held(c) for c in slot.children)):
            break
        slot = inner
    return slot


def constants(reference: Node, counts: dict[int, tuple[int, int, int]]) -> list[int]:
    """Numbers of the text nodes of blocks whose own texts are all constant;
    equal words within a varying block are no template."""
    template, stack = [], [(reference, own := [])]
    blocks = [own]
    while stack:
        node, texts = stack.pop()
        if node.tag == "#" and node.number in counts:
            texts.append(node.number)
        elif node.tag in BLOCK:
            blocks.append(texts := [])
        stack.extend((c, texts) for c in node.children)
    for texts in blocks:
        if all(counts[n][0] >= PAGES and counts[n][1] >= CONSTANT * counts[n][0] for n in texts):
            template += texts
    return sorted(template)


def body_digest(page: Node) -> str:
    """Digest of a page's slot without its headline: equal for copies."""
    slot = alone(page)
    heads, stack = set(), [(slot, False)]
    while stack:
        node, head = stack.pop()
        if node.tag == "#" and head:
            heads.add(id(node))
        stack.extend((c, head or node.tag == "h1") for c in node.children)
    return _digest(text_of(slot, heads))


def alone(page: Node) -> Node:
    """The article's slot of a page without a wrapper."""
    mass: dict[int, int] = {}
    _mass(page, mass)
    return descend(page, lambda n: mass.get(id(n), 0))


def text_of(page: Node, template: set[int]) -> str:
    """Blocks of the subtree in page order, without skipped blocks and
    template nodes (by identity), which leave a blank."""
    parts: list[str] = []

    def walk(node: Node) -> None:
        if node.tag == "#":
            parts.append(" " if id(node) in template else node.text)
            return
        block = node.tag in BLOCK
        if block:
            parts.append(" ")
        for c in node.children:
            if not c.skipped:
                walk(c)
        if block:
            parts.append(" ")
    walk(page)
    return " ".join("".join(parts).split())


def extract(page: Node, reference: Node, slot: int, template: list[int]) -> str:
    """Main text of one page by the wrapper of its layout. A page that has
    varying text outside the wrapper's slot (an article or main element: most
    of it, or another such element) has a slot of its own."""
    own = None
    constant, drop = set(template), set()
    for a, b in aligned(reference, page):
        if a.number == slot:
            own = b
        if a.number in constant and a.text == _digest(b.text):
            drop.add(id(b))
    mass: dict[int, int] = {}
    total = _mass(page, mass, drop)
    held = mass.get(id(own), 0)
    if own is not None and own.tag in MAIN:
        fits = held == total or held >= SHARE * total and not _others(page, own, mass)
    else:
        fits = own is not None and held == total and not page.main
    if not fits:
        own = descend(page, lambda n: mass.get(id(n), 0))
    return text_of(own, drop)


def _others(node: Node, own: Node, mass: dict[int, int]) -> bool:
    """Whether an article or main element outside ``own`` holds text."""
    if node is own or not node.main or not mass.get(id(node)):
        return False
    if node.tag in MAIN and not _inside(node, own):
        return True
    return any(_others(c, own, mass) for c in node.children)


def _inside(node: Node, own: Node) -> bool:
    return node is own or any(_inside(c, own) for c in node.children if c.main)


# --- on Spark -----------------------------------------------------------------

def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"))


def _sequence(html: Column) -> Column:
    """Hash of a page's tags of containers in order, with the beginnings of
    their names up to a digit: the first, rough grouping by layout."""
    frame = rf"(?i)<(/?(?:{'|'.join(sorted(FRAMES))})(?=[\s>/])(?:\s+(?:class|id)\s*=\s*[\"']?[^\"'>\d]*)?)"
    return F.xxhash64(F.regexp_extract_all(html, F.lit(frame), F.lit(1)))


def _reference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = [json.dumps(pack_tree(parse(h)), separators=(",", ":")) for h in b["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["host"], b["sequence"], pa.array(packed, pa.string())],
                                         names=["host", "sequence", "tree"])


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = ["[" + ",".join(layouts([c["tree"] for c in sorted(candidates, key=lambda c: c["place"])])) + "]"
                  for candidates in b["candidates"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["host"], pa.array(packed, pa.string())], names=["host", "trees"])


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of every page by host, layout and digest of its body, one of the
    pages of a batch that are copies of one another."""
    for b in batches:
        found: dict[tuple[str, int, str], bytes] = {}
        for host, html, trees in zip(b["host"].to_pylist(), b["html"].to_pylist(), b["trees"].to_pylist()):
            page, references = parse(html), unpack_layouts(trees)
            layout = nearest(references, page)
            key = host, layout, body_digest(page)
            if key not in found:
                found[key] = np.array(votes(references[layout][0], page), np.int32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in found], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))]
            + [pa.array(found.values(), pa.binary())], names=["host", "layout", "copy", "votes"])


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of votes by host, layout and reference node."""
    for b in batches:
        sums: dict[tuple[str, int, int], list[int]] = {}
        for host, layout, packed in zip(b["host"].to_pylist(), b["layout"].to_pylist(), b["votes"].to_pylist()):
            for node, same, chars in np.frombuffer(packed, np.int32).reshape(-1, 3).tolist():
                s = sums.setdefault((host, layout, node), [0, 0, 0])
                s[0] += 1
                s[1] += same
                s[2] += chars
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.string()), *(pa.array([k[i] for k in sums], pa.int32()) for i in (1, 2)),
             *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(3))],
            names=["host", "layout", "node", "pages", "same", "chars"])


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for trees, listed in zip(b["trees"].to_pylist(), b["counts"].to_pylist()):
            references = unpack_layouts(trees)
            counts: list[dict] = [{} for _ in references]
            for c in listed:
                counts[c["layout"]][c["node"]] = c["pages"], c["same"], c["chars"]
            found.append([induce(r, c) for (r, _), c in zip(references, counts)])
        yield pa.RecordBatch.from_arrays(
            [b["host"], b["trees"], pa.array([[i[0] for i in f] for f in found], pa.list_(pa.int32())),
             pa.array([[i[1] for i in f] for f in found], pa.list_(pa.list_(pa.int32())))],
            names=["host", "trees", "slots", "templates"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for html, trees, slots, templates in zip(b["html"].to_pylist(), b["trees"].to_pylist(),
                                                 b["slots"].to_pylist(), b["templates"].to_pylist()):
            page, references = parse(html), unpack_layouts(trees)
            i = nearest(references, page)
            texts.append(extract(page, references[i][0], slots[i], templates[i]))
        yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, rows, trees, slots, templates), one written row per host: small
    skeletons of at most LAYOUTS reference pages, whatever the host's number
    of pages. A host with more than a small share of all pages meets its pages
    by broadcast (``join_owners``), so its pages are not gathered."""
    scratch = Scratch(pages.sparkSession)
    rows = _rows(pages)
    # of each sequence of tags the page of the smallest id; a null id is the largest
    keyed = (rows.withColumn("key", F.coalesce("page_id", F.lit(2**63 - 1)))
             .withColumn("sequence", _sequence(F.col("html"))))
    groups = scratch.save(keyed.groupBy("host", "sequence").agg(F.min("key").alias("key"), F.count("*").alias("rows")),
                          "sequences")
    hosts = scratch.save(groups.groupBy("host").agg(F.sum("rows").alias("rows")), "hosts")
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("rows"), "key", "sequence"))
    first = groups.withColumn("place", place).filter(F.col("place") <= CANDIDATES).drop("rows")
    chosen = keyed.join(first.drop("place"), ["host", "sequence", "key"]).select("host", "sequence", "html")
    packed = (map_arrow(chosen, _reference, "host string, sequence long, tree string")
              .groupBy("host", "sequence").agg(F.min("tree").alias("tree"))
              .join(first.drop("key"), ["host", "sequence"])
              .groupBy("host").agg(F.collect_list(F.struct("place", "tree")).alias("candidates")))
    references = scratch.save(map_arrow(packed, _layouts, "host string, trees string").join(hosts, "host"),
                              "references")
    met = join_owners(rows.select("host", "html"), references, "host", "rows").select("host", "html", "trees")
    cast = (map_arrow(met, _vote, "host string, layout int, copy string, votes binary")
            .groupBy("host", "layout", "copy").agg(F.min("votes").alias("votes")))
    counted = (map_arrow(cast, _tally, "host string, layout int, node int, pages long, same long, chars long")
               .groupBy("host", "layout", "node").agg(*(F.sum(c).alias(c) for c in ("pages", "same", "chars"))))
    listed = counted.groupBy("host").agg(
        F.collect_list(F.struct("layout", "node", "pages", "same", "chars")).alias("counts"))
    found = map_arrow(references.join(listed, "host").select("host", "trees", "counts"), _induce,
                      "host string, trees string, slots array<int>, templates array<array<int>>")
    out = scratch.save(found.join(hosts, "host"), "wrappers")
    scratch.drop(references, hosts, groups)
    return out


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Null html counts as empty and gives an empty text; pages without a host
    share the empty host; repeated rows repeat; null ids and urls stay null;
    an empty table gives an empty result; extra columns are ignored. Html is
    read whole, whatever its length."""
    found = wrappers(pages)
    joined = (join_owners(_rows(pages), found, "host", "rows")
              .select("page_id", "url", "html", "trees", "slots", "templates"))
    return (map_arrow(joined, _extract, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
