"""Main text of pages by wrapper induction over the pages of a host.

A page becomes a small tree (`Outline`): block elements with a signature (tag, id, classes), runs of equal siblings
folded into one node, as a list of paragraphs or links is one slot of any length; what HTML itself
marks as no content (navigation, headers, footers, asides, forms, scripts, styles) and what an id or class names as menu, advert,
notice, share bar or comments has no place in it. One page of each host, the one whose content hashes lowest, is the
reference. Every different page of the host is aligned with it by simple tree matching: the largest set of node pairs with
equal signatures that keeps order and ancestry. A node takes the key of the node it is aligned with; a node
without a partner is keyed by its path, so pages of another layout meet under keys of their own. Spark counts, under
each key over all pages of the host, the texts, their characters and those of links. From these a host has its wrapper:

* the content key: the deepest element of the kinds that hold others, not template itself, that has at least `CONTENT` of what the host's pages say outside of links;
* template: a key on three or more pages whose commonest text stands on at least `CONSTANT` of the pages that have the key;
* menus: keys on three or more pages with at least `LINKED` of their text in links.

Every page is then aligned in the same way. Its text is that of the node under the content key (of the article around it or in it, where
there is one), without template and menu nodes. A page on which that node holds little, or that has none, falls back on its article or main
element, or on the subtree with most text. Where template and menus are nearly all of the content (`MOST`), as where pages repeat an
article, they stay. Where names of classes leave nothing, they are disregarded. `lists=False` does without all lists of tags and names, to
see what the wrapper does alone.

An article that its names call a comment, a teaser or the like is left out where it stands in an article or beside others. Words for headers
do not count inside an article or main element, whose heading they name.

Blocks are block-level elements; white space in one (and a line break) becomes one space; blocks are joined by two
newlines in page order. Null, empty and tag-less html give the text they have; unclosed and
stray tags are closed as browsers do for paragraphs, list items and table cells. A quote that is never closed does not hide what
follows it. All walks are loops, so depth is bounded by memory alone, and the scanner is linear in the length of a page.
Pages with no host share the wrapper of the empty host. Equal pages of a host count once. Repeated rows are rows of their
own, columns of other names (text, host and the like) are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch, release, scratch_table, size_sliced, text_or_empty

#: Share of the pages with a node that hold its commonest text, from which on the node is template.
CONSTANT = 0.9
#: A template node stands on at least three pages and this share of its host's pages, which bounds a wrapper's size.
SUPPORT = 0.005
LEAST = 3
#: Share of a host's text outside of links that its content node holds; share that it must hold of a page; share of links in a menu's text.
CONTENT, OWN, LINKED = 0.6, 0.3, 0.6
#: Template and menus are content where they hold more than this share of a page's content.
MOST = 0.8
#: Candidate pairs of nodes of one alignment; child lists met beyond it are aligned first come first served.
PAIRS = 200_000
_LOOK_AHEAD = 64
#: Wrappers are broadcast up to this many bytes in all; beyond it they are joined by host.
BROADCAST_BYTES = 32 << 20
_COUNTED = 200_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes object canvas select".split())
NO_CONTENT = frozenset("nav header footer aside form button dialog menu label fieldset".split()) | RAW | {"head"}
BLOCK = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
BOX = frozenset("article body center details div html main section td".split())
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|respond|replies|discussion|disqus|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login"
    r"|menu|nav\w*|toolbar|header|footer|masthead|sidebar|side|widget|related|recommend\w*|share|sharing|social|promo|sponsor\w*|tags|pagination|pager|skip|hidden|copyright|legal|search)(?:$|[\s_-])",
    re.I,
)
_HEADING = re.compile("header|masthead", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile("[>\"']")
_ATTR = re.compile(r"""(?<![\w-])(id|class|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_DIGITS = re.compile(r"\d+")
_LONG_REFERENCE = re.compile(r"&#(?:\d{9,}|[xX][0-9a-fA-F]{8,});?")
#: Open elements that an element of the same table or list ends.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}


def unescape(text: str) -> str:
    if "&" not in text:
        return text
    return entities.unescape(_LONG_REFERENCE.sub("\ufffd", text) if "&#" in text else text)


class Node:
    __slots__ = ("tag", "sig", "skip", "side", "items")

    def __init__(self, tag: str, sig: str = "", skip: bool = False, side: bool = False):
        self.tag, self.sig, self.skip, self.side, self.items = tag, sig or tag, skip, side, []


def _node(tag: str, attrs: str, inner: bool = False, tags: bool = True, words: bool = True) -> Node:
    """`inner`: in an article or main element. `tags`, `words`: if lists of tags, and of words in names, are heeded."""
    skip = tag in NO_CONTENT and (tags or tag in RAW or tag == "head") and not (inner and tag == "header")
    if not attrs or attrs.isspace():
        return Node(tag, tag, skip)
    names, side = [], False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
        if key in ("id", "class"):
            names.append(value)
            if words and tag not in ("html", "body", "main"):
                side |= bool(NOT_MAIN.search(_HEADING.sub("", value) if inner else value))
        elif key == "role":
            skip |= tags and value.lower() in _ROLES
        elif key == "hidden":
            skip = True
        elif key == "aria-hidden":
            skip |= value.lower() == "true"
        elif key == "style":
            skip |= "display:none" in value.replace(" ", "").lower()
    # digits in names number single nodes, not kinds of nodes; an article of its own is judged beside the others of its page
    return Node(tag, tag + "." + _DIGITS.sub("0", " ".join(names)) if names else tag, skip or side and (tag != "article" or inner), side)


class _Scanner:
    """Tokens of html in one pass: text, or (closing?, tag, attributes)."""

    def __init__(self, html: str):
        self.html, self.at, self.quotes, self.cdata = html, 0, True, True
        self.unended: set[str] = set()

    def _tag_end(self, at: int) -> int:
        """Position of the > that ends a tag; quoted values may hold others."""
        html, pos = self.html, at
        while self.quotes:
            q = _QUOTE_OR_END.search(html, pos)
            if q and q[0] == ">":
                return q.start()
            if q and not html[max(at, q.start() - 20) : q.start()].rstrip().endswith("="):
                pos = q.end()
                continue
            pos = html.find(q[0], q.end()) + 1 if q else 0
            if not pos:
                self.quotes = False
        return html.find(">", at)

    def skip_raw(self, tag: str) -> None:
        """Leave the content of an element that holds no markup; one of these that never ends takes the rest."""
        end = None if tag in self.unended else _RAW_END[tag].search(self.html, self.at)
        if end:
            self.at = end.end()
        else:
            self.unended.add(tag)
            if tag in ("script", "style", "title", "textarea"):
                self.at = len(self.html)

    def __iter__(self):
        html = self.html
        while (lt := html.find("<", self.at)) >= 0:
            if lt > self.at:
                yield html[self.at : lt]
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                self.at = end + 3 if end >= 0 else len(html)
                continue
            if self.cdata and html.startswith("<![CDATA[", lt):
                end = html.find("]]>", lt)
                if end >= 0:
                    yield html[lt + 9 : end].replace("&", "&amp;")
                    self.at = end + 3
                    continue
                self.cdata = False
            m = _OPEN.match(html, lt)
            if m is None and html[lt + 1 : lt + 2] not in ("!", "?"):
                yield "<"
                self.at = lt + 1
                continue
            end = self._tag_end(m.end()) if m else html.find(">", lt)
            if end < 0:
                yield html[lt:]
                return
            self.at = end + 1
            if m:
                yield bool(m[1]), m[2].lower(), html[m.end() : end]
        if self.at < len(html):
            yield html[self.at :]


def parse(html: str, tags: bool = True, words: bool = True) -> Node:
    root = Node("#root")
    stack, where, blocks = [root], {}, []  # open elements; their places by tag; places of the block elements

    def close(i: int) -> None:
        for k in range(len(stack) - 1, i - 1, -1):
            where[stack[k].tag].pop()
            if blocks and blocks[-1] == k:
                blocks.pop()
        del stack[i:]

    scanner = _Scanner(html)
    for token in scanner:
        if isinstance(token, str):
            stack[-1].items.append(token)
            continue
        closing, tag, attrs = token
        if closing:
            # a stray inline end does not leave its block
            if where.get(tag) and (tag in BLOCK or not blocks or where[tag][-1] > blocks[-1]):
                close(where[tag][-1])
            continue
        if tag in BLOCK:
            while blocks and (stack[blocks[-1]].tag == "p" or stack[blocks[-1]].tag in _ENDS.get(tag, ())):
                close(blocks[-1])
        if tag == "br":
            stack[-1].items.append(" ")
            continue
        node = _node(tag, attrs, bool(where.get("article") or where.get("main")), tags, words)
        if tag in VOID:
            if tag == "hr":
                stack[-1].items.append(node)
            continue
        stack[-1].items.append(node)
        if attrs.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            scanner.skip_raw(tag)
        else:
            where.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                blocks.append(len(stack))
            stack.append(node)
    return root


# ---------------------------------------------------------------- trees for alignment

_FLAT = np.dtype([("parent", "<i4"), ("sig", "<u8"), ("text", "<u8"), ("chars", "<u4"), ("linked", "<u4"), ("box", "?")])
_MASK = (1 << 64) - 1


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _in_order(root: Node) -> list[Node]:
    """The nodes that are not left out, parents before children."""
    out = [root]
    for x in out:
        out.extend(y for y in x.items if not isinstance(y, str) and not y.skip)
    return out


def _texts(root: Node) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """Hash of the text under each node, 0 where there is none; its characters, and those in links."""
    found: dict[int, int] = {}
    sizes: dict[int, tuple[int, int]] = {}
    for x in reversed(_in_order(root)):
        parts: list[bytes] = []
        chars = linked = 0
        for y in x.items:
            if isinstance(y, str):
                if words := y.split():
                    text = " ".join(words)
                    parts.append(text.encode("utf-8", "surrogatepass"))
                    chars += len(text)
            elif not y.skip and found[id(y)]:
                parts.append(found[id(y)].to_bytes(8, "little"))
                chars, linked = chars + sizes[id(y)][0], linked + sizes[id(y)][1]
        found[id(x)] = xxhash.xxh64_intdigest(b"\0".join(parts)) or 1 if parts else 0
        sizes[id(x)] = chars, chars if x.tag == "a" else linked
    return found, sizes


class Outline:
    """Flat tree, parents first: signature hash, text hash, characters, those in links and children of each node; of a page also the elements that a node folds."""

    __slots__ = ("sigs", "texts", "parents", "kids", "groups", "chars", "linked", "boxes")

    def __init__(self, sigs: list[int], texts: list[int], parents: list[int], groups: list[list[Node]], chars: list[int] | None = None, linked: list[int] | None = None, boxes: list[bool] | None = None):
        self.sigs, self.texts, self.parents, self.groups = sigs, texts, parents, groups
        self.chars, self.linked = chars or [0] * len(sigs), linked or [0] * len(sigs)
        self.boxes = boxes or [True] * len(sigs)
        self.kids: list[list[int]] = [[] for _ in sigs]
        for x, p in enumerate(parents):
            if p >= 0:
                self.kids[p].append(x)

    @classmethod
    def of(cls, root: Node) -> Outline:
        """Down to elements that hold no block."""
        hashes, sizes = _texts(root)
        groups, parents, texts, known = [[root]], [-1], [], {}
        for at, group in enumerate(groups):
            run: list[Node] = []
            for node in group:
                for x in node.items:
                    if not isinstance(x, str) and x.tag in BLOCK and not x.skip:
                        if run and run[0].sig == x.sig:
                            run.append(x)
                        else:
                            run = [x]
                            groups.append(run)
                            parents.append(at)
        for group in groups:
            own = [hashes[id(x)] for x in group if hashes[id(x)]]
            texts.append(own[0] if len(own) == 1 else xxhash.xxh64_intdigest(np.array(own, "<u8").tobytes()) if own else 0)
            if group[0].sig not in known:
                known[group[0].sig] = _hash(group[0].sig)
        chars, linked = ([min(sum(sizes[id(x)][k] for x in g), 0xFFFFFFFF) for g in groups] for k in (0, 1))
        return cls([known[g[0].sig] for g in groups], texts, parents, groups, chars, linked, [g[0].tag in BOX for g in groups])

    def to_bytes(self) -> bytes:
        flat = np.empty(len(self.sigs), _FLAT)
        flat["parent"], flat["sig"], flat["text"], flat["chars"], flat["linked"], flat["box"] = self.parents, self.sigs, self.texts, self.chars, self.linked, self.boxes
        return flat.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Outline:
        flat = np.frombuffer(raw, _FLAT)
        return cls(flat["sig"].tolist(), flat["text"].tolist(), flat["parent"].tolist(), [], flat["chars"].tolist(), flat["linked"].tolist(), flat["box"].tolist())

    def depths(self) -> list[int]:
        """Distance from the root of elements that hold others, 0 of paragraphs, lists and the like."""
        found: list[int] = []
        for p in self.parents:
            found.append(found[p] + 1 if p >= 0 else 0)
        return [d if box else 0 for d, box in zip(found, self.boxes)]


def _best_chain(n: int, m: int, weights: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """Largest total weight of cells that rise in both places, and those cells."""
    best = [[0] * (m + 1)]
    for i in range(n):
        before, row = best[-1], [0] * (m + 1)
        for j in range(m):
            row[j + 1] = max(before[j + 1], row[j], before[j] + weights.get((i, j), 0))
        best.append(row)
    cells, i, j = [], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            cells.append((i, j))
    return best[n][m], cells[::-1]


def _first_come(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Cells of equal signatures that rise in both places, each with the nearest partner."""
    cells, at = [], 0
    for i, sig in enumerate(a):
        for j in range(at, min(len(b), at + _LOOK_AHEAD)):
            if b[j] == sig:
                cells.append((i, j))
                at = j + 1
                break
    return cells


def align(a: Outline, b: Outline, limit: int = PAIRS) -> dict[int, int]:
    """Simple tree matching of two outlines from their roots: node of a to node of b."""
    if a.sigs[0] != b.sigs[0]:
        return {}
    pairs, cells = [(0, 0)], []  # candidate pairs, parents first; of each, its child cells and their pairs
    for x, y in pairs:
        left, right = [a.sigs[k] for k in a.kids[x]], [b.sigs[k] for k in b.kids[y]]
        if left == right and len(set(left)) == len(left):
            found = [(i, i) for i in range(len(left))]
        elif len(pairs) + len(left) * len(right) > limit:
            found = _first_come(left, right)
        else:
            found = [(i, j) for i, s in enumerate(left) for j, t in enumerate(right) if s == t]
        cells.append({cell: len(pairs) + k for k, cell in enumerate(found)})
        pairs += [(a.kids[x][i], b.kids[y][j]) for i, j in found]

    weights = [1] * len(pairs)
    chosen: list[list[tuple[int, int]]] = [[] for _ in pairs]
    for p in range(len(pairs) - 1, -1, -1):
        inner = cells[p]
        rising = all(u[0] < v[0] and u[1] < v[1] for u, v in zip(list(inner), list(inner)[1:]))
        if rising:
            total, chosen[p] = sum(weights[q] for q in inner.values()), list(inner)
        elif inner:
            x, y = pairs[p]
            total, chosen[p] = _best_chain(len(a.kids[x]), len(b.kids[y]), {c: weights[q] for c, q in inner.items()})
        else:
            total = 0
        weights[p] += total
    matched, todo = {}, [0]
    for p in todo:
        matched[pairs[p][0]] = pairs[p][1]
        todo += [cells[p][c] for c in chosen[p]]
    return matched


def _step(key: int, sig: int, kind: int) -> int:
    mixed = ((key ^ sig) * 0x9E3779B97F4A7C15 + kind) & _MASK
    return (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 & _MASK


def _keys_of(outline: Outline, given: dict[int, int]) -> list[int]:
    """Key of each node: the given one, else its parent's key, signature and number among such siblings."""
    keys: list[int] = []
    seen: Counter = Counter()
    for x, (p, sig) in enumerate(zip(outline.parents, outline.sigs)):
        if x in given:
            keys.append(given[x])
            continue
        kind = 2 * seen[p, sig] + bool(given)
        seen[p, sig] += 1
        keys.append(_step(keys[p] if p >= 0 else 0, sig, kind))
    return keys


def reference_keys(reference: Outline) -> list[int]:
    return _keys_of(reference, {})


def node_keys(page: Outline, reference: Outline, keys: list[int]) -> list[int]:
    return _keys_of(page, {x: keys[y] for x, y in align(page, reference).items()})


class Wrapper:
    """A reference page, the (key, text) pairs that are template, the keys of menus, and the key of the content (0: none)."""

    __slots__ = ("reference", "keys", "template", "menus", "content")

    def __init__(self, reference: Outline, template: set[tuple[int, int]], menus: set[int] = frozenset(), content: int = 0):
        self.reference, self.keys, self.template, self.menus, self.content = reference, reference_keys(reference), template, menus, content


def induce(pages: list[str], lists: bool = True) -> Wrapper:
    """The wrapper of a few pages of one host, without Spark."""
    outlines = {o.texts[0]: o for o in sorted((Outline.of(parse(p, lists, lists)) for p in pages), key=Outline.to_bytes, reverse=True)}
    reference = outlines[min(outlines)]
    keys = reference_keys(reference)
    texts: Counter = Counter()
    nodes: dict[int, list[int]] = {}
    for o in outlines.values():
        for k, t, chars, linked, depth in list(zip(node_keys(o, reference, keys), o.texts, o.chars, o.linked, o.depths()))[1:]:
            if t:
                texts[k, t] += 1
                own = nodes.setdefault(k, [0, 0, 0, depth])
                own[0], own[1], own[2] = own[0] + 1, own[1] + chars, own[2] + linked
    most: dict[int, tuple[int, int]] = {}
    for (k, t), n in texts.items():
        most[k] = max(most.get(k, (0, 0)), (n, t))
    told = sum(o.chars[0] - o.linked[0] for o in outlines.values())
    often = {k for k, own in nodes.items() if own[0] >= LEAST and own[0] >= SUPPORT * len(outlines)}
    template = {(k, most[k][1]) for k in often if most[k][0] >= CONSTANT * nodes[k][0]}
    menus = {k for k in often if nodes[k][2] >= LINKED * nodes[k][1]}
    fixed = {k for k, _ in template}
    content = max(((depth, k) for k, (_, chars, linked, depth) in nodes.items() if depth and k not in fixed and chars - linked >= CONTENT * told > 0), default=(0, 0))[1]
    return Wrapper(reference, template, menus, content)


# ---------------------------------------------------------------- extraction


def _marked(root: Node, wrapper: Wrapper) -> tuple[set[int], list[Node]]:
    """Ids of the elements that are template or menu, and the elements of the content, if they hold enough of the page."""
    page, found, content = Outline.of(root), set(), []
    for x, (key, text) in enumerate(zip(node_keys(page, wrapper.reference, wrapper.keys), page.texts)):
        if x and ((key, text) in wrapper.template or key in wrapper.menus):
            found.update(map(id, page.groups[x]))
        if x and key == wrapper.content and page.chars[x] - page.linked[x] >= OWN * (page.chars[0] - page.linked[0]):
            content = page.groups[x]
    return found, content


def _find_roots(root: Node, tag: str) -> list[Node]:
    out: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        if x.tag == tag:
            out.append(x)
        else:
            todo.extend(y for y in reversed(x.items) if not isinstance(y, str) and not y.skip)
    return out


def _densest(root: Node, template: set[int]) -> Node:
    """Down from the root while one block child holds nearly all slot text."""
    size: dict[int, int] = {}
    for x in reversed(_in_order(root)):
        size[id(x)] = 0 if id(x) in template else sum(len(y) if isinstance(y, str) else 0 if y.skip else size[id(y)] for y in x.items)
    at = root
    while True:
        heirs = (y for y in at.items if not isinstance(y, str) and not y.skip and y.tag in BLOCK and y.tag not in ("p", "h1") and size[id(y)] >= 0.9 * size[id(at)] > 0)
        if (heir := next(heirs, None)) is None:
            return at
        at = heir


def _blocks(root: Node, template: set[int], out: list[str]) -> None:
    line: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    stack = [(root, iter(root.items))]
    while stack:
        x, rest = stack[-1]
        for y in rest:
            if isinstance(y, str):
                line.append(y)
                continue
            if y.tag in BLOCK:
                flush()
            if not y.skip and id(y) not in template:
                stack.append((y, iter(y.items)))
                break
        else:
            stack.pop()
            if x.tag in BLOCK:
                flush()
    flush()


def _length(roots: list[Node]) -> int:
    found: list[str] = []
    for r in roots:
        _blocks(r, set(), found)
    return sum(map(len, found))


def _articles(root: Node) -> list[Node]:
    """Articles, or main elements; those that their names call something else only where there are no others."""
    for tag in ("article", "main"):
        found = _find_roots(root, tag)
        if found:
            return [x for x in found if not x.side] or found
    return []


def _content(root: Node, content: list[Node], template: set[int]) -> list[Node]:
    articles = _articles(root)
    if not content:
        return articles or [_densest(root, template)]
    inner = {id(x) for c in content for x in _in_order(c)}
    around = [r for r in articles if any(id(x) in set(map(id, content)) for x in _in_order(r))]
    related = around or [r for r in articles if id(r) in inner]
    if related or not articles:
        return related or content
    return articles if _length(articles) >= OWN * _length([root]) else content


def extract(html: str | None, wrapper: Wrapper | None = None, lists: bool = True) -> str:
    root = parse(html or "", lists, lists)
    template, content = _marked(root, wrapper) if wrapper else (set(), [])
    roots = _content(root, content, template)
    whole: list[str] = []
    for r in roots:
        _blocks(r, set(), whole)
    out: list[str] = []
    if template:
        for r in roots:
            _blocks(r, template, out)
    if sum(map(len, out)) < (1 - MOST) * sum(map(len, whole)) or not template:
        out = whole
    if not out and lists:  # names of classes alone do not empty a page
        root = parse(html or "", True, False)
        for r in _articles(root) or [_densest(root, set())]:
            _blocks(r, set(), out)
    return "\n\n".join(out)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
_DDL = "page_id long, url string, text string, n_chars long"
_TREES = pa.schema([("host", pa.string()), ("root", pa.int64()), ("tree", pa.binary())])
_KEYS = pa.schema([("host", pa.string()), ("node", pa.int64()), ("text", pa.int64()), *((c, pa.int64()) for c in ("n", "chars", "linked", "depth"))])
_KEYS_DDL = "host string, node long, text long, n long, chars long, linked long, depth long"


def _outlines(batches):
    for batch in batches:
        hosts, pages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in size_sliced(pages, 1 << 22):
            found = [Outline.of(parse(p)) for p in pages[a:b]]
            roots = np.array([o.texts[0] for o in found], "u8").view("i8")
            yield record_batch(_TREES, {"host": hosts[a:b], "root": roots, "tree": [o.to_bytes() for o in found]})


class _Known:
    """What was made of the last few thousand hosts."""

    def __init__(self, make, limit: int = 4000):
        self.make, self.limit, self.known = make, limit, {}

    def __call__(self, host: str, *raw: bytes | None):
        if host not in self.known:
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[host] = self.make(*raw) if raw[0] is not None else None
        return self.known[host]


def _count_nodes(references: dict | None):
    """(host, node, text) of each tree against its host's reference, counted inside the task with its characters. Node 0 counts pages."""

    def made(raw: bytes):
        reference = Outline.from_bytes(raw)
        return reference, reference_keys(reference)

    def run(batches):
        known, counts = _Known(made), {}

        def emit():
            hosts, nodes, texts = zip(*counts)
            n, chars, linked, depth = zip(*counts.values())
            columns = {"host": hosts, "node": np.array(nodes, "u8").view("i8"), "text": np.array(texts, "u8").view("i8"), "n": n, "chars": chars, "linked": linked, "depth": depth}
            counts.clear()
            return record_batch(_KEYS, columns)

        def add(key: tuple, chars: int, linked: int, depth: int) -> None:
            own = counts.setdefault(key, [0, 0, 0, depth])
            own[0], own[1], own[2] = own[0] + 1, own[1] + chars, own[2] + linked

        for batch in batches:
            hosts, trees = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            given = batch.column(2).to_pylist() if references is None else [references.value[h] for h in hosts]
            for host, tree, raw in zip(hosts, trees, given, strict=True):
                page, (reference, keys) = Outline.from_bytes(tree), known(host, raw)
                add((host, 0, 0), page.chars[0], page.linked[0], 0)
                for x, (k, t, depth) in enumerate(zip(node_keys(page, reference, keys), page.texts, page.depths())):
                    if x and t:
                        add((host, k or 1, t), page.chars[x], page.linked[x], depth)
                if len(counts) >= _COUNTED:
                    yield emit()
        if counts:
            yield emit()

    return run


def host_of(url="url"):
    """Lower-case host of a URL, without user, port and a leading www."""
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)


def _bytes_of(df: DataFrame, *columns: str) -> int:
    return df.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in columns), F.lit(100)))).first()[0] or 0


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """host, reference, template, menus, content: from all different pages of each host. Only outlines and counts are shuffled."""
    spark = pages.sparkSession
    rows = pages.select(host_of().alias("host"), text_or_empty("html").alias("html"))
    trees = rows.mapInArrow(_outlines, "host string, root long, tree binary").groupBy("host", "root").agg(F.min("tree").alias("tree"))
    trees = scratch_table(trees, "outlines")
    # the lowest root as an unsigned number
    rank = F.col("root").bitwiseXOR(F.lit(-(1 << 63)))
    references = scratch_table(trees.groupBy("host").agg(F.min(F.struct(rank.alias("rank"), "tree")).alias("least")).select("host", F.col("least.tree").alias("reference")), "references")
    if _bytes_of(references, "reference") <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast({r["host"]: bytes(r["reference"]) for r in references.toLocalIterator()})
        counted = trees.select("host", "tree").mapInArrow(_count_nodes(shared), _KEYS_DDL)
    else:
        counted = trees.join(references, "host").select("host", "tree", "reference").mapInArrow(_count_nodes(None), _KEYS_DDL)
    sums = [F.sum(c).alias(c) for c in ("n", "chars", "linked")]
    counts = scratch_table(counted.groupBy("host", "node", "text").agg(*sums, F.min("depth").alias("depth")), "node-texts")
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)))  # noqa: E731  the order of unsigned numbers
    nodes = counts.filter("node <> 0").groupBy("host", "node").agg(F.sum("n").alias("seen"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.min("depth").alias("depth"), F.max(F.struct("n", unsigned("text").alias("rank"))).alias("most"))
    totals = counts.filter("node = 0").select("host", F.col("n").alias("pages"), (F.col("chars") - F.col("linked")).alias("told"))
    nodes = nodes.join(totals, "host")
    often = (F.col("seen") >= LEAST) & (F.col("seen") >= F.lit(SUPPORT) * F.col("pages"))
    constant = often & (F.col("most.n") >= F.lit(CONSTANT) * F.col("seen"))
    menu = often & (F.col("linked") >= F.lit(LINKED) * F.col("chars"))
    holds = ~constant & (F.col("depth") > 0) & (F.col("told") > 0) & (F.col("chars") - F.col("linked") >= F.lit(CONTENT) * F.col("told"))
    pair = F.struct("node", unsigned("most.rank").alias("text"))
    kinds = nodes.filter(constant | menu | holds).groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(constant, pair))).alias("template"), F.sort_array(F.collect_list(F.when(menu, F.col("node")))).alias("menus"),
        F.max(F.when(holds, F.struct("depth", unsigned("node").alias("rank")))).alias("content"),
    )
    kinds = kinds.select("host", "template", "menus", unsigned("content.rank").alias("content"))
    wrappers = scratch_table(references.join(kinds, "host", "left"), "wrappers")
    release(trees, references, counts)
    return wrappers


def _apply(wrappers: dict | None):
    def made(reference: bytes, template: list | None, menus: list | None, content: int | None):
        pairs = {(p["node"] & _MASK, p["text"] & _MASK) for p in template or ()}
        return Wrapper(Outline.from_bytes(reference), pairs, {k & _MASK for k in menus or ()}, (content or 0) & _MASK)

    def run(batches):
        known = _Known(made)
        for batch in batches:
            page_ids, urls, pages, hosts = (batch.column(i).to_pylist() for i in range(4))
            given = list(zip(*(batch.column(i).to_pylist() for i in range(4, 8)))) if wrappers is None else [wrappers.value[h] for h in hosts]
            for a, b in size_sliced(pages, 1 << 22):
                texts = [extract(page, known(host, *raw)) for page, host, raw in zip(pages[a:b], hosts[a:b], given[a:b], strict=True)]
                yield record_batch(_OUT, {"page_id": page_ids[a:b], "url": urls[a:b], "text": texts, "n_chars": [len(t) for t in texts]})

    return run


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    bounded_batches(spark)
    wrappers = induce_wrappers(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"), host_of().alias("host"))
    size = wrappers.agg(F.sum(F.length("reference") + 24 * F.greatest(F.size("template"), F.lit(0)) + 8 * F.greatest(F.size("menus"), F.lit(0)) + 100)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast({r["host"]: (bytes(r["reference"]), [{"node": p[0], "text": p[1]} for p in r["template"] or ()], r["menus"], r["content"]) for r in wrappers.toLocalIterator()})
        return rows.mapInArrow(_apply(shared), _DDL)
    return rows.join(wrappers, "host").select("page_id", "url", "html", "host", "reference", "template", "menus", "content").mapInArrow(_apply(None), _DDL)
