"""Main text of web pages by wrapper induction over the pages of a host.

1. Each page is parsed once: its tree of block elements, with runs of like paragraphs,
   items or cells taken as one node, gives a short skeleton; its texts become blocks that
   know their node.
2. The commonest skeleton of a host is its wrapper. Every other skeleton of the host is
   aligned with it once by simple tree matching (Yang 1991), which maps nodes to the
   wrapper's slots. Nodes that the wrapper lacks, as those of another layout, get slots
   of their own by their path below the nearest node that it has.
3. Slots are compared over all distinct contents of a host: pages with the same main
   text are copies, whatever stands around them, and count once.
   - A text that stands in the same slot on most pages is template.
   - The content region is the deepest container that holds nearly all varying text that
     is no link. Slots outside it that most pages have are the page's furniture: menus,
     adverts, footers, whatever their tags and names. A region with less than half of the
     text is none; and slots whose texts stand on one page each are no furniture inside
     article or main, or beside the region in a container that is less than the page.
   - Versions of one article look like template. So no template takes more than half of
     a page's region or article, nor of a slot whose other texts vary.
4. What the comparison leaves open (hosts of few pages, slots that few pages have, parts
   inside the region such as reader comments) is decided by element names, roles, and
   class names, and by article elements.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, join_lookup, materialise

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|iframe|object|select|canvas|video|audio)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object|select|annotation-xml|annotation|xmp|noframes|canvas|video|audio)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# The block elements and void elements of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that an opening tag ends when they are open.
ENDS_P = BLOCKS - frozenset("html head body option td th tr tbody thead tfoot caption".split())
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FENCES = frozenset("ul ol dl table menu body".split())
DROPPED_TAGS = frozenset("nav header footer aside form menu dialog button head search fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_NAMES = frozenset(
    "nav navbar navigation navigations menu menus breadcrumb breadcrumbs header masthead topbar banner banners footer foot bottombar sidebar sidebars aside rail widget widgets"
    " ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos promotion cookie cookies consent gdpr notice notices alert alerts popup popups modal overlay"
    " newsletter subscribe subscription signup signin login register paywall share sharing social comment comments respond reply replies disqus discussion"
    " related recommended recommendations trending pagination pager search form forms copyright disclaimer legal toolbar skip".split()
)
# Longer words that begin so mean the same; words before which a name says that the part is elsewhere.
BEGINNINGS = ("comment", "advert", "sidebar", "breadcrumb", "cookie", "newsletter", "footer", "sponsor", "navigation", "subscri")
NEGATIONS = frozenset("with has no without".split())
LASTING = frozenset("comment comments respond reply replies disqus discussion aside sidebar related recommended".split())
# Words beside which a name still says what the part is (site-footer, ad-box-2); other words give it another sense (share-price).
NEUTRAL = frozenset(
    "site page main box wrapper wrap container list lists link links item items block blocks section sections area bar top bottom left right inner outer slot unit units group panel row col cols column columns"
    " primary secondary global local mobile desktop full width wide small large big post posts article articles entry entries story stories user users reader readers view module component zone region floating"
    " sticky fixed horizontal vertical first last button buttons icon icons text".split()
)
# Paragraphs of an article's own header whose class says so are text; its other parts, as the author's name, are not.
STANDFIRST = frozenset("standfirst lede dek deck subtitle subheading subheadline summary intro introduction abstract".split())
# A header of these is the article's own; its title is text.
OWN = frozenset("article post entry story content text".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD_OF = re.compile(r"[a-z]+")
# Short blocks that name what follows them.
LABELS = HEADINGS | {"dt", "th", "caption", "legend", "summary"}
# Siblings of these tags are one node; of others, the first APART of a run are nodes of their own.
RUNS = frozenset("p li tr td th dt dd option pre blockquote".split())
APART = 8
#: Flags of a block: in a part that its name leaves out; in an article or main element; a menu entry by its links.
MARKED, INSIDE, ENTRY = 1, 2, 4


class Element:
    """An open element: its tag, skeleton node, why its name leaves it out (or ''), and whether it lies in an article."""

    __slots__ = ("tag", "node", "mark", "root")

    def __init__(self, tag: str, node: list, mark: str, root: bool):
        self.tag, self.node, self.mark, self.root = tag, node, mark, root


def part_of(word: str) -> str:
    """The name of a part that a word of a class or id stands for, or ''."""
    if word in DROPPED_NAMES:
        return word
    return next((b for b in BEGINNINGS if word.startswith(b)), "")


def mark_of(words: list[str]) -> str:
    """The part that a class or an id names, or ''. Every other word of it must be a neutral one."""
    names = [part_of(w) for w in words]
    if not any(names) or not NEGATIONS.isdisjoint(words):
        return ""
    if any(not n and w not in NEUTRAL and len(w) > 1 for n, w in zip(names, words, strict=True)):
        return ""
    first = next(filter(None, names))
    return "" if first in ("header", "masthead", "banner") and not OWN.isdisjoint(words) else first


def names_of(attributes: str) -> tuple[str, str, bool]:
    """(signature, the left-out part that class, id or role name, hidden)."""
    signature = mark = ""
    hidden = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        name = name.lower()
        if name in ("class", "id"):
            tokens = [[w.lower() for w in WORD.findall(t)] for t in value.split()]
            signature += "." + "-".join(w for t in tokens for w in t)
            mark = mark or next(filter(None, map(mark_of, tokens)), "")
        elif name == "role" and value.lower() in DROPPED_ROLES:
            mark = mark or value.lower()
        elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
    return signature, mark, hidden


def read_page(html: str | None) -> tuple[list, list[tuple[int, str, int, int]]]:
    """The skeleton [label, children, number] and the blocks (node, text, flags, characters in links) in page order.

    Hidden elements, scripts and the like are no blocks; what is hidden from screen
    readers only is seen, and a formula is the text of its signs. Null: an empty skeleton.

    A menu entry is a block that is all but wholly links, outside articles and no
    heading: one of several links, or one whose container has nothing else. A paragraph
    that is one link is an entry only among others of its kind.
    """
    root: list = ["#", [], 0]
    count = 1
    stack = [Element("#", root, "", False)]
    opened: Counter[str] = Counter()
    blocks: list[tuple[int, str, int, int]] = []
    paragraphs: list[bool] = []
    several: list[Element | None] = []
    entries: list[tuple[int, Element]] = []  # blocks that may be, and their containers
    parts: Counter[Element] = Counter()
    text: list[str] = []
    linked = length = in_link = links = 0

    def flush() -> None:
        nonlocal linked, length, links
        if text:
            top = stack[-1]
            joined = " ".join(unescape("".join(text)).split())
            if joined and top.mark != "hidden":
                share = len(joined) * linked // length if linked else 0
                of = stack[-2] if top.tag in RUNS and len(stack) > 1 else top
                parts[of] += 1
                alone = linked and linked * 10 >= length * 9 and not top.root and top.tag not in HEADINGS
                if alone and links < 2:
                    entries.append((len(blocks), of))
                blocks.append((top.node[2], joined, (MARKED if top.mark else 0) | (INSIDE if top.root else 0) | (ENTRY if alone and links > 1 else 0), share))
                paragraphs.append(top.tag == "p")
                several.append(of if alone and links > 1 else None)
            text.clear()
        linked = length = links = 0

    def close(depth: int) -> None:
        for e in stack[depth:]:
            opened[e.tag] -= 1
        del stack[depth:]

    at = 0
    html = html or ""
    for m in TAG.finditer(html):
        if m.start() > at:
            piece = html[at : m.start()]
            text.append(piece)
            size = len(piece.strip())
            length += size
            linked += size if in_link else 0
        at = m.end()
        slash, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "a":
                in_link = 0 if slash else 1
                links += in_link
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        in_link = 0
        if slash:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        closes = ENDS_SAME.get(tag)
        if tag in ENDS_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        if closes and any(opened[t] for t in closes):
            outer = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in FENCES:
                    break
                outer = i if stack[i].tag in closes else outer
            if outer:
                close(outer)
        if tag in VOID:
            continue
        above = stack[-1]
        signature, named, hidden = names_of(attributes) if attributes.strip() else ("", "", False)
        mark = above.mark or ("hidden" if hidden else named or (tag if tag in DROPPED_TAGS else ""))
        is_root = tag in ("article", "main") and not named and not hidden
        if tag == "header" and above.root and not above.mark:
            mark = "byline"  # of an article: its headings and its standfirst are text
        if is_root and above.mark not in LASTING and above.mark != "hidden" or above.mark == "byline" and not hidden and (tag in HEADINGS or not STANDFIRST.isdisjoint(WORD_OF.findall(signature))):
            mark = ""  # an element left open before must not swallow the article
        elif tag in ("body", "html"):
            mark = ""
        label, parent = tag + signature, above.node
        if parent[1] and parent[1][-1][0] == label and (tag in RUNS or all(n[0] == label for n in parent[1][-APART:]) and len(parent[1]) >= APART):
            node = parent[1][-1]
        else:
            node = [label, [], count]
            count += 1
            parent[1].append(node)
        stack.append(Element(tag, node, mark, above.root or is_root and not mark))
        opened[tag] += 1
    if at < len(html):
        text.append(html[at:].split("<", 1)[0] if re.match(r"<[a-zA-Z/!?]", html[at:]) else html[at:])
    flush()
    like = Counter(of for _, of in entries) + Counter(filter(None, several))
    for i, of in entries:
        if like[of] == parts[of] and (like[of] > 1 or not paragraphs[i]):
            node, joined, flags, share = blocks[i]
            blocks[i] = node, joined, flags | ENTRY, share
    return root, blocks


def by_names(blocks: list[tuple[int, str, int, int]]) -> list[bool]:
    """Which blocks names and article elements keep, without any comparison of pages.

    If article or main elements hold half of the text or more, only what lies in them;
    else all but menu entries.
    """
    held = sum(len(t) for _, t, f, _ in blocks if f & INSIDE and not f & (MARKED | ENTRY))
    rooted = held > 0 and held * 2 >= sum(len(t) for _, t, f, _ in blocks if not f & (MARKED | ENTRY))
    return [not f & (MARKED | ENTRY) and (f & INSIDE > 0 or not rooted) for _, _, f, _ in blocks]


def parse(html: str | None) -> tuple[list, list[tuple[int, str]]]:
    """The skeleton of a page and the (node, text) that by_names keeps of it."""
    tree, blocks = read_page(html)
    return tree, [(n, t) for (n, t, _, _), kept in zip(blocks, by_names(blocks), strict=True) if kept]


def nodes_of(tree: list) -> list[list]:
    """All nodes, parents first, in order of their numbers."""
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node[1])
    return out


def written(tree: list) -> str:
    """A skeleton as text: a line `parent label` for each node, in order of their numbers."""
    parent = {c[2]: n[2] for n in nodes_of(tree) for c in n[1]}
    return "\n".join(f"{parent.get(n[2], -1)} {n[0]}" for n in nodes_of(tree))


def read_back(text: str) -> list:
    """The skeleton of a text made by written()."""
    nodes: list[list] = []
    for line in text.split("\n"):
        parent, _, label = line.partition(" ")
        node = [label, [], len(nodes)]
        nodes.append(node)
        if int(parent) >= 0:
            nodes[int(parent)][1].append(node)
    return nodes[0]


class Shapes:
    """Numbers for equal subtrees, and the size of the best matching of two of them."""

    def __init__(self) -> None:
        self.number: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.memo: dict[tuple[int, int], int] = {}

    def of(self, tree: list) -> dict[int, int]:
        """Node number to shape."""
        out: dict[int, int] = {}
        for node in reversed(nodes_of(tree)):
            key = (node[0], tuple(out[c[2]] for c in node[1]))
            if key not in self.number:
                self.number[key] = len(self.label)
                self.label.append(key[0])
                self.kids.append(key[1])
                self.size.append(1 + sum(self.size[k] for k in key[1]))
            out[node[2]] = self.number[key]
        return out

    def pair(self, s: int, t: int) -> int:
        """Weight of two shapes whose smaller pairs are known; 0 for different labels."""
        return self.size[s] if s == t else self.memo.get((s, t), 0)

    def know(self, s: int, t: int) -> None:
        """Find the weight of (s, t) and of all smaller pairs that it needs."""
        todo = [(s, t)]
        while todo:
            x, y = todo[-1]
            if x == y or (x, y) in self.memo or self.label[x] != self.label[y]:
                todo.pop()
                continue
            named: dict[str, list[int]] = {}
            for d in set(self.kids[y]):
                named.setdefault(self.label[d], []).append(d)
            missing = [(c, d) for c in set(self.kids[x]) for d in named.get(self.label[c], ()) if c != d and (c, d) not in self.memo]
            if missing:
                todo += missing
                continue
            self.memo[x, y] = 1 + self.best(self.kids[x], self.kids[y])
            todo.pop()

    def ends(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[int, int]:
        """Lengths of the equal beginning and of the equal end; some best matching pairs these one by one."""
        n = min(len(xs), len(ys))
        first = next((i for i in range(n) if xs[i] != ys[i]), n)
        last = next((i for i in range(n - first) if xs[-1 - i] != ys[-1 - i]), n - first)
        return first, last

    def rows(self, xs: tuple[int, ...], ys: tuple[int, ...], start: np.ndarray) -> Iterator[np.ndarray]:
        """Rows of the table of best ordered matchings after start, one for each of xs."""
        kinds, at = np.unique(np.array(ys, np.int64), return_inverse=True)
        known: dict[int, np.ndarray] = {}
        row = start
        for x in xs:
            if x not in known:
                known[x] = np.array([self.pair(x, y) for y in kinds.tolist()], np.int64)[at]
            row = np.maximum.accumulate(np.concatenate([[0], np.maximum(row[1:], row[:-1] + known[x])]))
            yield row

    def best(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> int:
        first, last = self.ends(xs, ys)
        total = sum(self.size[x] for x in xs[:first]) + sum(self.size[x] for x in xs[len(xs) - last :])
        row = np.zeros(len(ys) - first - last + 1, np.int64)
        for row in self.rows(xs[first : len(xs) - last], ys[first : len(ys) - last], row):  # noqa: B020
            pass
        return total + int(row[-1])

    def matched(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> list[tuple[int, int]]:
        """Places of a best ordered matching. Only every root-th row is held; the others are made again."""
        first, last = self.ends(xs, ys)
        pairs = [(i, i) for i in range(first)] + [(len(xs) - 1 - i, len(ys) - 1 - i) for i in range(last)]
        a, b = xs[first : len(xs) - last], ys[first : len(ys) - last]
        step = max(1, isqrt(len(a)))
        saved = [np.zeros(len(b) + 1, np.int64)]
        for i, row in enumerate(self.rows(a, b, saved[0]), 1):
            if i % step == 0:
                saved.append(row)
        i, j = len(a), len(b)
        while i and j:
            low = (i - 1) // step
            table = [saved[low], *self.rows(a[low * step : i], b, saved[low])]
            while i > low * step and j:
                here, above = table[i - low * step], table[i - 1 - low * step]
                if here[j] == above[j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((first + i, first + j))
        return pairs


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs (number in a, number in b) of simple tree matching, of most nodes.

    Equal subtrees are compared once, and memory is linear in the number of siblings
    times its root, so wide pages cost time in proportion to their siblings' product only.
    """
    if a[0] != b[0]:
        return []
    shapes = Shapes()
    of_a, of_b = shapes.of(a), shapes.of(b)
    shapes.know(of_a[a[2]], of_b[b[2]])
    pairs: list[tuple[int, int]] = []
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x[2], y[2]))
        if of_a[x[2]] == of_b[y[2]]:
            todo += zip(x[1], y[1], strict=True)
        else:
            todo += [(x[1][i], y[1][j]) for i, j in shapes.matched(tuple(of_a[c[2]] for c in x[1]), tuple(of_b[c[2]] for c in y[1]))]
    return pairs


def all_slots(own: list, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, slot) of every node of a skeleton: that of its pair, or a negative one of its path among the nodes without a pair."""
    slot = dict(pairs)
    todo = [own]
    while todo:
        node = todo.pop()
        nth: dict[str, int] = {}
        for child in node[1]:
            if child[2] not in slot:
                nth[child[0]] = nth.get(child[0], 0) + 1
                slot[child[2]] = -1 - (xxhash.xxh3_64_intdigest(f"{slot[node[2]]} {nth[child[0]]} {child[0]}".encode("utf-8", "replace")) >> 1)
        todo += node[1]
    return list(slot.items())


STATS = ("pages", "chars", "linked", "marked", "single", "fixed", "template")


def rules_of(skeleton: str, stats: list, host_pages: int, region_share: float) -> str:
    """What the comparison of a host's pages says of the nodes of a skeleton, as JSON.

    stats: (node, pages with its slot, characters there, of these in links, in parts left
    out by name, outside links in texts of one page only, and of template texts, hashes of
    the template texts), sums over distinct pages. same: node to its template texts. region: first and last node of the content
    region, or null. out: furniture outside it. labels: headings with template texts.
    """
    nodes = nodes_of(read_back(skeleton))
    n = len(nodes)
    varying, raw, pages, plain = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    own_text, rooted = np.zeros(n, bool), np.zeros(n, bool)
    heading = np.zeros(n, np.int64)
    same: dict[int, list[int]] = {}
    for node, seen, chars, linked, marked, single, fixed, template in stats:
        if not seen:
            continue
        # A slot most of whose text is fixed while the rest varies is that of versions of one article.
        if len(template) and not (2 * fixed > chars - linked > fixed and 2 * single > chars - linked - fixed):
            same[node] = sorted(map(int, template))
        plain[node] = max(0, chars - linked - marked) / seen
        own_text[node] = 2 * single > chars - linked > 0
        raw[node], pages[node] = chars, seen
        varying[node] = max(0, chars - linked - fixed) / seen
        heading[node] = nodes[node][0].split(".")[0] in HEADINGS and varying[node] > 0 and 2 * marked < chars and 2 * seen >= host_pages
    total, held, last = varying.copy(), raw.copy(), np.arange(n)
    for node in nodes:
        rooted[node[2]] |= node[0].split(".")[0] in ("article", "main")
        for c in node[1]:
            rooted[c[2]] = rooted[node[2]]
    for node in reversed(nodes):
        for c in node[1]:
            total[node[2]] += total[c[2]]
            held[node[2]] += held[c[2]]
            last[node[2]] = max(last[node[2]], last[c[2]])
    before = np.concatenate([[0], np.cumsum(heading)])  # varying headings with lower numbers
    at = above = nodes[0]
    while at[1] and total[0] > 0:
        down = max(at[1], key=lambda c: total[c[2]])
        # The region is a container, and the headings that lead up to the text are in it.
        leads = before[down[2]] - before[at[2]]
        if total[down[2]] < region_share * total[0] or held[down[2]] == raw[down[2]] or leads:
            break
        at, above = down, at
    inside = range(at[2], int(last[at[2]]) + 1)
    found = at[0].split(".")[0] not in ("#", "html", "body") and 2 * plain[inside.start : inside.stop].sum() >= plain.sum()
    # Beside the region, in a container that does not hold the whole page.
    beside = range(above[2], int(last[above[2]]) + 1) if above[0].split(".")[0] not in ("#", "html", "body") and held[above[2]] < held[0] else range(0)
    out = [i for i in range(n) if raw[i] and found and i not in inside and 2 * pages[i] >= host_pages and not (own_text[i] and (rooted[i] or i in beside))]
    return json.dumps({"region": [inside.start, inside.stop - 1] if found else None, "out": out, "same": {str(k): v for k, v in same.items()}, "labels": [i for i in same if nodes[i][0].split(".")[0] in LABELS]})


@lru_cache(maxsize=256)
def _rules(text: str) -> tuple[range, set[int], dict[int, set[int]], set[int]]:
    given = json.loads(text)
    first, last = given["region"] or (0, -1)
    return range(first, last + 1), set(given["out"]), {int(k): set(v) for k, v in given["same"].items()}, set(given["labels"])


def main_text(blocks: list[dict], rules: str | None) -> tuple[str, int, int, int]:
    """(text, blocks left out as template, as furniture, by name) of a page's blocks."""
    named = by_names([(b["node"], b["text"], b["flags"], b["linked"]) for b in blocks])
    if rules is None:
        kept = [b["text"] for b, keep in zip(blocks, named, strict=True) if keep]
        return "\n\n".join(kept), 0, 0, len(blocks) - len(kept)
    region, out, same, labels = _rules(rules)
    open_to, reasons = [], []
    for b, keep in zip(blocks, named, strict=True):
        node = b["node"]
        if node in region:
            keep = not b["flags"] & MARKED
        elif node in out:
            reasons.append("furniture")
            open_to.append(False)
            continue
        open_to.append(keep)
        reasons.append("" if not keep else "template" if b["hash"] in same.get(node, ()) else "kept")
    for i in range(len(blocks) - 2, -1, -1):
        # A title that many pages share, as of a part of a recipe, stays with the text under it.
        if reasons[i] == "template" and blocks[i]["node"] in region and blocks[i]["node"] in labels and reasons[i + 1] == "kept":
            reasons[i] = "kept"
    # Pages that differ in little else show no template: it never takes more than half of the region or of an article.
    within = [keep and (b["node"] in region or b["flags"] & INSIDE > 0) for b, keep in zip(blocks, open_to, strict=True)]
    lost = sum(len(b["text"]) for b, own, r in zip(blocks, within, reasons, strict=True) if own and r == "template")
    if 2 * lost > sum(len(b["text"]) for b, own in zip(blocks, within, strict=True) if own):
        reasons = ["kept" if own and r == "template" else r for r, own in zip(reasons, within, strict=True)]
    if "kept" not in reasons and any(within):
        reasons = ["kept" if keep and r == "template" else r for r, keep in zip(reasons, open_to, strict=True)]
    return "\n\n".join(b["text"] for b, r in zip(blocks, reasons, strict=True) if r == "kept"), reasons.count("template"), reasons.count("furniture"), reasons.count("")


BLOCK = [("node", pa.int32()), ("hash", pa.int64()), ("linked", pa.int32()), ("flags", pa.int32()), ("text", pa.string())]
PARSED = "page_id long, url string, host string, skeleton string, skeleton_id long, content long, blocks array<struct<node:int,hash:long,linked:int,flags:int,text:string>>"


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skeletons, contents, blocks = [], [], []
            for html in batch.column("html").to_pylist():
                tree, found = read_page(html)
                skeletons.append(written(tree))
                contents.append(_hash("\0".join(t for (_, t, _, _), keep in zip(found, by_names(found), strict=True) if keep)))
                blocks.append([{"node": n, "hash": _hash(t), "linked": share, "flags": f, "text": t} for n, t, f, share in found])
            columns = [batch.column(c) for c in ("page_id", "url", "host")]
            made = [pa.array(skeletons, pa.string()), pa.array(list(map(_hash, skeletons)), pa.int64()), pa.array(contents, pa.int64()), pa.array(blocks, pa.list_(pa.struct(BLOCK)))]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[n.split()[0] for n in PARSED.split(", ")])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(read, PARSED)


def _lookup(rows: DataFrame, lookup: DataFrame, key: list[str], size: int, limit: int) -> DataFrame:
    """rows with their one row of lookup: by broadcast if it has at most limit bytes, else with hot keys apart."""
    if size <= limit:
        return rows.join(F.broadcast(lookup), key)
    return join_lookup(rows, lookup, key, hot_keys(rows, key))


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = 5,
    template_share: float = 0.5,
    region_share: float = 0.8,
    broadcast_bytes: int = 32_000_000,
) -> DataFrame:
    """page_id, url, text, n_chars, n_template, n_furniture, n_named for every row of pages.

    text: the blocks of the main part, white space made single, joined by two line
    ends; empty for null or empty html. Hidden elements have no text. n_template: blocks
    left out because most pages of the host have them there; n_furniture: because they
    lie outside the region that holds region_share of the varying text; n_named: by
    names, roles or article elements, where the comparison says nothing.

    Ids are whole numbers. Pages without a host are one host. Repeated rows are rows of
    their own; they and other copies count once among the pages of the host. Hosts with
    under least_pages distinct pages are judged by names alone. No template takes more
    than half of a page's region or article, nor a heading inside the region whose text
    below it stays; so versions of one article (near copies), which would pass for
    template, stay whole wherever they share most of their text. An article's own header
    goes but for its headings and what its class calls a standfirst. Other columns are ignored; an empty table gives no rows.
    """
    parsed = materialise(_parsed(pages, id_col, url_col, html_col))
    block = lambda b: F.struct(b["node"].alias("node"), b["hash"].alias("hash"), F.length(b["text"]).alias("chars"), b["linked"].alias("linked"), b["flags"].bitwiseAND(MARKED).alias("marked"))
    once = F.array_distinct(F.transform("blocks", block))
    # Copies of a page stand for one page, that of the least skeleton.
    contents = parsed.select("host", "content", F.struct("skeleton_id", once.alias("once")).alias("page")).groupBy("host", "content").agg(F.min("page").alias("page"))
    contents = materialise(contents.select("host", "page.*"))
    counts = contents.groupBy("host", "skeleton_id").agg(F.count("*").alias("n"))
    shapes = parsed.groupBy("host", "skeleton_id").agg(F.min("skeleton").alias("skeleton")).join(counts, ["host", "skeleton_id"], "left")
    shapes = materialise(shapes.fillna(0, ["n"]))
    wrappers = shapes.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton_id")).alias("wrapper"), F.sum("n").alias("host_pages"))
    wrappers = materialise(wrappers)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slots = []
            for own, wrapper in zip(batch.skeleton, batch.wrapper, strict=True):
                tree = read_back(own)
                pairs = [(n[2], n[2]) for n in nodes_of(tree)] if own == wrapper else all_slots(tree, align(tree, read_back(wrapper)))
                slots.append([{"node": a, "slot": b} for a, b in pairs])
            yield pd.DataFrame({"host": batch.host, "skeleton_id": batch.skeleton_id, "n": batch.n, "slots": slots})

    enough = wrappers.filter(F.col("host_pages") >= least_pages)
    size = enough.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    compared = materialise(_lookup(shapes.join(enough.select("host"), "host", "left_semi"), enough, ["host"], size, broadcast_bytes))
    slots = compared.select("host", "skeleton_id", "n", "skeleton", "wrapper").mapInPandas(match, "host string, skeleton_id long, n long, slots array<struct<node:int,slot:long>>")
    slots = materialise(slots.select("host", "skeleton_id", "n", F.explode("slots").alias("s")).select("host", "skeleton_id", "n", "s.*"))
    size = 32 * slots.count()
    sums = [F.count("*").alias("same"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.sum(F.col("chars") * F.col("marked")).alias("marked"), F.max("chars").alias("length")]
    seen = contents.select("host", "skeleton_id", F.explode("once").alias("b")).select("host", "skeleton_id", "b.*").groupBy("host", "skeleton_id", "node", "hash").agg(*sums)
    seen = seen.join(enough.select("host"), "host", "left_semi")
    texts = _lookup(seen, slots.drop("n"), ["host", "skeleton_id", "node"], size, broadcast_bytes)
    texts = texts.groupBy("host", "slot", "hash").agg(*[F.sum(c).alias(c) for c in ("same", "chars", "linked", "marked")], F.max("length").alias("length"))
    texts = materialise(texts)
    of_slot = materialise(slots.groupBy("host", "slot").agg(F.sum("n").alias("pages")))
    repeated = texts.filter(F.col("same") > template_share * least_pages)
    template = _lookup(repeated, of_slot, ["host", "slot"], 32 * of_slot.count(), broadcast_bytes).filter((F.col("pages") >= least_pages) & (F.col("same") > template_share * F.col("pages")))
    # At most 1 / template_share times the texts that a page has there.
    template = template.groupBy("host", "slot").agg(F.sum(F.col("same") * F.col("length")).alias("fixed"), F.collect_list("hash").alias("template"))
    single = F.sum(F.when(F.col("same") == 1, F.col("chars") - F.col("linked")).otherwise(0)).alias("single")
    stats = texts.groupBy("host", "slot").agg(*[F.sum(c).alias(c) for c in ("chars", "linked", "marked")], single)
    stats = of_slot.join(stats, ["host", "slot"], "left").join(template, ["host", "slot"], "left")
    stats = materialise(stats.select("host", "slot", "pages", "chars", "linked", "marked", "single", F.coalesce("fixed", F.lit(0)).alias("fixed"), F.coalesce("template", F.array().cast("array<bigint>")).alias("template")))
    size = stats.agg(F.sum(64 + F.length("host") + 8 * F.size("template"))).first()[0] or 0
    facts = _lookup(slots, stats, ["host", "slot"], size, broadcast_bytes)
    # A row per node: bounded by the skeleton.
    facts = facts.filter("chars is not null").groupBy("host", "skeleton_id").agg(F.collect_list(F.struct("node", *STATS)).alias("facts"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rules = [
                rules_of(own, [tuple(f.values()) for f in given] if given is not None else [], n, region_share)
                for own, given, n in zip(batch.skeleton, batch.facts, batch.host_pages, strict=True)
            ]
            yield pd.DataFrame({"host": batch.host, "skeleton_id": batch.skeleton_id, "rules": rules})

    ruled = compared.drop("n", "wrapper").join(facts, ["host", "skeleton_id"], "left").mapInPandas(decide, "host string, skeleton_id long, rules string")
    rules = materialise(shapes.select("host", "skeleton_id").join(ruled, ["host", "skeleton_id"], "left"))
    size = rules.agg(F.sum(F.coalesce(F.length("rules"), F.lit(0)) + F.length("host") + 16)).first()[0] or 0
    joined = _lookup(parsed.select("page_id", "url", "host", "skeleton_id", "blocks"), rules, ["host", "skeleton_id"], size, broadcast_bytes)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(b, r) for b, r in zip(batch.column("blocks").to_pylist(), batch.column("rules").to_pylist(), strict=True)]
            numbers = [pa.array([m[i] for m in made], pa.int64()) for i in (1, 2, 3)]
            texts = pa.array([m[0] for m in made], pa.string())
            sizes = pa.array([len(m[0]) for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts, sizes, *numbers], names=["page_id", "url", "text", "n_chars", "n_template", "n_furniture", "n_named"])

    return joined.select("page_id", "url", "blocks", "rules").mapInArrow(assemble, "page_id long, url string, text string, n_chars long, n_template long, n_furniture long, n_named long")
