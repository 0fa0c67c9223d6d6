"""HTML pages as flat node lists with features for a classifier."""

from __future__ import annotations

import html
import re
import uuid
from collections import Counter

import numpy as np

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<!--.*?(?:-->|\Z)|<[!?][^>]*+>", re.S
)
#: The attribute that labels composed pages for training. No page can know its name.
MARK = f"y-{uuid.uuid4().hex}"
_ATTRIBUTE = re.compile(rf"(class|id|role|{MARK})\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TAIL = re.compile(r"<!--.*\Z|<[!?/a-zA-Z][^<]*\Z", re.S)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW = frozenset("script style title noscript template textarea iframe svg canvas".split())
#: Of these an element that is never closed ends at once, instead of taking the rest of the page.
_LOOSE = frozenset("noscript template iframe svg canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr math mi mn mo mrow ms mtext object".split()
)
#: An element here is closed by the start of one of its set.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
_SCOPES = frozenset("ul ol dl table select body div article section".split())
#: Words in tags, classes, ids and roles that say what a node is for, by group.
HINTS = {
    "main": "article main content post story entry prose body",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header masthead topbar brand logo head",
    "footer": "footer copyright colophon contentinfo foot",
    "side": "aside sidebar side related recommended widget trending popular complementary rail",
    "notice": "notice cookie cookies consent gdpr alert newsletter subscribe popup modal overlay dialog banner",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion",
    "form": "form login search input button select label signup register option",
    "comment": "comment comments discussion reply replies respond thread disqus",
    "share": "share sharing social follow toolbar tags",
}
_BIT = {word: 1 << i for i, words in enumerate(HINTS.values()) for word in words.split()}
_KINDS = ["p", "li", "a", "h", "div", "table", "#text"]


class Nodes:
    """Nodes of some pages in document order; a subtree is a run of nodes."""

    def __init__(self):
        self.page: list[int] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.depth: list[int] = []
        self.kind: list[int] = []
        self.own: list[int] = []
        self.above: list[int] = []
        self.near: list[int] = []
        self.rank: list[int] = []
        self.before: list[int] = []
        self.gap: list[bool] = []
        self.text: list[str] = []
        self.linked: list[bool] = []
        self.label: list[int] = []

    def _add(self, page, parent, depth, tag, own, text, gap, linked, label, children, previous) -> int:
        at = len(self.page)
        self.page.append(page)
        self.parent.append(parent)
        self.last.append(at)
        self.depth.append(depth)
        self.kind.append(_KINDS.index(tag) if tag in _KINDS else 3 if tag[0] == "h" and tag[1:].isdigit() else len(_KINDS))
        self.own.append(own)
        self.above.append(own | self.above[parent] if parent >= 0 else own)
        self.near.append(own or (self.near[parent] if parent >= 0 else 0))
        self.rank.append(children.get(parent, 0))
        children[parent] = children.get(parent, 0) + 1
        self.before.append(previous.get(parent, -1))
        previous[parent] = at
        self.gap.append(gap)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return at

    def add_page(self, page: int, source: str) -> None:
        """Parse a page; broken markup is repaired the way browsers mostly do."""
        children: dict[int, int] = {}
        previous: dict[int, int] = {}
        root = self._add(page, -1, 0, "body", 0, "", True, False, -1, children, previous)
        stack = [(root, "", -1)]
        links = 0
        gap = True
        at, end = 0, len(source)
        final = source.rfind(">")
        opened: Counter[str] = Counter()
        lower = None
        absent: set[str] = set()

        def close(to: int) -> None:
            nonlocal links
            while len(stack) > to:
                node, name, _ = stack.pop()
                self.last[node] = len(self.page) - 1
                opened[name] -= 1
                links -= name == "a"

        while at < end:
            # Behind the last bracket there is no tag, and no use in trying every "<".
            match = _TAG.search(source, at) if at <= final else _TAIL.search(source, at)
            stop = match.start() if match else end
            if stop > at:
                text = source[at:stop]
                if not text.isspace():
                    parent, _, label = stack[-1]
                    text = html.unescape(text) if "&" in text else text
                    self._add(page, parent, len(stack), "#text", 0, text, gap, links > 0, label, children, previous)
                    gap = False
                else:
                    gap = True  # White space between inline nodes.
            if not match:
                break
            at = match.end()
            if match.re is _TAIL:
                break
            name = match[2] or match[5]
            if not name:
                continue
            name = name.lower()
            block = name not in _INLINE
            gap = True if block else gap
            if match[1] or match[4]:
                if opened[name] <= 0:
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] == name:
                        close(i)
                        break
                continue
            attributes = match[3] or match[6] or ""
            if name in _RAW and not attributes.endswith("/"):
                if lower is None:
                    lower = source.lower()
                found = -1 if name in absent else lower.find(f"</{name}", at)
                if found >= 0 or name not in _LOOSE:
                    at = end if found < 0 else source.find(">", found) + 1 or end
                else:
                    absent.add(name)
                continue
            if name in _VOID or name in ("html", "head", "body"):
                continue
            if block and any(s[1] == "p" for s in stack[-3:]):
                for i in range(len(stack) - 1, max(0, len(stack) - 4), -1):
                    if stack[i][1] == "p":
                        close(i)
                        break
            if name in _CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] in _CLOSES[name]:
                        close(i)
                        break
                    if stack[i][1] in _SCOPES:
                        break
            own = _BIT.get(name, 0)
            parent, _, label = stack[-1]
            if "=" in attributes:
                for key, *values in _ATTRIBUTE.findall(attributes):
                    value = values[0] or values[1] or values[2]
                    if key == MARK:
                        label = int(value)
                        continue
                    for word in _TOKEN.findall(value):
                        own |= _BIT.get(word.lower(), 0)
            node = self._add(page, parent, len(stack), name, own, "", False, False, label, children, previous)
            stack.append((node, name, label))
            opened[name] += 1
            links += name == "a"
        close(0)

    def features(self) -> np.ndarray:
        """A row of features for each node."""
        n = len(self.page)
        parent, last = np.array(self.parent), np.array(self.last)
        page, depth = np.array(self.page), np.array(self.depth)
        start = np.arange(n)
        up = np.where(parent < 0, start, parent)
        length = np.fromiter(map(len, self.text), np.float64, n)
        is_text = length > 0
        counts = np.stack([
            length, length * np.array(self.linked), ~is_text, is_text,
            np.fromiter((t.count(" ") for t in self.text), np.float64, n),
            np.fromiter((t.count(",") + t.count(".") for t in self.text), np.float64, n),
        ])
        sums = np.concatenate([np.zeros((len(counts), 1)), np.cumsum(counts, axis=1)], axis=1)
        chars, linked, tags, runs, blanks, marks = total = sums[:, last + 1] - sums[:, start]
        root = np.searchsorted(page, page)  # First node of the page.
        whole = np.maximum(total[0][root], 1)
        width = np.bincount(up[parent >= 0], minlength=n)
        rank, siblings = np.array(self.rank), width[up]
        before = np.array(self.before)
        earlier = np.where(before >= 0, chars[before], 0)
        later = np.zeros(n)
        later[before[before >= 0]] = chars[before >= 0]
        own, above, near = np.array(self.own), np.array(self.above), np.array(self.near)
        kind = np.array(self.kind)
        bits = [1 << i for i in range(len(HINTS))]
        below = own | 0
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            inner = level[parent[level] >= 0]
            np.bitwise_or.at(below, parent[inner], below[inner])
        columns = [
            np.log1p(chars), linked / np.maximum(chars, 1), np.log1p(tags), np.log1p(runs),
            chars / (tags + 1), marks / np.maximum(blanks + 1, 1), chars / np.maximum(blanks + runs, 1),
            chars / whole, chars / np.maximum(chars[up], 1), linked[up] / np.maximum(chars[up], 1),
            depth, rank, siblings, rank / np.maximum(siblings, 1), np.log1p(width),
            np.log1p(earlier), np.log1p(later), (sums[0][start] - sums[0][root]) / whole,
            (kind == len(_KINDS) - 1), *[kind == i for i in range(len(_KINDS) - 1)],
            *[(own & b) > 0 for b in bits], *[(above & b) > 0 for b in bits], *[(below & b) > 0 for b in bits],
            *[(near & b) > 0 for b in bits],
        ]
        return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)

    def targets(self) -> np.ndarray:
        """1 for nodes with labelled main text in their subtree, 0 for others with text, else -1."""
        n = len(self.page)
        label, last = np.array(self.label), np.array(self.last)
        is_text = np.fromiter(map(bool, self.text), bool, n)
        good = np.concatenate(([0], np.cumsum(is_text & (label == 1))))
        known = np.concatenate(([0], np.cumsum(is_text & (label >= 0))))
        here = np.arange(n)
        out = np.where(known[last + 1] > known[here], 0, -1)
        return np.where(good[last + 1] > good[here], 1, out)

    def decode(self, score: np.ndarray) -> np.ndarray:
        """The most likely choice of nodes in which no node is kept below a dropped one.

        From the deepest nodes up, a node's gain is its own score and the gains of those
        children that are worth keeping; from the root down, a child is kept if its
        parent is and its gain is positive. Roots are kept.
        """
        depth, parent = np.array(self.depth), np.array(self.parent)
        gain = score.astype(np.float64).copy()
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        for level in reversed(levels[1:]):
            np.add.at(gain, parent[level], np.maximum(gain[level], 0))
        kept = np.zeros(len(depth), bool)
        kept[levels[0]] = True
        for level in levels[1:]:
            kept[level] = kept[parent[level]] & (gain[level] > 0)
        return kept

    def texts(self, kept: np.ndarray, pages: int) -> list[str]:
        """The text of kept nodes of each page; blocks and white space become one space."""
        parts: list[list[str]] = [[] for _ in range(pages)]
        space: list = [""] * pages
        for i, text in enumerate(self.text):
            if text:
                p = self.page[i]
                if self.gap[i]:
                    space[p] = " "
                if kept[i]:
                    parts[p] += (space[p], text)
                    space[p] = ""
                else:
                    space[p] = " "
        return [" ".join("".join(p).split()) for p in parts]
