"""HTML to passages: the per-task helper of the page chunker.

A passage never mixes text across a node that was split: reading the tree depth first, a node
whose whole text fits the word limit is one piece; otherwise its children are taken in order. With
``merge`` neighbouring pieces under one parent are joined, left to right, up to the limit. A
single text longer than the limit is cut at word boundaries, so nothing is lost.
"""

from __future__ import annotations

from html.parser import HTMLParser

# HTML elements without an end tag, and the default exclusions.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
EXCLUDED = frozenset(("noscript", "script", "style"))


class _Tree(HTMLParser):
    """Nested lists: a node is ``[tag, child, child, …]``, a text child is a string."""

    def __init__(self, excluded: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.excluded = excluded
        self.root: list = ["#root"]
        self.open = [self.root]
        self.skipping: str | None = None
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        if self.skipping:
            self.depth += tag == self.skipping
        elif tag in self.excluded:
            self.skipping, self.depth = tag, 1
        elif tag not in VOID:
            node = [tag]
            self.open[-1].append(node)
            self.open.append(node)

    def handle_endtag(self, tag):
        if self.skipping:
            self.depth -= tag == self.skipping
            if not self.depth:
                self.skipping = None
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if not self.skipping and data.strip():
            self.open[-1].append(data)


def _pieces(root: list, limit: int, merge: bool) -> list[list[str]]:
    """Word lists of the pieces below ``root``; iterative, as pages may nest deeply."""
    done: dict[int, tuple[bool, list[list[str]]]] = {}
    stack = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if not ready:
            stack.append((node, True))
            stack.extend((c, False) for c in node[1:] if isinstance(c, list))
            continue
        # (fits whole, pieces) of every child, in order.
        parts: list[tuple[bool, list[list[str]]]] = []
        for child in node[1:]:
            if isinstance(child, list):
                parts.append(done.pop(id(child)))
            else:
                w = child.split()
                cut = [w[i : i + limit] for i in range(0, len(w), limit)]
                parts.append((len(cut) == 1, cut))
        parts = [p for p in parts if p[1]]
        words = sum(len(piece) for _, pieces in parts for piece in pieces)
        if parts and words <= limit and all(whole for whole, _ in parts):
            done[id(node)] = (True, [[w for _, pieces in parts for piece in pieces for w in piece]])
            continue
        out: list[list[str]] = []
        joinable = False
        for whole, pieces in parts:
            if merge and whole and joinable and len(out[-1]) + len(pieces[0]) <= limit:
                out[-1] = out[-1] + pieces[0]
            else:
                out.extend(pieces)
            joinable = whole
        done[id(node)] = (False, out)
    return done[id(root)][1]


def passages(html: str, max_words: int, merge: bool, excluded: frozenset[str] = EXCLUDED) -> list[str]:
    tree = _Tree(excluded)
    tree.feed(html)
    tree.close()
    return [" ".join(piece) for piece in _pieces(tree.root, max_words, merge)]
