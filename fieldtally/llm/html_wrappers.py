"""Main text of web pages by wrappers that are inferred for each host.

A wrapper is a union-free regular expression over a host's token streams: tags, text slots, optional
and repeated groups. It starts as one page, its neighbouring repetitions folded into repeated groups,
and is aligned with further pages of the host. Texts that differ make a slot; a stretch that only one
side has becomes a repeated group where it repeats its neighbour, else an optional group. Groups of up to
``longest_group`` tokens are folded (a parameter of ``infer`` and ``main_text``); what repeats in longer ones stays
as single nodes.

The wrapper says what the article is. Its region is the element that is marked up as one, else the smallest
element that holds most of the text of slots that vary from page to page. In a host without markup a slot of the
region is article if it varies; a block of text that at least ``FIXED_PAGES`` different pages share at one place, and all
that have the place, is a notice or the like, whatever its element is called. Below the region, elements named as
menus, forms and so on are left out, and those whose class says so unless they hold most of the region. What
stands around the region decides nothing, so no class of ``body`` can empty a page. Every page is
aligned with its host's wrapper: texts of a fixed slot, the same ones, are left out, and texts in a slot that is article
in its pages are taken wherever they stand, but for menus and the like; others go by the element they stand in.

A wrapper is inferred from all pages of its host. Each is read into an outline; sums over the outlines give the host's
region, and elements that hold most of it. Pages of one shape (the same nodes with the same answers) are counted together,
with a hash of the texts that they share, and shapes are merged ``MERGED_PARTS`` at a time, level by level, so no task holds
all pages of a host. Marks that few of the host's pages have (ids of headings, say) align nothing: such elements are aligned
by their names. All pages are then extracted with the wrapper, whole. Hosts of very many pages are joined under several salts.

Defined cases: null and empty html give the empty text; pages without a host share a wrapper; repeated
rows are extracted each, and rows without page_id as well; unclosed and stray tags are read as browsers do; pages of any
length are read whole; an empty table gives no rows; other columns go through unless named ``text`` or ``n_chars`` in any
case of letters.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import others, quoted, written

#: Wrappers of one host that a task merges at a time.
MERGED_PARTS = 32
#: Cells of the largest table that an alignment fills at once; longer streams are halved first.
CELLS = 1 << 24
#: Longest stretch of tokens that is looked for as a repeated group, unless a caller says otherwise.
LONGEST_GROUP = 24
#: Different pages that must share a text for it to be taken for a fixed one.
FIXED_PAGES = 3
#: Share of a host's pages, ``FIXED_PAGES`` at least, that must have an element's marks for streams to be aligned by them.
MARK_SHARE = 0.01
#: Pages of a host that are joined with one copy of its wrapper.
SALT_PAGES = 20_000
#: Share of the slots' text that the article's element must hold where none is marked up.
MOST = 0.6

# Names of HTML elements.
HIDDEN = "script|style|noscript|template|textarea|svg|iframe|object|select|head|title"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
ARTICLE = {"article", "main"}
OTHER = set("nav header footer aside form button menu dialog select label fieldset".split())
# Words in class, id and role attributes of what is not the article.
OTHER_WORDS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form header login masthead menu nav navbar navigation newsletter notice notices popup promo "
    "related replies search share sharing sidebar signup social sponsor sponsored subscribe widget "
    "complementary contentinfo".split()
)
# Words beside those that say nothing about what an element holds.
PLAIN_WORDS = set(
    "a an area bar block bottom box button buttons container content div group inner item items left link links list "
    "main my outer page panel post posts reader right row section site slot the thread top unit us user wrap wrapper".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*>",
    re.S | re.I,
)
_MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PLACE = re.compile(r"\b(?:class|id|role)=((?:(?!\b(?:class|id|role|itemprop)=).)*)")
_WORD = re.compile(r"[a-z]+")
TEXT = "#"
OUTLINE = {
    "symbols": "array<string>", "places": "array<int>", "paths": "array<array<string>>", "weights": "array<long>",
    "marked": "boolean", "sizes": "array<long>", "raw": "array<long>", "even": "array<long>",
}


class Token:
    """A tag (``symbol``: name and marks, after a stroke if closing) or a text in its element."""

    __slots__ = ("path", "symbol", "text")

    def __init__(self, symbol: str, text: str, path: tuple[str, ...]):
        self.symbol, self.text, self.path = symbol, text, path


def _symbol(name: str, marks: str) -> str:
    if "=" not in marks:
        return name
    found = sorted(
        f"{k.lower()}={re.sub(r'[0-9]+', '', a or b or c).strip().lower()}" for k, a, b, c in _MARK.findall(marks)
    )
    return " ".join([name, *found])


def tokens(page: str) -> list[Token]:
    """Tags and texts in page order, each with the open elements around it."""
    out: list[Token] = []
    stack: list[str] = []
    path: tuple[str, ...] = ()
    at = 0
    for match in _TOKEN.finditer(page):
        if match.start() > at:
            text = page[at : match.start()]
            if not text.isspace():
                out.append(Token(TEXT, text, path))
            elif out and out[-1].symbol == TEXT:
                out[-1].text += text
            else:
                out.append(Token(" ", text, path))
        at = match.end()
        name = match[3]
        if name is None:
            continue
        name = name.lower()
        if match[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].split(" ", 1)[0] == name:
                    del stack[i:]
                    path = tuple(stack)
                    out.append(Token("/" + name, "", path))
                    break
            continue
        symbol = _symbol(name, match[4])
        if name in BLOCK and "p" in stack and name not in VOID:  # an open paragraph ends
            del stack[len(stack) - 1 - stack[::-1].index("p") :]
        if name == "li":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].split(" ", 1)[0] in ("ul", "ol", "menu"):
                    break
                if stack[i].split(" ", 1)[0] == "li":
                    del stack[i:]
                    break
        path = tuple(stack)
        out.append(Token(symbol, "", path))
        if name not in VOID and not match[4].rstrip().endswith("/"):
            stack.append(symbol)
            path = tuple(stack)
    if at < len(page) and not page[at:].isspace():
        out.append(Token(TEXT, page[at:], path))
    return out


def telling(marks: str) -> bool:
    """Whether a class, id or role is made of words for menus, adverts and the like (``share-prices`` is not)."""
    for mark in _PLACE.findall(marks):
        for name in mark.split():
            words = _WORD.findall(name)
            if any(w in OTHER_WORDS for w in words) and all(w in OTHER_WORDS or w in PLAIN_WORDS for w in words):
                return True
    return False


def named_other(path: tuple[str, ...]) -> bool:
    """Whether an element on the way is a menu, form or the like by its name."""
    return any(symbol.split(" ", 1)[0] in OTHER for symbol in path)


class Node:
    """A piece of a wrapper: ``one``, ``optional`` or ``repeated`` run of symbols. ``answers`` has bit 1 where a text of
    its slot is article as its elements tell, bit 2 where one is not; ``pages`` of different content have texts there,
    all the same if ``text`` is not None: their hash."""

    __slots__ = ("answers", "kind", "pages", "symbols", "text")

    def __init__(self, kind: str, symbols: tuple[str, ...], answers: int = 0, pages: int = 0, text: int | None = None):
        self.kind, self.symbols, self.answers, self.pages, self.text = kind, tuple(symbols), answers, pages, text


def fold(symbols: list[str], longest: int = LONGEST_GROUP) -> list[tuple[str, tuple[str, ...], int, int]]:
    """A stream as pieces: a stretch that follows itself becomes one repeated group. Kind, symbols, begin and end."""
    out = []
    at, n = 0, len(symbols)
    while at < n:
        for period in range(2, min(longest, (n - at) // 2) + 1):
            if symbols[at] == symbols[at + period] and symbols[at : at + period] == symbols[at + period : at + 2 * period]:
                end = at + 2 * period
                while symbols[end : end + period] == symbols[at : at + period]:
                    end += period
                out.append(("repeated", tuple(symbols[at : at + period]), at, end))
                at = end
                break
        else:
            out.append(("one", (symbols[at],), at, at + 1))
            at += 1
    return out


def aligned(symbols: list[str], marks: set[str]) -> list[str]:
    """Symbols by which streams are aligned: with their marks if the host has those on enough pages, else names."""
    return [s if " " not in s or s in marks else s.split(" ", 1)[0] for s in symbols]


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``x`` and every beginning of ``y``."""
    row = np.zeros(len(y) + 1, np.int32)
    for value in x.tolist():
        same = np.where(y == value, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(same, row[1:]))
    return row


def _common(x: np.ndarray, y: np.ndarray, cells: int = CELLS) -> list[tuple[int, int]]:
    """Places of a longest common subsequence. Where the table would be over ``cells``, ``x`` is halved and
    ``y`` cut where the lengths of both sides add up to the most."""
    if len(x) > 1 and len(x) * len(y) > cells:
        half = len(x) // 2
        cut = int((_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]).argmax())
        after = _common(x[half:], y[cut:], cells)
        return _common(x[:half], y[:cut], cells) + [(half + i, cut + j) for i, j in after]
    best = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i in range(len(x) - 1, -1, -1):
        same = np.where(y == x[i], best[i + 1, 1:] + 1, 0)
        row = np.maximum(same, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    found = []
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j] and best[i, j] == best[i + 1, j + 1] + 1:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] == best[i, j]:
            i += 1
        else:
            j += 1
    return found


def _paired(a: list[tuple[str, ...]], b: list[tuple[str, ...]]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of the symbols of two lists of nodes."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    left, right = a[start : len(a) - end], b[start : len(b) - end]
    middle = []
    if left and right:
        known: dict[tuple, int] = {}
        x = np.array([known.setdefault(s, len(known)) for s in left])
        y = np.array([known.setdefault(s, len(known)) for s in right])
        middle = [(start + i, start + j) for i, j in _common(x, y)]
    return (
        [(i, i) for i in range(start)] + middle + [(len(a) - end + i, len(b) - end + i) for i in range(end)]
    )


def _alone(nodes: list[Node], neighbours: list[Node]) -> list[Node]:
    """A stretch that only one side has: more of a neighbour that it repeats, else optional."""
    out = []
    run = tuple(s for n in nodes for s in n.symbols)
    for near in neighbours:
        size = len(near.symbols)
        if size > 1 and len(run) % size == 0 and near.symbols * (len(run) // size) == run:
            near.kind = "repeated"
            for n in nodes:
                near.answers |= n.answers
            if TEXT in run:  # these pages have fewer or more texts there
                near.pages, near.text = near.pages + max(n.pages for n in nodes), None
            return []
    for node in nodes:
        if node.kind == "one":
            node.kind = "optional"
        out.append(node)
    return out


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper that also fits the page, or all pages of another wrapper."""
    out: list[Node] = []
    i = j = 0
    pairs = _paired([n.symbols for n in wrapper], [n.symbols for n in page])
    for p, q in [*pairs, (len(wrapper), len(page))]:
        after = [wrapper[p]] if p < len(wrapper) else []
        for side in (wrapper[i:p], page[j:q]):
            if side:
                out.extend(_alone(side, [*out[-1:], *after]))
        if p < len(wrapper):
            node, own = wrapper[p], page[q]
            if own.kind == "repeated" or node.kind == "one":
                node.kind = own.kind
            node.text = node.text if node.text == own.text else None
            node.answers |= own.answers
            node.pages += own.pages
            out.append(node)
        i, j = p + 1, q + 1
    return out


def _main(path: tuple[str, ...]) -> int | None:
    """Depth of the outermost element that is marked up as the article."""
    for i, symbol in enumerate(path):
        name, _, marks = symbol.partition(" ")
        if name in ARTICLE or "role=main" in marks or "itemprop=articlebody" in marks:
            return i + 1
    return None


def _marked(path: tuple[str, ...]) -> int | None:
    """Depth of the article's element if it is marked up and in no menu or the like."""
    depth = _main(path)
    return None if depth is None or named_other(path[: depth - 1]) else depth


class Rule:
    """What a host's pages say before they are aligned: whether any has its article marked up, else the element that
    holds it; elements that are article against their class; symbols whose marks enough pages have."""

    def __init__(self, marked: bool, element=(), holding=(), marks=()):
        self.marked, self.element = marked, tuple(element)
        self.holding, self.marks = {tuple(e) for e in holding}, set(marks)

    def below(self, path: tuple[str, ...]) -> int | None:
        """Depth at which the path enters the article's element."""
        if self.marked:
            return _marked(path)
        return len(self.element) if path[: len(self.element)] == self.element else None

    def inside(self, path: tuple[str, ...]) -> bool:
        """Whether a text there is article as far as its elements tell; those of ``holding`` are, whatever their class."""
        depth = self.below(path)
        if depth is None or named_other(path[depth:]):
            return False
        return not any(
            telling(path[i].partition(" ")[2]) and path[: i + 1] not in self.holding for i in range(depth, len(path))
        )

    def told(self, path: tuple[str, ...]) -> list[tuple[str, ...]] | None:
        """Elements with a telling class around a text of the region; None if it is not of the region."""
        depth = self.below(path)
        if depth is None or named_other(path[depth:]):
            return None
        return [path[: i + 1] for i in range(depth, len(path)) if telling(path[i].partition(" ")[2])]


def read_rule(text: str) -> Rule:
    return Rule(**json.loads(text))  # what is null in the table is left out


def enclosing(element: tuple[str, ...]) -> tuple[str, ...]:
    """The innermost block element that is no single paragraph, item or heading."""
    while element and element[-1].split(" ", 1)[0] not in BLOCK:
        element = element[:-1]
    if element and element[-1].split(" ", 1)[0] in ("p", "li", "h1", "h2", "h3"):
        element = element[:-1]
    return element


def _hash(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def even_hash(text: str) -> int:
    """Hash of a text with its white space made even."""
    return _hash(" ".join(text.split()).encode("utf-8", "replace"))


def node_hash(even: list[int]) -> int:
    """Hash of the texts of a node in one page."""
    return _hash(np.asarray(even, np.int64).tobytes())


def outline(page: str) -> dict:
    """What a page adds to its host's wrapper: its symbols; the elements around its texts, with the length of their
    texts; where no article is marked up, also the place, length and hash of each text, as it is and with its white
    space made even."""
    stream = [t for t in tokens(page) if t.symbol != " "]
    texts = [t for t in stream if t.symbol == TEXT]
    paths: dict[tuple[str, ...], int] = {}
    weights: list[int] = []
    for t in texts:
        if paths.setdefault(t.path, len(paths)) == len(weights):
            weights.append(0)
        weights[paths[t.path]] += len(t.text)
    marked = any(_marked(path) is not None for path in paths)
    some = [] if marked else texts
    return {
        "symbols": [t.symbol for t in stream],
        "places": [paths[t.path] for t in texts],
        "paths": [list(path) for path in paths],
        "weights": weights,
        "marked": marked,
        "sizes": [len(t.text) for t in some],
        "raw": [_hash(t.text.encode("utf-8", "replace")) for t in some],
        "even": [even_hash(t.text) for t in some],
    }


def shape(symbols: list[str], places, paths, even, rule: Rule, longest_group: int = LONGEST_GROUP) -> tuple[str, list[int]]:
    """A page's nodes with their answers, as JSON, and the hash of the texts of each that has some (none where the host
    has marked-up articles: nothing is fixed there)."""
    inside = [1 if rule.inside(tuple(path)) else 2 for path in paths]
    nodes, texts = [], []
    seen = 0
    for kind, run, at, end in fold(aligned(symbols, rule.marks), longest_group):
        count = run.count(TEXT) * ((end - at) // len(run))
        answers = 0
        for place in places[seen : seen + count]:
            answers |= inside[place]
        if count and not rule.marked:
            texts.append(node_hash(even[seen : seen + count]))
        seen += count
        nodes.append([kind, run, answers])
    return json.dumps(nodes, ensure_ascii=False), texts


def sprout(own: str, pages: int, texts: list[int | None]) -> str:
    """The wrapper of all pages of one shape, as JSON; ``texts`` has None for nodes where they differ."""
    same = iter(texts)
    nodes = [
        [*node, pages, next(same)] if texts and TEXT in node[1] else [*node, 0, None] for node in json.loads(own)
    ]
    return json.dumps(nodes, ensure_ascii=False)


def merge(parts: list[tuple[int, str]]) -> str:
    """The wrapper that fits all pages of several ones, given with their pages; those of most pages come first."""
    wrapper: list[Node] | None = None
    for _, part in sorted(parts, key=lambda p: (-p[0], p[1])):
        own = [Node(*node) for node in json.loads(part)]
        wrapper = own if wrapper is None else align(wrapper, own)
    return json.dumps([[n.kind, n.symbols, n.answers, n.pages, n.text] for n in wrapper or []], ensure_ascii=False)


def _fixed(node: Node) -> bool:
    """Whether enough different pages have the same texts at a node, and no page others."""
    return node.pages >= FIXED_PAGES and node.text is not None


def _fixed_nodes(wrapper: list[Node]) -> set[int]:
    """Nodes of blocks all of whose texts are fixed: a block is what stands between two tags of block elements."""
    found: set[int] = set()
    block: list[int] = []

    def close() -> None:
        if all(_fixed(wrapper[i]) for i in block):
            found.update(block)
        block.clear()

    for i, node in enumerate(wrapper):
        if any(symbol.lstrip("/").split(" ", 1)[0] in BLOCK for symbol in node.symbols):
            close()
            if node.kind == "repeated":
                block.append(i)
                close()
        elif TEXT in node.symbols:
            block.append(i)
    close()
    return found


def finished(merged: str, rule: Rule, longest_group: int = LONGEST_GROUP) -> str:
    """The wrapper as JSON: its nodes with the answer of each slot (the hash of its texts if they are fixed), and what the
    host's rule says of elements."""
    wrapper = [Node(*node) for node in json.loads(merged)]
    fixed = _fixed_nodes(wrapper)
    nodes = []
    for i, node in enumerate(wrapper):
        answer = {1: True, 2: False}.get(node.answers)
        nodes.append([node.kind, node.symbols, node.text if answer and i in fixed else answer])
    return json.dumps(
        {"nodes": nodes, "marked": rule.marked, "inside": rule.element, "holding": sorted(rule.holding), "group": longest_group},
        ensure_ascii=False,
    )


def _rule_of(outlines: list[dict]) -> Rule:
    """The rule of a host's different pages, which ``rules`` finds for all hosts in Spark."""
    pages_of: Counter = Counter()
    weights: Counter = Counter()
    for own in outlines:
        pages_of.update({s for s in own["symbols"] if " " in s})
        for path, weight in zip(own["paths"], own["weights"]):
            weights[tuple(path)] += weight
    marks = {s for s, n in pages_of.items() if n >= max(FIXED_PAGES, MARK_SHARE * len(outlines))}
    rule = Rule(any(own["marked"] for own in outlines), marks=marks)
    if not rule.marked:
        having: dict[int, set[int]] = {}
        varied: Counter = Counter()
        texts = [
            (number, tuple(own["paths"][place]), raw, size)
            for number, own in enumerate(outlines) for place, raw, size in zip(own["places"], own["raw"], own["sizes"])
            if not named_other(tuple(own["paths"][place]))
        ]
        for number, _, raw, _ in texts:
            having.setdefault(raw, set()).add(number)
        for _, path, raw, size in texts:
            if len(having[raw]) == 1:
                varied[path] += size
        counted = varied or {path: w for path, w in weights.items() if not named_other(path)}
        holding: Counter = Counter()
        for path, weight in counted.items():
            for depth in range(len(path) + 1):
                holding[path[:depth]] += weight
        enough = [path for path, weight in holding.items() if weight >= MOST * sum(counted.values())]
        rule.element = enclosing(max(enough, key=len, default=()))
    told: Counter = Counter()
    total = 0
    for path, weight in weights.items():
        elements = rule.told(path)
        if elements is not None:
            total += weight
            for element in elements:
                told[element] += weight
    rule.holding = {element for element, weight in told.items() if 2 * weight >= total}
    return rule


def infer(pages: list[str], longest_group: int = LONGEST_GROUP) -> str:
    """The wrapper of a few pages of one host, without Spark."""
    # A page that comes twice is one page: what it shares with itself is not fixed.
    outlines = [outline(page) for page in dict.fromkeys(pages)]
    rule = _rule_of(outlines)
    shapes: dict[str, list[list[int]]] = {}
    for own in outlines:
        key, texts = shape(own["symbols"], own["places"], own["paths"], own["even"], rule, longest_group)
        shapes.setdefault(key, []).append(texts)
    parts = [
        (len(texts), sprout(key, len(texts), [same[0] if len(set(same)) == 1 else None for same in zip(*texts)]))
        for key, texts in shapes.items()
    ]
    return finished(merge(parts), rule, longest_group)


class Wrapper:
    """A wrapper as ``extract`` needs it."""

    def __init__(self, wrapper: str | dict):
        known = json.loads(wrapper) if isinstance(wrapper, str) else wrapper
        self.symbols = [tuple(symbols) for _, symbols, _ in known["nodes"]]
        self.answers = [answer for _, _, answer in known["nodes"]]
        self.rule = Rule(known["marked"], known["inside"], known["holding"], {s for run in self.symbols for s in run})
        self.group = known["group"]
        self.paths: dict[tuple[str, ...], bool] = {}

    def inside(self, path: tuple[str, ...]) -> bool:
        if path not in self.paths:
            if len(self.paths) > 10_000:
                self.paths.clear()
            self.paths[path] = self.rule.inside(path)
        return self.paths[path]


def extract(page: str | None, wrapper: str | dict | Wrapper) -> str:
    """The article's blocks, one to a line."""
    if not page:
        return ""
    known = wrapper if isinstance(wrapper, Wrapper) else Wrapper(wrapper)
    stream = tokens(page)
    solid = [t for t in stream if t.symbol != " "]
    own = fold(aligned([t.symbol for t in solid], known.rule.marks), known.group)
    answers: dict[int, bool | str | None] = {}
    for i, j in _paired(known.symbols, [run for _, run, _, _ in own]):
        answer = known.answers[i]
        if answer is not None:
            # A slot of several elements has no answer of its own.
            texts = [t for t in solid[own[j][2] : own[j][3]] if t.symbol == TEXT]
            if not isinstance(answer, bool):
                # A page that has other texts there has them by chance: the slot's pages all have the same.
                answer = "fixed" if node_hash([even_hash(t.text) for t in texts]) == answer else None
            answers.update((id(t), answer) for t in texts)
    blocks: list[str] = []
    held: list[str] = []

    def close() -> None:
        line = " ".join(html.unescape("".join(held)).split())
        if line:
            blocks.append(line)
        held.clear()

    for t in stream:
        if t.symbol == TEXT or t.symbol == " ":
            answer = answers.get(id(t))
            if known.inside(t.path):
                main = answer != "fixed"
            else:
                # The wrapper knows the slot for article, the page's own element is another.
                main = answer is True and not named_other(t.path) and not any(telling(x.partition(" ")[2]) for x in t.path[2:])
            if main:
                held.append(t.text)
        else:
            name = t.symbol.lstrip("/").split(" ", 1)[0]
            if name in BLOCK:
                close()
            elif name == "br" and held:
                held.append(" ")
    close()
    return "\n".join(blocks)


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^/]*//([^/?#]*)", 1), F.lit("")))


def outlines(pages: DataFrame) -> DataFrame:
    """``host, page`` (the html's hash) and the outline of every different page of each host."""
    rows = pages.filter("html is not null").select(host_of().alias("host"), F.xxhash64("html").alias("page"), "html")

    def outlined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):  # outlines are larger than pages
                some = batch.iloc[at : at + 500]
                found = pd.DataFrame([outline(page) for page in some["html"]], index=some.index, columns=list(OUTLINE))
                yield pd.concat([some[["host", "page"]], found], axis=1)

    schema = "host string, page long, " + ", ".join(f"{name} {kind}" for name, kind in OUTLINE.items())
    return written(rows.mapInPandas(outlined, schema).dropDuplicates(["host", "page"]), "outlines")


def elements(known: DataFrame, hosts: DataFrame, weights: DataFrame) -> DataFrame:
    """``host, element`` of hosts without markup: the smallest element that holds most of the text that varies."""
    names = F.transform("path", lambda symbol: F.substring_index(symbol, " ", 1))
    plain = ~F.arrays_overlap(names, F.array(*(F.lit(name) for name in sorted(OTHER))))
    unmarked = hosts.filter("not marked").select("host")
    text = F.explode(F.arrays_zip("places", "raw", "sizes")).alias("text")
    texts = (
        known.filter("not marked").join(unmarked, "host").select("host", "page", "paths", text)
        .select("host", "page", "text.raw", "text.sizes", F.expr("paths[text.places]").alias("path")).filter(plain)
    )
    of_text = Window.partitionBy("host", "raw")
    varied = (
        texts.groupBy("host", "raw", "path")
        .agg(F.min("page").alias("first"), F.max("page").alias("last"), F.sum("sizes").alias("size"))
        .select("host", "path", "size", F.min("first").over(of_text).alias("first"), F.max("last").over(of_text).alias("last"))
        .filter("first = last").groupBy("host", "path").agg(F.sum("size").alias("varied"))
    )
    counted = written(
        weights.join(unmarked, "host").filter(plain).join(varied, ["host", "path"], "left")
        .select("host", "path", "weight", F.coalesce("varied", F.lit(0).cast("long")).alias("varied")),
        "counted",
    )
    sums = [F.sum("weight").alias("weight"), F.sum("varied").alias("varied")]
    totals = counted.groupBy("host").agg(F.sum("weight").alias("all_weight"), F.sum("varied").alias("all_varied"))
    around = F.explode(F.transform(F.sequence(F.lit(0), F.size("path")), lambda depth: F.slice("path", F.lit(1), depth)))
    most = F.when(F.col("all_varied") > 0, F.col("varied") >= MOST * F.col("all_varied")).otherwise(
        F.col("weight") >= MOST * F.col("all_weight")
    )
    return (
        counted.select("host", around.alias("element"), "weight", "varied").groupBy("host", "element").agg(*sums)
        .join(totals, "host").filter(most).groupBy("host").agg(F.max_by("element", F.size("element")).alias("element"))
    )


def rules(known: DataFrame) -> DataFrame:
    """``host, rule`` (JSON) of the outlines' hosts, from all their pages."""
    hosts = written(known.groupBy("host").agg(F.max("marked").alias("marked"), F.count(F.lit(1)).alias("pages")), "hosts")
    weights = written(
        known.select("host", F.explode(F.arrays_zip("paths", "weights")).alias("of"))
        .groupBy("host", F.col("of.paths").alias("path")).agg(F.sum("of.weights").alias("weight")),
        "weights",
    )
    marks = (
        known.select("host", F.explode(F.array_distinct("symbols")).alias("symbol")).filter("symbol like '% %'")
        .groupBy("host", "symbol").agg(F.count(F.lit(1)).alias("having")).join(hosts, "host")
        .filter(F.col("having") >= F.greatest(F.lit(float(FIXED_PAGES)), MARK_SHARE * F.col("pages")))
        .groupBy("host").agg(F.sort_array(F.collect_list("symbol")).alias("marks"))
    )
    enclosed = F.udf(lambda path: list(enclosing(tuple(path))) if path is not None else None, "array<string>")
    first = written(
        hosts.join(elements(known, hosts, weights), "host", "left").join(marks, "host", "left")
        .select("host", "marked", enclosed("element").alias("element"), "marks"),
        "first-rules",
    )

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, path, weight, marked, element in batch.itertuples(index=False):
                around = Rule(marked, () if element is None else element).told(tuple(path))
                if around is not None:
                    out.append((host, None, weight))
                    out.extend((host, list(e), weight) for e in around)
            yield pd.DataFrame(out, columns=["host", "path", "weight"])

    of_region = weights.join(first, "host").select("host", "path", "weight", "marked", "element")
    sums = written(
        of_region.mapInPandas(told, "host string, path array<string>, weight long")
        .groupBy("host", "path").agg(F.sum("weight").alias("weight")),
        "told",
    )
    total = sums.filter("path is null").select("host", F.col("weight").alias("total"))
    holding = (
        sums.filter("path is not null").join(total, "host").filter("2 * weight >= total")
        .groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("holding"))
    )
    rule = F.to_json(F.struct("marked", "element", "holding", "marks"))
    return written(first.join(holding, "host", "left").select("host", rule.alias("rule")), "rules")


def by_host(rows: DataFrame, known: DataFrame, salt: str) -> DataFrame:
    """The rows, each with what is known of its host; hosts of very many rows are joined under several salts."""
    # Few hosts have that many pages: no more than the table has rows for each SALT_PAGES.
    copies = F.ceil(F.col("pages") / SALT_PAGES).alias("copies")
    large = written(
        rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") > SALT_PAGES).select("host", copies),
        "large-hosts",
    )
    if large.isEmpty():
        return rows.join(known, "host", "left")
    # Written, so that Spark sees the size of the copies and sends them to the executors only if it is small.
    count = F.coalesce(F.col("copies"), F.lit(1).cast("long"))
    copied = known.join(large, "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    salted = rows.join(large, "host", "left").withColumn("salt", F.pmod(F.xxhash64(salt), count))
    return salted.drop("copies").join(written(copied.drop("copies"), "copies"), ["host", "salt"], "left")


def sprouts(known: DataFrame, ruled: DataFrame, longest_group: int) -> DataFrame:
    """``host, pages, nodes``: the wrapper of each different shape of a host's pages, with the number of these."""

    def shaped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read: dict[str, Rule] = {}
        for batch in batches:
            out = []
            for host, rule, symbols, places, paths, even in batch.itertuples(index=False):
                if rule not in read:
                    if len(read) > 1000:
                        read.clear()
                    read[rule] = read_rule(rule)
                out.append((host, *shape(list(symbols), places, paths, even, read[rule], longest_group)))
            yield pd.DataFrame(out, columns=["host", "shape", "texts"])

    pages = by_host(known.select("host", "page", "symbols", "places", "paths", "even"), ruled, "page")
    shapes = pages.select("host", "rule", "symbols", "places", "paths", "even").mapInPandas(
        shaped, "host string, shape string, texts array<long>"
    )
    same = F.when(F.col("low") == F.col("high"), F.col("low"))
    nodes = (
        shapes.select("host", "shape", F.posexplode_outer("texts").alias("place", "text"))
        .groupBy("host", "shape", "place").agg(F.count(F.lit(1)).alias("pages"), F.min("text").alias("low"), F.max("text").alias("high"))
        .groupBy("host", "shape").agg(
            F.max("pages").alias("pages"),
            F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", same.alias("text"))))).alias("texts"),
        )
    )

    @F.pandas_udf("string")
    def sprouted(shapes: pd.Series, pages: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([sprout(s, int(n), t) for s, n, t in zip(shapes, pages, (json.loads(t) for t in texts))], dtype=object)

    # As text, since a column of numbers and nulls would come as floats.
    listed = F.to_json(F.col("texts.text"))
    return written(nodes.select("host", "pages", sprouted("shape", "pages", listed).alias("nodes")), "sprouts")


def wrappers(pages: DataFrame, longest_group: int = LONGEST_GROUP) -> DataFrame:
    """``host, wrapper`` of every host, from all its pages: shapes are merged some at a time until one is left."""
    known = outlines(pages)
    ruled = rules(known)
    parts = sprouts(known, ruled, longest_group)
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        nodes = merge(list(zip(group["pages"].tolist(), group["nodes"])))
        return pd.DataFrame({"host": [group["host"].iat[0]], "pages": [group["pages"].sum()], "nodes": [nodes]})

    while True:
        counts = written(parts.groupBy("host").agg(F.count(F.lit(1)).alias("parts")), "part-counts")
        if counts.filter("parts > 1").isEmpty():
            break
        bucket = F.pmod(F.xxhash64("nodes"), F.ceil(F.col("parts") / MERGED_PARTS)).alias("bucket")
        parts = written(
            parts.join(counts, "host").select("host", "pages", "nodes", bucket).repartition(tasks, "host", "bucket")
            .groupBy("host", "bucket").applyInPandas(merged, "host string, pages long, nodes string"),
            "parts",
        )

    @F.pandas_udf("string")
    def finish(nodes: pd.Series, rule: pd.Series) -> pd.Series:
        return pd.Series([finished(n, read_rule(r), longest_group) for n, r in zip(nodes, rule)], dtype=object)

    return parts.join(ruled, "host").select("host", finish("nodes", "rule").alias("wrapper"))


def main_text(pages: DataFrame, longest_group: int = LONGEST_GROUP) -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``."""
    names = others(pages, "html", "text", "n_chars")
    known = written(wrappers(pages, longest_group), "wrappers")
    rows = pages.select(F.struct(*quoted(names)).alias("row"), "html", host_of().alias("host"))
    joined = by_host(rows, known, "html")

    @F.pandas_udf("string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        read: dict[str, Wrapper] = {}
        for texts, rules in batches:
            out = []
            for page, rule in zip(texts, rules):
                if rule is None:
                    out.append("")
                    continue
                if rule not in read:
                    if len(read) > 1000:
                        read.clear()
                    read[rule] = Wrapper(rule)
                out.append(extract(page, read[rule]))
            yield pd.Series(out, dtype=object)

    return joined.withColumn("text", extracted("html", "wrapper")).select(
        "row.*", "text", F.char_length("text").cast("long").alias("n_chars")
    )
