"""Token streams of HTML pages and their union-free patterns: alignment, repeated and optional groups, text slots.

A page is a stream of block tags and texts; inline tags are part of the text around them.  Balanced, it is a tree:
every element is a list of items, and an item is an element or a text slot.  ``fold`` turns neighbouring repetitions,
of one item or of groups up to PERIOD items, into one repeated item; ``align`` merges two lists, where an item without
a partner becomes optional.  Merged slots point to the slot they became a part of, so the slots of any page can be
followed into a pattern (a wrapper) that its stream was aligned with.  No alternatives are ever made: patterns are
union-free.
"""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher

import xxhash

PERIOD = 4  # items of the longest repeated group
WIDEST = 150  # items of a list; longer ones keep one item for each tag and class, whatever the order
DEEPEST = 60  # levels of a tree; what lies deeper belongs to the element at that depth
LINKED = 0.8  # share of a text inside links that makes it a link slot
# Fixed lists of HTML: elements that begin a block, those whose content is no text, and those that close one another.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul caption".split())
SKIPPED = frozenset("script style noscript template title iframe svg object canvas audio video select textarea button datalist head".split())
RAW = "script|style|textarea|title|iframe|noscript|template"
EMPTY = frozenset("hr br img input meta link source area base col embed track wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
HELD_BY = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "tbody": {"table"}, "tfoot": {"table"}}
#: Elements that repeat whatever they hold.
ITEMS = frozenset("p li dt dd tr td th h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"""<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_PARAGRAPH, _OTHERS, _HEAD = frozenset(["p"]), BLOCKS - {"p"}, frozenset(["head"])


class Slot:
    """A text slot with what its texts have in common over pages."""

    __slots__ = ("kind", "many", "opt", "up", "n", "chars", "linked", "low", "high", "at")

    def __init__(self, kind="#", many=False, opt=False, n=0, chars=0, linked=0, low=None, high=None):
        self.kind, self.many, self.opt, self.up, self.at = kind, many, opt, None, None
        self.n, self.chars, self.linked, self.low, self.high = n, chars, linked, low, high

    def root(self) -> Slot:
        at = self
        while at.up is not None:
            at = at.up
        return at

    key = property(lambda self: self.kind)

    def absorb(self, other: Slot) -> None:
        other.up = self
        self.many, self.opt = self.many or other.many, self.opt or other.opt
        self.n, self.chars, self.linked = self.n + other.n, self.chars + other.chars, self.linked + other.linked
        if other.low is not None:
            self.low = other.low if self.low is None else min(self.low, other.low)
            self.high = other.high if self.high is None else max(self.high, other.high)

    def shape(self) -> str:
        return self.kind


class Element:
    """An element with its items, or a repeated group of items (tag ``()``)."""

    __slots__ = ("key", "many", "opt", "items")

    def __init__(self, key, many=False, opt=False, items=()):
        self.key, self.many, self.opt, self.items = key, many, opt, list(items)

    def absorb(self, other: Element) -> None:
        self.many, self.opt = self.many or other.many, self.opt or other.opt
        self.items = align(self.items, other.items)

    def shape(self) -> str:
        return f"{self.key}[{','.join(i.shape() for i in self.items)}]"


def tag(key: str) -> str:
    return key.split(".", 1)[0]


def same(x, y) -> bool:
    """Whether neighbours repeat: plain items by their tag, containers by what they hold."""
    return x.key == y.key and (isinstance(x, Slot) or tag(x.key) in ITEMS or x.shape() == y.shape())


def _group_key(items) -> str:
    return f"({','.join(i.key for i in items)})"


def fold(items: list) -> list:
    """Neighbouring repetitions as one repeated item, then the width bound."""
    for period in range(1, PERIOD + 1):
        if len(items) < 2 * period and period > 1:
            break
        out, i = [], 0
        while i < len(items):
            if period == 1:
                if out and same(out[-1], items[i]):
                    out[-1].absorb(items[i])
                    out[-1].many = True
                else:
                    out.append(items[i])
                i += 1
                continue
            part = items[i:i + period]
            if len(part) == period and out and out[-1].key == _group_key(part):
                out[-1].items = align(out[-1].items, part)
                i += period
            elif len(part) == period and [x.key for x in part] == [x.key for x in items[i + period:i + 2 * period]]:
                out.append(Element(_group_key(part), True, False, part))
                i += period
            else:
                out.append(items[i])
                i += 1
        items = out
    return _narrowed(items)


def _narrowed(items: list) -> list:
    """Within WIDEST: one item for each tag and class, then for each tag, in the order of their first ones."""
    for short in (str, tag):
        if len(items) <= WIDEST:
            break
        flat = []
        for x in items:
            parts = x.items if x.key.startswith("(") else [x]
            for part in parts:
                part.many = part.many or part is not x
            flat += parts
        first: dict = {}
        for x in flat:
            held = first.setdefault(short(x.key), x)
            if held is not x:
                held.absorb(x)
                held.many = held.opt = True
        items = list(first.values())
    return items


def _optional(items: list) -> list:
    for x in items:
        x.opt = True
    return items


def _paired(xs: list, ys: list, name) -> list:
    """Blocks of (equal, xs, ys)."""
    a, b = [name(x) for x in xs], [name(y) for y in ys]
    if a == b:
        return [(True, xs, ys)]
    return [(op == "equal", xs[i:j], ys[k:m]) for op, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes()]


def align(xs: list, ys: list) -> list:
    """One list for both: equal items merge, first those of equal content, then those of equal tag; others are optional."""
    if len(xs) == len(ys) == 1 and xs[0].key == ys[0].key:
        xs[0].absorb(ys[0])
        return xs
    out = []
    for equal, some, others in _paired(xs, ys, lambda x: x.shape()):
        for merge, left, right in [(True, some, others)] if equal else _paired(some, others, lambda x: x.key):
            if merge:
                for x, y in zip(left, right):
                    x.absorb(y)
                out += left
            else:
                out += _optional(left) + _optional(right)
    return fold(out)


def slots(items: list) -> list[Slot]:
    out = []
    for x in items:
        out += [x] if isinstance(x, Slot) else slots(x.items)
    return out


def dump(items: list, stats: bool = False) -> list:
    return [[x.kind, x.many, x.opt] + ([x.n, x.chars, x.linked, x.low, x.high] if stats else []) if isinstance(x, Slot)
            else [x.key, x.many, x.opt, dump(x.items, stats)] for x in items]


def load(data: list) -> list:
    return [Slot(*d) if d[0] in ("#", "@") else Element(d[0], d[1], d[2], load(d[3])) for d in data]


def pattern(items: list) -> str:
    """The regular expression that the items stand for."""
    out = ""
    for x in items:
        if isinstance(x, Slot):
            inner = "#TEXT" if x.kind == "#" else "#LINKS"
        elif x.key.startswith("("):
            inner = f"({pattern(x.items)})"
        else:
            inner = f"<{x.key}>{pattern(x.items)}</{tag(x.key)}>"
        mark = {(False, False): "", (False, True): "?", (True, False): "+", (True, True): "*"}[x.many, x.opt]
        out += f"({inner}){mark}" if mark and not inner.startswith("(") else inner + mark
    return out


def _element_key(name: str, attributes: str) -> tuple[str, bool]:
    """Tag with the words of class, id and role; and whether the element is hidden."""
    if not attributes or attributes.isspace():
        return name, False
    found, hidden = set(), False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            found.update(w.lower() for w in _WORDS.findall(html.unescape(value)))
        elif key == "hidden" or key == "style" and _HIDDEN.search(value):
            hidden = True
    return ".".join([name, *sorted(found)]), hidden


class Page:
    """The folded stream of one page and its blocks of text, each with its slot."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[Slot, str]] = []
        self.items: list = []
        # Open elements: (tag, items, whether text in it is skipped).  Inline elements only while they skip.
        self.stack: list[tuple[str, list, bool]] = [("", self.items, False)]
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self.linked = self.link = 0
        self._read(source)
        self.items = self._folded(self.items)
        self.slots = slots(self.items)
        for i, slot in enumerate(self.slots):
            slot.at = i

    def _folded(self, items: list) -> list:
        for x in items:
            if isinstance(x, Element):
                x.items = self._folded(x.items)
        return fold([x for x in items if isinstance(x, Slot) or x.items])

    def _text(self, part: str) -> None:
        if part and not self.stack[-1][2]:
            part = html.unescape(part) if "&" in part else part
            self.texts.append(part)
            if self.link:
                self.linked += len(part)

    def _flush(self) -> None:
        """Ends a block."""
        if self.texts:
            joined = "".join(self.texts)
            text = " ".join(joined.split())
            if text:
                linked = min(len(text), self.linked)
                slot = Slot("@" if linked >= LINKED * len(text) else "#", n=1, chars=len(text), linked=linked)
                self.stack[-1][1].append(slot)
                self.blocks.append((slot, text))
            self.texts = []
        self.linked = 0

    def _close(self, to: int) -> None:
        self._flush()
        del self.stack[to:]

    def _find(self, names, held=()) -> int | None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                return i
            if self.stack[i][0] in held:
                return None
        return None

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name == "a":
            self.link = 1
        block = name in BLOCKS
        if block:
            at = self._find(CLOSED_BY[name], HELD_BY[name]) if name in CLOSED_BY else None
            # A paragraph ends at any block; in a list or table only its own one.
            at = self._find(_PARAGRAPH, _OTHERS) if at is None else at
            at = self._find(_HEAD) if at is None else at
            if at is not None:
                self._close(at)
            self._flush()
        if name in EMPTY or attributes.endswith("/") and not block:
            return
        if not block and name not in SKIPPED and "hidden" not in attributes and "none" not in attributes:
            return
        key, hidden = _element_key(name, attributes)
        skip = self.stack[-1][2] or hidden or name in SKIPPED
        if not block and not skip:
            return
        items = self.stack[-1][1]
        if block and len(self.stack) < DEEPEST:
            element = Element(key)
            items.append(element)
            items = element.items
        self.stack.append((name, items, skip))

    def _read(self, source: str) -> None:
        end = 0
        for m in _TOKEN.finditer(source):
            if m.start() > end:
                self._text(source[end:m.start()])
            end = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if not m["end"]:
                self._open(name, m["rest"])
                continue
            block = name in BLOCKS
            if block:
                self._flush()
            if block or name == "a":
                self.link = 0
            at = self._find({name}, HELD_BY.get(name, ()))
            if at is not None and any(s[0] in BLOCKS for s in self.stack[at:]):
                self._close(at)
            elif at is not None:  # inline: the block goes on behind it
                del self.stack[at:]
        self._text(source[end:])
        self._flush()

    def skeleton(self) -> str:
        return json.dumps(dump(self.items), separators=(",", ":"))

    def facts(self) -> list[tuple[int, int, int]]:
        """(characters, characters inside links, hash of the texts) of each slot."""
        texts: list[list[str]] = [[] for _ in self.slots]
        for slot, text in self.blocks:
            texts[slot.root().at].append(text)
        return [(s.chars, s.linked, xxhash.xxh3_64_intdigest("\n".join(t)) - (1 << 63)) for s, t in zip(self.slots, texts)]
