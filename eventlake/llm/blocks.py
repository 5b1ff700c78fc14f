"""Cutting a page into leaf blocks of text with the path of tags above each."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

#: Elements that begin a block of their own (fixed values of the HTML standard).
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol optgroup option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text of the page.
RAW_TAGS = frozenset("script style template textarea".split())
#: Elements that end an open one of the same kind.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: What begins a tag, a comment or another declaration.
OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
#: What ends a tag or hides its end.
BORDER = re.compile(r"[>\"']")
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
SPLIT = re.compile(r"[^a-zA-Z]+")


class Path:
    """The steps above a block, as the last of them and the path before it, which blocks share; so a block at any depth takes one step more."""

    __slots__ = ("above", "step", "notes")

    def __init__(self, above: Path | None, step: str):
        self.above, self.step = above, step
        #: What a reader found out about this path.
        self.notes: dict = {}

    @classmethod
    def of(cls, steps: Iterable[str]) -> Path | None:
        path = None
        for step in steps:
            path = cls(path, step)
        return path

    def noted(self, key: str, own: Callable, first):
        """The value of a path from the value of the path before it and the last step, worked out once for each path."""
        way, node = [], self
        while node is not None and key not in node.notes:
            way.append(node)
            node = node.above
        value = first if node is None else node.notes[key]
        for node in reversed(way):
            value = node.notes[key] = own(value, node)
        return value


@dataclass(slots=True)
class Block:
    text: str
    way: Path | None
    #: Share of the characters inside links.
    linked: float

    @property
    def path(self) -> tuple[str, ...]:
        steps, node = [], self.way
        while node is not None:
            steps.append(node.step)
            node = node.above
        return tuple(reversed(steps))


def packed(blocks: list[Block]) -> tuple[list, list]:
    """Blocks as plain lists, shared paths once: (number of the path before or -1, step) and (text, number of its path, linked)."""
    numbers: dict[int, int] = {}
    paths: list[tuple[int, str]] = []

    def number(path: Path | None) -> int:
        way = []
        while path is not None and id(path) not in numbers:
            way.append(path)
            path = path.above
        before = -1 if path is None else numbers[id(path)]
        for node in reversed(way):
            paths.append((before, node.step))
            before = numbers[id(node)] = len(paths) - 1
        return before

    return paths, [(b.text, number(b.way), b.linked) for b in blocks]  # the blocks keep their paths alive, so ids stay theirs


def unpacked(paths: list, rows: list) -> list[Block]:
    known: list[Path] = []
    for before, step in paths:
        known.append(Path(None if before < 0 else known[before], step))
    return [Block(text, None if at < 0 else known[at], linked) for text, at, linked in rows]


def names_of(attributes: str) -> tuple[str, ...]:
    found = []
    for match in NAMES.finditer(attributes):
        found += [n.lower() for n in SPLIT.split(match[1] or match[2] or match[3] or "") if n]
    return tuple(found)


def step(tag: str, attributes: str) -> str:
    """One step of a path: the tag and the words of its class, id and role."""
    return " ".join((tag, *names_of(attributes))) if attributes else tag


class Cursor:
    """Goes through a page tag by tag, in time that grows with the length of the page, however broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.last_end = page.rfind(">")
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        #: Quotes hide the end of a tag, until a tag has no end outside of them.
        self.quotes = True

    def end_of_tag(self, at: int) -> int:
        """The place of the `>` that ends a tag whose name ends at `at`; -1 if there is none."""
        if at > self.last_end:
            return -1
        place = at
        while self.quotes:
            border = BORDER.search(self.page, place)
            if border is None:
                self.quotes = False
            elif border[0] == ">":
                return border.start()
            else:
                # A quote that is never closed is a character like others.
                closed = border.start() < self.last_quote[border[0]]
                place = 1 + (self.page.find(border[0], border.end()) if closed else border.start())
        return self.page.find(">", at)

    def tags(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, closing, name, attributes) of each tag; comments and declarations have no name.

        The reader may send the place to go on from, behind the content of a script.
        """
        page, at = self.page, 0
        while match := OPENING.search(page, at):
            start = match.start()
            if match[1]:
                found = page.find("-->", match.end())
                at = len(page) if found < 0 else found + 3
            else:
                found = self.end_of_tag(match.end()) if match[4] else page.find(">", match.end()) if match.end() <= self.last_end else -1
                if found < 0:
                    at = match.end()  # no tag
                    continue
                at = found + 1
            name = (match[4] or "").lower()
            sent = yield start, at, bool(match[3]), name, page[match.end() : at - 1] if name else ""
            at = at if sent is None else sent


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of text of a page in order; empty ones are left out."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, Path]] = []
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    links = 0
    at = 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            size = len(text)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append(Block(text, stack[-1][1] if stack else None, min(1.0, linked / size)))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text)

    def pop() -> str:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        return tag

    tags = Cursor(page).tags()
    found = next(tags, None)
    while found is not None:
        start, end, closing, tag, attributes = found
        add(page[at:start])
        at = end
        go_on = None
        if not tag:
            pass
        elif closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK_TAGS:
                end_block()
                if open_tags[tag]:
                    while pop() != tag:
                        pass
        elif tag in RAW_TAGS and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = go_on = close.end() if close else len(page)
            parts.append(" ") if parts else None
        elif tag in BLOCK_TAGS:
            end_block()
            links = 0
            if stack and stack[-1][0] == "p" and tag not in ("button", "label", "noscript", "option", "select"):
                pop()
            while stack and stack[-1][0] in SELF_CLOSING.get(tag, ()):
                pop()
            if tag not in VOID_TAGS:
                stack.append((tag, Path(stack[-1][1] if stack else None, step(tag, attributes))))
                open_tags[tag] += 1
        elif tag == "br" or tag == "img" or tag == "input":
            if parts:
                parts.append(" ")
        elif tag == "a":
            links += 1
        try:
            found = tags.send(go_on)
        except StopIteration:
            break
    add(page[at:])
    end_block()
    return blocks
