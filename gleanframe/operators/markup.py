"""Per-page helper of the extraction job: one pass over the HTML, rules as data.

Runs inside an Arrow UDF. It only finds text and attributes; what they mean is
decided by Column expressions in ``extract``. Unclosed and stray tags are
tolerated; attributes are read only for tags some rule mentions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa

# a comment, a declaration, an element with raw text, an end tag, or a start tag;
# text is what lies between tokens
_TOKEN = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)
      |[!?][^>]*+>
      |(?P<raw>script|style|title|textarea)(?=[\s/>])(?P<raw_attrs>[^>]*+)>(?P<body>.*?)(?:</(?P=raw)[^>]*+>|\Z)
      |/(?P<end>[A-Za-z][^\s/>]*+)[^>]*+>
      |(?P<start>[A-Za-z][^\s/>]*+)
       (?P<attrs>(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+|[^>]*+)>)""",
    re.S | re.X | re.I,
)
_ATTR = re.compile(r"""([^\s=/>"'][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_COMPOUND = re.compile(r"([a-z0-9]*)((?:\.[^.\[]+)*)(?:\[([\w-]+)='([^']*)'\])?")

# Fixed values of HTML: elements without content, elements whose text is no page
# text, which start tags end an open element, and how strongly elements nest
# (an end tag does not reach past an element of higher rank).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNREAD = ("script", "style")
_ENDED_BY = {
    "p": frozenset(
        "address blockquote body caption center dd dir div dl dt h1 h2 h3 h4 h5 h6 "
        "hr li menu ol p pre table tbody td tfoot th tr ul".split()
    ),
    "b": frozenset("center p td th".split()),
    "a": frozenset("a fieldset table td th".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "td": frozenset("td th tr tbody tfoot".split()),
    "th": frozenset("td th tr tbody tfoot".split()),
    "tr": frozenset("tr tbody tfoot".split()),
}
_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "tbody": 180, "table": 190, "body": 200, "html": 220}


@dataclass(frozen=True)
class Pick:
    """Text (or one attribute) of the first or of all elements a selector finds.

    Selectors are ``tag.class.class[name='value']`` steps, joined by blanks
    meaning "somewhere inside".
    """

    selector: str
    attr: str | None = None
    many: bool = False


@dataclass(frozen=True)
class PageRules:
    """Named picks, plus card grids given by words their class text must contain."""

    picks: dict[str, Pick]
    grids: dict[str, tuple[str, ...]] = field(default_factory=dict)


def _steps(selector: str) -> list[tuple]:
    steps = []
    for part in selector.split():
        tag, classes, name, value = _COMPOUND.fullmatch(part).groups()
        steps.append((tag, frozenset(classes.split(".")[1:]), name, value))
    return steps


class _Element:
    """An open element: what it is, what to do when it closes, the grids it is."""

    __slots__ = ("tag", "attrs", "classes", "on_close", "grids")

    def __init__(self, tag: str, attrs: dict[str, str], classes: list[str]):
        self.tag = tag
        self.attrs = attrs
        self.on_close = []
        self.grids = ()
        self.classes = classes

    def fits(self, step: tuple) -> bool:
        tag, classes, name, value = step
        return (
            (not tag or tag == self.tag)
            and classes.issubset(self.classes)
            and (name is None or self.attrs.get(name) == value)
        )


class _Card:
    """A direct ``div`` of a grid: texts of its first paragraph and of a span in it."""

    __slots__ = ("grid", "text", "value", "first", "in_p", "in_first")

    def __init__(self, grid: str):
        self.grid, self.text, self.value, self.first = grid, None, None, None
        self.in_p = self.in_first = False

    def note_first(self, piece: str, element: _Element | None = None) -> None:
        """Keep what stands first in the paragraph: a text, or an element as markup."""
        if self.in_first:
            self.first.append(piece)
        elif self.in_p and self.first is None:
            self.first = [piece]
            if element is not None:
                self.in_first = True
                element.on_close.append(lambda: setattr(self, "in_first", False))


#: Pages whose fields are held as Python objects at a time.
PAGES_AT_ONCE = 200
#: Attribute texts that a reader keeps parsed, and how long they may be; templates repeat them.
KEPT_ATTRS, KEPT_LENGTH = 2000, 200
#: Name of the field that says why a page could not be read to its end.
READ_ERROR = "read_error"


class PageReader:
    """Reads pages by one rule set; make one per task and call ``read`` per page."""

    def __init__(self, rules: PageRules):
        self._rules = rules
        picks = [(name, pick, _steps(pick.selector)) for name, pick in rules.picks.items()]
        tags = {step[0] for _, _, steps in picks for step in steps}
        self._any_tag = [entry for entry in picks if not entry[2][-1][0]]
        self._by_tag = {tag: [entry for entry in picks if entry[2][-1][0] in ("", tag)] for tag in tags}
        self._with_attrs = None if "" in tags else tags | ({"div"} if rules.grids else set())

        self._parsed: dict[str, tuple[dict[str, str], list[str]]] = {}

    def attributes(self, text: str) -> tuple[dict[str, str], list[str]]:
        """Attributes and classes that a tag's text gives; shared, so not to be changed."""
        if (known := self._parsed.get(text)) is not None:
            return known
        attrs: dict[str, str] = {}
        for name, double, single, bare in _ATTR.findall(text):
            attrs.setdefault(name.lower(), unescape(double or single or bare))
        known = attrs, attrs["class"].split() if "class" in attrs else []
        if len(text) <= KEPT_LENGTH:
            if len(self._parsed) >= KEPT_ATTRS:
                self._parsed.clear()
            self._parsed[text] = known
        return known

    def read_all(self, htmls: pa.Array, kind: pa.DataType) -> pa.Array:
        """The fields of all pages as structs of ``kind``, ``PAGES_AT_ONCE`` pages at a time."""
        done = [pa.array([], kind)]
        for at in range(0, len(htmls), PAGES_AT_ONCE):
            done.append(pa.array([self.read(html) for html in htmls.slice(at, PAGES_AT_ONCE).to_pylist()], kind))
        return pa.concat_arrays(done)

    def read(self, html: str | None) -> dict:
        found: dict = {name: None for name in self._rules.picks}
        found.update({name: [] for name in self._rules.grids})
        found[READ_ERROR] = None
        walk = _PageWalk(self, found)
        try:
            walk.run(html or "")
        except Exception as problem:  # one broken page must not fail the task
            found.update(dict.fromkeys(walk.reading))
            found[READ_ERROR] = f"{type(problem).__name__}: {problem}"[:200]
        return found


class _PageWalk:
    """State of reading one page: open elements, open texts, open cards."""

    def __init__(self, reader: PageReader, found: dict):
        self.reader, self.found = reader, found
        self.grids = dict(reader._rules.grids)
        self.stack: list[_Element] = []
        self.texts: list[list[str]] = []
        self.cards: list[_Card] = []
        self.reading: list[str] = []

    def run(self, html: str) -> None:
        position = 0
        for token in _TOKEN.finditer(html):
            start = token.start()
            if start > position and self.texts:
                self.take_text(unescape(html[position:start]))
            position = token.end()
            kind = token.lastgroup
            if kind == "end":
                self.end(token["end"].lower())
            elif kind == "attrs":
                tag, attrs = token.group("start", "attrs")
                tag = tag.lower()
                self.open(tag, attrs, token)
                if tag in _VOID or attrs.endswith("/"):
                    self.close_to(len(self.stack) - 1)
            elif kind == "body":
                tag = token["raw"].lower()
                self.open(tag, token["raw_attrs"], token)
                if tag not in _UNREAD and self.texts:
                    self.take_text(unescape(token["body"]))
                self.close_to(len(self.stack) - 1)
            elif kind == "comment":
                for card in self.cards:
                    card.note_first(token["comment"])
        if position < len(html) and self.texts:
            self.take_text(unescape(html[position:]))
        self.close_to(0)

    def take_text(self, text: str) -> None:
        stripped = text.strip()
        for parts in self.texts:
            parts.append(stripped)
        for card in self.cards:
            card.note_first(text)

    def close_to(self, depth: int) -> None:
        stack = self.stack
        while len(stack) > depth:
            on_close = stack.pop().on_close
            while on_close:
                on_close.pop()()

    def end(self, tag: str) -> None:
        for card in self.cards:
            if card.in_first:
                card.first.append(f"</{tag}>")
        stack = self.stack
        if stack and stack[-1].tag == tag:  # most often
            on_close = stack.pop().on_close
            while on_close:
                on_close.pop()()
            return
        rank = _RANK.get(tag, 100)
        for depth in range(len(stack) - 1, -1, -1):
            open_tag = stack[depth].tag
            if open_tag == tag:
                self.close_to(depth)
                return
            if _RANK.get(open_tag, 100) > rank:
                return

    def open(self, tag: str, attr_text: str, token: re.Match) -> None:
        stack, reader = self.stack, self.reader
        while stack and stack[-1].tag in _ENDED_BY and tag in _ENDED_BY[stack[-1].tag]:
            self.close_to(len(stack) - 1)
        if attr_text and (reader._with_attrs is None or tag in reader._with_attrs):
            element = _Element(tag, *reader.attributes(attr_text))
        else:
            element = _Element(tag, {}, [])
        parent = stack[-1] if stack else None
        stack.append(element)
        for name, pick, steps in reader._by_tag.get(tag, reader._any_tag):
            if (pick.many or self.found[name] is None) and element.fits(steps[-1]) and self.inside(steps):
                self.pick(name, pick, element)
        if tag == "div" and (self.grids or parent and parent.grids):
            self.open_div(element, parent)
        elif self.cards:
            for card in self.cards:
                if tag == "p" and card.text is None:
                    card.text, card.in_p = self.listen(element), True
                    element.on_close.append(lambda card=card: setattr(card, "in_p", False))
                    continue
                if tag == "span" and card.value is None and card.in_p:
                    card.value = self.listen(element)
                card.note_first(token[0], element)

    def inside(self, steps: list[tuple]) -> bool:
        """Do the open elements satisfy all steps before the last."""
        wanted = len(steps) - 1
        for ancestor in reversed(self.stack[:-1]):
            if not wanted:
                break
            if ancestor.fits(steps[wanted - 1]):
                wanted -= 1
        return not wanted

    def pick(self, name: str, pick: Pick, element: _Element) -> None:
        found = self.found
        if pick.attr is not None:
            value = element.attrs.get(pick.attr)
            if not pick.many:
                found[name] = (value or "").strip()
            elif value:
                found[name] = [*(found[name] or []), value]
            return
        parts = self.listen(element)
        if pick.many:
            target = found[name] = found[name] or []
            slot = len(target)
            target.append("")
        else:
            target, slot = found, name
            found[name] = ""
        self.reading.append(name)

        def finish() -> None:
            target[slot] = "".join(parts)
            self.reading.remove(name)

        element.on_close.append(finish)

    def listen(self, element: _Element) -> list[str]:
        """Collect the stripped texts inside the element until it closes."""
        parts: list[str] = []
        self.texts.append(parts)

        def stop() -> None:
            self.texts = [other for other in self.texts if other is not parts]

        element.on_close.append(stop)
        return parts

    def open_div(self, element: _Element, parent: _Element | None) -> None:
        class_text = " ".join(element.classes)
        for name, words in list(self.grids.items()) if class_text else ():
            if all([word in class_text for word in words]):
                del self.grids[name]  # only the first such element counts
                element.grids = (*element.grids, name)
        for name in parent.grids if parent else ():
            card = _Card(name)
            self.cards.append(card)
            element.on_close.append(lambda card=card: self.close_card(card))

    def close_card(self, card: _Card) -> None:
        self.cards = [other for other in self.cards if other is not card]
        if card.text is not None:
            self.found[card.grid].append(
                {
                    "first": "".join(card.first or ()),
                    "value": None if card.value is None else "".join(card.value),
                    "text": "".join(card.text),
                }
            )
