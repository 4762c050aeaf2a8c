"""Names and the literals they get, read from source code and configuration of any common syntax.

The text is read once into tokens: strings, names, signs, brackets, lines and tags. A stack
holds what is open: bracketed values, blocks by indent, sections and elements. So a literal
has its own name and those of all it stands in.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

STRING = r"""\"\"\"(?:[^\\"]|\\.|"(?!""))*+\"\"\"|'''(?:[^\\']|\\.|'(?!''))*+'''|"(?:[^"\\\n]|\\.)*+"|(?:(?<!\w)|(?<=\W[bBrRuUfF]))'(?:[^'\\\n]|\\.)*+'(?!\w)|`[^`\n]*+`"""
TOKEN = re.compile(
    rf"""(?P<string>{STRING})"""
    r"""|(?P<end></[A-Za-z_][\w.:-]*+\s*+>)"""
    r"""|(?P<tag><[A-Za-z_][\w.:-]*+(?:\s++[\w.:-]++\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'))*+\s*+/?>)"""
    r"""|(?P<line>\n[\x20\t\r]*+(?:-[\x20\t]++)*+)"""
    r"""|(?P<name>(?<![\w.$-])[A-Za-z_$][\w.$-]*+)"""
    r"""|(?P<test>[=!<>]=++)"""
    r"""|(?P<sign>:=|=>|=|:(?!:))"""
    r"""|(?P<open>[\[{(])|(?P<close>[\]})])|(?P<stop>[,;])|(?P<plus>\+)""",
    re.DOTALL,
)
#: A value without quotes, with the scheme of a header before it.
BARE = re.compile(r"[\x20\t]*+(?:(?i:bearer|basic|digest)[\x20\t]++)?([\w+/=.$@!%*#~^-]++)(?![\w\x20\t]*+[(\[])")
#: The lines of a YAML block scalar, deeper than its key.
BLOCK = re.compile(r"[\x20\t]*+[|>][+-]?[\x20\t]*+\n")
SECTION = re.compile(r"""\[{1,2}([\w."'\x20:-]++)\]{1,2}[\x20\t\r]*+(?=\n|\Z)""")
ATTRIBUTE = re.compile(r"""([\w.:-]++)\s*+=\s*+("[^"<]*+"|'[^'<]*+')""")
ELEMENT_TEXT = re.compile(r"\s*+([^<>\s](?:[^<>]*[^<>\s])?)\s*+(?=</)")
#: An option of a command line and its value.
OPTION = re.compile(r"(?<!\S)--?([A-Za-z][\w-]*+)[\x20\t]++(?!-)([\w+/=.$@!%*#~^-]++)")

CLOSERS = {"[": "]", "{": "}", "(": ")"}
#: Calls whose literal argument is a key to look up, not a value.
LOOKUPS = frozenset("getenv get environ env getproperty getstring getvalue lookup find fetch read load input prompt getpass require import config open print log printf format t".split())
#: Calls that give their second argument to the name in their first.
SETTERS = frozenset("set put define add setenv setproperty setheader header append insert export env addheader withheader setdefault putstring config setattr setattribute".split())
#: Attributes that hold a name, and those that hold its value.
NAMED, VALUED = ("name", "key", "id", "property"), ("value", "content", "default")


def quotes(text: str) -> int:
    """How many quote characters a string opens with."""
    return 3 if len(text) >= 6 and text[:3] in ('"""', "'''") else 1


@dataclass
class Pairs:
    """What was read: literals and constants by target, and how sensitive each target is."""

    literals: dict[str, set[tuple[int, int, bool]]] = field(default_factory=lambda: defaultdict(set))
    uses: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))  # constant -> targets
    scores: dict[str, float] = field(default_factory=dict)


@dataclass(slots=True)
class Frame:
    """Something open: a bracket, a block by indent, a section or an element."""

    kind: str
    target: str = ""
    score: float = 0.0
    indent: int = -1
    setter: bool = False
    key: str = ""  # the first argument of a setter


class Reader:
    """One reading of a text; ``score`` says how sensitive a name is, ``apart`` which take nothing from their container."""

    def __init__(self, text: str, pairs: Pairs, score: Callable[[str], float], apart: Callable[[str], bool]):
        self.text, self.pairs, self.score, self.apart = text, pairs, score, apart
        self.frames = [Frame("top")]
        self.open: dict[str, int] = defaultdict(int)
        self.brackets = 0
        self.last = ""  # what a sign would make a name
        self.last_end = -1
        self.pending: tuple[str, float] | None = None  # the target whose value comes next
        self.given: tuple[str, float] | None = None  # the target whose value may go on
        self.callee = ""
        self.indent = 0

    def target(self, own: str) -> tuple[str, float]:
        """The target of a name here: a plain name takes the score of what it stands in."""
        score, top = self.score(own), self.frames[-1]
        if score or not top.score or self.apart(own):
            return own, score
        return f"{top.target}/{own}", 0.9 * top.score

    def put(self, to: tuple[str, float], start: int, end: int, quoted: bool) -> None:
        name, score = to
        self.pairs.literals[name].add((start, end, quoted))
        self.pairs.scores[name] = max(score, self.pairs.scores.get(name, 0.0))

    def use(self, to: tuple[str, float], constant: str) -> None:
        self.pairs.uses[constant].add(to[0])
        self.pairs.scores[to[0]] = max(to[1], self.pairs.scores.get(to[0], 0.0))

    def push(self, frame: Frame) -> None:
        self.frames.append(frame)
        self.open[frame.kind] += 1
        self.brackets += frame.kind in ")]}"

    def pop(self) -> Frame:
        frame = self.frames.pop()
        self.open[frame.kind] -= 1
        self.brackets -= frame.kind in ")]}"
        return frame

    def pop_to(self, kind: str) -> None:
        """Close the innermost frame of a kind and all inside it; nothing without one."""
        while self.open[kind] and self.pop().kind != kind:
            pass

    def rest(self) -> None:
        self.last, self.pending, self.given, self.callee = "", None, None, ""

    # one method a token

    def string(self, m: re.Match) -> None:
        width = quotes(m[0])
        start, end = m.start() + width, m.end() - width
        top = self.frames[-1]
        to = self.pending
        if to is None and self.callee and self.last_end == m.start():
            to = self.given  # the name was a prefix of the string
        elif to is None and top.setter and top.key:
            to = self.target(top.key)
        elif to is None and top.kind in ")]" and top.score and not top.setter:
            to = (top.target, top.score)
        if to is not None:
            self.put(to, start, end, True)
            self.given, self.pending = to, None
        self.last, self.last_end, self.callee = self.text[start:end] if end - start <= 200 else "", m.end(), ""

    def name(self, m: re.Match) -> None:
        top = self.frames[-1]
        to = self.pending
        if to is None and top.kind in ")]" and top.score and not top.setter:
            to = (top.target, top.score)
        if to is not None:
            self.use(to, m[0].lstrip("$"))
            self.given, self.pending = to, None
            self.callee = m[0]
        else:
            self.callee = ""
        self.last, self.last_end = m[0], m.end()

    def sign(self, m: re.Match) -> None:
        if not self.last or self.text[self.last_end : m.start()].strip("\x20\t]"):
            self.rest()
            return
        to = self.target(self.last)
        self.rest()
        self.pending = to
        if to[1] == 0.0 and not self.frames[-1].score:
            return  # its literals are read by plain pairs
        block = BLOCK.match(self.text, m.end()) if not self.brackets else None
        if block:
            self.block(to, block.end())
        bare = BARE.match(self.text, m.end())
        if bare:
            self.put(to, bare.start(1), bare.end(1), False)

    def block(self, to: tuple[str, float], start: int) -> None:
        """The lines of a block scalar as one literal."""
        at = end = start
        while at < len(self.text):
            stop = self.text.find("\n", at)
            stop = len(self.text) if stop < 0 else stop
            line = self.text[at:stop]
            if line.strip() and len(line) - len(line.lstrip("\x20\t")) <= self.indent:
                break
            end, at = (stop if line.strip() else end), stop + 1
        while start < end and self.text[start] in "\x20\t\n":
            start += 1
        if start < end:
            self.put(to, start, end, True)

    def test(self, m: re.Match) -> None:
        self.rest()

    def stop(self, m: re.Match) -> None:
        top = self.frames[-1]
        if top.setter and not top.key:
            top.key = self.last
        self.rest()

    def plus(self, m: re.Match) -> None:
        self.pending, self.last = self.given, ""

    def opening(self, m: re.Match) -> None:
        closer, top = CLOSERS[m[0]], self.frames[-1]
        adjacent = self.last_end == m.start()
        word = re.split(r"[.$]", self.last)[-1].lower().replace("_", "")
        if self.pending is not None:
            frame = Frame(closer, *self.pending)
        elif self.callee and adjacent and self.given is not None:
            passes = m[0] == "(" and word not in LOOKUPS
            frame = Frame(closer, self.given[0], 0.9 * self.given[1]) if passes else Frame(closer)
            self.pairs.uses[self.last.lstrip("$")].discard(self.given[0])
        elif self.last and adjacent and m[0] == "(":
            own = self.score(self.last) if word.startswith(("set", "with", "use")) else 0.0
            frame = Frame(closer, self.last, own, setter=word in SETTERS)
        elif adjacent and m[0] == "[":
            frame = Frame(closer)  # a subscript
        else:
            frame = Frame(closer, top.target, top.score)
        self.push(frame)
        self.rest()

    def closing(self, m: re.Match) -> None:
        given = self.given
        self.pop_to(m[0])
        if m[0] != "]" or not self.last:
            self.last = ""
        self.last_end = m.end() if self.last else self.last_end
        self.pending, self.given, self.callee = None, given, ""

    def line(self, m: re.Match) -> None:
        if self.brackets:
            return
        after = self.text[m.end() : m.end() + 1]
        if after in ("\n", ""):
            return
        lead = m[0][1:]
        dashed = "-" in lead
        indent = len(lead[: lead.index("-")] if dashed else lead)
        if self.pending is not None and (indent > self.indent or (dashed and indent == self.indent)):
            self.push(Frame("block", *self.pending, indent=self.indent))
        while self.frames[-1].kind == "block" and (indent < self.frames[-1].indent or (indent == self.frames[-1].indent and not dashed)):
            self.pop()
        self.rest()
        self.indent = len(lead)
        top = self.frames[-1]
        if dashed and top.kind == "block" and top.score:
            item = BARE.match(self.text, m.end())
            if item and self.text[item.end() : item.end() + 1] in ("", "\n", "\r", "\x20"):
                self.put((top.target, top.score), item.start(1), item.end(1), False)
            self.pending = (top.target, top.score) if after in "\"'" and not self.is_key(m.end()) else None
        elif after == "[":
            self.section(m.end())

    def is_key(self, at: int) -> bool:
        string = TOKEN.match(self.text, at)
        return bool(string and string["string"] and self.text[string.end() : string.end() + 1] == ":")

    def section(self, at: int) -> None:
        """An INI section lasts up to the next one."""
        m = SECTION.match(self.text, at)
        if m and not self.brackets:
            self.pop_to("section")
            name = m[1].strip("\"' ")
            self.push(Frame("section", name, self.score(name)))

    def tag(self, m: re.Match) -> None:
        given = {a[1].lower(): (a[2][1:-1], a.start(2) + 1, a.end(2) - 1) for a in ATTRIBUTE.finditer(m[0])}
        named = next((given[n][0] for n in NAMED if n in given), "")
        for name, (_, start, end) in given.items():
            to = self.target(named if named and name in VALUED else name)
            if to[1]:
                self.put(to, m.start() + start, m.start() + end, True)
        self.rest()
        if m[0].endswith("/>"):
            return
        element = re.match(r"<([\w.:-]++)", m[0])[1]
        own = element.rsplit(":", 1)[-1]
        to = self.target(own if self.score(own) or not named else named)
        text = ELEMENT_TEXT.match(self.text, m.end())
        if text and to[1]:
            self.put(to, text.start(1), text.end(1), True)
        self.push(Frame("<" + element, *to))

    def end(self, m: re.Match) -> None:
        self.pop_to("<" + m[0][2:-1].strip())
        self.rest()

    def read(self) -> None:
        act = {k: getattr(self, k) for k in ("string", "name", "sign", "test", "stop", "plus", "line", "tag", "end")}
        act |= {"open": self.opening, "close": self.closing}
        if self.text.startswith("["):
            self.section(0)
        for m in TOKEN.finditer(self.text):
            act[m.lastgroup](m)
        for m in OPTION.finditer(self.text):
            to = (m[1], self.score(m[1]))
            if to[1]:
                self.put(to, m.start(2), m.end(2), False)


def read_pairs(text: str, pairs: Pairs, score: Callable[[str], float], apart: Callable[[str], bool]) -> None:
    """Adds the pairs of a text. Time is linear in its length; brackets that don't match close nothing."""
    Reader(text, pairs, score, apart).read()
